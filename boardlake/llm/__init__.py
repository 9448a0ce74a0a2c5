"""Operators of a training-data pipeline: scoring, de-duplication, search, scans, mixing and archives."""
