"""Spark-native reads, incremental sync, ranked search and audits for mirrored project boards."""
