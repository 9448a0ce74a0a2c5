"""The stages of the corpus pipeline: each takes (session, documents, folder of the tables) and returns a frame.

All keep every column of their input as it is, whatever it is called; helper columns get names the input does not
have. Decisions go by a row's own text, so null ids, repeated ids and repeated rows are judged each for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.llm import decontaminate, mixing, secrets, simhash, toxicity
from boardlake.session import ship_package, staged


def _fresh(name: str, frame: DataFrame) -> str:
    """``name``, with underscores before it until the frame has no such column (in any case of letters)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _text(frame: DataFrame) -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold. Null and empty texts have no hits and stay."""
    ship_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _fresh("toxicity", docs)
    return toxicity.score_texts(docs, model, "text", score).filter(F.col(score) < toxicity.THRESHOLD).drop(score)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near copies: that with the smallest id (null last), of repeated rows one.

    See :func:`simhash.near_copy_groups`: fingerprints over five-word shingles at 2 or fewer differing bits propose
    links, and a link counts if the shingle sets are similar. Null and empty texts are one group.
    """
    ship_package(spark)
    key, group, rank, ident = (_fresh(name, docs) for name in ("text_key", "text_group", "text_rank", "row_ident"))
    keyed = docs.withColumn(key, F.sha2(_text(docs), 256))
    # A row's text and id as one column, so that the join and the choice among repeated rows use one and the same shuffle.
    named = F.concat(F.col(key), F.coalesce(F.concat(F.lit(":"), F.col("doc_id").cast("string")), F.lit("")))
    groups = simhash.near_copy_groups(keyed.select(F.col(key).alias("key"), _text(docs).alias("text")), width, similarity)
    groups = groups.select(F.col("key").alias(key), F.col("label").alias(group))
    # The representative is chosen on small rows: the id and the key of the text.
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("key"), named.alias("ident"))
    best = keyed.select(key, "doc_id").join(groups, key).groupBy(group).agg(F.min(order).alias(rank))
    kept = staged(best.select(F.col(f"{rank}.ident").alias(ident)), "dedup-kept")
    # Rows left with one name have one text and id: repeated rows, of which one stays.
    row = F.min(F.struct(*[F.col(c) for c in docs.columns])).alias(rank)
    return keyed.withColumn(ident, named).join(kept, ident, "left_semi").groupBy(ident).agg(row).select(F.col(f"{rank}.*"))


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    ship_package(spark)
    key = _fresh("text_key", docs)
    found = decontaminate.find_copies(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = found.select(F.col("text_key").alias(key)).distinct()
    return docs.withColumn(key, F.sha2(_text(docs), 256)).join(leaked, key, "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark and ``n_chars``, where there is one, counted anew."""
    base, spans = _fresh("secret_base", docs), _fresh("secret_spans", docs)
    found = secrets.with_spans(docs, _text(docs), base, spans)
    masked = found.withColumn("text", secrets.masked(F.col("text"), F.col(spans)))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of which it takes words, with their size in words and the words taken, repeats counted."""
    size, taken = _fresh("n_words", docs), _fresh("taken", docs)
    return mixing.with_taken(docs, size, taken).filter(F.col(taken) > 0)
