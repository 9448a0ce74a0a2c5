"""Ranked top-k that reads only the blocks of postings which can hold a hit, and a stored dictionary of terms.

Documents are sorted by length and cut into blocks of at most ``BLOCK_DOCS``, fewer where these are long. A row of ``blocks`` is one token in one block: the documents' places
(0 to ``BLOCK_DOCS`` - 1, which Parquet stores as bit-packed differences), weighted occurrences and lengths, and beside these lists the largest
weight and the smallest length in it. With idf these bound the score of every document of the block. A search first reads the bounds alone (for a
prefix of several tokens also their lists, as a document's weight is the sum of theirs). The blocks with the best bounds give a k-th score; a block
whose bound is below it is not ranked. Results equal those of ``search.rank_matches``, cut.

``terms`` is the sorted dictionary: documents and occurrences per token. A prefix is expanded there before postings are touched, so their
scan gets whole tokens.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from boardlake.operators import search as S
from boardlake.operators.index import TextIndex, index_stats
from boardlake.operators.pieces import blocked_documents, joined_fields
from boardlake.session import staged

BLOCK_DOCS = 1024
FIRST_BLOCKS = 8  # blocks of a query read at first
SALTS = 16
EXPANDED = 1_000  # tokens of a prefix that are named to the postings scan; beyond, the prefix is


@dataclass(frozen=True)
class BlockIndex:
    """``terms``: (token, docs, hits). ``blocks``: (token, block, n, max_f, min_tokens, places, f, lengths). ``names``: (block, place, doc_id)."""

    terms: DataFrame
    blocks: DataFrame
    names: DataFrame
    totals: DataFrame


def store_blocks(index: TextIndex, path: str) -> BlockIndex:
    """Write blocks, dictionary and document numbers of an index and read them back."""
    spark = index.forward.sparkSession
    # The order is total: the range cuts documents of one length as well, so that no task gets all of them.
    order = ["doc_tokens", "salt", "doc_id"]
    salted = joined_fields(index.forward).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    ordered = salted.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "doc_tokens", "fields", F.spark_partition_id().alias("part"))
    blocked = staged(blocked_documents(ordered, BLOCK_DOCS, index.weights), "block-pieces")
    rows = blocked.filter("token IS NOT NULL").drop("docs")
    rows.repartitionByRange("token", "block").sortWithinPartitions("token", "block").write.option("parquet.writer.version", "v2").parquet(f"{path}/blocks")
    terms = spark.read.parquet(f"{path}/blocks").groupBy("token").agg(F.sum("n").alias("docs"), F.sum("hits").alias("hits"))
    terms.repartitionByRange("token").sortWithinPartitions("token").write.parquet(f"{path}/terms")
    names = blocked.filter("token IS NULL").select("block", F.posexplode("docs").alias("place", "doc_id"))
    names.repartitionByRange("block", "place").sortWithinPartitions("block", "place").write.parquet(f"{path}/names")
    index_stats(index).write.parquet(f"{path}/stats")
    return load_blocks(spark, path)


def load_blocks(spark: SparkSession, path: str) -> BlockIndex:
    return BlockIndex(*[spark.read.parquet(f"{path}/{part}") for part in ("terms", "blocks", "names", "stats")])


def _admitted(terms: list) -> Column:
    """A condition on ``token`` that the scan can push down: whole tokens, or a prefix."""
    return reduce(lambda a, b: a | b, [F.col("token").startswith(t.term) if t.is_prefix else F.col("token") == t.term for t in terms], F.lit(False))


def expand_terms(index: BlockIndex, queries: str | dict[str, str]) -> DataFrame:
    """The dictionary's tokens of every one-term word of literal queries: (word, token, docs, hits). Reads the dictionary's fitting ranges only."""
    spark = index.terms.sparkSession
    words = S.word_terms(S.keyed_words(S.parse_queries(S.query_frame(spark, queries)))).filter("n_terms = 1").collect()
    named = spark.createDataFrame([(w.word, w.term, w.is_prefix) for w in words], "word string, term string, is_prefix boolean")
    fits = F.when(F.col("is_prefix"), F.col("token").startswith(F.col("term"))).otherwise(F.col("token") == F.col("term"))
    # The words of literal queries are a handful of rows, the tokens are those some word admits.
    return index.terms.filter(_admitted(words)).join(F.broadcast(named), fits).select("word", "token", "docs", "hits")


def expanded_postings(index: TextIndex, blocks: BlockIndex, queries: str | dict[str, str]) -> DataFrame:
    """The postings that prefixes and terms of literal queries admit, found by naming the dictionary's tokens to the scan.

    A prefix of more than ``EXPANDED`` tokens is given to the scan as it is: its tokens are neighbours there.
    """
    rows = S.word_terms(S.keyed_words(S.parse_queries(S.query_frame(index.forward.sparkSession, queries)))).collect()
    admits = []
    for row in rows:
        near = blocks.terms.filter(_admitted([row])).select("token").limit(EXPANDED + 1).collect() if row.is_prefix else []
        admits.append(F.col("token").isin(*[t.token for t in near]) if row.is_prefix and len(near) <= EXPANDED else _admitted([row]))
    return index.postings.filter(reduce(lambda a, b: a | b, admits, F.lit(False)))


def _saturated(f: Column, length: Column, average: Column) -> Column:
    return f * (S.K1 + 1) / (f + S.K1 * (1 - S.B + S.B * length / average))


@dataclass(frozen=True)
class TopSearch:
    """A search in progress: ``bounds`` (query_id, block, bound) of all blocks that hold every word, ``chosen`` (query_id, block) that were read."""

    hits: DataFrame
    bounds: DataFrame
    chosen: DataFrame


def search_top(index: BlockIndex, queries: str | dict[str, str], limit: int) -> TopSearch:
    """The ``limit`` best documents of each literal query: ``hits`` (query_id, doc_id, rank), ties by id.

    For queries of one-term words (with or without prefix); a phrase needs positions, which blocks do not hold, and is an error.
    """
    spark = index.blocks.sparkSession
    parsed = S.keyed_words(S.parse_queries(S.query_frame(spark, queries))).collect()
    if any(len(w.terms) > 1 for w in parsed):
        raise ValueError("phrases are ranked from postings, see search.rank_matches")
    words = spark.createDataFrame([(w.query_id, w.n_words, w.word_no, w.word) for w in parsed], "query_id string, n_words int, word_no int, word string")
    stats = index.totals.first()
    tokens = staged(expand_terms(index, queries), "top-tokens")
    counts = {r.word: (r.n, r.docs) for r in tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("docs").alias("docs")).collect()}
    read = index.blocks.filter(_admitted([Row(term=w.terms[0], is_prefix=w.is_prefix) for w in parsed])).join(tokens.select("word", "token"), "token")
    best = read.groupBy("word", "block").agg(F.sum("max_f").alias("f"), F.min("min_tokens").alias("length"))
    # Documents of a word: from the dictionary for one token. For several they are counted block by block, since a document may hold more
    # than one, and the largest weight is that of a document with all it holds: the tokens' largest together would bound nothing.
    several = [w for w, (n, _) in counts.items() if n > 1]
    if several:
        entries = read.filter(F.col("word").isin(*several)).select("word", "block", F.explode(F.arrays_zip("places", "f", "lengths")).alias("e"))
        per_doc = entries.groupBy("word", "block", F.col("e.places").alias("place")).agg(F.sum("e.f").alias("f"), F.max("e.lengths").alias("length"))
        per_block = staged(per_doc.groupBy("word", "block").agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("f"), F.min("length").alias("length")), "top-prefixes")
        counts |= {r.word: (0, r.n) for r in per_block.groupBy("word").agg(F.sum("n").alias("n")).collect()}
        best = best.filter(~F.col("word").isin(*several)).unionByName(per_block.drop("n"))
    idf = F.ln((F.lit(float(stats.docs or 0)) - F.col("docs") + 0.5) / (F.col("docs") + 0.5))
    known = spark.createDataFrame([(w, float(n)) for w, (_, n) in counts.items()], "word string, docs double")
    weighed = words.join(known, "word").select("query_id", "n_words", "word_no", "word", F.when(idf > 0, idf).otherwise(F.lit(S.IDF_FLOOR)).alias("idf"))
    weighed = spark.createDataFrame(weighed.collect(), weighed.schema)  # a row per word of the literal queries
    average = F.lit(stats.avg_tokens)

    whole = F.count(F.lit(1)) == F.max("n_words")
    bound = F.sum(F.col("idf") * _saturated(F.col("f"), F.col("length"), average))
    bounds = staged(best.join(weighed, "word").groupBy("query_id", "block").agg(bound.alias("bound"), whole.alias("_whole")).filter("_whole").drop("_whole"), "top-bounds")

    def scored(chosen: DataFrame) -> DataFrame:
        """Exact ranks of the documents of chosen blocks: (query_id, block, place, rank)."""
        lists = read.join(weighed, "word").join(chosen, ["query_id", "block"], "left_semi")
        one = lists.select("query_id", "block", "n_words", "word_no", "idf", F.explode(F.arrays_zip("places", "f", "lengths")).alias("e"))
        frequency = one.groupBy("query_id", "block", F.col("e.places").alias("place"), "word_no").agg(
            F.sum("e.f").alias("f"), F.max("e.lengths").alias("length"), F.max("idf").alias("idf"), F.max("n_words").alias("n_words")
        )
        score = F.sum(F.col("idf") * _saturated(F.col("f"), F.col("length"), average))
        ranked = frequency.groupBy("query_id", "block", "place").agg(score.alias("score"), whole.alias("_whole")).filter("_whole")
        return ranked.select("query_id", "block", "place", F.round(-F.col("score"), S.RANK_DIGITS).alias("rank"))

    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    first = bounds.withColumn("_no", F.row_number().over(order)).filter(F.col("_no") <= max(FIRST_BLOCKS, -(-2 * limit // BLOCK_DOCS)))
    found = S.best_per_query(scored(first.select("query_id", "block")), limit, ["block", "place"])
    reached = {r.query_id: r["rank"] for r in found.groupBy("query_id").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= limit).collect()}
    least = spark.createDataFrame([(q, -rank) for q, rank in reached.items()], "query_id string, least double")
    # Ranks are rounded, so a bound may fall short of the k-th score by a rounding step.
    open_ = bounds.join(least, "query_id", "left").filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - 10.0**-S.RANK_DIGITS * 2))
    chosen = staged(open_.select("query_id", "block"), "top-blocks")
    ties = Window.partitionBy("query_id").orderBy("rank")
    near = scored(chosen).withColumn("_at", F.rank().over(ties)).filter(F.col("_at") <= limit).drop("_at")
    hits = S.best_per_query(near.join(index.names, ["block", "place"]).select("query_id", "doc_id", "rank"), limit, ["doc_id"])
    return TopSearch(hits, bounds, chosen)
