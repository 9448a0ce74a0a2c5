"""Mixing sources to target weights with Sainte-Laguë apportionment of equal-token blocks.

The wanted tokens are cut into blocks of equal size. Blocks go to the sources, and a source's blocks to its
shards, by the highest quotients target / (2 s + 1). In a shard, documents lie end to end in a seeded order and
the blocks cut from that line are taken: whole passes first, then as many more as the quota asks, spaced evenly
from a seeded start. A document's share is what the taken blocks cover of it.

Only DataFrame functions run. Rows that agree in id, source and size are counted before anything is laid out, and
lie in the line as parts of many copies each; a source is dealt over as many shards as its parts and words need.
So no task holds more than a shard, whatever the share of a source or an id: one id adds its distinct sizes at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlake.session import staged

WORD = r"[^\x20\x09-\x0D]+"
SEED = 20_240
BLOCK_TOKENS = 16
SHARD_ROWS = 16_384
SHARD_WORDS = 2**30
# Copies of a row that are laid out as one: as many as hold about so many words, within these bounds.
PART_WORDS = 2**22
PART_COPIES = (64, 65_536)


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``rows``, ``target`` from rows of ``source`` and ``size``.

    Sources by code point, null last, weigh ``weights``, repeating. They share ``share`` of all sizes by weight;
    a target stops at ``limit`` times its source's size and the excess is shared anew. The level at which that
    ends is found in one pass over the sources sorted by ``cap / weight``: all with a lower ratio are capped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    known = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levelled = known.withColumn("_level", level).withColumn("_capped", F.col("cap") <= F.col("weight") * F.col("_level"))
    # The first source that is not capped has the highest level of these and sets it for all from there on.
    free = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(whole)
    target = F.when(F.col("_capped"), F.col("cap")).otherwise(F.col("weight") * free)
    return levelled.select("source", "source_size", "rows", F.coalesce(target, F.lit(0.0)).alias("target"))


def _entries(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """``id``, ``source``, ``size``, ``copies``, ``words`` and ``key``: rows alike, in parts of so many copies.

    The key orders the line and picks the shard. It depends on seed and id, and on the number of the part from the second on.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    alike = sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    least, most = PART_COPIES
    full = F.least(F.greatest(F.floor(F.lit(PART_WORDS) / (F.col("size") + 1)), F.lit(least)), F.lit(most)).cast("bigint")
    parts = alike.withColumn("full", full).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / F.col("full")))))
    copies = F.least(F.col("full"), F.col("n") - F.col("part") * F.col("full"))
    name = F.coalesce(F.col("id").cast("string"), F.lit("-"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), name, F.when(F.col("part") > 0, F.col("part").cast("string"))))
    return parts.select("id", "source", "size", copies.alias("copies"), (copies * F.col("size")).alias("words"), key.alias("key"))


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], weight: str, seats: Column, cap: str) -> DataFrame:
    """Add ``seats``: ``seats`` (constant in a group) dealt to a group's parties by the highest quotients weight / (2 s + 1).

    Every quotient over W / (2 B - n) surely wins and none under W / (2 B + n) does (W: weights, n: parties, B: seats),
    so only the few between are ranked. Ties go to the party first in order. A party gets ``cap`` seats at most.
    """
    own = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(own), F.sum(weight).over(own)
    sized = parties.withColumn("_seats", seats).withColumn("_n", n).withColumn("_total", total)

    def over(quotient: Column) -> Column:
        return F.floor((F.col(weight) / quotient + 1) / 2).cast("bigint")

    sure = F.when((2 * F.col("_seats") > F.col("_n")) & (F.col(weight) > 0), over(F.col("_total") / (2 * F.col("_seats") - F.col("_n")))).otherwise(F.lit(0))
    most = F.when(F.col(weight) > 0, over(F.col("_total") / (2 * F.col("_seats") + F.col("_n")))).otherwise(F.lit(0))
    # One seat of slack on either side keeps rounding of the bounds harmless.
    bounds = sized.withColumn("_sure", F.least(F.greatest(sure - 1, F.lit(0)), F.col(cap))).withColumn("_most", F.greatest("_sure", F.least(most + 1, F.col(cap))))
    left = F.col("_seats") - F.sum("_sure").over(own)
    open_seats = F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_most") - 1)).otherwise(F.array().cast("array<bigint>"))
    claims = bounds.withColumn("_left", left).select(*group, *party, "_left", F.col(weight).alias("_w"), F.explode(open_seats).alias("_s"))
    ranked = claims.withColumn("_rank", F.row_number().over(own.orderBy((F.col("_w") / (2 * F.col("_s") + 1)).desc(), *party, "_s")))
    won = ranked.filter(F.col("_rank") <= F.col("_left")).groupBy(*group, *party).agg(F.count(F.lit(1)).alias("_won"))
    kept = bounds.select(*parties.columns, "_sure")
    return kept.join(won, [*group, *party], "left").select(*parties.columns, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("seats"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: int = 2, block: int = BLOCK_TOKENS, shard_rows: int = SHARD_ROWS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target`` and ``taken`` per row of ``docs``.

    ``size`` is the number of words, ``target`` that of the row's source, ``taken`` the words the mix takes of the
    document, repeats counted, never over ``limit`` times its size. Null and empty texts have size 0 and give
    nothing. A null source is a source of its own. Null ids and repeated rows are rows like any other; rows alike in
    id, source and size share what their part was given evenly, up to one word. The order in a shard depends on seed
    and id only, so reruns agree. An empty table gives no rows. Other columns are not read.
    """
    entries = staged(_entries(docs, id_col, text_col, source_col, seed), "mix-sizes")
    mixed = _mixed(entries, weights, share, limit, block, shard_rows, seed)
    own = mixed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    taken = _div((F.col("copy") + 1) * F.col("taken"), F.col("copies")) - _div(F.col("copy") * F.col("taken"), F.col("copies"))
    return own.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))


def with_taken(docs: DataFrame, size_col: str, taken_col: str, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with all its columns, the size of each row in words and the words the mix takes of it.

    The mix is that of :func:`mix_sources` with its defaults; the shares are found on small rows and joined to
    the texts by id, source and size, which are all a share depends on.
    """
    entries = staged(_entries(docs, id_col, text_col, source_col, seed), "mix-sizes")
    mixed = _mixed(entries, (3, 1, 2), 1.5, 2, BLOCK_TOKENS, SHARD_ROWS, seed)
    # Rows that agree in id, source and size share what they were given evenly, up to one word.
    own = mixed.groupBy("id", "source", "size").agg(F.sum("taken").alias("taken"), F.sum("copies").alias("n"))
    left = docs.withColumn(size_col, word_count(F.col(text_col))).alias("d")
    agrees = F.col(f"d.{id_col}").eqNullSafe(F.col("m.id")) & F.col(f"d.{source_col}").eqNullSafe(F.col("m.source")) & (F.col(f"d.{size_col}") == F.col("m.size"))
    joined = left.join(own.alias("m"), agrees)
    return joined.select("d.*", F.least(F.round(F.col("m.taken") / F.col("m.n")), 2 * F.col("m.size")).cast("bigint").alias(taken_col))


def _div(a: Column, b: Column) -> Column:
    """The whole quotient, in integers throughout."""
    return F.call_function("div", a, b)


def _mixed(rows: DataFrame, weights: Sequence[float], share: float, limit: int, block: int, shard_rows: int, seed: int) -> DataFrame:
    """``id``, ``source``, ``size``, ``copies``, ``source_size``, ``target`` and ``taken`` (of all copies) of the rows of :func:`_entries`."""
    sources = source_targets(rows.select("source", F.col("words").alias("size")), weights, share, limit)
    # Names stand for sources from here on, null included, so that joins and windows meet no null.
    sources = sources.withColumn("name", _name(F.col("source"))).withColumn("shards", F.ceil(F.greatest(F.col("rows") / shard_rows, F.col("source_size") / SHARD_WORDS)).cast("bigint"))
    sources = staged(sources.drop("source"), "mix-sources")
    shard = F.pmod(F.conv(F.substring("key", 1, 12), 16, 10).cast("bigint"), F.col("shards"))
    placed = rows.withColumn("name", _name(F.col("source"))).join(sources.drop("rows"), "name").withColumn("shard", shard)
    shards = placed.groupBy("name", "shard").agg(F.sum("words").alias("shard_size"))
    shards = shards.withColumn("blocks", F.ceil(F.col("shard_size") / block).cast("bigint")).withColumn("cap", limit * F.col("blocks"))
    quotas = _quotas(sources, shards, block)
    line = Window.partitionBy("name", "shard").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("end", F.sum("words").over(line)).join(quotas, ["name", "shard"])
    return laid.select("id", "source", "size", "copies", "source_size", "target", F.least(_taken(block, seed), limit * F.col("words")).alias("taken"))


def _name(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _quotas(sources: DataFrame, shards: DataFrame, block: int) -> DataFrame:
    """``name``, ``shard``, ``blocks`` and ``quota``: blocks for sources, then for the shards of each."""
    capacity = shards.groupBy("name").agg(F.sum("cap").alias("cap"))
    all_seats = F.round(F.sum("target").over(Window.partitionBy("_all")) / block).cast("bigint")
    parties = sources.select("name", "target").join(capacity, "name").withColumn("_all", F.lit(1))
    dealt = sainte_lague(parties, ["_all"], ["name"], "target", all_seats, "cap").select("name", F.col("seats").alias("source_seats"))
    own = shards.join(dealt, "name").withColumn("weight", F.col("shard_size").cast("double"))
    return sainte_lague(own, ["name"], ["shard"], "weight", F.col("source_seats"), "cap").select("name", "shard", "blocks", F.col("seats").alias("quota"))


def _taken(block: int, seed: int) -> Column:
    """Words of an entry that lie in taken blocks: whole passes, and its part of the blocks spaced over the shard.

    Of the first x blocks from the seeded start, x * more / blocks are taken, rounded down. So the blocks that an entry
    touches are counted by a difference, however many they are; the first and the last count by what is the entry's.
    """
    begin, end, blocks = F.col("end") - F.col("words"), F.col("end"), F.col("blocks")
    passes = F.when(blocks > 0, _div(F.col("quota"), blocks)).otherwise(F.lit(0))
    more = F.when(blocks > 0, F.col("quota") % blocks).otherwise(F.lit(0))
    start = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "name", "shard")), 1, 12), 16, 10).cast("bigint"), blocks)
    first, last = _div(begin, F.lit(block)), _div(end - 1, F.lit(block))

    def before(j: Column) -> Column:
        return _div((j + start) * more, blocks)

    taken = F.lit(block) * (before(last + 1) - before(first))
    ahead = (before(first + 1) - before(first)) * (begin - first * block)
    after = (before(last + 1) - before(last)) * ((last + 1) * block - end)
    extra = F.when((F.col("words") > 0) & (more > 0), taken - ahead - after).otherwise(F.lit(0))
    return (passes * F.col("words") + extra).cast("bigint")
