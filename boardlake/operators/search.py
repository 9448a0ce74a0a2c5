"""Ranked text search for one query or a frame of queries."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardlake.functions.text import RAW_TOKEN, SPACE, strip, tokenize
from boardlake.operators.index import TextIndex, holding, index_stats, only_documents
from boardlake.operators.pieces import entries_of
from boardlake.operators.reads import equals, keep_if, status_in
from boardlake.schemas import SEARCH_LIMIT, SNIPPET_TOKENS
from boardlake.session import staged

# Fixed values of the ranking formula: saturation, length share, floor of the inverse document frequency.
HIT_PARTS = 64
K1 = 1.2
B = 0.75
IDF_FLOOR = 1e-6
RANK_DIGITS = 9
RARE_WORDS = 3  # words of a query that choose its candidates

WORD_TYPE = "array<struct<terms:array<string>,is_prefix:boolean>>"
HIT_COLUMNS = [
    "query_id", "kind", "issue_id", "identifier", "company_id", "status", "title", "updated_at", "snippet", "rank", "comment_id",
]


def query_frame(spark: SparkSession, queries: str | dict[str, str] | DataFrame) -> DataFrame:
    """Frame (query_id, text) of one text, a few named texts, or as given."""
    if isinstance(queries, DataFrame):
        return queries
    named = {"q": queries} if isinstance(queries, str) else queries
    return spark.createDataFrame(list(named.items()), "query_id string, text string")


def parse_queries(queries: DataFrame) -> DataFrame:
    """Words per query: (query_id, words[terms, is_prefix]).

    A fully quoted text is one exact phrase. Otherwise every blank-separated word, without its
    quotes, is a phrase whose last token is a prefix. No operators exist; words without tokens are
    ignored.
    """
    trimmed = strip(F.col("text"))
    quoted = trimmed.rlike(r'^".*"$') & (F.length(trimmed) > 1)
    phrase = F.array(F.struct(tokenize(trimmed).alias("terms"), F.lit(False).alias("is_prefix")))
    plain = F.transform(
        F.split(F.replace(trimmed, F.lit('"'), F.lit("")), SPACE),
        lambda word: F.struct(tokenize(word).alias("terms"), F.lit(True).alias("is_prefix")),
    )
    words = F.when(quoted, phrase).otherwise(plain).cast(WORD_TYPE)
    return queries.select("query_id", F.filter(words, lambda w: F.size(w["terms"]) > 0).alias("words"))


def query_words(queries: DataFrame) -> DataFrame:
    """One row per word: (query_id, word_no, terms, is_prefix)."""
    word = parse_queries(queries).select("query_id", F.posexplode("words").alias("word_no", "word"))
    return word.select("query_id", F.col("word_no").cast("bigint").alias("word_no"), "word.terms", "word.is_prefix")


def keyed_words(parsed: DataFrame) -> DataFrame:
    """One row per word of a query: (query_id, n_words, word_no, word, terms, is_prefix).

    ``word`` names equal words of all queries alike, so that each is matched once.
    """
    placed = parsed.select("query_id", F.size("words").alias("n_words"), F.posexplode("words").alias("word_no", "item"))
    name = F.concat(F.array_join("item.terms", " "), F.when(F.col("item.is_prefix"), F.lit("*")).otherwise(F.lit("")))
    return placed.select("query_id", "n_words", "word_no", name.alias("word"), "item.terms", "item.is_prefix")


def word_terms(words: DataFrame) -> DataFrame:
    """One row per term of each distinct word: (word, n_terms, term_no, term, is_prefix)."""
    distinct = words.select("word", "terms", F.col("is_prefix").alias("_prefix")).distinct()
    term = distinct.select("word", F.size("terms").alias("n_terms"), "_prefix", F.posexplode("terms").alias("term_no", "term"))
    last = F.col("term_no") == F.col("n_terms") - 1
    return term.withColumn("is_prefix", F.col("_prefix") & last).drop("_prefix")


def match_terms(postings: DataFrame, terms: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Postings or entries that satisfy a term: equal tokens, or tokens that start with a prefix term.

    Prefixes become an equality join: a token is offered once per distinct term length, cut to
    that length. Spark broadcasts the terms while they are small; otherwise both sides are
    shuffled by the cut token and AQE splits frequent ones. With ``tokens``, the index's distinct ones, these are matched
    first and once, and postings meet only what their whole token was found to satisfy.
    """
    if tokens is not None:
        return postings.join(staged(match_terms(tokens.select("token"), terms), "matched-tokens"), "token")
    lengths = terms.agg(F.collect_set(F.length("term")).alias("lengths")).scalar()
    measured = postings.withColumn("_lengths", lengths)
    fitting = F.filter("_lengths", lambda n: n <= F.length("token"))
    offered = measured.withColumn("_cut", F.explode_outer(F.transform(fitting, lambda n: F.substr("token", F.lit(1), n))))
    fits = (F.col("_cut") == F.col("term")) & (F.col("is_prefix") | (F.col("token") == F.col("term")))
    return offered.join(terms, fits).drop("_cut", "_lengths")


def phrase_hits(entries: DataFrame, terms: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Phrase occurrences: (word, doc_id, col, start, doc_tokens).

    A phrase of n terms starts where n consecutive positions each satisfy their term: each term's positions in a document
    are moved back to the start, and starts that come n times are kept. Rows spread by document, whatever the
    frequency of a token, and hold the positions of a term as a list.
    """
    return _phrases(match_terms(entries, terms, tokens))


def _phrases(matched: DataFrame) -> DataFrame:
    starts = F.transform("places", lambda p: p - F.col("term_no"))
    found = (
        matched.groupBy("word", "doc_id", "col")
        .agg(F.array_sort(F.flatten(F.collect_list(starts))).alias("_all"), F.max("n_terms").alias("_needed"), F.max("doc_tokens").alias("doc_tokens"))
    )

    def whole(start: Column, at: Column) -> Column:
        """The first of exactly as many equal starts as the phrase has terms."""
        first = F.coalesce(F.get("_all", at - 1) != start, F.lit(True))
        ended = F.coalesce(F.get("_all", at + F.col("_needed")) != start, F.lit(True))
        return first & ended & F.coalesce(F.get("_all", at + F.col("_needed") - 1) == start, F.lit(False))

    kept = found.select("word", "doc_id", "col", "doc_tokens", F.explode(F.filter("_all", whole)).alias("start"))
    return kept.select("word", "doc_id", "col", F.col("start").cast("bigint").alias("start"), "doc_tokens")


def word_frequency(index: TextIndex, request: Request) -> DataFrame:
    """Weighted occurrences of each word per document: (word, doc_id, f, doc_tokens).

    Words of one term are counted as they are matched, so tasks add them up before the shuffle;
    only phrases go through their start positions.
    """
    weight = reduce(lambda w, item: w.when(F.col("col") == item[0], F.lit(item[1])), index.weights.items(), F)

    def counted(hits: DataFrame, number: Column) -> DataFrame:
        return hits.groupBy("word", "doc_id").agg(F.sum(weight * number).alias("f"), F.max("doc_tokens").alias("doc_tokens"))

    legs = []
    if request.has_single:
        legs.append(counted(match_terms(request.entries, request.terms.filter("n_terms = 1"), request.tokens), F.col("hits")))
    if request.has_phrase:
        legs.append(counted(phrase_hits(request.entries, request.terms.filter("n_terms > 1"), request.tokens), F.lit(1)))
    # True for every row. It makes each use of the frame need the same columns, so that Spark
    # matches and shuffles once and reuses the exchange.
    whole = "f > 0 AND doc_tokens > 0 AND word IS NOT NULL AND doc_id IS NOT NULL"
    return reduce(lambda a, b: a.unionByName(b), [leg.filter(whole) for leg in legs])


def _complete(words: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words of queries with what is known of them, and the queries (query_id) of which every word is known."""
    placed = words.select("query_id", "n_words", "word_no", "word").join(known, "word")
    held = placed.groupBy("query_id").agg(F.count(F.lit(1)).alias("_held"), F.max("n_words").alias("_needed"))
    return placed, held.filter("_held = _needed").select("query_id")


def rare_candidates(index: TextIndex, words: DataFrame, matched: DataFrame) -> DataFrame:
    """Documents that hold the rarest words of a query, at most ``RARE_WORDS``: (query_id, doc_id). Only they can hold all of its words.

    How rare a word is, is told by the dictionary: the documents of its tokens, added up, of a phrase's rarest term.
    """
    per_term = matched.groupBy("word", "term_no").agg(F.sum("docs").alias("docs"), F.max("n_terms").alias("n_terms"))
    bound = per_term.groupBy("word").agg(
        F.min(F.struct("docs", "term_no")).alias("least"), F.count(F.lit(1)).alias("_terms"), F.max("n_terms").alias("n_terms")
    )
    bound = bound.filter("_terms = n_terms").select("word", "least.docs", "least.term_no")
    placed, complete = _complete(words, bound)
    each = placed.join(complete, "query_id", "left_semi").select("query_id", "word", "docs", "term_no").distinct()
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("docs", "word"))
    rare = staged(each.withColumn("_place", place).filter(F.col("_place") <= RARE_WORDS).select("query_id", "word", "term_no"), "rare-words")
    wanted = matched.join(rare.select("word", "term_no").distinct(), ["word", "term_no"], "left_semi").select("token", "word")
    found = holding(index, staged(wanted, "rare-tokens")).join(rare, "word").groupBy("query_id", "doc_id").agg(F.count(F.lit(1)).alias("_held"))
    needed = rare.groupBy("query_id").agg(F.count(F.lit(1)).alias("_needed"))
    return found.join(needed, "query_id").filter("_held = _needed").select("query_id", "doc_id")


def document_counts(index: TextIndex, matched: DataFrame, has_phrase: bool) -> DataFrame:
    """Documents of each word in the whole index: (word, n)."""
    columns = ["token", "word", "n_terms", "term_no"]
    holders = holding(index, matched.filter("n_terms = 1").select("token", "word"))
    if has_phrase:
        wanted = staged(matched.filter("n_terms > 1").select(columns), "phrase-tokens")
        met = index.entries.join(wanted, "token") if index.packed is None else entries_of(index.packed.join(wanted, "token"), *columns[1:])
        holders = holders.unionByName(_phrases(met).select("word", "doc_id").filter("doc_id IS NOT NULL").distinct())
    return holders.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def rank_documents(index: TextIndex, request: Request) -> DataFrame:
    """BM25 rank of documents that hold every word of a query: (query_id, doc_id, rank); smaller is better.

    Document counts and lengths are those of the whole index, whatever filters come later. The
    documents of a query's rarest words are its candidates: only for them are the other words looked
    up, so frequent words never multiply queries by documents. For a frame of queries the candidates come first, and the
    words are matched in their documents alone; ranks that are not asked for cost no count of documents per word.
    """
    if request.tokens is None:
        frequency = word_frequency(index, request)
        found = frequency.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        placed, complete = _complete(request.words, found)
        rarest = placed.groupBy("query_id").agg(F.min_by("word", F.struct("n", "word")).alias("word")).join(complete, "query_id", "left_semi")
        candidates = frequency.join(rarest, "word").select("query_id", "doc_id")
    else:
        matched = staged(match_terms(request.tokens.select("token", "docs"), request.terms), "matched-tokens")
        phrases = not matched.filter("n_terms > 1").isEmpty()
        candidates = staged(rare_candidates(index, request.words, matched), "candidates")
        chosen = only_documents(index, staged(candidates.select("doc_id").distinct(), "candidate-ids"))
        frequency = word_frequency(index, replace(request, entries=chosen.entries, tokens=chosen.terms, has_phrase=phrases))
        asked = request.words.join(candidates, "query_id", "left_semi").select("word").distinct()
        found = document_counts(index, matched.join(asked, "word", "left_semi"), phrases)
    totals = index_stats(index)
    docs = totals.select("docs").scalar().cast("double")
    average = totals.select("avg_tokens").scalar()
    idf = F.ln((docs - F.col("n") + 0.5) / (F.col("n") + 0.5))
    weight = F.when(idf > 0, idf).otherwise(F.lit(IDF_FLOOR))
    saturated = F.col("f") * (K1 + 1) / (F.col("f") + K1 * (1 - B + B * F.col("doc_tokens") / average))
    return (
        candidates.join(request.words.select("query_id", "n_words", "word_no", "word"), "query_id")
        .join(frequency, ["word", "doc_id"])
        .join(found, "word", "left")
        .groupBy("query_id", "doc_id")
        .agg(F.sum(weight * saturated).alias("score"), F.count(F.lit(1)).alias("_held"), F.max("n_words").alias("_needed"))
        .filter("_held = _needed")
        .select("query_id", "doc_id", F.round(-F.col("score"), RANK_DIGITS).alias("rank"))
    )


@dataclass(frozen=True)
class Request:
    """Queries ready to run: the entries to read, distinct terms, words per query, parsed texts; for a frame of queries the tokens to match first."""

    entries: DataFrame
    terms: DataFrame
    words: DataFrame
    parsed: DataFrame
    has_single: bool = True
    has_phrase: bool = True
    tokens: DataFrame | None = None


def prepare(index: TextIndex, queries: str | dict[str, str] | DataFrame) -> Request:
    """Parse queries. The tokens of literal queries are pushed into the scan of the entries."""
    parsed = parse_queries(query_frame(index.forward.sparkSession, queries))
    if isinstance(queries, DataFrame):
        # Staged, the words are parsed once, and Spark knows that they are few where they are.
        words = staged(keyed_words(parsed), "query-words")
        return Request(index.entries, staged(word_terms(words), "query-terms"), words, parsed, tokens=index.terms)
    # Texts the caller typed: a few rows, kept as local frames.
    spark = parsed.sparkSession
    parsed = spark.createDataFrame(parsed.collect(), parsed.schema)
    words = keyed_words(parsed)
    rows = word_terms(words).collect()
    terms = spark.createDataFrame(rows, word_terms(words).schema)
    admits = [F.col("token").startswith(r.term) if r.is_prefix else F.col("token") == r.term for r in rows]
    entries = index.entries.filter(reduce(lambda a, b: a | b, admits, F.lit(False)))
    single, phrase = any(r.n_terms == 1 for r in rows), any(r.n_terms > 1 for r in rows)
    return Request(entries, terms, words, parsed, single or not phrase, phrase)


def rank_matches(index: TextIndex, queries: str | dict[str, str] | DataFrame) -> DataFrame:
    """All matching documents with their rank: (query_id, doc_id, rank)."""
    return rank_documents(index, prepare(index, queries))


def search_limit(limit: float | None) -> int:
    return max(1, math.floor(SEARCH_LIMIT if limit is None else limit))


def best_per_query(hits: DataFrame, limit: int, ties: list[str]) -> DataFrame:
    """The ``limit`` best hits of each query, cut first in ``HIT_PARTS`` parts of its hits.

    A query with many hits is cut by many tasks, whatever the limit: Spark's own cut before the shuffle ends at 1,000.
    """
    part = F.pmod(F.xxhash64(*ties), F.lit(HIT_PARTS))

    def cut(rows: DataFrame, *keys: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank", *ties))
        return rows.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")

    return cut(cut(hits.withColumn("_part", part), "query_id", "_part").drop("_part"), "query_id")


def choose_snippet(seps, raw, folded, words, size: int = SNIPPET_TOKENS) -> str | None:
    """Excerpt of at most ``size`` tokens around the best cluster of hits, each hit in brackets.

    A window scores 1000 for each word it holds and 1 for each further hit. Windows start at hits and
    are then centred, or at the start of a sentence for a bonus of 100 (120 at the very beginning).
    The first best window wins.
    """
    if seps is None:
        return None
    count = len(raw)
    found = []
    for no, word in enumerate(words):
        terms, last = list(word["terms"]), len(word["terms"]) - 1
        for at in range(min(count, len(folded)) - last):
            if all(folded[at + k] == t for k, t in enumerate(terms[:-1])) and (
                folded[at + last].startswith(terms[-1]) if word["is_prefix"] else folded[at + last] == terms[-1]
            ):
                found.append((at, no, at + last))
    found.sort()

    def score(start: int, index: int) -> tuple[int, int]:
        seen, extra, end = set(), 0, start
        while index < len(found) and found[index][0] < start + size:
            extra += found[index][1] in seen
            seen.add(found[index][1])
            end = found[index][2] + 1
            index += 1
        return 1000 * len(seen) + extra, end

    best, begin = 0, 0
    sentence, first_in_sentence, next_token = 0, 0, 1
    for index, (at, _, _) in enumerate(found):
        while next_token <= at:
            if seps[next_token].rstrip(" \t\r\n")[-1:] in (".", ":") and seps[next_token][-1] in " \t\r\n":
                sentence = next_token
            next_token += 1
        while found[first_in_sentence][0] < sentence:
            first_in_sentence += 1
        value, end = score(at, index)
        if value > best:
            best = value
            begin = max(0, min(at - int((size - (end - at)) / 2), count - size))
        if count > size and sentence < at:
            value = score(sentence, first_in_sentence)[0] + (100 if sentence else 120)
            if value > best:
                best, begin = value, sentence
    stop = min(count, begin + size)
    marks = []
    for at, _, end in found:
        if marks and at <= marks[-1][1]:
            marks[-1][1] = max(marks[-1][1], end)
        else:
            marks.append([at, end])
    opens, closes = {m[0] for m in marks}, {m[1] for m in marks}
    out = ["…" if begin > 0 else seps[0]] if count else list(seps[:1])
    for at in range(begin, stop):
        inside = [m for m in marks if m[0] < begin <= m[1]] if at == begin else []
        out.append(("[" if at in opens or inside else "") + raw[at])
        out.append("]" if at in closes or (at == stop - 1 and any(m[0] <= at < m[1] for m in marks)) else "")
        out.append(seps[at + 1] if at + 1 < stop or stop == count else "…")
    return "".join(out)


@F.pandas_udf(T.StringType())
def _snippets(seps: pd.Series, raw: pd.Series, folded: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([choose_snippet(*row) for row in zip(seps, raw, folded, words)], dtype="object")



def snippet(text: Column, words: Column) -> Column:
    """Excerpt of a text for the words of a query. Splitting and folding stay in the JVM; meant for the few rows of a result."""
    tokens = F.regexp_extract_all(text, F.lit(RAW_TOKEN), F.lit(0))
    return _snippets(F.split(text, RAW_TOKEN, -1), tokens, tokenize(text), words)


def _issue_filters(company_id: str | None, status: list[str] | None) -> list[Column]:
    return [c for c in (equals("company_id", company_id), status_in("status", status)) if c is not None]


def search_issues(
    index: TextIndex,
    issues: DataFrame,
    queries: str | dict[str, str] | DataFrame,
    company_id: str | None = None,
    status: list[str] | None = None,
    limit: float | None = None,
) -> DataFrame:
    """Best issues per query. Only when filters are given do the ranked documents meet the issues before the cut."""
    request = prepare(index, queries)
    ranked = rank_documents(index, request)
    filters = _issue_filters(company_id, status)
    if filters:
        ranked = ranked.join(keep_if(issues, *filters).select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    top = best_per_query(ranked, search_limit(limit), ["doc_id"])
    detail = issues.select(
        F.col("id").alias("issue_id"), "identifier", "company_id", "status", "title", "updated_at", "description"
    )
    return (
        top.withColumnRenamed("doc_id", "issue_id")
        .join(detail, "issue_id")
        .join(request.parsed, "query_id")
        .withColumns(
            {
                "kind": F.lit("issue"),
                "snippet": snippet(F.col("description"), F.col("words")),
                "comment_id": F.lit(None).cast("string"),
            }
        )
        .select(*HIT_COLUMNS)
    )


def search_comments(
    index: TextIndex,
    comments: DataFrame,
    issues: DataFrame,
    queries: str | dict[str, str] | DataFrame,
    company_id: str | None = None,
    status: list[str] | None = None,
    limit: float | None = None,
) -> DataFrame:
    """Best comments per query; filters apply to the parent issue, comments without one drop out."""
    request = prepare(index, queries)
    ranked = rank_documents(index, request).withColumnRenamed("doc_id", "comment_id")
    parents = comments.select(F.col("id").alias("comment_id"), "issue_id")
    allowed = keep_if(issues, *_issue_filters(company_id, status)).select(F.col("id").alias("issue_id"))
    live = ranked.join(parents, "comment_id").join(allowed, "issue_id", "left_semi")
    top = best_per_query(live, search_limit(limit), ["comment_id"])
    text = comments.select(F.col("id").alias("comment_id"), F.col("created_at").alias("updated_at"), "body")
    detail = issues.select(F.col("id").alias("issue_id"), "identifier", "company_id", "status", "title")
    return (
        top.join(text, "comment_id")
        .join(detail, "issue_id")
        .join(request.parsed, "query_id")
        .withColumns({"kind": F.lit("comment"), "snippet": snippet(F.col("body"), F.col("words"))})
        .select(*HIT_COLUMNS)
    )


def search_all(
    issue_index: TextIndex,
    comment_index: TextIndex,
    issues: DataFrame,
    comments: DataFrame,
    queries: str | dict[str, str] | DataFrame,
    company_id: str | None = None,
    status: list[str] | None = None,
    limit: float | None = None,
) -> DataFrame:
    """Issue and comment hits merged; ranks of the two indexes are compared as they are."""
    count = search_limit(limit)
    legs = search_issues(issue_index, issues, queries, company_id, status, count).unionByName(
        search_comments(comment_index, comments, issues, queries, company_id, status, count)
    )
    return best_per_query(legs, count, ["kind", "issue_id", "comment_id"])


def in_order(hits: DataFrame) -> DataFrame:
    """Sort a result for display."""
    return hits.orderBy("query_id", "rank", F.col("kind").desc(), "issue_id", F.col("comment_id").asc_nulls_first())


def scan_matches(rows: DataFrame, weights: dict[str, float], text: str, key: str = "id") -> DataFrame:
    """Ids of rows holding every word of one query, found by scanning the texts without an index.

    The tokens of a text are joined by blanks, so that a phrase is a substring with a blank before it.
    """
    words = parse_queries(query_frame(rows.sparkSession, text)).collect()[0].words
    lines = [F.concat(F.lit(" "), F.array_join(tokenize(F.col(c)), " "), F.lit(" ")) for c in weights if c in rows.columns]

    def holds(word) -> Column:
        phrase = " " + " ".join(word.terms) + ("" if word.is_prefix else " ")
        return reduce(lambda a, b: a | b, [line.contains(phrase) for line in lines])

    if not words:
        return rows.select(F.col(key).alias("doc_id")).limit(0)
    return keep_if(rows, *[holds(word) for word in words]).select(F.col(key).alias("doc_id"))
