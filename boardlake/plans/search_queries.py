"""Registered text-index and search queries. The SQL counterparts match phrases on token lists, without postings."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from boardlake.functions.text import tokenize
from boardlake.operators import blocks as B
from boardlake.operators import search as S
from boardlake.operators import trigrams
from boardlake.operators.index import COMMENT_TEXT, ISSUE_TEXT, TextIndex, build_index, index_stats, store_index, term_stats, update_index
from boardlake.plans.views import table, view, views
from boardlake.schemas import SNIPPET_TOKENS
from boardlake.session import scratch_path

QUERIES = {}
ORACLES = {}

TOKENS = r"regexp_extract_all(strip_accents(lower(coalesce({0}, ''))), '[\p{{L}}\p{{N}}\p{{Co}}]+')"
# Token lists per indexed column of the two corpora.
ORACLE_VIEWS = {
    "issue_tokens": "SELECT id AS doc_id, "
    + ", ".join(f"{TOKENS.format(c)} AS {c}" for c in ISSUE_TEXT)
    + " FROM issues",
    "comment_tokens": f"SELECT id AS doc_id, {TOKENS.format('body')} AS body FROM comments",
    "issue_fields": " UNION ALL ".join(f"SELECT doc_id, '{c}' AS col, {w} AS weight, {c} AS tokens FROM issue_tokens" for c, w in ISSUE_TEXT.items()),
    "comment_fields": "SELECT doc_id, 'body' AS col, 1.0 AS weight, body AS tokens FROM comment_tokens",
    "issue_postings": "SELECT doc_id, col, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM issue_fields",
}


def register(name: str, oracle: str | None = None):
    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


_stored: dict[tuple[str, str, str], TextIndex] = {}


def stored_index(spark, sf: str, corpus: str) -> TextIndex:
    """Index of a corpus, written once per application and read by every search."""
    key = (spark.sparkContext.applicationId, sf, corpus)
    if key not in _stored:
        weights = ISSUE_TEXT if corpus == "issues" else COMMENT_TEXT
        _stored[key] = store_index(view(spark, sf, corpus), weights, scratch_path(spark, f"{corpus}-index"))
    return _stored[key]


_blocks: dict[tuple[str, str], B.BlockIndex] = {}


def stored_blocks(spark, sf: str) -> B.BlockIndex:
    """Blocks and dictionary of the issues' index, written once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _blocks:
        _blocks[key] = B.store_blocks(stored_index(spark, sf, "issues"), scratch_path(spark, "issues-blocks"))
    return _blocks[key]


# --- tokens and index ---


@register("tokenize", f"SELECT doc_id, len({TOKENS.format('text')}) AS n, array_to_string({TOKENS.format('text')}, ' ') AS tokens FROM documents")
def tokenize_documents(spark, sf):
    tokens = tokenize(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(tokens).cast("bigint").alias("n"), F.array_join(tokens, " ").alias("tokens"))


@register(
    "query_words",
    f"""WITH plain AS (SELECT CAST(item_id AS VARCHAR) AS query_id, replace(trim(text, ' \n\t'), '"', '') AS text FROM benchmark
  UNION ALL SELECT 'quoted ' || item_id, replace(trim(text, ' \n\t'), '"', '') FROM benchmark WHERE text LIKE '%\n%'),
items AS (SELECT query_id, unnest(regexp_split_to_array(text, '[\\s\\p{{Z}}]+')) AS word,
  generate_subscripts(regexp_split_to_array(text, '[\\s\\p{{Z}}]+'), 1) AS no FROM plain),
words AS (SELECT query_id, no, {TOKENS.format('word')} AS terms FROM items),
numbered AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY no) - 1 AS word_no, terms FROM words WHERE len(terms) > 0)
SELECT query_id, word_no, array_to_string(terms, ' ') AS terms, true AS is_prefix FROM numbered
UNION ALL SELECT 'quoted ' || item_id, 0, array_to_string({TOKENS.format('text')}, ' '), false FROM benchmark WHERE text NOT LIKE '%\n%'""",
)
def query_words(spark, sf):
    items = table(spark, sf, "benchmark").withColumn("query_id", F.col("item_id").cast("string"))
    # In quotes a passage is one phrase, unless it has several lines: then its words count one by one.
    quoted = items.select(F.concat(F.lit("quoted "), "query_id").alias("query_id"), F.concat(F.lit(' "'), "text", F.lit('" ')).alias("text"))
    words = S.query_words(items.select("query_id", "text").unionByName(quoted))
    return words.withColumn("terms", F.array_join("terms", " "))


@register(
    "index_build",
    """WITH lengths AS (SELECT doc_id, count(*) AS doc_tokens FROM issue_postings GROUP BY doc_id)
SELECT p.token, p.doc_id, p.col, CAST(p.pos AS BIGINT) AS pos, l.doc_tokens FROM issue_postings p JOIN lengths l ON l.doc_id = p.doc_id""",
)
def index_build(spark, sf):
    return build_index(view(spark, sf, "issues"), ISSUE_TEXT).postings


@register("index_terms", "SELECT token, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM issue_postings GROUP BY token")
def index_terms(spark, sf):
    return term_stats(stored_index(spark, sf, "issues"))


@register("index_dictionary", ORACLES["index_terms"])
def index_dictionary(spark, sf):
    """The same counts from the stored dictionary."""
    return stored_blocks(spark, sf).terms


@register(
    "index_stats",
    "SELECT count(*) AS docs, CAST(sum(len(identifier) + len(title) + len(description)) AS BIGINT) AS tokens, "
    "sum(len(identifier) + len(title) + len(description)) / count(*) AS avg_tokens FROM issue_tokens",
)
def corpus_stats(spark, sf):
    return index_stats(stored_index(spark, sf, "issues"))


@register(
    "index_update",
    f"""WITH current AS (SELECT i.id, i.identifier, CASE WHEN l.quality = 1 THEN 'Renamed ' || i.identifier ELSE i.title END AS title, i.description
  FROM issues i LEFT JOIN labels l ON i.id = 'is-' || l.doc_id WHERE coalesce(l.toxic, 0) = 0),
fields AS (SELECT id AS doc_id, 'identifier' AS col, {TOKENS.format('identifier')} AS tokens FROM current
  UNION ALL SELECT id, 'title', {TOKENS.format('title')} FROM current UNION ALL SELECT id, 'description', {TOKENS.format('description')} FROM current)
SELECT doc_id, col, unnest(tokens) AS token, CAST(generate_subscripts(tokens, 1) - 1 AS BIGINT) AS pos FROM fields""",
)
def index_update(spark, sf):
    issues = view(spark, sf, "issues")
    labels = table(spark, sf, "labels").withColumn("id", F.concat(F.lit("is-"), F.col("doc_id").cast("string")))
    renamed = issues.join(labels.filter("quality = 1 AND toxic = 0").select("id"), "id", "left_semi")
    renamed = renamed.withColumn("title", F.concat(F.lit("Renamed "), "identifier"))
    removed = issues.join(labels.filter("toxic = 1").select("id"), "id", "left_semi")
    updated = update_index(stored_index(spark, sf, "issues"), renamed, removed)
    return updated.postings.select("doc_id", "col", "token", "pos")


# --- search ---

# A query of the SQL counterparts: words as (terms, last term is a prefix).
QUERY_TEXTS = {
    "one": "there",
    "two": "Éleaux que",
    "prefix": "EN-1 the",
    "phrase": '"of the"',
    "rare": 'reeoria OR "token" - which',
}
QUERY_WORDS = {
    "one": [(["there"], True)],
    "two": [(["eleaux"], True), (["que"], True)],
    "prefix": [(["en", "1"], True), (["the"], True)],
    "phrase": [(["of", "the"], False)],
    "rare": [(["reeoria"], True), (["or"], True), (["token"], True), (["which"], True)],
}
SEARCHED = {"one": "there", "two": "Éleaux que", "prefix": "EN-1 the", "phrase": '"of the"'}


def _phrase_count(terms: list[str], prefix: bool, tokens: str = "tokens") -> str:
    tests = []
    for k, term in enumerate(terms):
        token = f"{tokens}[i + {k}]"
        last = prefix and k == len(terms) - 1
        tests.append(f"coalesce(starts_with({token}, '{term}'), false)" if last else f"coalesce({token} = '{term}', false)")
    return f"len(list_filter(generate_series(1, len({tokens})), lambda i: {' AND '.join(tests)}))"


def hits_sql(corpus: str, queries: dict[str, list]) -> str:
    """Occurrences per query, document, word and column."""
    legs = [
        f"SELECT '{q}' AS query_id, {no} AS word_no, {len(words)} AS n_words, doc_id, col, weight, {_phrase_count(*word)} AS hits FROM {corpus}_fields"
        for q, words in queries.items()
        for no, word in enumerate(words)
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(legs)}) AS legs WHERE hits > 0"


def rank_sql(corpus: str, queries: dict[str, list]) -> str:
    """CTEs up to ``{corpus}_ranked`` (query_id, doc_id, rank)."""
    return f"""{corpus}_hits AS ({hits_sql(corpus, queries)}),
{corpus}_length AS (SELECT doc_id, sum(len(tokens)) AS dl FROM {corpus}_fields GROUP BY doc_id),
{corpus}_total AS (SELECT count(*) AS docs, sum(dl) / count(*) AS avg_len FROM {corpus}_length),
{corpus}_freq AS (SELECT query_id, word_no, n_words, doc_id, sum(weight * hits) AS f FROM {corpus}_hits GROUP BY ALL),
{corpus}_idf AS (SELECT query_id, word_no, CASE WHEN ln((docs - n + 0.5) / (n + 0.5)) > 0 THEN ln((docs - n + 0.5) / (n + 0.5)) ELSE 1e-6 END AS idf
  FROM (SELECT query_id, word_no, count(*)::DOUBLE AS n FROM {corpus}_freq GROUP BY ALL) AS found, {corpus}_total),
{corpus}_ranked AS (SELECT q.query_id, q.doc_id, round(-sum(idf * f::DOUBLE * 2.2 / (f::DOUBLE + 1.2 * (0.25 + 0.75 * dl / avg_len))), 9) AS rank
  FROM {corpus}_freq q JOIN {corpus}_idf USING (query_id, word_no) JOIN {corpus}_length l ON l.doc_id = q.doc_id, {corpus}_total
  GROUP BY q.query_id, q.doc_id, n_words HAVING count(*) = n_words)"""


def found_sql(queries: dict[str, list]) -> str:
    """Occurrences per distinct word of the queries, document and column."""
    words = {" ".join(terms) + "*" * prefix: [(terms, prefix)] for listed in queries.values() for terms, prefix in listed}
    return f"SELECT query_id AS word, doc_id, col, CAST(hits AS BIGINT) AS hits FROM ({hits_sql('issue', words)}) AS found"


@register("search_phrase", found_sql({"phrase": QUERY_WORDS["phrase"], "exact": [(["en", "7"], False)]}))
def search_phrase(spark, sf):
    request = S.prepare(stored_index(spark, sf, "issues"), {"phrase": '"of the"', "exact": '"EN-7"'})
    return S.phrase_hits(request.entries, request.terms).groupBy("word", "doc_id", "col").agg(F.count(F.lit(1)).alias("hits"))


@register("search_prefix", found_sql({q: QUERY_WORDS[q] for q in ("one", "two", "prefix")}))
def search_prefix(spark, sf):
    request = S.prepare(stored_index(spark, sf, "issues"), {q: QUERY_TEXTS[q] for q in ("one", "two", "prefix")})
    return S.phrase_hits(request.entries, request.terms).groupBy("word", "doc_id", "col").agg(F.count(F.lit(1)).alias("hits"))


@register(
    "prefix_expansion",
    "WITH terms AS (SELECT token, count(DISTINCT doc_id) AS docs, count(*) AS hits FROM issue_postings GROUP BY token) "
    + " UNION ALL ".join(f"SELECT '{term}*' AS word, * FROM terms WHERE starts_with(token, '{term}')" for term in ("there", "eleaux", "que")),
)
def prefix_expansion(spark, sf):
    return B.expand_terms(stored_blocks(spark, sf), {q: QUERY_TEXTS[q] for q in ("one", "two")})


@register("prefix_postings", found_sql({q: QUERY_WORDS[q] for q in ("one", "two")}))
def prefix_postings(spark, sf):
    """Occurrences of prefix words, from a scan that was given the dictionary's tokens."""
    index, texts = stored_index(spark, sf, "issues"), {q: QUERY_TEXTS[q] for q in ("one", "two")}
    found = S.match_terms(B.expanded_postings(index, stored_blocks(spark, sf), texts), S.prepare(index, texts).terms)
    return found.groupBy("word", "doc_id", "col").agg(F.count(F.lit(1)).alias("hits"))


@register("bm25_rank", f"WITH {rank_sql('issue', QUERY_WORDS)} SELECT query_id, doc_id, rank FROM issue_ranked")
def bm25_rank(spark, sf):
    return S.rank_matches(stored_index(spark, sf, "issues"), QUERY_TEXTS)


@register(
    "search_scan",
    f"WITH {rank_sql('issue', {'prefix': QUERY_WORDS['prefix']})} SELECT doc_id FROM issue_ranked",
)
def search_scan(spark, sf):
    return S.scan_matches(view(spark, sf, "issues"), ISSUE_TEXT, QUERY_TEXTS["prefix"])


_HIT = "query_id, kind, issue_id, identifier, company_id, status, title, updated_at, rank, comment_id"
_ISSUE_LEG = """SELECT r.query_id, 'issue' AS kind, i.id AS issue_id, i.identifier, i.company_id, i.status, i.title, i.updated_at, r.rank, CAST(NULL AS VARCHAR) AS comment_id,
  row_number() OVER (PARTITION BY r.query_id ORDER BY r.rank, i.id) AS place FROM issue_ranked r JOIN issues i ON i.id = r.doc_id"""
_COMMENT_LEG = """SELECT r.query_id, 'comment' AS kind, i.id AS issue_id, i.identifier, i.company_id, i.status, i.title, c.created_at AS updated_at, r.rank, c.id AS comment_id,
  row_number() OVER (PARTITION BY r.query_id ORDER BY r.rank, c.id) AS place FROM comment_ranked r JOIN comments c ON c.id = r.doc_id JOIN issues i ON i.id = c.issue_id"""
_SEARCHED_WORDS = {q: QUERY_WORDS[q] for q in SEARCHED}


@register(
    "search_issues",
    f"WITH {rank_sql('issue', _SEARCHED_WORDS)} SELECT {_HIT} FROM ({_ISSUE_LEG} WHERE i.company_id = 'co-1' AND i.status IN ('todo', 'done')) AS leg WHERE place <= 10",
)
def search_issues(spark, sf):
    index = stored_index(spark, sf, "issues")
    hits = S.search_issues(index, view(spark, sf, "issues"), SEARCHED, company_id="co-1", status=["todo", "done"], limit=10)
    return hits.drop("snippet")


@register(
    "search_deep",
    f"WITH {rank_sql('issue', {'one': QUERY_WORDS['one']})} SELECT query_id, issue_id, rank FROM ({_ISSUE_LEG}) AS leg WHERE place <= 2000",
)
def search_deep(spark, sf):
    """More hits than Spark's own cut before a shuffle admits."""
    hits = S.search_issues(stored_index(spark, sf, "issues"), view(spark, sf, "issues"), {"one": QUERY_TEXTS["one"]}, limit=2000)
    return hits.select("query_id", "issue_id", "rank")


@register(
    "search_top",
    f"WITH {rank_sql('issue', {q: QUERY_WORDS[q] for q in ('one', 'two', 'rare')})} SELECT query_id, issue_id, rank FROM ({_ISSUE_LEG}) AS leg WHERE place <= 25",
)
def search_top(spark, sf):
    """The best issues of each query, from the blocks that can hold them."""
    hits = B.search_top(stored_blocks(spark, sf), {q: QUERY_TEXTS[q] for q in ("one", "two", "rare")}, 25).hits
    return hits.select("query_id", F.col("doc_id").alias("issue_id"), "rank")


@register(
    "search_comments",
    f"WITH {rank_sql('comment', _SEARCHED_WORDS)} SELECT {_HIT} FROM ({_COMMENT_LEG} WHERE i.status IN ('todo', 'done')) AS leg WHERE place <= 25",
)
def search_comments(spark, sf):
    comments, issues = views(spark, sf, "comments", "issues")
    return S.search_comments(stored_index(spark, sf, "comments"), comments, issues, SEARCHED, status=["todo", "done"]).drop("snippet")


@register(
    "search_all",
    f"""WITH {rank_sql('issue', _SEARCHED_WORDS)}, {rank_sql('comment', _SEARCHED_WORDS)},
legs AS (SELECT * FROM ({_ISSUE_LEG}) AS a WHERE place <= 25 UNION ALL SELECT * FROM ({_COMMENT_LEG}) AS b WHERE place <= 25),
merged AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank, kind, issue_id, comment_id NULLS FIRST) AS final FROM legs)
SELECT {_HIT} FROM merged WHERE final <= 25""",
)
def search_all(spark, sf):
    issues, comments = views(spark, sf, "issues", "comments")
    hits = S.search_all(stored_index(spark, sf, "issues"), stored_index(spark, sf, "comments"), issues, comments, SEARCHED)
    return S.in_order(hits).drop("snippet")


def _snippet_sql(queries: dict[str, list], size: int) -> str:
    """Snippets of the final hits: every window that starts at a hit or at the sentence before it is scored in sets, then one is written out."""
    words = " UNION ALL ".join(f"SELECT '{q}' AS query_id, {no} AS no, {terms} AS terms, {str(prefix).lower()} AS is_prefix" for q, listed in queries.items() for no, (terms, prefix) in enumerate(listed))
    raw = r"[\p{L}\p{N}\p{Co}][\p{L}\p{N}\p{Co}\p{M}]*"
    matched = "len(list_filter(range(len(terms)), lambda k: CASE WHEN is_prefix AND k = len(terms) - 1 THEN coalesce(starts_with(folded[p + k + 1], terms[k + 1]), false) ELSE coalesce(folded[p + k + 1] = terms[k + 1], false) END)) = len(terms)"
    ended = r"regexp_matches(seps[t + 1], '[.:][ \t\r\n]+$')"

    def scored(start: str, first: str) -> str:
        inside = f"list_filter(all_hits, lambda h: h.i >= {first} AND h.p < {start} + {size})"
        return f"999 * len(list_distinct(list_transform({inside}, lambda h: h.no))) + len({inside})"

    return f"""WITH words AS ({words}),
final AS ({ORACLES['search_all']}),
texts AS (SELECT f.query_id, f.kind, f.issue_id, f.comment_id, row_number() OVER () AS hit, coalesce(c.body, i.description) AS text
  FROM final f JOIN issues i ON i.id = f.issue_id LEFT JOIN comments c ON f.kind = 'comment' AND c.id = f.comment_id),
cut AS (SELECT *, regexp_extract_all(text, '{raw}') AS raw, {TOKENS.format('text')} AS folded, regexp_split_to_array(text, '{raw}') AS seps, len(regexp_extract_all(text, '{raw}')) AS count FROM texts),
found AS (SELECT hit, p, no, p + len(terms) - 1 AS stop FROM cut JOIN words USING (query_id), unnest(range(0, least(count, len(folded)) - len(terms) + 1)) AS u(p) WHERE {matched}),
placed AS (SELECT *, row_number() OVER (PARTITION BY hit ORDER BY p, no, stop) AS i FROM found),
every AS (SELECT hit, list({{'i': i, 'p': p, 'no': no, 'stop': stop}} ORDER BY i) AS all_hits FROM placed GROUP BY hit),
begun AS (SELECT f.*, count, all_hits, coalesce(list_max(list_filter(range(1, p + 1), lambda t: {ended})), 0) AS sentence FROM placed f JOIN cut USING (hit) JOIN every USING (hit)),
firsts AS (SELECT *, list_min(list_transform(list_filter(all_hits, lambda h: h.p >= sentence), lambda h: h.i)) AS first FROM begun),
windows AS (SELECT hit, i, 0 AS turn, {scored('p', 'i')} AS value,
    greatest(0, least(p - ({size} - (list_max(list_transform(list_filter(all_hits, lambda h: h.i = last_i), lambda h: h.stop)) + 1 - p)) // 2, count - {size})) AS begin
  FROM (SELECT *, list_max(list_transform(list_filter(all_hits, lambda h: h.i >= i AND h.p < p + {size}), lambda h: h.i)) AS last_i FROM firsts) AS ends
  UNION ALL SELECT hit, i, 1, {scored('sentence', 'first')} + CASE WHEN sentence > 0 THEN 100 ELSE 120 END, sentence FROM firsts WHERE count > {size} AND sentence < p),
best AS (SELECT hit, arg_max(begin, (value, -i, -turn)) AS begin FROM windows GROUP BY hit),
islands AS (SELECT *, sum(CASE WHEN p <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY hit ORDER BY i) AS island FROM (SELECT *, coalesce(max(stop) OVER (PARTITION BY hit ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS reach FROM placed)),
spans AS (SELECT hit, list({{'a': a, 'z': z}}) AS marks FROM (SELECT hit, min(p) AS a, max(stop) AS z FROM islands GROUP BY hit, island) GROUP BY hit),
shown AS (SELECT cut.*, coalesce(begin, 0) AS begin, least(count, coalesce(begin, 0) + {size}) AS halt, coalesce(marks, []) AS marks FROM cut LEFT JOIN best USING (hit) LEFT JOIN spans USING (hit))
SELECT query_id, kind, issue_id, comment_id, (CASE WHEN begin > 0 AND count > 0 THEN '…' ELSE seps[1] END) || array_to_string(list_transform(range(begin, halt), lambda t:
  (CASE WHEN len(list_filter(marks, lambda m: m.a = t OR (t = begin AND m.a < begin AND begin <= m.z))) > 0 THEN '[' ELSE '' END) || raw[t + 1]
  || (CASE WHEN len(list_filter(marks, lambda m: m.z = t OR (t = halt - 1 AND m.a <= t AND t < m.z))) > 0 THEN ']' ELSE '' END)
  || (CASE WHEN t + 1 < halt OR halt = count THEN seps[t + 2] ELSE '…' END)), '') AS snippet FROM shown"""


@register("search_snippet", _snippet_sql(_SEARCHED_WORDS, SNIPPET_TOKENS))
def search_snippet(spark, sf):
    issues, comments = views(spark, sf, "issues", "comments")
    hits = S.search_all(stored_index(spark, sf, "issues"), stored_index(spark, sf, "comments"), issues, comments, SEARCHED)
    return S.in_order(hits).select("query_id", "kind", "issue_id", "comment_id", "snippet")


@register(
    "search_many",
    """WITH items AS (SELECT CAST(item_id AS VARCHAR) AS query_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}\\p{Co}]+') AS words FROM benchmark),
lines AS (SELECT doc_id, ' ' || array_to_string(identifier, ' ') || ' | ' || array_to_string(title, ' ') || ' | ' || array_to_string(description, ' ') AS line FROM issue_tokens),
found AS (SELECT q.query_id, l.doc_id FROM items q JOIN lines l ON len(list_filter(q.words, lambda w: NOT contains(l.line, ' ' || w))) = 0)
SELECT query_id, doc_id FROM found""",
)
def search_many(spark, sf):
    """Every benchmark passage as one query: all of its words, in one job."""
    queries = table(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    return S.rank_matches(stored_index(spark, sf, "issues"), queries).select("query_id", "doc_id")


_PATTERNS = {"word": "ther", "inner": "e, a", "mixed": "Re ", "none": "zqzqzq", "wild": "the_re", "short": "a"}


@register(
    "match_indexed",
    " UNION ALL ".join(
        f"SELECT '{name}' AS pattern, id FROM issues WHERE lower(title) LIKE '%{text.lower()}%' OR lower(description) LIKE '%{text.lower()}%'" for name, text in _PATTERNS.items()
    ),
)
def match_indexed(spark, sf):
    """Issues whose title or description holds a pattern, from the index of three-letter pieces where it can serve."""
    issues, columns = view(spark, sf, "issues"), ["title", "description"]
    index = trigrams.store_pieces(issues, columns, scratch_path(spark, "issues-pieces"))
    found = [trigrams.match_indexed(index, issues, text, columns).select(F.lit(name).alias("pattern"), "id") for name, text in _PATTERNS.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), found)
