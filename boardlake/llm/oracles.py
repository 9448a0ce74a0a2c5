"""DuckDB SQL of the operators that SQL can express on whole tables.

Not here: fitted scores (1), approximate search (3), token counts of a library (5), alignments (6), XXH64 fingerprints (2),
spans of a scan with its tests (4), 400-byte windows of all texts (7), which SQL is too slow for, and learned centroids (13).
Those are tested against brute force, 1 and 13 also on held-out rows.
"""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SUPERKMER = f"""WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+49], ' ') AS k FROM w, unnest(range(1, len(ws) - 48)) AS t(i)),
firsts AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, j FROM win JOIN firsts USING (k), unnest(range(i, i + 50)) AS u(j) WHERE f < doc_id),
words AS (SELECT doc_id, j, ws[j] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(j)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS rest FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(1 + ((CAST('0x' || substr(s, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) AS INT), 1)), '')"""
WARC = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, strlen(h) AS n, sha1(h) AS s, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f"""

# Seats are found by ranking every quotient, not only those near the limit.
MIXING = f"""WITH w AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5('20240:' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS key FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS rows FROM w GROUP BY source),
weighed AS (SELECT *, coalesce('s' || source, 'n') AS name, ([3.0, 1.0, 2.0])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM totals),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
sources AS (SELECT *, CASE WHEN cap <= weight * level THEN cap ELSE weight * max(level) FILTER (cap > weight * level) OVER () END AS target, CAST(ceil(rows / 16384) AS BIGINT) AS shards FROM levels),
placed AS (SELECT w.*, s.name, s.source_size, s.target, CAST('0x' || substr(key, 1, 12) AS BIGINT) % shards AS shard FROM w JOIN sources s ON w.source IS NOT DISTINCT FROM s.source),
shards AS (SELECT name, shard, sum(size) AS shard_size, CAST(ceil(sum(size) / 16) AS BIGINT) AS blocks FROM placed GROUP BY name, shard),
caps AS (SELECT name, CAST(sum(2 * blocks) AS BIGINT) AS cap FROM shards GROUP BY name),
claims AS (SELECT s.name, row_number() OVER (ORDER BY s.target / (2 * seat + 1) DESC, s.name, seat) AS place
  FROM sources s JOIN caps c USING (name), unnest(range(0, c.cap)) AS t(seat) WHERE s.target > 0),
won AS (SELECT name, count(*) AS seats FROM claims WHERE place <= (SELECT round(sum(target) / 16) FROM sources) GROUP BY name),
shard_claims AS (SELECT h.name, h.shard, row_number() OVER (PARTITION BY h.name ORDER BY shard_size::DOUBLE / (2 * seat + 1) DESC, h.shard, seat) AS place, seats
  FROM shards h JOIN won USING (name), unnest(range(0, 2 * blocks)) AS t(seat)),
quotas AS (SELECT name, shard, count(*) FILTER (place <= seats) AS quota FROM shard_claims GROUP BY name, shard),
laid AS (SELECT p.*, blocks, coalesce(quota, 0) AS quota, CAST('0x' || substr(md5('20240:' || p.name || ':' || p.shard), 1, 12) AS BIGINT) % greatest(blocks, 1) AS start,
  CAST(sum(size) OVER (PARTITION BY p.name, p.shard ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stop
  FROM placed p JOIN shards h USING (name, shard) LEFT JOIN quotas q USING (name, shard)),
parts AS (SELECT *, stop - size AS begin, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS passes, CASE WHEN blocks > 0 THEN quota % blocks ELSE 0 END AS more FROM laid)
SELECT doc_id, size, source_size, target, CAST(least(2 * size, passes * size + CASE WHEN size > 0 AND more > 0 THEN list_sum(list_transform(range(begin // 16, (stop - 1) // 16 + 1),
  lambda j: (((j + start) % blocks + 1) * more // blocks - ((j + start) % blocks) * more // blocks) * (least(stop, (j + 1) * 16) - greatest(begin, j * 16)))) ELSE 0 END) AS BIGINT) AS taken FROM parts"""

_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _least(*candidates: str) -> str:
    return f"list_min(list_filter([{', '.join(candidates)}], lambda x: x IS NOT NULL))"


def _cheaper(best: str, cost: str, letter: str, line: str | None = None) -> str:
    """The best way on from ``best`` after one edit."""
    lines = f"list_concat([{line}], {best}.r)" if line else f"{best}.r"
    return f"{{'c': {best}.c + {cost}, 'a': '{letter}' || {best}.a, 'r': {lines}}}"


def _before(state: str) -> str:
    """All edits of row ``step`` after which ``state`` goes on, from the states' best ways on (b0 start, b1 system, b2 user, b3 assistant)."""
    after = {"b0": {"s": "b1", "u": "b2"}, "b1": {"u": "b2"}, "b2": {"a": "b3"}, "b3": {"u": "b2"}}[state]
    roles = {"u": "'user:' || step.text", "a": "'assistant:' || step.text"}
    ways = [_cheaper(state, "4", "D")]
    for initial, to in after.items():
        ways.append(f"CASE WHEN NOT step.doomed AND step.initial = '{initial}' THEN {_cheaper(to, 'step.extra', 'K', 'step.line')} END")
        if initial in roles:
            ways.append(f"CASE WHEN NOT step.doomed THEN {_cheaper(to, '3 + step.extra', 'R', roles[initial])} END")
    return _least(*ways, f"CASE WHEN NOT step.doomed AND step.initial = '' THEN {_cheaper(state, 'step.extra', 'K', 'step.line')} END")


_INSERTED = f"""{_least('b0', _cheaper('b2', '3', 'I', "'user:'"))} AS b0, {_least('b1', _cheaper('b2', '3', 'I', "'user:'"))} AS b1,
  {_least('b2', _cheaper('b3', '3', 'I', "'assistant:'"))} AS b2, {_least('b3', _cheaper('b2', '3', 'I', "'user:'"))} AS b3"""
# The best way to the end is carried from the last row to the first for each of the four states; two inserts in a row are always enough.
REPAIR = f"""WITH RECURSIVE keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT *, {_CRC32} % 20 AS kind FROM keyed),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(len(role) || ':' || role || text)) AS i FROM damaged),
faults AS (SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen, right(regexp_replace(text, '[\\x20\\x09-\\x0D]+\\z', ''), 1) NOT IN ('.', '!', '?') AS cut,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
steps AS (SELECT conv_id, i, {{'initial': initial, 'doomed': blank OR seen, 'extra': CASE WHEN cut THEN 3 ELSE 0 END, 'text': text, 'line': role || ':' || text}} AS step FROM faults),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (seen AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT seen AND NOT blank) AS truncated,
  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
ways AS (SELECT conv_id, n AS left_, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS b0, {{'c': 6::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS b1,
  {{'c': 3::BIGINT, 'a': 'I', 'r': ['assistant:']}} AS b2, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS b3 FROM counts
UNION ALL SELECT conv_id, left_, {_INSERTED} FROM (SELECT conv_id, left_, {_INSERTED} FROM (
  SELECT w.conv_id, left_ - 1 AS left_, {_before('b0')} AS b0, {_before('b1')} AS b1, {_before('b2')} AS b2, {_before('b3')} AS b3
  FROM ways w JOIN steps s ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = w.left_)))
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(b0.c, 0) AS cost, coalesce(b0.a, '') AS audit, sha256(coalesce(array_to_string(b0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN counts c ON k.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM ways WHERE left_ = 0) w ON k.conv_id IS NOT DISTINCT FROM w.conv_id"""


def _clustering(rounds: int = 10) -> str:
    """Every round as two steps of its own: nearest centroids, then floors of means."""
    norm = "list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c)"

    def nearest(i: int) -> str:
        return f"a{i} AS MATERIALIZED (SELECT vec_id, n, any_value(v) AS v, min({{'d': CAST({norm} AS BIGINT), 'k': k}}) AS m FROM kept, c{i} GROUP BY vec_id, n)"

    def moved(i: int) -> str:
        return f"""s{i} AS (SELECT m.k AS k, j, CAST(sum(CAST(v[j] AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM a{i}, unnest(range(1, 65)) AS t(j) GROUP BY m.k, j),
m{i} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS c FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k))"""

    steps = ",\n".join(f"{nearest(i)},\n{moved(i)}" for i in range(rounds))
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
first AS (SELECT v, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM kept),
c0 AS MATERIALIZED (SELECT CAST(k AS INT) AS k, v AS c FROM first WHERE k < 8),
{steps},
{nearest(rounds)}
SELECT vec_id, m.k AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.k) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON m.k = k"""


ORACLES = {"op8_mixing": MIXING, "op9_superkmer": SUPERKMER, "op10_warc": WARC, "op11_repair": REPAIR, "op12_bitplanes": _clustering()}
