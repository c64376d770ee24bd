"""DuckDB form of the queries that SQL can express: op1, op3, op9, op10, op11 and op13, written from their contracts.

The others have none: XXH64 fingerprints (op6), gear-hash chunks (op2), tokenizers (op5, op7), a trained Markov model
(op4) and spans chosen by checksum and context (op8).
"""

from __future__ import annotations

from tallybook.llm import mixing, pq, repetition, tries, urls
from tallybook.llm.common import WORD


def quality_rules() -> str:
    """Word by word: the n-gram at a word is the text of that word and the following ones."""
    lengths = [3, *repetition.GRAM_PERCENT]
    leads = ", ".join(f"LEAD(word, {k}) OVER (PARTITION BY r ORDER BY i) AS w{k}" for k in range(1, max(lengths)))
    grams = ", ".join(
        f"{' || chr(32) || '.join(['word', *(f'w{k}' for k in range(1, n))])} AS g{n}" for n in lengths)
    often = ", ".join(f"g{n} IS NOT NULL AND COUNT(*) OVER (PARTITION BY r, g{n}) > 1 AS o{n}" for n in lengths)
    inside = ", ".join(
        f"bool_or(o{n}) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}"
        for n in lengths)
    chars = ", ".join(
        f"COALESCE(SUM(LENGTH(word)) FILTER (c{n}), 0) AS gram{n}_chars" for n in repetition.GRAM_PERCENT)
    names = ["word_chars", "n_repeat_words", *(f"gram{n}_chars" for n in repetition.GRAM_PERCENT)]
    counted = ", ".join(f"CAST(COALESCE({c}, 0) AS BIGINT) AS {c}" for c in names)
    good = " AND ".join([
        f"100 * n_dup_lines <= {repetition.LINE_PERCENT} * n_lines",
        f"100 * dup_line_chars <= {repetition.LINE_CHAR_PERCENT} * word_chars",
        *(f"100 * gram{n}_chars <= {p} * word_chars" for n, p in repetition.GRAM_PERCENT.items())])
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS t FROM documents),
  lists AS (SELECT r, regexp_extract_all(t, '{WORD}') AS ws FROM docs),
  words AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM lists),
  ahead AS (SELECT r, i, word, {leads} FROM words),
  grams AS (SELECT r, i, word, {grams} FROM ahead),
  often AS (SELECT r, i, word, {often} FROM grams),
  inside AS (SELECT r, word, {inside} FROM often),
  by_word AS (SELECT r, SUM(LENGTH(word)) AS word_chars, COUNT(*) FILTER (c3) AS n_repeat_words, {chars}
    FROM inside GROUP BY r),
  lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs),
  real AS (SELECT r, LENGTH(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
      row_number() OVER (PARTITION BY r, line) > 1 AS again
    FROM lines WHERE regexp_matches(line, '{WORD}')),
  by_line AS (SELECT r, COUNT(*) AS n_lines, COUNT(*) FILTER (again) AS n_dup_lines,
      COALESCE(SUM(chars) FILTER (again), 0) AS dup_line_chars FROM real GROUP BY r),
  counts AS (SELECT doc_id, CAST(LEN(ws) AS BIGINT) AS n_words, {counted},
      CAST(LENGTH(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(COALESCE(n_lines, 0) AS BIGINT) AS n_lines, CAST(COALESCE(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
      CAST(COALESCE(dup_line_chars, 0) AS BIGINT) AS dup_line_chars
    FROM docs JOIN lists USING (r) LEFT JOIN by_word USING (r) LEFT JOIN by_line USING (r)),
  judged AS (SELECT *, n_words < {repetition.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT *, NOT base_failed AND {good} AS kept FROM judged"""


def url_filter() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    return rf"""
WITH rules(h, p, v) AS (VALUES {rules}),
  rests AS (SELECT row_number() OVER () AS r, page_id,
      CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  split AS (SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
  ranked AS (SELECT r, h || p AS rule, v, row_number() OVER (
      PARTITION BY r ORDER BY LENGTH(h) DESC, LENGTH(p) DESC, v = 'block' DESC) AS place
    FROM split JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, COALESCE(v, '{urls.DEFAULT}') AS verdict
FROM split LEFT JOIN (SELECT * FROM ranked WHERE place = 1) USING (r)"""


def mix() -> str:
    """Every quotient of every source and shard is listed and ranked; the highest ones win a block each."""
    weight = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(mixing.WEIGHTS))
    block, cap, seed = mixing.BLOCK_WORDS, mixing.CAP, mixing.SEED

    def number(md5):
        return f"CAST('0x' || substr({md5}, 1, 8) AS BIGINT)"

    return rf"""
WITH docs AS (SELECT doc_id, COALESCE('s' || source, 'n') AS name,
      CAST(LEN(regexp_extract_all(COALESCE(text, ''), '{WORD}')) AS BIGINT) AS size,
      md5('{seed}:' || COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || COALESCE(text, '')) AS mark FROM documents),
  sources AS (SELECT name, CAST(SUM(size) AS BIGINT) AS source_size FROM docs GROUP BY name),
  weighed AS (SELECT *, CASE (row_number() OVER (ORDER BY name = 'n', name) - 1) % {len(mixing.WEIGHTS)} {weight} END AS w,
      CAST(SUM(source_size) OVER () AS BIGINT) AS total FROM sources),
  -- The sources that reach their cap first are full; the others share what those leave.
  levels AS (SELECT a.name, (a.total - COALESCE(SUM({cap} * b.source_size) FILTER (b.full_first), 0))
      / SUM(b.w) FILTER (NOT b.full_first) AS level, ANY_VALUE({cap} * a.source_size / a.w) AS fills
    FROM weighed a, LATERAL (SELECT o.source_size, o.w, ({cap} * o.source_size / o.w, o.name)
      < ({cap} * a.source_size / a.w, a.name) AS full_first FROM weighed o) b GROUP BY a.name, a.total),
  aims AS (SELECT name, source_size, total, LEAST(CAST({cap} * source_size AS DOUBLE),
      (SELECT MAX(level) FROM levels WHERE level <= fills) * w) AS target FROM weighed),
  -- Blocks are at most a quarter of the smallest target.
  fine AS (SELECT GREATEST(1, LEAST({block}, CAST(FLOOR(COALESCE(MIN(target) FILTER (target > 0), 0) / 4) AS BIGINT))) AS block
    FROM aims),
  quotients AS (SELECT name, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, name, k) AS place, total
    FROM aims, fine, UNNEST(range(1, CAST(ROUND(total / block) AS BIGINT) + 1)) AS u(k) WHERE target > 0),
  quotas AS (SELECT name, COUNT(*) AS quota FROM quotients, fine WHERE place <= ROUND(total / block) GROUP BY name),
  cut AS (SELECT name, source_size, target, COALESCE(quota, 0) AS quota, block,
      GREATEST(1, CAST(CEIL(source_size / {mixing.SHARD_WORDS}) AS BIGINT)) AS shards FROM aims LEFT JOIN quotas USING (name), fine),
  dealt AS (SELECT d.*, c.source_size, c.target, c.quota, c.block, {number('mark')} % c.shards AS shard
    FROM docs d JOIN cut c USING (name)),
  circles AS (SELECT name, shard, quota, block, CAST(SUM(size) AS BIGINT) AS circle FROM dealt GROUP BY name, shard, quota, block),
  shard_quotients AS (SELECT name, shard, quota, row_number() OVER (
      PARTITION BY name ORDER BY CAST(circle AS DOUBLE) / (2 * k - 1) DESC, shard, k) AS place
    FROM circles, UNNEST(range(1, quota + 1)) AS u(k) WHERE circle > 0),
  shard_quotas AS (SELECT name, shard, COUNT(*) AS blocks FROM shard_quotients WHERE place <= quota GROUP BY name, shard),
  shards AS (SELECT name, shard, circle,
      LEAST(COALESCE(blocks, 0) * block, {cap} * circle) AS words,
      {number(f"md5('{seed}:' || name || ':' || shard)")}
        % GREATEST(1, CAST(CEIL(circle / block) AS BIGINT)) * block AS start
    FROM circles LEFT JOIN shard_quotas USING (name, shard)),
  placed AS (SELECT d.*, circle, words, start, CASE WHEN circle > 0 THEN words // circle ELSE 0 END AS laps,
      SUM(size) OVER (PARTITION BY name, shard ORDER BY mark, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS c1
    FROM dealt d JOIN shards USING (name, shard)),
  stops AS (SELECT *, c1 - size AS c0, start + words - laps * circle AS stop FROM placed)
SELECT doc_id, size, source_size, target, CAST(laps * size + GREATEST(0, LEAST(c1, stop) - GREATEST(c0, start))
  + GREATEST(0, LEAST(c1, stop - circle) - c0) AS BIGINT) AS taken FROM stops"""


def near_vectors() -> str:
    """Every pair, and the smallest id reachable from each row."""
    return f"""
WITH RECURSIVE vectors AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  good AS (SELECT * FROM vectors WHERE v IS NOT NULL AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN v IF x <> 0]) > 0),
  links AS (SELECT a.r AS u, b.r AS v FROM good a JOIN good b
    ON a.r <> b.r AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {pq.COSINE}),
  reach(u, v) AS (SELECT r, r FROM vectors UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
  parts AS (SELECT reach.u AS r, MIN(vec_id) AS component_id FROM reach JOIN vectors ON vectors.r = reach.v GROUP BY 1),
  counts AS (SELECT u AS r, COUNT(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_links, component_id,
  vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN parts USING (r) LEFT JOIN counts USING (r)"""


def hard_negatives() -> str:
    """Every anchor against every row; sums of whole doubles below 2 ** 53 are exact."""
    return """
WITH good AS (SELECT row_number() OVER () AS r, vec_id,
      CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
  scores AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike,
      CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM good a JOIN good b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
  positives AS (SELECT anchor, anchor_id, other AS positive_id, score AS positive_score,
      row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other NULLS LAST) AS place FROM scores WHERE alike),
  ranked AS (SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
      row_number() OVER (PARTITION BY anchor, place ORDER BY score DESC, other NULLS LAST) AS n
    FROM positives p JOIN scores s USING (anchor)
    WHERE place <= 5 AND NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE n <= 3"""


def conversation_trie() -> str:
    """Each member's beginnings as text of digests; a node's ancestors are the shorter beginnings of its smallest member."""
    key = "md5(CAST(length(r) AS VARCHAR) || ':' || r || x)"
    steps = "flatten([[ascii(ch), -1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN string_split(CAST(c AS VARCHAR), '')])"
    shift = "xor(a >> 1, CASE WHEN a & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)"
    ones = "CAST(4294967295 AS BIGINT)"
    crc = f"xor(list_reduce({steps}, lambda a, s: CASE WHEN s >= 0 THEN xor(a, s) ELSE {shift} END, {ones}), {ones})"
    return f"""
WITH filled AS (SELECT conv_id AS c, turn, COALESCE(role, '') AS r, COALESCE(text, '') AS x FROM conversations
    WHERE conv_id IS NOT NULL),
  keyed AS (SELECT c, {key} AS k, length(x) AS n,
      row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, {key}) AS i FROM filled),
  own AS (SELECT c, MAX(i) AS own FROM keyed GROUP BY c),
  convs AS (SELECT c, own, {crc} % {tries.HEADS} AS h, c - c % {tries.FAMILY} AS b FROM own),
  taken AS (SELECT convs.*, LEAST(h, COALESCE(f.own, 0)) AS t FROM convs LEFT JOIN own f ON f.c = b),
  turns AS (SELECT t.c, k.i AS d, k, n FROM taken t JOIN keyed k ON k.c = t.b AND k.i <= t.t
    UNION ALL SELECT t.c, t.t + k.i - h, k, n FROM taken t JOIN keyed k ON k.c = t.c AND k.i > h),
  members AS (SELECT c, d, n, string_agg(k, '') OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS p FROM turns
    UNION ALL SELECT c, 0, 0, '' FROM convs),
  nodes AS (SELECT p, MIN(c) AS c, ANY_VALUE(d) AS d, ANY_VALUE(n) AS n, COUNT(*) AS n_convs FROM members GROUP BY p),
  kids AS (SELECT left(p, 32 * (d - 1)) AS p, COUNT(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
  sums AS (SELECT m.p, COUNT(*) FILTER (n_children IS NULL) AS n_leaves, CAST(SUM((b.n_convs - 1) * b.n) AS BIGINT) AS saved
    FROM nodes b LEFT JOIN kids USING (p) JOIN members m ON m.c = b.c AND m.d <= b.d GROUP BY m.p),
  lasts AS (SELECT c, MAX_BY(p, d) AS p FROM members GROUP BY c),
  ends AS (SELECT p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS ends FROM lasts GROUP BY p)
SELECT nodes.c AS conv_id, nodes.d AS depth, up.c AS parent_conv_id, nodes.n_convs, COALESCE(n_children, 0) AS n_children, n_leaves,
  saved AS saved_tokens, COALESCE(ends, sha256('')) AS ends_sha256
FROM nodes LEFT JOIN nodes up ON nodes.d > 0 AND up.p = left(nodes.p, 32 * (nodes.d - 1)) LEFT JOIN kids ON kids.p = nodes.p
JOIN sums ON sums.p = nodes.p LEFT JOIN ends ON ends.p = nodes.p"""


def sql_by_query() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules(), "op3_url_filter": url_filter(), "op9_mixing": mix(),
            "op10_embedding_dedup": near_vectors(), "op11_hard_negatives": hard_negatives(),
            "op13_conversation_trie": conversation_trie()}
