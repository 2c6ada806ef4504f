"""SQL of the queries that SQL can express."""

from clientela.llm import secrets
from clientela.llm.queries import ORACLES
from clientela.llm.winnow import LONG_WORDS

_WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLES["op1_line_dedup"] = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
filled AS (SELECT doc_id, l, i, len({_WORDS.format(text='l')}) AS w FROM lines WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
ahead AS (
  SELECT doc_id, i, l, w, lead(i, 1) OVER p AS i1, lead(i, 2) OVER p AS i2, lead(l, 1) OVER p AS l1, lead(l, 2) OVER p AS l2,
    lead(w, 1) OVER p AS w1 FROM filled WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
windows AS (
  SELECT doc_id, i AS start, i2 AS stop, l, l1, l2 FROM ahead WHERE i2 IS NOT NULL
  UNION ALL SELECT doc_id, i, i1, l, l1, '' FROM ahead WHERE i1 IS NOT NULL AND w + w1 > {LONG_WORDS}
  UNION ALL SELECT doc_id, i, i, l, '', '' FROM ahead WHERE w > {LONG_WORDS}),
firsts AS (SELECT l, l1, l2, min(doc_id) AS source FROM windows GROUP BY ALL),
marked AS (
  SELECT windows.*, source, row_number() OVER (PARTITION BY doc_id, l, l1, l2 ORDER BY start) > 1 AS again
  FROM windows JOIN firsts USING (l, l1, l2)),
found AS (
  SELECT doc_id, start, stop, CASE WHEN again THEN doc_id ELSE source END AS source,
    max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM marked WHERE again OR source < doc_id),
runs AS (
  SELECT *, sum(CASE WHEN start <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY start, stop) AS run FROM found)
SELECT doc_id, min(start) AS first_line, max(stop) AS last_line, count(*) AS n_windows,
  arg_min(source, (start, -stop, source)) AS source_id
FROM runs GROUP BY doc_id, run"""
ORACLES["op1_line_dedup_long"] = ORACLES["op1_line_dedup"]


def _spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
  {kind}_all AS (SELECT row, t, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}) AS m,
      regexp_extract_all(t, {p}, {group}) AS v FROM docs WHERE regexp_matches(t, {p})),
  {kind}_at AS (SELECT row, t, unnest(m) AS m, unnest(v) AS v, unnest(list_transform(range(1, len(m) + 1), lambda k:
      CAST(list_sum(list_transform(gaps[1:k], lambda g: length(g))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda g: length(g))), 0) AS BIGINT))) AS s
      FROM {kind}_all),
  {kind} AS (SELECT row, {rank} AS rank, '{kind}' AS kind, s, s + length(m) AS e, md5(v) AS digest, m FROM {kind}_at
      WHERE length(v) >= {least})"""


_KINDS = [k[0] for k in secrets.BASE]
_LISTED = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e), '')"
ORACLES["op3_secret_scan"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents),
{','.join(_spans(i, *k) for i, k in enumerate((*secrets.BASE, secrets.BARE)))},
  base AS ({' UNION ALL '.join(f'SELECT * EXCLUDE (m) FROM {k}' for k in _KINDS)}),
  tokens AS (SELECT * EXCLUDE (m) FROM bare b WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]')
    AND regexp_matches(m, '[a-z]') AND NOT EXISTS (SELECT 1 FROM base WHERE base.row = b.row AND base.s < b.e AND b.s < base.e)),
  everything AS (SELECT * FROM base UNION ALL SELECT * FROM tokens),
  freq AS (SELECT digest, count(DISTINCT source) AS owners FROM everything JOIN docs USING (row) GROUP BY digest),
  judged AS (SELECT everything.*, owners <= {secrets.OWNERS} AS live FROM everything JOIN freq USING (digest)),
  per_base AS (SELECT row, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _KINDS)}, {_LISTED} AS listed FROM base GROUP BY row),
  per_all AS (SELECT row, {_LISTED} AS spans FROM judged WHERE kind <> 'bare' OR live GROUP BY row),
  verdicts AS (SELECT row, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example FROM judged GROUP BY row)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in _KINDS)}, sha256(coalesce(listed, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM docs LEFT JOIN per_base USING (row) LEFT JOIN per_all USING (row) LEFT JOIN verdicts USING (row)"""

ORACLES["op7_minhash_near_dedup"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents WHERE text IS NOT NULL),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    ELSE [array_to_string(w, ' ')] END) AS s FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS joint FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * joint >= 75 * (x.n + y.n - joint)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT a AS node, a AS other FROM edges UNION SELECT node, b FROM reached JOIN edges ON other = a),
least AS (SELECT node, min(other) AS component FROM reached GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON node = doc_id"""

ORACLES["op10_benchmark_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_WORDS.format(text='lower(text)')} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
items AS (SELECT DISTINCT item_id, {_WORDS.format(text='lower(text)')} AS w FROM benchmark WHERE text IS NOT NULL),
item_shingles AS (SELECT item_id, len(w) AS n, unnest(range(0, len(w) - 4)) AS off,
  unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM items WHERE len(w) >= 5),
doc_shingles AS (SELECT doc_id, len(w) AS length, unnest(range(0, len(w) - 4)) AS pos,
  unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM docs WHERE len(w) >= 5),
seeds AS (SELECT DISTINCT doc_id, item_id, n, greatest(0, least(pos - off, length - n)) AS start FROM doc_shingles JOIN item_shingles USING (s)),
pairs AS (SELECT DISTINCT doc_id, item_id FROM seeds),
windows AS (SELECT DISTINCT doc_id, n, start FROM seeds),
held AS (SELECT windows.doc_id, windows.n, start, s, count(*) AS c FROM windows JOIN doc_shingles
  ON windows.doc_id = doc_shingles.doc_id AND pos >= start AND pos + 4 < start + windows.n GROUP BY ALL),
held_all AS (SELECT doc_id, n, start, sum(c) AS total FROM held GROUP BY ALL),
own AS (SELECT item_id, s, count(*) AS c FROM item_shingles GROUP BY ALL),
own_all AS (SELECT item_id, sum(c) AS total FROM own GROUP BY ALL),
both_of AS (SELECT doc_id, item_id, n, start, sum(least(held.c, own.c)) AS joint FROM pairs JOIN held USING (doc_id) JOIN own USING (item_id, s) GROUP BY ALL),
scored AS (SELECT both_of.doc_id, both_of.item_id, both_of.n, both_of.start, both_of.joint / (held_all.total + own_all.total - both_of.joint) AS similarity
  FROM both_of JOIN held_all USING (doc_id, n, start) JOIN own_all USING (item_id)),
ranked AS (SELECT scored.*, length FROM scored JOIN (SELECT doc_id, len(w) AS length FROM docs) USING (doc_id) WHERE 100 * similarity >= 75)
SELECT doc_id, item_id, start, least(n, length - start) AS n_words, similarity FROM ranked
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, n DESC) = 1"""


ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.id AS anchor, b.id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND (a.label <> b.label OR a.id <> b.id)),
positives AS (
  SELECT anchor, id AS positive, score AS best FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT anchor AS anchor_id, positive AS positive_id,
  CAST(row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, best AS positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor)
WHERE NOT same AND 30 * best <= 100 * score AND 100 * score <= 90 * best
QUALIFY row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, id) <= 10"""
