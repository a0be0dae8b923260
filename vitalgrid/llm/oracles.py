"""SQL that states what operators have to return, for DuckDB over the same tables."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({0}, '{1}')"
_PLAIN = _WORDS.format(_LOWER.format("coalesce(text, '')"), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
        FROM b WHERE len(w) > 0)
),
p AS (
  SELECT row_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM (SELECT row_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)
),
h AS (SELECT DISTINCT row_id, i, k, item_id FROM p JOIN g USING (k, gram)),
n AS (
  SELECT row_id, count(DISTINCT word) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + k)) AS word FROM h) GROUP BY row_id
),
t AS (
  SELECT row_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS id FROM h WHERE item_id IS NOT NULL) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (row_id) LEFT JOIN t USING (row_id)
"""

_SPACED = _WORDS.format("x", r"[^\x20\x09-\x0D]+")

FILTER_AUDIT = f"""
WITH t AS (SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, {_SPACED} AS words, min(doc_id) OVER (PARTITION BY x) AS smallest FROM t),
m AS (
  SELECT part, doc_id,
    CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]+', '', 'g')) > 3 * length(x) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN smallest < doc_id THEN 'E' ELSE '' END AS fails
  FROM w
),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails
),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f, left(filter_order, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
),
met AS (
  SELECT *, contains(fails, f) AS own,
         translate(fails, before, '') <> fails AS gone
  FROM steps, c
),
r AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (WHERE NOT gone AND NOT own), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE NOT gone AND own), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND own), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE fails = f), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE NOT gone AND own), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE NOT gone AND own), 0) AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""

# A digest's 40 hex digits are eight groups of 20 bits, and each group four letters of base 32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(hex, {5 * group + 1}, 5) AS INTEGER)"
    f" >> {shift}) & 31), 1)"
    for group in range(8)
    for shift in (15, 10, 5, 0)
)

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS stored FROM pages),
d AS (SELECT page_id, strlen(x) AS size, sha1(x) AS hex, page_id IS NOT DISTINCT FROM stored AS own, stored FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN own THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN NOT own THEN stored END AS refers_to
FROM d
"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row_id, doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"), r"[^\x20\x09-\x0D]+")} AS w
  FROM documents
),
g AS (
  SELECT DISTINCT row_id, array_to_string(w[i:i + 3], ' ') AS gram
  FROM (SELECT row_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)
),
s AS (SELECT row_id, count(*) AS n, sha256(string_agg(gram, chr(10) ORDER BY gram)) AS set_id FROM g GROUP BY row_id),
u AS (
  SELECT set_id, any_value(n) AS n, min(row_id) AS row_id, min(doc_id) AS first_id, count(*) AS copies
  FROM s JOIN d USING (row_id) GROUP BY set_id
),
e AS (SELECT u.set_id, u.n, gram FROM u JOIN g USING (row_id)),
links AS (
  SELECT a.set_id AS a, b.set_id AS b
  FROM e a JOIN e b ON a.gram = b.gram AND a.set_id <> b.set_id
  GROUP BY a.set_id, b.set_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(a, b) AS (
  SELECT set_id, set_id FROM u
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
c AS (SELECT reach.a AS set_id, min(first_id) AS component_id FROM reach JOIN u ON u.set_id = reach.b GROUP BY reach.a),
k AS (
  SELECT set_id, any_value(u.copies) - 1 + coalesce(sum(other.copies), 0) AS n_links
  FROM u LEFT JOIN (SELECT links.a, copies FROM links JOIN u ON u.set_id = links.b) other ON other.a = u.set_id
  GROUP BY set_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       CAST(coalesce(n_links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN s USING (row_id) LEFT JOIN c USING (set_id) LEFT JOIN k USING (set_id)
"""

ORACLES = {
    "op5_warc": WARC,
    "op9_ngram_jaccard_join": NGRAM_JOIN,
    "op12_decontamination": DECONTAMINATION,
    "op13_filter_audit": FILTER_AUDIT,
}
