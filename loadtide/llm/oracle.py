"""DuckDB SQL for the results of the queries that SQL can state."""

ORACLES: dict[str, str] = {}

ORACLES["op6_hyperminhash"] = r"""
WITH RECURSIVE
words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS sh
    FROM words)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON reach.r = x),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLES["op4_mixture"] = r"""
WITH
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, [1, 2, 3][src % 3 + 1]::BIGINT AS w, 3 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS total FROM named),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, src) AS rank,
    (total - sum(cap) OVER (ORDER BY cap / w, src) + cap)::DOUBLE
      / sum(w) OVER (ORDER BY cap / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM weighed),
stopping AS (SELECT *, bool_and(cap <= level * w) OVER (ORDER BY rank) AS stops FROM levels),
shared AS (
  SELECT src, source, source_size,
    CASE WHEN stops THEN cap::DOUBLE ELSE (SELECT arg_min(level, rank) FROM stopping WHERE NOT stops) * w END AS target
  FROM stopping),
lines AS (
  SELECT d.doc_id, d.size, s.source_size, s.target, round(s.target)::BIGINT AS taken_line,
    sum(size) OVER (PARTITION BY s.src ORDER BY md5('mix' || coalesce(doc_id::VARCHAR, '')), doc_id, size
      ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized d JOIN shared s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, taken_line - start)) + greatest(0, least(size, taken_line - source_size - start))
    + greatest(0, least(size, taken_line - 2 * source_size - start)))::BIGINT AS taken
FROM lines
"""

ORACLES["op1_warc"] = """
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id < last THEN last END AS refers_to, TRUE AS intact
FROM (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS d,
    max(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS last
  FROM pages)
"""

ORACLES["op2_metricjoin"] = """
WITH RECURSIVE
vectors AS MATERIALIZED (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings
  UNION SELECT reach.vec_id, y FROM reach JOIN links ON reach.r = x),
least AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts ON vec_id = x
"""

ORACLES["op11_rtree"] = """
WITH
kept AS MATERIALIZED (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
hard AS (
  SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT * FROM hard WHERE rank <= 10
"""

ORACLES["op12_decontam"] = r"""
WITH
split AS MATERIALIZED (
  SELECT 0 AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM benchmark),
words AS MATERIALIZED (
  SELECT kind, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM split),
windows AS MATERIALIZED (
  SELECT DISTINCT id AS item_id, least(len(w), 10) AS n,
    unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') for i in range(1, len(w) - least(len(w), 10) + 2)]) AS s
  FROM words WHERE kind = 1 AND len(w) > 0),
grams AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, unnest([array_to_string(w[i:i + n - 1], ' ') for i in range(1, len(w) - n + 2)]) AS s
  FROM words, (SELECT DISTINCT n FROM windows) WHERE kind = 0 AND len(w) >= n),
met AS MATERIALIZED (SELECT r, i, grams.n, item_id FROM grams JOIN windows USING (n, s)),
hits AS (SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM met) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM met WHERE item_id IS NOT NULL) GROUP BY r)
SELECT id AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hits USING (r) LEFT JOIN found USING (r) WHERE kind = 0
"""


def _rounds(n: int) -> str:
    """Assignment and floored means, written out ``n`` times, and the last assignment."""
    out = []
    for k in range(n + 1):
        out.append(f"""near{k} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := p.square + b.square - 2 * list_inner_product(p.v, b.v), e := entry)) AS best
  FROM parts p JOIN book{k} b USING (part) GROUP BY r, part)""")
        if k < n:
            out.append(f"""mean{k} AS (
  SELECT part, entry, list(m ORDER BY spot) AS v FROM (
    SELECT part, best.e AS entry, spot, floor(sum(x) / count(*)) AS m
    FROM (SELECT part, best, unnest(v) AS x, unnest(range(len(v))) AS spot FROM near{k} JOIN parts USING (r, part))
    GROUP BY part, best.e, spot) GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (
  SELECT part, entry, v, list_inner_product(v, v) AS square FROM (
    SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m USING (part, entry)))""")
    return ",\n".join(out)


ORACLES["op13_walsh"] = f"""
WITH
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT *, list_inner_product(v, v) AS square
  FROM (SELECT r, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v FROM kept, (SELECT unnest(range(4)) AS part))),
book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v, square FROM parts WHERE r <= 256),
{_rounds(4)},
coded AS (
  SELECT r, string_agg(printf('%02x', best.e::INTEGER), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near4 GROUP BY r),
books AS (
  SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, spot)) AS s
  FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS spot FROM book4))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, (SELECT s FROM books) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""
