"""SQL counterparts of the queries, for DuckDB."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")},
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n,
    unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
      lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS win FROM b WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win
  FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (SELECT doc_id,
    {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
x AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM both_in WHERE 100 * c >= 75 * (na + nb - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
m AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.b, s.doc_id)) AS component_id,
  s.doc_id = least(s.doc_id, coalesce(m.b, s.doc_id)) AS kept
FROM s LEFT JOIN m ON s.doc_id = m.a"""

MIXING = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS wanted,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight FROM t),
r AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS used, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)
      AS open FROM w WINDOW before AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT min_by((wanted - used) / open, cap / weight) AS level FROM r WHERE cap / weight > (wanted - used) / open),
g AS (SELECT source, source_size, CASE WHEN level IS NULL OR cap <= weight * level THEN cap::DOUBLE
      ELSE weight * level END AS target FROM w, lv),
p AS (SELECT d.doc_id, size, d.source, source_size, target,
    CASE WHEN source_size > 0 THEN round(target / source_size, 9) ELSE 0 END AS rate,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS turn
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY turn, CAST(doc_id AS VARCHAR), size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
    sum(size) OVER (PARTITION BY source) * (rate - floor(rate)) AS due FROM p)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  size * (CAST(floor(rate) AS BIGINT) + CAST(rate > floor(rate) AND upto - size / 2.0 <= due AS BIGINT)) END AS taken
FROM q"""

SUBSTRING = rf"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
x AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i,
    unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS g
  FROM d WHERE len(w) >= 35),
r AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
p AS (SELECT doc_id, list(DISTINCT p) AS gone
  FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM x SEMI JOIN r USING (g)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(gone, z[2])),
      lambda z: z[1]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN p USING (doc_id)"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

URL_FILTER = f"""
WITH p AS (SELECT page_id, url, coalesce({LOWER.format("regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1)")}, '') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT host FROM p GROUP BY host HAVING host <> '' AND 3 * count(*) FILTER (contains(url, 'utm_')) >= count(*)),
r AS (SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow' WHEN host IN (SELECT host FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM r"""

# h is crc32 (polynomial 0xEDB88320, reflected) of the digits of conv_id, modulo 6.
TRIE = """
WITH numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS rank
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce([4294967295] || [ord(c)::BIGINT FOR c IN string_split(conv_id::VARCHAR, '')],
           lambda crc, byte: list_reduce([xor(crc, byte)] || [0::BIGINT FOR i IN range(8)],
             lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered)
), turns AS (
  SELECT i.conv_id, 0 AS part, n.rank, n.role, n.text FROM ids i JOIN numbered n ON n.conv_id = i.base AND n.rank <= i.h
  UNION ALL
  SELECT i.conv_id, 1, n.rank, n.role, n.text FROM ids i JOIN numbered n ON n.conv_id = i.conv_id AND n.rank > i.h
), deep AS (
  SELECT conv_id, role, text, row_number() OVER w AS depth, list(sha256(role || chr(1) || text)) OVER w AS path
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY part, rank)
), places AS (
  SELECT conv_id, depth, sha256(array_to_string(path, ',')) AS node,
         CASE WHEN depth > 1 THEN sha256(array_to_string(path[:-2], ',')) ELSE '' END AS parent, length(text) AS size FROM deep
  UNION ALL
  SELECT conv_id, 0, '', NULL, 0 FROM ids
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(size) AS saved
  FROM places GROUP BY node
), child AS (
  SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  -- The least member of a node passes through all nodes above it.
  SELECT p.node, sum(n.saved) AS saved, sum((c.node IS NULL)::INT) AS leaves
  FROM nodes n LEFT JOIN child c ON c.node = n.node JOIN places p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  GROUP BY p.node
), ends AS (
  SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS listed
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM places GROUP BY conv_id) GROUP BY node
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n_children, 0)::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
       sha256(coalesce(e.listed, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN nodes p ON p.node = n.parent
LEFT JOIN child c ON c.node = n.node LEFT JOIN ends e ON e.node = n.node
"""
