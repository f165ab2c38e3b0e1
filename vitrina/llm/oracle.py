"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op2_exact_topk"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM s)
WHERE rank <= 20
"""

ORACLE_SQL["op3_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
a AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
l AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) - 1 AS pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 5 AS long
  FROM a WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
b AS (SELECT *, sum(CASE WHEN long THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY pos) AS part FROM l),
w AS (
  SELECT r, doc_id, pos, [line, lead(line) OVER v, lead(line, 2) OVER v, lead(line, 3) OVER v, lead(line, 4) OVER v] AS run, lead(pos, 4) OVER v AS ends
  FROM b WHERE NOT long WINDOW v AS (PARTITION BY r, part ORDER BY pos)),
f AS (
  SELECT r, doc_id, pos, 1 AS n, [line] AS run FROM b WHERE long
  UNION ALL SELECT r, doc_id, pos, 5, run FROM w WHERE ends IS NOT NULL),
k AS (
  SELECT *, row_number() OVER o AS k, first_value(r) OVER o AS r1, first_value(pos) OVER o AS p1
  FROM f WINDOW o AS (PARTITION BY n, run ORDER BY doc_id, pos)),
later AS (SELECT * FROM k WHERE k > 1),
near AS (  -- shorter lines around a later long line, with those around its earliest place
  SELECT x.r, s.pos, bool_and(coalesce(t.line = s.line AND NOT t.long, false)) OVER (
    PARTITION BY x.r, x.pos, s.pos > x.pos ORDER BY abs(s.pos - x.pos)) AS same
  FROM later x JOIN b y ON y.r = x.r AND y.pos = x.pos JOIN b s ON s.r = x.r AND NOT s.long AND s.part IN (y.part - 1, y.part)
  LEFT JOIN b t ON t.r = x.r1 AND t.pos = x.p1 + s.pos - x.pos WHERE x.n = 1),
g AS (
  SELECT DISTINCT r, unnest(range(pos, pos + n)) AS pos FROM later
  UNION SELECT r, pos FROM near WHERE same),
kept AS (
  SELECT a.r, string_agg(a.line, chr(10) ORDER BY a.i) AS text
  FROM a LEFT JOIN l ON a.r = l.r AND a.i = l.i LEFT JOIN g ON g.r = l.r AND g.pos = l.pos
  WHERE g.r IS NULL GROUP BY a.r),
n_lines AS (SELECT r, count(*) AS n FROM l GROUP BY r),
n_gone AS (SELECT r, count(*) AS n FROM g GROUP BY r)
SELECT d.doc_id, coalesce(n_lines.n, 0) AS n_lines, coalesce(n_gone.n, 0) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM d LEFT JOIN kept ON kept.r = d.r LEFT JOIN n_lines ON n_lines.r = d.r LEFT JOIN n_gone ON n_gone.r = d.r
"""

ORACLE_SQL["op4_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, unnest(range(0, len(w) - 34)) AS i, unnest(list_transform(range(0, len(w) - 34), lambda i: array_to_string(w[i + 1:i + 35], ' '))) AS t FROM d WHERE len(w) >= 35),
h AS (SELECT r, i, md5(t) AS t FROM s),
twice AS (SELECT t FROM h GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM h JOIN twice USING (t)),
g AS (SELECT r, list(p) AS ps, count(*) AS n FROM gone GROUP BY r),
kept AS (
  SELECT a.r, string_agg(a.x, ' ' ORDER BY a.p) AS t
  FROM (SELECT r, unnest(w) AS x, unnest(range(0, len(w))) AS p FROM d) a LEFT JOIN gone ON a.r = gone.r AND a.p = gone.p
  WHERE gone.r IS NULL GROUP BY a.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN g USING (r) LEFT JOIN kept USING (r)
"""

ORACLE_SQL["op5_decontaminate"] = r"""
WITH dw AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM documents),
bw AS (
  SELECT item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM benchmark),
items AS (
  SELECT DISTINCT item_id, len(t) AS n, array_to_string(t, ' ') AS t
  FROM (SELECT item_id, unnest(list_transform(range(0, greatest(len(w) - 10, 0) + 1), lambda i: w[i + 1:i + 10])) AS t FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM items),
m AS (
  SELECT r, item_id, i, n FROM (
    SELECT r, n, unnest(range(0, len(w) - n + 1)) AS i, unnest(list_transform(range(0, len(w) - n + 1), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS t
    FROM dw, lens WHERE len(w) >= n) JOIN items USING (n, t)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
ids AS (SELECT r, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS ids FROM m WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN ids USING (r)
"""

ORACLE_SQL["op7_lm_score"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, count(*) OVER (PARTITION BY coalesce(text, '')) AS copies,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT r, copies, len(w) AS n, unnest(w) AS b, unnest(range(0, len(w))) AS i, unnest(list_prepend(NULL, w[1:len(w) - 1])) AS a FROM d WHERE len(w) > 0),
c1 AS (SELECT b, count(*) AS n1 FROM t GROUP BY b),
c2 AS (SELECT a, b, count(*) AS n2 FROM t WHERE a IS NOT NULL GROUP BY a, b),
o1 AS (SELECT r, b, count(*) AS m1 FROM t GROUP BY r, b),
o2 AS (SELECT r, a, b, count(*) AS m2 FROM t WHERE a IS NOT NULL GROUP BY r, a, b),
s AS (SELECT sum(n1) AS total FROM c1),
g AS (
  SELECT t.r, t.a,
    log2((c1.n1 - copies * o1.m1 + 1) / CAST(total - copies * n + 1 AS DOUBLE)) AS one,
    c2.n2 - copies * o2.m2 AS pair, p.n1 - copies * q.m1 AS context
  FROM t CROSS JOIN s JOIN c1 ON c1.b = t.b JOIN o1 ON o1.r = t.r AND o1.b = t.b
  LEFT JOIN c2 ON c2.a = t.a AND c2.b = t.b LEFT JOIN o2 ON o2.r = t.r AND o2.a = t.a AND o2.b = t.b
  LEFT JOIN c1 p ON p.b = t.a LEFT JOIN o1 q ON q.r = t.r AND q.b = t.a),
x AS (
  SELECT r, sum(CASE WHEN a IS NULL THEN one WHEN pair > 0 AND context > 0 THEN log2(pair / CAST(context AS DOUBLE)) ELSE one + log2(0.4) END) AS lp
  FROM g GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(lp, 0), 3) AS log2_prob, CASE WHEN len(w) > 0 THEN round(lp / len(w), 6) END AS mean_log2
FROM d LEFT JOIN x USING (r)
"""

ORACLE_SQL["op8_url_filter"] = r"""
WITH rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
p AS (
  SELECT row_number() OVER () AS r, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
f AS (
  SELECT r, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY r ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.r = f.r AND k = 1
"""

ORACLE_SQL["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, (xor(list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END, xor(a, b)),
    CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, 0 AS half, t.pos, role, text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY half, pos) AS depth FROM r),
path AS (
  SELECT conv_id, depth, strlen(text) AS bytes,
    string_agg(sha256(strlen(role) || ':' || role || text), '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING) AS node
  FROM p
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM path GROUP BY node, depth),
up AS (SELECT n.*, parent.conv_id AS parent_conv_id, parent.node AS parent FROM n LEFT JOIN n parent ON parent.depth = n.depth - 1 AND parent.node = left(n.node, 64 * (CAST(n.depth AS INTEGER) - 1)) AND n.depth > 0),
kids AS (SELECT parent AS node, count(*) AS n_children FROM up WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT a.node, sum(CASE WHEN kids.node IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((d.n_convs - 1) * d.bytes) AS saved_tokens
  FROM n d JOIN path a ON a.conv_id = d.conv_id AND a.depth <= d.depth LEFT JOIN kids ON kids.node = d.node GROUP BY a.node),
ends AS (
  SELECT node, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(node, depth) AS node FROM path GROUP BY conv_id) GROUP BY node)
SELECT up.conv_id, CAST(up.depth AS BIGINT) AS depth, up.parent_conv_id, up.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM up JOIN below USING (node) LEFT JOIN kids USING (node) LEFT JOIN ends USING (node)
"""

ORACLE_SQL["op13_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN coalesce(min(d.doc_id) OVER (PARTITION BY text) < d.doc_id, false) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS g, sum(toxic) AS t FROM m GROUP BY part, mask),
f(f, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT [v.f, w.f, x.f, y.f, z.f] AS fs, [v.b, w.b, x.b, y.b, z.b] AS bs FROM f v, f w, f x, f y, f z
  WHERE v.b + w.b + x.b + y.b + z.b = 31 AND v.b | w.b | x.b | y.b | z.b = 31),
s AS (
  SELECT array_to_string(fs, '') AS filter_order, step, bs[step] AS bit, coalesce(list_sum(bs[1:step - 1]), 0) AS before
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN g ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN t ELSE 0 END) AS toxic_lost
  FROM c, (SELECT filter_order, step, CAST(bit AS BIGINT) AS bit, CAST(before AS BIGINT) AS before FROM s) GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""
