"""DuckDB SQL for the operators that SQL can express on whole tables."""

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""

MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '-0'), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496.0 AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight,
         1.5::DOUBLE * sum(source_size) OVER () AS words FROM s),
c AS (  -- sources in the order in which they fill up; what is full before each
  SELECT *, 2.0::DOUBLE * source_size / weight AS fills,
         coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0) AS full_words,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free_weight
  FROM w WINDOW before AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT (words - full_words) / free_weight AS level FROM c WHERE (words - full_words) / free_weight <= fills
      ORDER BY fills, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * level) AS target FROM w, l),
p AS (
  SELECT d.*, source_size, target, floor(coalesce(target / nullif(source_size, 0), 0)) AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
o AS (
  SELECT *, target - whole * source_size AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY u, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ends
  FROM p)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN ends - size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM o"""


def _url_filter(order: int = 3) -> str:
    levels = []
    for k in range(order + 1):
        shorter = f"JOIN t{k - 1} s ON right(n.g, {k}) = s.g" if k else ""
        pa, pr = ("s.pa", "s.pr") if k else ("1.0::DOUBLE / 40", "1.0::DOUBLE / 40")
        levels.append(f"""
n{k} AS (SELECT right(gram, {k + 1}) AS g, sum(a) AS a, sum(r) AS r FROM counts GROUP BY 1),
c{k} AS (SELECT left(g, {k}) AS c, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta, count(*) FILTER (r > 0) AS tr
         FROM n{k} GROUP BY 1),
t{k} AS (SELECT n.g, CASE WHEN na > 0 THEN (a + ta * {pa}) / (na + ta) ELSE {pa} END AS pa,
                CASE WHEN nr > 0 THEN (r + tr * {pr}) / (nr + tr) ELSE {pr} END AS pr
         FROM n{k} n JOIN c{k} c ON left(n.g, {k}) = c.c {shorter})""")
    return rf"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
h AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
j AS (
  SELECT row_number() OVER () AS id, *, CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
    CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 5 AS fold,
    '{"^" * order}' || regexp_replace(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
      'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0/.\-_?=&%#:~+]', '*', 'g') AS folded FROM h),
r AS MATERIALIZED (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS said FROM j),
grams AS MATERIALIZED (
  SELECT id, said, fold, substr(folded, CAST(i AS BIGINT), {order + 1}) AS gram
  FROM (SELECT *, unnest(range(1, length(folded) - {order - 1})) AS i FROM r)),
counts AS MATERIALIZED (
  SELECT gram, count(*) FILTER (said = 'allow' AND fold > 0) AS a, count(*) FILTER (said = 'block' AND fold > 0) AS r
  FROM grams GROUP BY gram),{",".join(levels)},
s AS (SELECT id, avg(ln(pa) - ln(pr)) AS score FROM grams JOIN t{order} ON gram = g GROUP BY id),
v AS MATERIALIZED (SELECT r.*, coalesce(s.score, 0) AS score FROM r LEFT JOIN s USING (id)),
m AS (
  SELECT coalesce(avg(score) FILTER (said = 'allow'), 0) AS ma, coalesce(stddev_pop(score) FILTER (said = 'allow'), 0) AS sa,
         coalesce(avg(score) FILTER (said = 'block'), 0) AS mb, coalesce(stddev_pop(score) FILTER (said = 'block'), 0) AS sb
  FROM v WHERE fold = 0),
x AS (SELECT CASE WHEN sa + sb > 0 THEN (ma * sb + mb * sa) / (sa + sb) ELSE (ma + mb) / 2 END AS threshold FROM m)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN score >= threshold THEN 'allow' ELSE 'block' END) AS verdict FROM v, x"""


URL_FILTER = _url_filter()


COLLOCATIONS = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
o AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
u AS (SELECT lang, w[i] AS w1, count(*) AS f FROM o GROUP BY ALL),
b AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, count(*) AS f FROM o WHERE i + 1 <= len(w) GROUP BY ALL),
t AS (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, count(*) AS f FROM o WHERE i + 2 <= len(w) GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM u GROUP BY lang),
inside AS (
  SELECT lang, x, y, max(f) AS longer FROM (SELECT lang, w1 AS x, w2 AS y, f FROM t UNION ALL SELECT lang, w2, w3, f FROM t) GROUP BY ALL),
two AS (
  SELECT b.lang, b.w1 || ' ' || b.w2 AS phrase, b.f AS a, x.f AS l, y.f AS r,
         (1000000::HUGEINT * b.f * b.f) // (x.f::HUGEINT * y.f) AS score
  FROM b JOIN u x ON x.lang = b.lang AND x.w1 = b.w1 JOIN u y ON y.lang = b.lang AND y.w1 = b.w2
  LEFT JOIN inside i ON i.lang = b.lang AND i.x = b.w1 AND i.y = b.w2
  WHERE b.f >= 10 AND (longer IS NULL OR 100 * longer < 50 * b.f)),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, t.f AS a, x.f AS l1, q.f AS r1, p.f AS l2, z.f AS r2,
         (1000000::HUGEINT * t.f * t.f) // (x.f::HUGEINT * q.f) AS s1, (1000000::HUGEINT * t.f * t.f) // (p.f::HUGEINT * z.f) AS s2
  FROM t JOIN u x ON x.lang = t.lang AND x.w1 = t.w1 JOIN u z ON z.lang = t.lang AND z.w1 = t.w3
  JOIN b p ON p.lang = t.lang AND p.w1 = t.w1 AND p.w2 = t.w2 JOIN b q ON q.lang = t.lang AND q.w1 = t.w2 AND q.w2 = t.w3),
every AS (
  SELECT * FROM two UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM cuts)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM every JOIN n USING (lang) QUALIFY rank <= 2000"""


PREFIX_TRIE = r"""
WITH c AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM c),
h AS (  -- the remainder of the CRC-32 of the number as text, bit by bit
  SELECT conv_id, xor(4294967295::BIGINT, list_reduce(
           list_transform(range(0, 8 * length(s)), lambda i: CAST((ascii(s[i // 8 + 1]) >> (i % 8)::INTEGER) & 1 AS BIGINT)),
           lambda crc, bit: CASE WHEN (xor(crc, bit) & 1) = 1 THEN xor(crc >> 1, 3988292384::BIGINT) ELSE crc >> 1 END,
           4294967295::BIGINT)) % 4 AS h FROM ids),
turns AS (
  SELECT h.conv_id, 0 AS own, pos, role, text FROM h JOIN c ON c.conv_id = h.conv_id - h.conv_id % 20 AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM h JOIN c ON c.conv_id = h.conv_id AND pos > h),
whole AS (
  SELECT h.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY own, pos) FILTER (own IS NOT NULL), []) AS path
  FROM h LEFT JOIN turns USING (conv_id) GROUP BY h.conv_id),
member AS (
  SELECT conv_id, len(path) AS total, unnest(range(0, len(path) + 1)) AS depth, path FROM whole),
m AS (SELECT conv_id, depth, total, path[1:depth] AS p, path[1:depth - 1] AS q, path[depth].text AS said FROM member),
n AS (
  SELECT depth, p, any_value(q) AS q, min(conv_id) AS conv_id, count(*) AS n,
         coalesce(len(regexp_extract_all(any_value(said), '[^\x20\x09-\x0D]+')), 0) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (total = depth), '')) AS ends
  FROM m GROUP BY depth, p),
k AS (SELECT n.*, (SELECT count(*) FROM n b WHERE b.depth = n.depth + 1 AND b.q = n.p) AS children FROM n),
under AS (  -- every node with those of its subtree
  SELECT a.depth, a.p, sum(b.words * (b.n - 1)) AS saved, count(*) FILTER (b.children = 0) AS leaves
  FROM k b JOIN m a ON a.conv_id = b.conv_id AND a.depth <= b.depth GROUP BY a.depth, a.p)
SELECT k.conv_id, k.depth, CASE WHEN k.depth > 0 THEN up.conv_id END AS parent_conv_id, k.n AS n_convs, k.children AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, k.ends AS ends_sha256
FROM k JOIN under USING (depth, p) LEFT JOIN n up ON up.depth = k.depth - 1 AND up.p = k.q"""
