"""DuckDB SQL of the queries that SQL can express."""

SQL: dict[str, str] = {}

#: Words: A-Z lower-cased, then runs of everything but ASCII signs, blanks and controls.
_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op3_decontamination"] = rf"""
WITH item AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
        FROM item, LATERAL unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
spot AS (SELECT doc_id, p.i AS i, n, array_to_string(w[p.i:p.i + n - 1], ' ') AS s
       FROM doc, lens, LATERAL unnest(range(1, len(w) - n + 2)) AS p(i)),
hit AS (SELECT doc_id, i, spot.n AS n, item_id FROM spot JOIN win ON spot.n = win.n AND spot.s = win.s),
places AS (SELECT doc_id, count(DISTINCT i + k.j) AS n_hit FROM (SELECT DISTINCT doc_id, i, n FROM hit) h,
           LATERAL unnest(range(0, n)) AS k(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
          FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op8_neighbours"] = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
q AS (SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
d AS (SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.e, c.e) AS score
      FROM q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

SQL["op11_mixing"] = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT)
                  / 4503599627370496.0 AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS i FROM w),
-- the sources before a row are stopped at twice their size, the row and those behind it share the rest by weight
l AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE - 2.0 * (sum(source_size) OVER (ORDER BY i) - source_size)::DOUBLE)
                / (sum(weight) OVER (ORDER BY i DESC)) AS level FROM o),
t AS (SELECT source, source_size, least(2.0 * source_size, weight * (SELECT coalesce(min_by(level, i) FILTER (WHERE level * weight <= 2.0 * source_size), 0) FROM l)) AS target
      FROM l),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM t)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""

#: crc32 of a string's UTF-8 bytes, bit by bit.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, 4 * len(hex(encode({0})))),
          lambda i: ((ascii(substr(hex(encode({0})), (i // 8 * 2 + 1 + (1 - i % 8 // 4))::INT, 1)) - 48
                      - CASE WHEN ascii(substr(hex(encode({0})), (i // 8 * 2 + 1 + (1 - i % 8 // 4))::INT, 1)) > 57 THEN 7 ELSE 0 END)
                     >> (i % 4)::INT) & 1)),
          lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384::BIGINT)), 4294967295::BIGINT)"""

SQL["op12_resampling"] = rf"""
WITH doc AS (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
bench AS (SELECT coalesce({_WORDS.format('text')}, []) AS w FROM benchmark),
dw AS (SELECT unnest(w) AS word FROM doc), bw AS (SELECT unnest(w) AS word FROM bench),
word AS (SELECT word, sum(s) AS s, sum(t) AS t FROM (SELECT word, 1 AS s, 0 AS t FROM dw UNION ALL SELECT word, 0, 1 FROM bw) GROUP BY word),
bucket AS (SELECT word, s, t, {_CRC.format('word')} % 10000 AS b FROM word),
n AS (SELECT b, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM bucket GROUP BY b),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM n),
gain AS (SELECT word, floor(1000 * ln((n.t + 1) * (total.s + 10000) / ((n.s + 1) * (total.t + 10000)))) AS g
         FROM bucket JOIN n USING (b), total),
weight AS (SELECT doc_id, sum(g) AS weight FROM (SELECT doc_id, unnest(w) AS word FROM doc) JOIN gain USING (word) GROUP BY doc_id),
scored AS (SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
             (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
           FROM doc LEFT JOIN weight USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM placed) THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

SQL["op13_spelling"] = rf"""
WITH RECURSIVE run AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS r
             FROM documents),
-- shorter runs can't give words
spelled AS (SELECT r, n, {_CRC.format("doc_id || ':' || r")} AS h FROM (SELECT doc_id, r, count(*) AS n FROM run WHERE length(r) >= 7 GROUP BY doc_id, r)),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word FROM spelled)
      WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
hole AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM v, LATERAL unnest(range(1, length(word) + 1)) AS t(i)),
pair AS (SELECT x.word, y.word AS near, y.n AS near_n FROM hole x JOIN hole y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
         UNION SELECT x.word, y.word, y.n FROM hole x JOIN v y ON x.a || x.z = y.word
         UNION SELECT y.word, x.word, x.n FROM hole x JOIN v y ON x.a || x.z = y.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS near_n, (list(near ORDER BY near_n DESC, near))[1] AS near FROM pair GROUP BY word),
f AS (SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form, CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
      FROM v LEFT JOIN best USING (word)),
way AS (SELECT word, word AS at FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON way.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n
FROM f JOIN way ON f.word = way.word JOIN f AS last ON way.at = last.word AND last.form IS NULL
"""
