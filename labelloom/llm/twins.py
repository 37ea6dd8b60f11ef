"""DuckDB twins of the queries on words and phrases."""

SPELLING = r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT run, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) AS BIGINT) - 64] END)) AS b FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(b, lambda c, x: xor(t[xor(c & 255, x) + 1], c >> 8), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM bytes, crc),
slipped AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM hashed),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS MATERIALIZED (SELECT DISTINCT word, n, length(word) AS len, i, substr(word, 1, CAST(i AS BIGINT) - 1) || substr(word, CAST(i AS BIGINT) + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) AS p(i)),
pairs AS (
    SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.len = b.len AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT c.word, c.n, v.word, v.n FROM cut c JOIN v ON v.word = c.rest
    UNION SELECT v.word, v.n, c.word, c.n FROM cut c JOIN v ON v.word = c.rest),
best AS (SELECT word, n, count(*) AS n_near, max(other_n) AS top FROM pairs GROUP BY ALL),
forms AS MATERIALIZED (SELECT v.word, v.n, coalesce(any_value(best.n_near), 0) AS n_near, min(pairs.other) AS form, CASE WHEN min(pairs.other) IS NOT NULL THEN any_value(best.top) END AS form_n
    FROM v LEFT JOIN best ON best.word = v.word LEFT JOIN pairs ON pairs.word = v.word AND pairs.other_n = best.top AND best.top >= 2 * v.n GROUP BY v.word, v.n),
roots AS (SELECT word, word AS root FROM forms WHERE form IS NULL UNION ALL SELECT f.word, r.root FROM forms f JOIN roots r ON f.form = r.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


PHRASES = r"""
WITH RECURSIVE
texts AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT d, lang, p, piece FROM (SELECT d, lang, string_split_regex(text, '[.,;:!?\x0A-\x0D]') AS ps FROM texts), unnest(ps) WITH ORDINALITY AS u(piece, p)),
words AS (SELECT d, lang, p, i, w FROM (SELECT d, lang, p, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces), unnest(ws) WITH ORDINALITY AS u(w, i)),
next AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM words WINDOW o AS (PARTITION BY d, p ORDER BY i)),
f AS MATERIALIZED (
    SELECT lang, 1 AS m, [w] AS k, count(*) AS f FROM next GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, 2, [w, w2], count(*) FROM next WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, 3, [w, w2, w3], count(*) FROM next WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL SELECT lang, 4, [w, w2, w3, w4], count(*) FROM next WHERE w4 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT c.lang, c.m, c.k AS w, c.f AS a, j, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
    FROM f c, unnest(range(1, c.m)) AS u(j), f x, f y WHERE c.m >= 2 AND x.lang = c.lang AND y.lang = c.lang AND x.k = c.k[1:j] AND y.k = c.k[j + 1:c.m]),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, j) = 1),
inside AS (SELECT lang, f.k[i:i + size - 1] AS w, max(f.f) AS top FROM f, unnest(range(1, 4)) AS u(i), unnest(range(2, 4)) AS v(size) WHERE f.m >= 3 AND size < f.m AND i + size - 1 <= f.m GROUP BY ALL),
total AS (SELECT lang, count(*) AS n FROM words GROUP BY lang)
SELECT lang, row_number() OVER o AS rank, array_to_string(w, ' ') AS phrase, a, l, r, n, score
FROM lowest LEFT JOIN inside USING (lang, w) JOIN total USING (lang) WHERE top IS NULL OR 100 * CAST(top AS HUGEINT) < 80 * a
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) QUALIFY row_number() OVER o <= 2000"""


SETS = r"""
WITH RECURSIVE
texts AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM texts),
nodes AS MATERIALIZED (SELECT min(doc_id) AS node, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
held AS (SELECT node, n, unnest(s) AS g FROM nodes),
pairs AS MATERIALIZED (SELECT x.node AS a, y.node AS b FROM held x JOIN held y ON x.g = y.g AND x.node <> y.node GROUP BY x.node, y.node, x.n, y.n HAVING 180 * count(*) >= 80 * (x.n + y.n)),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a),
least AS (SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN nodes ON nodes.s = sets.s LEFT JOIN least USING (node)"""
