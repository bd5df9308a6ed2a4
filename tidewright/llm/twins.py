"""SQL twins of corpus queries: plain comparisons of all pairs, strings or places, for DuckDB on small tables."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text of code points below 256, bit by bit."""
    data = (f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN ord(ch) < 128 THEN [ord(ch)] "
            "ELSE [192 + (ord(ch) >> 6), 128 + (ord(ch) & 63)] END))")
    bits = f"flatten(list_transform({data}, lambda b: list_transform(range(8), lambda k: ((b >> k) & 1)::BIGINT)))"
    step = "xor(c >> 1, 3988292384 * (xor(c, bit) & 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, bit: {step}), 4294967295::BIGINT)"


SETS = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents),
  g AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS g FROM (
      SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 2))) AS i FROM w WHERE len(words) > 0)),
  s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
  c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
  e AS (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
  two AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  reach AS (SELECT doc_id AS node, doc_id AS there FROM documents UNION
      SELECT node, b FROM reach JOIN two ON there = a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(there) AS component_id FROM reach GROUP BY node) r ON r.node = d.doc_id"""

REPEATS = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
  part AS (SELECT doc_id, n, o, substr(x, 2 * o + 1, 910) AS x FROM (
      SELECT doc_id, n, x, unnest(range(0, n - 199, 256)) AS o FROM h WHERE n >= 200)),
  win AS (SELECT doc_id, o + j AS i, md5(substr(x, 2 * j + 1, 400)) AS p FROM (
      SELECT doc_id, x, o, unnest(range(least(256, n - 199 - o))) AS j FROM part)),
  twice AS (SELECT p FROM win GROUP BY p HAVING count(*) > 1),
  hit AS (SELECT doc_id, i, CASE WHEN i > 200 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 1 ELSE 0 END AS gap
      FROM win SEMI JOIN twice USING (p)),
  span AS (SELECT doc_id, min(i) AS low, max(i) + 200 AS high FROM (
      SELECT doc_id, i, sum(gap) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit) GROUP BY doc_id, r),
  piece AS (SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS before FROM span),
  cut AS (SELECT doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
      string_agg(substr(x, 2 * before + 1, 2 * (low - before)), '' ORDER BY low) AS kept FROM piece JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM h LEFT JOIN cut USING (doc_id)"""

VECTORS = """
WITH RECURSIVE v AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM (
      SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))
      WHERE len(list_filter(v, lambda x: x <> 0)) > 0),
  e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      AND CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95 END),
  reach AS (SELECT vec_id AS node, vec_id AS there FROM embeddings UNION SELECT node, b FROM reach JOIN e ON there = a),
  root AS (SELECT node, min(there) AS component_id FROM reach GROUP BY node),
  links AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN root ON node = vec_id LEFT JOIN links ON a = vec_id"""

VARIANTS = f"""
WITH RECURSIVE r AS (SELECT doc_id, {LOWER.format("run")} AS run, count(*) AS m FROM (
      SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
  k AS (SELECT run, m, {crc32("doc_id::VARCHAR || ':' || run")} AS h FROM r),
  w AS (SELECT word, sum(m)::BIGINT AS n FROM (SELECT m, CASE WHEN h % 97 = 0
      THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM k)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
  d AS (SELECT word, i, left(word, (i - 1)::INT) || substr(word, i + 1) AS rest FROM (
      SELECT word, unnest(generate_series(1, length(word))) AS i FROM w)),
  e AS (SELECT a.word AS word, b.word AS other FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word
      UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word),
  best AS (SELECT e.word, other, y.n AS other_n, count(*) OVER (PARTITION BY e.word) AS n_near, x.n AS own
      FROM e JOIN w x ON x.word = e.word JOIN w y ON y.word = other
      QUALIFY row_number() OVER (PARTITION BY e.word ORDER BY y.n DESC, other) = 1),
  f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 2 * own THEN other END AS form,
      CASE WHEN other_n >= 2 * own THEN other_n END AS form_n FROM w LEFT JOIN best ON best.word = w.word),
  chain AS (SELECT word, word AS there FROM f UNION ALL
      SELECT chain.word, f.form FROM chain JOIN f ON f.word = there WHERE f.form IS NOT NULL)
SELECT f.word, f.form, there AS root, f.n, f.n_near, f.form_n
FROM f JOIN chain ON chain.word = f.word JOIN f z ON z.word = there AND z.form IS NULL"""

RUNS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, {crc32("doc_id::VARCHAR")} AS h FROM documents),
  c AS (SELECT doc_id, words, h, len(words) AS n, CASE WHEN len(words) > 0 THEN (h // 10) % len(words) END AS a FROM w),
  p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM c),
  t AS (SELECT doc_id, i, words[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word, n FROM (
      SELECT *, unnest(range(n)) AS i FROM p)),
  same AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
      AND 4 * (y.i - x.i) <= x.n),
  part AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS b FROM same),
  rep AS (SELECT doc_id, min(i) AS start, max(i) + 1 + q AS stop, q FROM part GROUP BY doc_id, q, b
      HAVING count(*) + q >= greatest(6, 4 * q)),
  run AS (SELECT doc_id, start, stop, stop - start AS length, q FROM rep r WHERE NOT EXISTS (SELECT 1 FROM rep o
      WHERE o.doc_id = r.doc_id AND o.q < r.q AND o.start <= r.start AND o.stop >= r.stop)),
  best AS (SELECT doc_id, start, length, q FROM run QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, q) = 1),
  lines AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines
      FROM run GROUP BY doc_id),
  gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, stop)) AS i FROM run),
  rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM t ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, q::BIGINT AS period,
  (1000 * length // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents LEFT JOIN lines USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN rest USING (doc_id)"""
