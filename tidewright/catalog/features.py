"""Feature steps."""

import functools

from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.functions.columns import words
from tidewright.operators import features as fe
from tidewright.operators import terms as tm
from tidewright.session import Scratch, settle

WIDTH = 64
INF = float("inf")
COMMON = ["the", "and", "that"]

CELLS = f"FROM embeddings, range(1, {WIDTH + 1}) r(pos)"
CELL = "CAST(embedding[pos] AS DOUBLE)"
POS = "CAST(pos - 1 AS INTEGER) AS pos"
DOC_WORDS = """w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \\r\\n]'),
  lambda x: regexp_matches(x, '[^ \\t\\n\\f\\r]')) AS words FROM documents)"""


def vectors(t):
    return fe.as_vector(t.embeddings, "embedding").select("vec_id", "label", "features")


def doc_words(t):
    return t.documents.select("doc_id", words(F.col("text")).alias("words"))


def words_by_doc(t):
    """The same dealt by document while texts are whole: what is counted by document and word moves no more after that."""
    return t.documents.select("doc_id", "text").repartition("doc_id").select("doc_id", words(F.col("text")).alias("words"))


def cells(df, vector, digits=6):
    return fe.vector_rows(df, ["vec_id"], vector).withColumn("x", F.round("x", digits))


@query("fe_01_binarizer", "SELECT event_id, CASE WHEN value > 100 THEN 1.0::DOUBLE ELSE 0.0 END AS high FROM events")
def _(spark, t):
    return fe.binarize(t.events.select("event_id", "value"), "value", 100.0, "high").drop("value")


@query("fe_02_bucketizer", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity - 25) / 25 AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey,
 CASE WHEN v < -0.5 THEN 0.0::DOUBLE WHEN v < 0 THEN 1.0 WHEN v < 0.5 THEN 2.0 ELSE 3.0 END AS bucket FROM x""")
def _(spark, t):
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", ((F.col("l_quantity") - 25) / 25).alias("v"))
    return fe.bucketize(x, "v", [-INF, -0.5, 0.0, 0.5, INF], "bucket").drop("v")


@query("fe_03_quantile_buckets", """
SELECT CAST(b AS DOUBLE) AS bucket, TRUE AS near_a_third, (SELECT count(*) FROM events) AS n_rows FROM range(3) r(b)""")
def _(spark, t):
    b = fe.quantile_buckets(t.events.select("value"), "value", 3, "bucket")
    n = t.events.agg(F.count("*")).scalar()
    per = b.groupBy("bucket").agg(F.count("*").alias("c"))
    return per.select("bucket", (F.abs(F.col("c") / n - 1 / 3) < 0.01).alias("near_a_third"),
                      n.alias("n_rows"))


def chi_sql(name, condition):
    return f"""SELECT {name} AS f, sum((o - e) ** 2 / e) AS chi FROM (
      SELECT a.x, b.y, (SELECT count(*) FROM d WHERE ({condition}) = a.x AND quality = b.y) AS o,
        (SELECT count(*) FROM d WHERE ({condition}) = a.x) * (SELECT count(*) FROM d WHERE quality = b.y)
          / (SELECT count(*) FROM d) AS e
      FROM (SELECT unnest([TRUE, FALSE]) AS x) a, (SELECT unnest([0, 1]) AS y) b)"""


@query("fe_04_chi_squared_top_feature", f"""
WITH d AS (SELECT quality, toxic, n_chars, lang FROM labels JOIN documents USING (doc_id)),
c AS ({chi_sql(0, 'toxic = 1')} UNION ALL {chi_sql(1, 'n_chars > 1000')} UNION ALL {chi_sql(2, "lang = 'en'")})
SELECT f AS feature, (SELECT count(*) FROM d) AS n_rows FROM c ORDER BY chi DESC LIMIT 1""")
def _(spark, t):
    d = t.labels.join(t.documents.select("doc_id", "n_chars", "lang"), "doc_id").select(
        F.col("quality").cast("double").alias("label"), F.col("toxic").cast("double").alias("a"),
        (F.col("n_chars") > 1000).cast("double").alias("b"), (F.col("lang") == "en").cast("double").alias("c"))
    out, model = fe.top_features(fe.assemble(d, ["a", "b", "c"]), "features", "label", 1)
    return out.agg(F.count("*").alias("n_rows")).select(
        F.lit(model.selectedFeatures[0]).alias("feature"), "n_rows")


@query("fe_05_given_vocabulary_counts", f"""
WITH {DOC_WORDS} SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos,
 CAST(len(list_filter(words, lambda x: x = {COMMON}[i])) AS DOUBLE) AS x FROM w, range(1, 4) r(i)""")
def _(spark, t):
    c = fe.count_given_terms(doc_words(t), "words", "counts", COMMON)
    return fe.vector_rows(c, ["doc_id"], "counts")


@query("fe_05b_learned_vocabulary", f"""
WITH {DOC_WORDS}, u AS (SELECT doc_id, unnest(words) AS term FROM w),
top AS (SELECT term, count(*) AS n FROM u GROUP BY term HAVING count(DISTINCT doc_id) >= 2 ORDER BY n DESC, term LIMIT 3)
SELECT term, CAST(n AS DOUBLE) AS n FROM top""")
def _(spark, t):
    out, model = fe.count_terms(doc_words(t), "words", "counts", 3, 2)
    names = F.array(*[F.lit(w) for w in model.vocabulary])
    sums = fe.vector_rows(out, [], "counts").groupBy("pos").agg(F.sum("x").alias("n"))
    return sums.select(F.get(names, F.col("pos")).alias("term"), "n")


DCT_SQL = f"""SELECT vec_id, CAST(k AS INTEGER) AS pos, round(sqrt({2 / WIDTH}) * CASE WHEN k = 0 THEN sqrt(0.5) ELSE 1 END *
 sum({CELL} * cos(pi() * (pos - 0.5) * k / {WIDTH})), 5) AS x
FROM embeddings, range(1, {WIDTH + 1}) r(pos), range({WIDTH}) q(k) GROUP BY vec_id, k"""


@query("fe_06_cosine_transform", DCT_SQL)
def _(spark, t):
    return cells(fe.cosine_transform(vectors(t), "features", "y"), "y", 5)


@query("fe_06b_cosine_transform_back", f"SELECT vec_id, {POS}, round({CELL}, 5) AS x {CELLS}")
def _(spark, t):
    y = fe.cosine_transform(vectors(t), "features", "y")
    return cells(fe.cosine_transform(y, "y", "back", inverse=True), "back", 5)


@query("fe_07_elementwise_product", f"SELECT vec_id, {POS}, round({CELL} * (pos - 1), 6) AS x {CELLS}")
def _(spark, t):
    return cells(fe.weigh(vectors(t), "features", range(WIDTH), "y"), "y")


INDEX_SQL = """ix AS (SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS idx
 FROM events GROUP BY event_type)"""


@query("fe_08_string_indexer", f"WITH {INDEX_SQL} SELECT event_id, idx FROM events JOIN ix USING (event_type)")
def _(spark, t):
    return fe.index_text(t.events.select("event_id", "event_type"), "event_type", "idx")[0].drop("event_type")


@query("fe_09_index_to_string", "SELECT event_id, event_type AS back FROM events")
def _(spark, t):
    indexed, _ = fe.index_text(t.events.select("event_id", "event_type"), "event_type", "idx")
    return fe.text_of_index(indexed, "idx", "back").select("event_id", "back")


@query("fe_10_one_hot", f"""
WITH {INDEX_SQL} SELECT event_id, CAST(p AS INTEGER) AS pos, CASE WHEN idx = p THEN 1.0::DOUBLE ELSE 0.0 END AS x
FROM events JOIN ix USING (event_type), range(4) r(p)""")
def _(spark, t):
    indexed, _ = fe.index_text(t.events.select("event_id", "event_type"), "event_type", "idx")
    return fe.vector_rows(fe.one_hot(indexed, "idx", "flags")[0], ["event_id"], "flags")


@query("fe_11_min_max_scaler", f"""
WITH c AS (SELECT vec_id, pos, {CELL} AS v {CELLS}), m AS (SELECT pos, min(v) AS lo, max(v) AS hi FROM c GROUP BY pos)
SELECT vec_id, {POS}, round(CASE WHEN hi = lo THEN 0.5 ELSE (v - lo) / (hi - lo) END, 6) AS x FROM c JOIN m USING (pos)""")
def _(spark, t):
    return cells(fe.scale_min_max(vectors(t), "features", "y")[0], "y")


@query("fe_12_standard_scaler", f"""
WITH c AS (SELECT vec_id, pos, {CELL} AS v {CELLS}), m AS (SELECT pos, stddev_samp(v) AS sd FROM c GROUP BY pos)
SELECT vec_id, {POS}, round(CASE WHEN sd = 0 THEN 0 ELSE v / sd END, 6) AS x FROM c JOIN m USING (pos)""")
def _(spark, t):
    return cells(fe.scale_deviation(vectors(t), "features", "y")[0], "y")


@query("fe_13_normalizer_l1", f"""
WITH c AS (SELECT vec_id, pos, {CELL} AS v {CELLS}), m AS (SELECT vec_id, sum(abs(v)) AS s FROM c GROUP BY vec_id)
SELECT vec_id, {POS}, round(v / s, 6) AS x FROM c JOIN m USING (vec_id)""")
def _(spark, t):
    return cells(fe.normalize(vectors(t), "features", "y", 1.0), "y")


@query("fe_13b_normalizer_max", f"""
WITH c AS (SELECT vec_id, pos, {CELL} AS v {CELLS}), m AS (SELECT vec_id, max(abs(v)) AS s FROM c GROUP BY vec_id)
SELECT vec_id, {POS}, round(v / s, 6) AS x FROM c JOIN m USING (vec_id)""")
def _(spark, t):
    return cells(fe.normalize(vectors(t), "features", "y", INF), "y")


@query("fe_14_bigrams", f"""
WITH {DOC_WORDS} SELECT bigram, count(*) AS n FROM
 (SELECT unnest(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigram FROM w)
GROUP BY bigram""")
def _(spark, t):
    return tm.bigram_counts(t.documents)


@query("fe_15_principal_components", """
SELECT CAST(k AS INTEGER) AS component, TRUE AS unit_length, TRUE AS share_matches_projection, (SELECT count(*) FROM embeddings) AS n_rows
FROM range(3) r(k)""")
def _(spark, t):
    projected, model = fe.principal_components(vectors(t), "features", 3)
    shares, pc = model.explainedVariance.toArray(), model.pc.toArray()
    total = fe.vector_rows(projected, ["vec_id"], "features").groupBy("pos").agg(
        F.var_samp("x").alias("v")).agg(F.sum("v")).scalar()
    per = fe.vector_rows(projected, ["vec_id"], "projected").groupBy(F.col("pos").alias("component")).agg(
        F.var_samp("x").alias("v"), F.count("*").alias("n_rows"))
    share = F.get(F.array(*[F.lit(float(s)) for s in shares]), F.col("component"))
    unit = F.get(F.array(*[F.lit(float((pc[:, k] ** 2).sum())) for k in range(3)]), F.col("component"))
    return per.select("component", (F.abs(unit - 1) < 1e-9).alias("unit_length"),
                      (F.abs(F.col("v") / total - share) < 1e-9).alias("share_matches_projection"), "n_rows")


@query("fe_16_polynomial_expansion", """
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS a, l_tax AS b FROM lineitem),
e AS (SELECT l_orderkey, l_linenumber, l_partkey, [a, a*a, a*a*a, b, a*b, a*a*b, b*b, a*b*b, b*b*b] AS v FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(i - 1 AS INTEGER) AS pos, round(v[i], 6) AS x FROM e, range(1, 10) r(i)""")
def _(spark, t):
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    v = fe.assemble(t.lineitem.select(*key, "l_discount", "l_tax"), ["l_discount", "l_tax"])
    e = fe.expand_polynomial(v, "features", 3, "y")
    return fe.vector_rows(e, key, "y").withColumn("x", F.round("x", 6))


@query("fe_17_formula", """
WITH ix AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i, count(*) OVER () AS k
 FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 1.0::DOUBLE ELSE 0.0 END AS label, CAST(s AS INTEGER) AS pos,
 CASE WHEN s = k - 1 THEN CAST(month(o_orderdate) AS DOUBLE) WHEN s = i THEN 1.0 ELSE 0.0 END AS x
FROM orders JOIN ix ON o_orderpriority = p, range(5) r(s)""")
def _(spark, t):
    o = t.orders.select("o_orderkey", (F.col("o_totalprice") > 200000).cast("double").alias("expensive"),
                        "o_orderpriority", F.month("o_orderdate").alias("month"))
    out, _ = fe.formula(o, "expensive ~ o_orderpriority + month")
    return fe.vector_rows(out, ["o_orderkey", "label"], "features")


@query("fe_18_sql_step", """
SELECT o_orderkey, o_totalprice / 2 AS half, upper(o_orderstatus) AS status FROM orders""")
def _(spark, t):
    return SQLTransformer(statement="SELECT o_orderkey, o_totalprice / 2 AS half, "
                                    "upper(o_orderstatus) AS status FROM __THIS__").transform(t.orders)


@query("fe_19_stop_words", f"""
WITH {DOC_WORDS} SELECT doc_id, len(words) AS n_words,
 len(list_filter(words, lambda x: NOT list_contains({COMMON}, lower(x)))) AS n_kept FROM w""")
def _(spark, t):
    out = fe.drop_stop_words(doc_words(t), "words", "kept", COMMON)
    return out.select("doc_id", F.size("words").cast("bigint").alias("n_words"),
                      F.size("kept").cast("bigint").alias("n_kept"))


@query("fe_20_tokenizer", r"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s')) AS token FROM documents)
WHERE token <> '' GROUP BY token""")
def _(spark, t):
    w = fe.tokenize(t.documents.select("text"), "text").select(F.explode("words").alias("token"))
    return w.filter("token <> ''").groupBy("token").agg(F.count("*").alias("n"))


@query("fe_21_pattern_tokenizer", r"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W')) AS token FROM documents)
WHERE token <> '' GROUP BY token""")
def _(spark, t):
    w = fe.tokenize_by_pattern(t.documents.select("text"), "text").select(F.explode("words").alias("token"))
    return w.groupBy("token").agg(F.count("*").alias("n"))


@query("fe_21b_pattern_matches", r"""
SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\w+')) AS token FROM documents)
GROUP BY token""")
def _(spark, t):
    w = fe.tokenize_by_pattern(t.documents.select("text"), "text", r"\w+", gaps=False)
    return w.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query("fe_22_hashed_term_counts", f"""
WITH {DOC_WORDS} SELECT doc_id, CAST(len(words) AS DOUBLE) AS total, TRUE AS within_width FROM w""")
def _(spark, t):
    h = fe.hash_terms(doc_words(t), "words", "counts", 1000).select("doc_id", vector_to_array("counts").alias("v"))
    return h.select("doc_id", F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("total"),
                    (F.size("v") == 1000).alias("within_width"))


@query("fe_23_term_weights", f"""
WITH {DOC_WORDS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM w) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc_id, count(*) AS terms, round(sum(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1))), 4) AS weight
FROM tf JOIN df USING (term) GROUP BY doc_id""")
def _(spark, t):
    return fe.term_weights(t.documents, "doc_id", "text").groupBy("doc_id").agg(
        F.count("*").alias("terms"), F.round(F.sum("tfidf"), 4).alias("weight"))


@query("fe_23b_idf_model", f"""
WITH {DOC_WORDS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM w) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc_id, term, round(tf * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS x FROM tf JOIN df USING (term)""")
def _(spark, t):
    # Counted once, for the frequencies and for the result; the vocabulary is as large as it is and stays a table.
    counts = settle(tm.term_counts(words_by_doc(t), ["doc_id"]))
    weights = tm.TermWeights.of_counts(counts, t.documents.count())
    return weights.weigh(counts, ["doc_id"]).select("doc_id", "term", F.round("tfidf", 6).alias("x"))


@query("fe_24_vector_assembler", f"""
SELECT vec_id, CAST(p AS INTEGER) AS pos, round(CASE WHEN p = 0 THEN label WHEN p = 1 THEN vec_id ELSE CAST(embedding[p - 1] AS DOUBLE) END, 6) AS x
FROM embeddings, range({WIDTH + 2}) r(p)""")
def _(spark, t):
    return cells(fe.assemble(vectors(t), ["label", "vec_id", "features"], "all"), "all")


@query("fe_25_vector_indexer", """
WITH ix AS (SELECT l_linenumber, CAST(row_number() OVER (ORDER BY l_linenumber) - 1 AS DOUBLE) AS i FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_partkey, l_linenumber, i AS line_index, l_quantity AS quantity, 1 AS n_categorical
FROM lineitem JOIN ix USING (l_linenumber)""")
def _(spark, t):
    key = ["l_orderkey", "l_partkey", "l_linenumber"]
    v = fe.assemble(t.lineitem.select(*key, "l_quantity"), ["l_linenumber", "l_quantity"])
    out, model = fe.index_vector(v, "features", "indexed", 10)
    arr = vector_to_array("indexed")
    return out.select(*key, F.get(arr, 0).alias("line_index"), F.get(arr, 1).alias("quantity"),
                      F.lit(len(model.categoryMaps)).alias("n_categorical"))


@query("fe_26_vector_slicer", """
SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, round(CAST(embedding[[2, 6, 64][p]] AS DOUBLE), 6) AS x FROM embeddings, range(1, 4) r(p)""")
def _(spark, t):
    named = fe.name_components(vectors(t), "features", [f"f{i}" for i in range(WIDTH)])
    return cells(fe.slice_vector(named, "features", "y", indices=[1, 5], names=["f63"]), "y")


@query("fe_27_word_vectors_of_documents", """
SELECT doc_id, TRUE AS is_mean_of_its_words FROM documents""")
def _(spark, t):
    docs = words_by_doc(t)
    model = tm.WordVectors.fit(docs)
    out = model.transform(docs, ["doc_id"], name="v")
    # Words of a turn at a time here too: a row for every word of all documents is several times the input.
    scratch = Scratch(spark)
    every, vectors = docs.select("doc_id", F.explode("words").alias("word")), model.terms.select("word", "vector")
    sums = [scratch.settle(every.filter(tm.in_turn("word", k)).join(vectors.filter(tm.in_turn("word", k)), "word").groupBy("doc_id").agg(
        F.count("*").alias("n"), *[F.sum(F.get("vector", i)).alias(f"s{i}") for i in range(3)])) for k in range(tm.TURNS)]
    scratch.keep(*sums)
    means = functools.reduce(DataFrame.union, sums).groupBy("doc_id").agg(
        *[(F.sum(f"s{i}") / F.sum("n")).alias(f"m{i}") for i in range(3)])
    off = [F.abs(F.get("v", i) - F.coalesce(f"m{i}", F.lit(0.0))) < 1e-9 for i in range(3)]
    return out.join(means, "doc_id", "left").select("doc_id", (off[0] & off[1] & off[2]).alias("is_mean_of_its_words"))


@query("fe_28_near_words", """
SELECT CAST(40 AS BIGINT) AS n, TRUE AS cosines_agree, TRUE AS none_nearer, CAST(0 AS BIGINT) AS same_word""")
def _(spark, t):
    model = tm.WordVectors.fit(doc_words(t))
    near = settle(model.nearest("the", 40))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    u = model.terms.select("word", F.col("vector").alias("u"))
    the = u.filter("word = 'the'").select(F.col("u").alias("v"))
    others = u.filter("word <> 'the'").select("word", "u", the.scalar().alias("v")).select(
        "word", (dot("u", "v") / F.sqrt(dot("u", "u") * dot("v", "v"))).alias("cosine"))
    both = others.join(near, "word", "left")
    listed = F.col("similarity").isNotNull()
    return both.agg(
        F.count_if(listed).alias("n"), F.every(F.coalesce(F.abs(F.col("similarity") - F.col("cosine")) < 1e-4, F.lit(True))).alias("cosines_agree"),
        (F.min("similarity") >= F.max(F.when(~listed, F.col("cosine"))) - 1e-4).alias("none_nearer"),
        near.filter("word = 'the'").agg(F.count("*")).scalar().alias("same_word"))


@query("fe_29_bias_term", f"""
SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, round(coalesce(CAST(embedding[p] AS DOUBLE), 1.0), 6) AS x FROM embeddings, range(1, {WIDTH + 2}) r(p)""")
def _(spark, t):
    return cells(fe.with_bias(vectors(t), "features", "y"), "y")


@query("fe_30_price_features", """
WITH d AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, dayofweek(any_value(l_shipdate)) AS dow, sum(l_quantity) AS units,
  sum(l_extendedprice) AS price FROM lineitem GROUP BY 1)
SELECT day, CAST(p AS INTEGER) AS pos, round(ln(units + 1), 6) AS label,
 round(CASE WHEN p = 0 THEN ln((SELECT max(price / units) FROM d) / (price / units)) WHEN p = dow + 1 THEN 1 ELSE 0 END, 6) AS x
FROM d, range(8) r(p)""")
def _(spark, t):
    from tidewright.operators.aggregates import daily_sales
    d = daily_sales(t.lineitem, "l_shipdate", "l_quantity", "l_extendedprice").withColumn(
        "unit_price", F.col("price") / F.col("units"))
    flags = F.array(*[F.when(F.dayofweek("day") == i, 1.0).otherwise(0.0) for i in range(1, 8)])
    out = fe.price_features(d.withColumn("flags", flags), F.col("unit_price"), F.col("units"),
                            d.select(F.max("unit_price")).scalar(), "flags")
    return fe.vector_rows(out, ["day", "label"], "features").select(
        "day", "pos", F.round("label", 6).alias("label"), F.round("x", 6).alias("x"))
