"""Fitted models. Where a fit has a closed form the SQL computes it; elsewhere the query
returns row counts and properties that must hold."""

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.catalog.evaluation import rounded
from tidewright.catalog.features import COMMON, DOC_WORDS, doc_words, vectors
from tidewright.catalog.relational import ratings
from tidewright.operators import certificates as ct
from tidewright.operators import evaluation as ev
from tidewright.operators import features as fe
from tidewright.operators import models as md
from tidewright.operators import monotone as mono
from tidewright.operators import recommend as rc
from tidewright.operators import terms as tm
from tidewright.operators.graphs import logistic_descent
from tidewright.operators.relational import key_split
from tidewright.session import Scratch, fresh_path, settle


def halves(df, *key):
    return key_split(df, list(key), [0.7, 0.3], seed=1)


def two_classes(t):
    return vectors(t).withColumn("label", (F.col("label") < 5).cast("double"))


def ten_classes(t):
    return vectors(t).withColumn("label", F.col("label").cast("double"))


EMBEDDED = "FROM embeddings"
#: How far from level a converged fit may be, as a share of the slope at weights of 0; a hinge has kinks that no fit meets exactly.
SLOPE, HINGE_SLOPE, SURVIVAL_SLOPE = 1e-4, 0.05, 1e-3
#: Share of the right side that solved factors, which are single precision, may be off by.
RESIDUAL = 1e-3
HELD_OUT = "SELECT count(*) AS n_rows, TRUE AS better_than_constant FROM lineitem"


def price_classes(t):
    """Three classes of what a line's quantity comes to after discount and tax, to be told from quantity, retail price,
    discount and tax: no single one of them tells the class near its limits."""
    retail = t.part.select(F.col("p_partkey").alias("l_partkey"), (F.col("p_retailprice") / 1000).alias("retail"))
    net = F.col("l_quantity") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    d = t.lineitem.join(retail, "l_partkey").select(
        "l_orderkey", "l_partkey", (F.col("l_quantity") / 50).alias("qty"), "retail", "l_discount", "l_tax",
        F.when(net < 15, 0.0).when(net < 32, 1.0).otherwise(2.0).alias("label"))
    return fe.assemble(d, ["qty", "retail", "l_discount", "l_tax"])


def constant_error(test, label="label"):
    """Share of rows that the best constant guess gets wrong."""
    return 1 - test.groupBy(label).count().agg(F.max("count") / F.sum("count")).scalar()


def held_out(model, train, test):
    """Rows of both parts, and whether errors on unseen rows are under nine tenths of those of the best constant guess."""
    n = train.select(F.lit(1)).union(test.select(F.lit(1))).agg(F.count("*").alias("n_rows"))
    error = ev.accuracy(model.transform(test)).select("test_error").scalar()
    return n.select("n_rows", (error < constant_error(test) * 0.9).alias("better_than_constant"))


@query("cl_01_logistic_elastic_net", f"""
SELECT count(*) AS n_rows, TRUE AS sparse, TRUE AS loss_falls, TRUE AS optimal {EMBEDDED}""")
def _(spark, t):
    d = two_classes(t)
    m = md.logistic(d, maxIter=200, tol=1e-10, regParam=0.05, elasticNetParam=0.8)
    loss = m.summary.objectiveHistory
    zeros = sum(1 for w in m.coefficients if w == 0.0)
    slopes = ct.linear_slopes(d, m.coefficients.toArray(), m.intercept, "logistic", 0.05, 0.8)
    # The fit starts at weights of 0. Where these are the least point already, and are shown to be, there is nothing to fall.
    stays = zeros == len(m.coefficients) and slopes.worst() < SLOPE
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(zeros > 0).alias("sparse"), F.lit(loss[-1] < loss[0] or (stays and loss[-1] == loss[0])).alias("loss_falls"),
        F.lit(slopes.worst() < SLOPE).alias("optimal"))


@query("cl_02_logistic_by_gradient_steps", f"SELECT count(*) AS n_rows, TRUE AS steps_follow_slopes, TRUE AS slopes_halved {EMBEDDED}")
def _(spark, t):
    d = two_classes(t)
    points = d.select((F.col("label") * 2 - 1).alias("y"), vector_to_array("features").alias("x"))
    n = d.count()
    # A step is as long as the curvature allows: that of the mean loss is at most a quarter of the mean squared length.
    width = points.agg(F.avg(F.aggregate("x", F.lit(0.0), lambda a, x: a + x * x))).first()[0]
    step = 4 / width / n
    before = np.array(logistic_descent(points, [0.0] * 64, rounds=9, step=step))
    after = np.array(logistic_descent(points, list(before), rounds=1, step=step))
    level = lambda w: ct.loss_slopes(d, w, 0.0, "logistic")
    moved = np.abs(before - step * n * level(before)[2][0, :-1] - after).max()
    _, _, last, _, first, _ = level(logistic_descent(points, list(after), rounds=60, step=step))
    left = np.abs(last[0, :-1]).max() / np.abs(first[0, :-1]).max()
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(bool(moved < 1e-9 * np.abs(after).max())).alias("steps_follow_slopes"), F.lit(bool(left < 0.5)).alias("slopes_halved"))


@query("cl_03_logistic_ten_classes", f"SELECT count(*) AS n_rows, 10 AS classes, TRUE AS scores_sum_to_one, TRUE AS optimal {EMBEDDED}")
def _(spark, t):
    d = ten_classes(t)
    m = md.logistic(d, maxIter=200, tol=1e-10, regParam=0.01, family="multinomial")
    slopes = ct.linear_slopes(d, m.coefficientMatrix.toArray(), m.interceptVector.toArray(), "logistic", 0.01)
    p = m.transform(d).select(vector_to_array("probability").alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda s, x: s + x)
    return p.agg(F.count("*").alias("n_rows"), F.lit(m.numClasses).alias("classes"),
                 F.every(F.abs(total - 1) < 1e-9).alias("scores_sum_to_one"), F.lit(slopes.worst() < SLOPE).alias("optimal"))


@query("cl_04_summary_and_best_threshold", f"""
SELECT count(*) AS n_rows, TRUE AS auc_agrees, TRUE AS threshold_agrees, TRUE AS loss_falls {EMBEDDED}""")
def _(spark, t):
    d = two_classes(t)
    m = md.logistic(d, maxIter=10, regParam=0.01)
    scored = m.transform(d).select(F.get(vector_to_array("probability"), 1).alias("score"), "label", "features")
    auc = ev.area_under_roc(ev.threshold_counts(scored, "score", "label")).first()["auc"]
    tuned, best = md.with_best_threshold(m, m.transform(d))
    f1 = ev.class_measures(ev.confusion(tuned.transform(d))).filter("class = 1").first()["f1"]
    loss = m.summary.objectiveHistory
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(abs(auc - m.summary.areaUnderROC) < 0.01).alias("auc_agrees"),
        F.lit(abs(f1 - best["f1"]) < 1e-9).alias("threshold_agrees"), F.lit(loss[-1] < loss[0]).alias("loss_falls"))


@query("cl_05_margin_classifier", f"SELECT count(*) AS n_rows, TRUE AS auc_agrees, TRUE AS nearly_optimal {EMBEDDED}")
def _(spark, t):
    d = two_classes(t)
    m = md.margin_classifier(d.persist(), maxIter=150, tol=1e-12, regParam=0.01)
    slopes = ct.linear_slopes(d, m.coefficients.toArray(), m.intercept, "hinge", 0.01)
    raw = m.transform(d)
    s = raw.select(F.get(vector_to_array("rawPrediction"), 1).alias("score"), "label")
    auc = ev.area_under_roc(ev.threshold_counts(s, "score", "label")).first()["auc"]
    other = BinaryClassificationEvaluator().evaluate(raw)
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(abs(auc - other) < 0.01).alias("auc_agrees"), F.lit(slopes.worst() < HINGE_SLOPE).alias("nearly_optimal"))


@query("cl_06_naive_bayes", f"""
WITH {DOC_WORDS}, d AS (SELECT quality, doc_id, words FROM w JOIN labels USING (doc_id)),
c AS (SELECT quality, term, count(*) AS tf FROM (SELECT quality, unnest(words) AS term FROM d) GROUP BY ALL),
v AS (SELECT DISTINCT term FROM c), q AS (SELECT quality, count(*) AS docs FROM d GROUP BY 1),
k AS (SELECT quality, sum(tf) AS total FROM c GROUP BY quality), n AS (SELECT (SELECT count(*) FROM v) AS v, (SELECT count(*) FROM d) AS d)
SELECT CAST(q.quality AS DOUBLE) AS class, v.term, round(ln((coalesce(tf, 0) + 1) / (total + n.v)), 6) AS log_term,
 round(ln((docs + 1) / (n.d + 2)), 6) AS log_class FROM q JOIN k USING (quality) CROSS JOIN v CROSS JOIN n
 LEFT JOIN c ON c.quality = q.quality AND c.term = v.term""")
def _(spark, t):
    docs = doc_words(t).join(t.labels, "doc_id")
    m = tm.TermBayes.fit(docs, "quality", smoothing=1.0)
    return rounded(m.log_terms().select("class", "term", "log_term", "log_class"), "class", "term")


@query("cl_07_tree_classifier", "SELECT count(*) AS n_rows, TRUE AS better_than_constant, TRUE AS printed FROM lineitem")
def _(spark, t):
    train, test = halves(price_classes(t), "l_orderkey", "l_partkey")
    m = md.tree_classifier(train)
    return held_out(m, train, test).withColumn("printed", F.lit("If (feature" in m.toDebugString))


@query("cl_08_forest_classifier", HELD_OUT)
def _(spark, t):
    train, test = halves(price_classes(t), "l_orderkey", "l_partkey")
    return held_out(md.forest_classifier(train, trees=3, seed=12345), train, test)


@query("cl_09_boosted_classifier", HELD_OUT)
def _(spark, t):
    d = price_classes(t).withColumn("label", (F.col("label") > 0).cast("double"))
    train, test = halves(d, "l_orderkey", "l_partkey")
    return held_out(md.boosted_classifier(train, rounds=3), train, test)


@query("cl_10_perceptron", HELD_OUT)
def _(spark, t):
    train, test = halves(price_classes(t), "l_orderkey", "l_partkey")
    return held_out(md.perceptron(train, [4, 5, 4, 3], rounds=40), train, test)


# ---- numbers --------------------------------------------------------------------------


def priced(t):
    """Extended price in thousands against quantity."""
    return fe.assemble(t.lineitem.select(F.col("l_quantity").alias("q"),
                                         (F.col("l_extendedprice") / 1000).alias("label")), ["q"])


@query("rg_01_linear_regression_shifted", """
WITH x AS (SELECT l_quantity AS q, l_extendedprice / 1000 AS y FROM lineitem)
SELECT round(regr_slope(y, q), 6) AS slope, round(regr_intercept(y, q), 6) AS intercept,
 round(avg(q) * regr_slope(y, q) + regr_intercept(y, q) + 17, 4) AS mean_shifted FROM x""")
def _(spark, t):
    d = priced(t)
    m = md.linear(d, solver="normal")
    moved = md.shifted(m.transform(d), 17)
    return moved.agg(F.round(F.lit(float(m.coefficients[0])), 6).alias("slope"),
                     F.round(F.lit(float(m.intercept)), 6).alias("intercept"),
                     F.round(F.avg("prediction"), 4).alias("mean_shifted"))


@query("rg_02_linear_elastic_net_summary", """
WITH x AS (SELECT l_quantity AS q, l_extendedprice / 1000 AS y FROM lineitem),
m AS (SELECT count(*) AS n, (count(*) - 1) / count(*) AS k, corr(q, y) AS r, stddev_samp(q) AS sq, stddev_samp(y) AS sy, avg(q) AS mq, avg(y) AS my FROM x),
w AS (SELECT *, greatest(k * r - 0.3 / sy * 0.8, 0) / (k + 0.3 / sy * 0.2) * sy / sq AS slope FROM m)
SELECT n AS n_rows, TRUE AS r2_agrees, TRUE AS rmse_agrees, round(slope, 4) AS slope, round(my - slope * mq, 3) AS intercept FROM w""")
def _(spark, t):
    # With one feature the optimum is a soft threshold of the correlation, in units of both deviations.
    d = priced(t)
    m = md.linear(d, regParam=0.3, elasticNetParam=0.8, maxIter=100, tol=1e-9, solver="l-bfgs")
    own = ev.regression_measures(m.transform(d)).first()
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(abs(own["r2"] - m.summary.r2) < 1e-6).alias("r2_agrees"),
        F.lit(abs(own["rmse"] - m.summary.rootMeanSquaredError) < 1e-6).alias("rmse_agrees"),
        F.round(F.lit(float(m.coefficients[0])), 4).alias("slope"), F.round(F.lit(float(m.intercept)), 3).alias("intercept"))


@query("rg_03_survival", "SELECT count(*) AS n_rows, TRUE AS quantiles_ordered, TRUE AS most_likely FROM events")
def _(spark, t):
    # The value is the time to an error; events of other kinds are censored.
    e = t.events.select(F.col("value").alias("label"), (F.col("event_type") == "error").cast("double").alias("censor"),
                        F.hour("ts").alias("hour"), F.from_json("props", "k int").alias("p"))
    d = fe.assemble(e.select("label", "censor", "hour", F.col("p.k").alias("k")), ["hour", "k"])
    # A time of 0 has no logarithm, so no likelihood: such events teach nothing, but are scored as all others.
    timed = d.filter("label > 0")
    m = md.survival(timed)
    slopes = ct.survival_slopes(timed, m.coefficients.toArray(), m.intercept, m.scale)
    q = m.transform(d).select(vector_to_array("quantiles").alias("q"))
    return q.agg(F.count("*").alias("n_rows"), F.every(F.get("q", 0) < F.get("q", 1)).alias("quantiles_ordered"),
                 F.lit(bool(np.abs(slopes).max() < SURVIVAL_SLOPE)).alias("most_likely"))


def regression_rows(t):
    """Total price of an order from its number of lines, total quantity and largest discount."""
    li = t.lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("lines"), F.sum("l_quantity").alias("qty"), F.max("l_discount").alias("disc"),
        (F.sum("l_extendedprice") / 1000).alias("label"))
    return fe.assemble(li, ["lines", "qty", "disc"]).select("l_orderkey", "label", "features")


REGRESSED = """SELECT count(DISTINCT l_orderkey) AS n_rows, TRUE AS explains_half FROM lineitem"""


def held_out_r2(fit, t):
    train, test = halves(regression_rows(t), "l_orderkey")
    r2 = ev.regression_measures(fit(train).transform(test)).select("r2").scalar()
    n = train.select("label").union(test.select("label")).agg(F.count("*").alias("n_rows"))
    return n.select("n_rows", (r2 > 0.5).alias("explains_half"))


@query("rg_04_tree_regressor", REGRESSED)
def _(spark, t):
    return held_out_r2(md.tree_regressor, t)


@query("rg_05_forest_regressor", REGRESSED)
def _(spark, t):
    return held_out_r2(lambda d: md.forest_regressor(d, trees=3, seed=12345, maxDepth=4), t)


@query("rg_06_boosted_regressor", REGRESSED)
def _(spark, t):
    return held_out_r2(lambda d: md.boosted_regressor(d, rounds=3), t)


@query("rg_07_isotonic", """
WITH p AS (SELECT CAST(p_size AS DOUBLE) AS x, sum(p_retailprice) AS s, count(*) AS w FROM part GROUP BY 1),
c AS (SELECT x, s, w, sum(s) OVER (ORDER BY x) AS cs, sum(w) OVER (ORDER BY x) AS cw FROM p),
g AS (SELECT i.x AS x, j.x AS lo, min((k.cs - j.cs + j.s) / (k.cw - j.cw + j.w)) AS m
      FROM c i JOIN c j ON j.x <= i.x JOIN c k ON k.x >= i.x GROUP BY 1, 2)
SELECT x AS feature, round(max(m), 4) AS prediction FROM g GROUP BY x""")
def _(spark, t):
    blocks = mono.monotone_blocks(t.part, "p_size", "p_retailprice", per_range=20)
    points = t.part.select(F.col("p_size").cast("double").alias("feature")).distinct()
    return mono.monotone_values(blocks, points, "feature").select("feature", F.round("prediction", 4).alias("prediction"))


# ---- groups ---------------------------------------------------------------------------


@query("km_01_k_means", f"SELECT count(*) AS n_rows, 10 AS k, TRUE AS cost_agrees {EMBEDDED}")
def _(spark, t):
    d = vectors(t)
    m = md.k_means(d, 10, seed=1)
    cost = md.within_cost(m.transform(d), m.clusterCenters()).first()["cost"]
    # The cost of a fit is that of the centres which its last round began with; the ones it ended with can only be nearer.
    other, trained = md.cost_by_distances(d, m.clusterCenters()), m.summary.trainingCost
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(m.clusterCenters())).alias("k"),
        F.lit(abs(cost - other) <= 1e-6 * other and cost <= trained * (1 + 1e-6)).alias("cost_agrees"))


@query("km_02_bisecting_k_means", f"SELECT count(*) AS n_rows, 4 AS k, TRUE AS cost_agrees {EMBEDDED}")
def _(spark, t):
    d = vectors(t)
    m = md.bisecting_k_means(d, 4, seed=1)
    cost = md.within_cost(m.transform(d), m.clusterCenters()).first()["cost"]
    # Of this model's own centres: the cost of its summary is that of the groups before the last round moved them.
    other = m.computeCost(d)
    return d.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(m.clusterCenters())).alias("k"), F.lit(abs(cost - other) <= 1e-6 * other).alias("cost_agrees"))


TOPIC_WIDTH = 1 << 14


@query("km_03_topics", """
SELECT count(*) AS n_docs, 3 AS topics, TRUE AS mixes_sum_to_one, 3 AS terms_each, TRUE AS bounded FROM documents""")
def _(spark, t):
    # Hashed counts hold all terms in a stated width, whatever the vocabulary.
    # They are written once: every round draws its rows from all of them.
    counted = settle(fe.hash_terms(doc_words(t), "words", "features", TOPIC_WIDTH).select(F.size("words").alias("n"), "features"))
    m = md.topics(counted, 3, rounds=10, seed=1, optimizer="online")
    mix = m.transform(counted).select(vector_to_array("topicDistribution").alias("m"))
    total = F.aggregate("m", F.lit(0.0), lambda s, x: s + x)
    terms = {len(r["termIndices"]) for r in m.describeTopics(3).collect()}
    # The perplexity is the same bound by the word, so it takes no second pass of inference.
    tokens = counted.agg(F.sum("n")).first()[0]
    likelihood = m.logLikelihood(counted)
    bounded = likelihood < 0 < -likelihood / tokens
    # A document without a known term has no mix: its row is all zeros.
    return mix.agg(F.count("*").alias("n_docs"), F.lit(m.topicsMatrix().numCols).alias("topics"),
                   F.every((F.abs(total - 1) < 1e-6) | (total == 0)).alias("mixes_sum_to_one"),
                   F.lit(terms.pop()).alias("terms_each"), F.lit(bool(bounded)).alias("bounded"))


@query("km_04_power_iteration", """
SELECT n_nationkey AS id, n_nationkey % 2 = 0 AS with_the_first FROM nation""")
def _(spark, t):
    # Two planted groups: nations of even and of odd number, tied strongly inside and weakly across.
    n = t.nation.select(F.col("n_nationkey").cast("bigint").alias("src"))
    pairs = n.join(n.select(F.col("src").alias("dst")), F.col("src") < F.col("dst"))
    tie = F.when(F.col("src") % 2 == F.col("dst") % 2, 1.0).otherwise(0.01)
    groups = md.power_iteration_groups(pairs.withColumn("similarity", tie), 2, 30)
    first = groups.filter("id = 0").select("cluster").scalar()
    return groups.select(F.col("id").cast("int").alias("id"), (F.col("cluster") == first).alias("with_the_first"))


# ---- recommendation -------------------------------------------------------------------

RATED = "(SELECT DISTINCT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def ids(df):
    return df.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"),
                     F.col("rating").cast("float").alias("rating"))


@query("rc_01_factors", f"SELECT count(*) AS predicted, TRUE AS solved, CAST(0 AS BIGINT) AS unknown_predicted FROM {RATED}")
def _(spark, t):
    r = Scratch(spark).settle(ids(ratings(t)))
    m = rc.fit_factors(r, rank=4, rounds=10, reg=0.1, seed=5)
    scored = m.transform(r.select("user", "item"))
    # As many strangers as users, each with an item that is known.
    strangers = m.transform(r.groupBy((-F.col("user") - 1).alias("user")).agg(F.min("item").alias("item")))
    # Users are solved last, so their factors are exact for the items' as these are.
    left = ct.factor_residuals(r, m.userFactors, m.itemFactors, 0.1).agg(F.max("residual")).scalar()
    return scored.agg(F.count("*").alias("predicted"), (left < RESIDUAL).alias("solved"),
                      strangers.agg(F.count("*")).scalar().alias("unknown_predicted"))


@query("rc_02_rank_by_validation", """
SELECT CAST(rank AS INTEGER) AS rank, TRUE AS solved, TRUE AS better_than_no_factors, CAST(1 AS BIGINT) AS n_chosen
FROM (SELECT unnest([4, 8, 12]) AS rank)""")
def _(spark, t):
    scratch = Scratch(spark)
    train, validation = key_split(scratch.settle(ids(ratings(t))), ["user", "item"], [0.8, 0.2], 3)
    best, models, errors = rc.fit_ranks(train, validation, (4, 8, 12), rounds=10, seed=5)
    left = {r: ct.factor_residuals(train, m.userFactors, m.itemFactors, 0.1).agg(F.max("residual")).first()[0] for r, m in models.items()}
    guess = rc.zero_error(validation, train)
    scratch.drop(*[x for x, _ in scratch.tables.values()])
    rows = [(r, left[r] < RESIDUAL, errors[best] < guess, int(errors[best] == min(errors.values()))) for r in errors]
    return spark.createDataFrame(rows, "rank int, solved boolean, better_than_no_factors boolean, n_chosen bigint")


NEW_USER = -1


def new_ratings(t):
    """A new user likes the twenty largest parts."""
    return t.part.orderBy(F.desc("p_size"), "p_partkey").limit(20).select(
        F.lit(NEW_USER).alias("user"), F.col("p_partkey").cast("int").alias("item"), F.lit(50.0).cast("float").alias("rating"))


@query("rc_03_report_for_new_user", """
SELECT CAST(25 AS BIGINT) AS listed, CAST(0 AS BIGINT) AS already_rated, TRUE AS all_rated_often, TRUE AS titled""")
def _(spark, t):
    mine = new_ratings(t)
    all_ratings = Scratch(spark).settle(ids(ratings(t)).unionByName(mine))
    m = rc.fit_factors(all_ratings, rank=4, rounds=10, seed=5)
    titles = t.part.select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"))
    best = rc.recommend_for(m, NEW_USER, titles.select("item"), all_ratings, titles)
    return best.agg(F.count("*").alias("listed"),
                    best.join(mine, "item", "left_semi").agg(F.count("*")).scalar().alias("already_rated"),
                    F.every(F.col("ratings") >= 25).alias("all_rated_often"), F.every(F.col("title") != "").alias("titled"))


@query("rc_03b_report_by_popularity", f"""
WITH r AS {RATED}, c AS (SELECT l_partkey AS item, count(*) AS ratings FROM r GROUP BY 1 HAVING count(*) >= 25)
SELECT p_name AS title, CAST(item AS INTEGER) AS item, ratings, CAST(ratings AS DOUBLE) AS prediction FROM c JOIN part ON item = p_partkey
WHERE item NOT IN (SELECT l_partkey FROM r WHERE o_custkey = 1) ORDER BY ratings DESC, item LIMIT 25""")
def _(spark, t):
    r = Scratch(spark).settle(ids(ratings(t)))
    titles = t.part.select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"))
    counts = rc.item_counts(r)
    guess = rc.unrated(titles, r, 1).join(counts, "item").select("item", F.col("ratings").cast("double").alias("prediction"))
    return rc.report(guess, titles, counts)


@query("rc_04_search_with_predictions", """
SELECT CAST(p_partkey AS INTEGER) AS item, p_name AS title, p_partkey IN (SELECT l_partkey FROM lineitem) AS predicted
FROM part WHERE contains(p_name, 'ring')""")
def _(spark, t):
    r = Scratch(spark).settle(ids(ratings(t)))
    m = rc.fit_factors(r, rank=4, rounds=10, seed=5)
    titles = t.part.select(F.col("p_partkey").cast("int").alias("item"), F.col("p_name").alias("title"))
    return rc.search_titles(m, titles, "ring", 1).select("item", "title", F.col("prediction").isNotNull().alias("predicted"))


# ---- stages, parameters, tuning -------------------------------------------------------


@query("pl_01_text_stages_score_unlabelled", """
SELECT count(*) AS n_docs, TRUE AS scored, TRUE AS beats_constant_guess FROM documents""")
def _(spark, t):
    docs = t.documents.select("doc_id", "text")
    labelled = docs.join(t.labels, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    train, test = halves(labelled, "doc_id")
    m = md.text_classifier(train)
    error = ev.accuracy(m.transform(test)).select("test_error").scalar()
    return m.transform(docs).agg(F.count("*").alias("n_docs"), F.every(F.col("prediction").isin(0.0, 1.0)).alias("scored"),
                                 (error < constant_error(test)).alias("beats_constant_guess"))


@query("pl_02_stages_with_label_names", """
SELECT count(*) AS n_rows, TRUE AS only_known_names, TRUE AS tree_read_back, TRUE AS better_than_constant FROM lineitem""")
def _(spark, t):
    from pyspark.ml.classification import DecisionTreeClassifier
    d = price_classes(t).withColumn("size", F.element_at(F.array(F.lit("small"), F.lit("middle"), F.lit("large")), (F.col("label") + 1).cast("int")))
    train, test = halves(d.drop("label"), "l_orderkey", "l_partkey")
    m = md.with_label_names(train, DecisionTreeClassifier(maxDepth=5), "size", max_categories=10)
    known = m.stages[0].labels
    error = m.transform(test).agg(F.avg((F.col("predicted_label") != F.col("size")).cast("double"))).scalar()
    return m.transform(train.union(test)).agg(
        F.count("*").alias("n_rows"), F.every(F.col("predicted_label").isin(known)).alias("only_known_names"),
        F.lit("DecisionTree" in m.stages[2].toDebugString).alias("tree_read_back"),
        (error < constant_error(test, "size") * 0.9).alias("better_than_constant"))


@query("pl_03_parameter_maps", f"""
SELECT count(*) AS n_rows, 30 AS max_iter, 0.1::DOUBLE AS reg, TRUE AS renamed, TRUE AS explained {EMBEDDED}""")
def _(spark, t):
    d = two_classes(t)
    lr = LogisticRegression(maxIter=10, regParam=0.01)
    first = {lr.maxIter: 20}
    first.update({lr.maxIter: 30, lr.regParam: 0.1})
    m = md.fit_with(lr, d, first, {lr.probabilityCol: "chance"})
    used = md.settings_of(m)
    out = m.transform(d)
    return out.agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(used["maxIter"]).alias("max_iter"), F.lit(used["regParam"]).alias("reg"),
        F.lit("chance" in out.columns).alias("renamed"), F.lit("regParam" in lr.explainParams()).alias("explained"))


@query("pl_04_grid_search", """
SELECT count(DISTINCT l_orderkey) AS n_rows, 12 AS tried, TRUE AS best_is_lowest FROM lineitem""")
def _(spark, t):
    d = regression_rows(t)
    lr = LinearRegression(maxIter=5)
    found = md.search(lr, d, {lr.regParam: [0.1, 0.01], lr.fitIntercept: [True, False],
                              lr.elasticNetParam: [0.0, 0.5, 1.0]}, RegressionEvaluator(), seed=3)
    tried = found.validationMetrics
    params = found.getEstimatorParamMaps()[tried.index(min(tried))]
    same = all(found.bestModel.getOrDefault(k.name) == v for k, v in params.items())
    return found.bestModel.transform(d).agg(F.count("*").alias("n_rows")).select(
        "n_rows", F.lit(len(tried)).alias("tried"), F.lit(same).alias("best_is_lowest"))


@query("snk_04_model_save_and_load", f"SELECT vec_id, TRUE AS same {EMBEDDED}")
def _(spark, t):
    d = ten_classes(t)
    m = md.tree_classifier(d)
    path = fresh_path(spark, "model")
    m.write().overwrite().save(path)
    again = type(m).load(path)
    a, b = m.transform(d).select("vec_id", F.col("prediction").alias("a")), again.transform(d).select("vec_id", F.col("prediction").alias("b"))
    return a.join(b, "vec_id").select("vec_id", (F.col("a") == F.col("b")).alias("same"))


@query("ev_05b_evaluator_agrees", "SELECT count(*) AS n_rows, TRUE AS agrees FROM lineitem")
def _(spark, t):
    from tidewright.catalog.evaluation import guesses
    g = guesses(t).select(F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction"))
    own = ev.accuracy(g).first()["accuracy"]
    other = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(g)
    return g.agg(F.count("*").alias("n_rows")).select("n_rows", F.lit(abs(own - other) < 1e-12).alias("agrees"))


# ---- functions passed to operators ----------------------------------------------------


@query("ud_01_function_with_bound_arguments", """
SELECT event_id, round(value * 3 + 0.5, 6) AS y FROM events""")
def _(spark, t):
    factor, offset = 3.0, 0.5

    @F.pandas_udf("double")
    def line(v):
        return v * factor + offset

    return t.events.select("event_id", F.round(line("value"), 6).alias("y"))


@query("ud_02_reduce_by_expression", """
SELECT event_type, count(*) AS n, round(exp(avg(ln(value))), 6) AS geometric_mean FROM events GROUP BY event_type""")
def _(spark, t):
    # The logarithm of 0 is minus infinity, not null: a group with a value of 0 has a geometric mean of 0.
    log = F.when(F.col("value") == 0, F.lit(float("-inf"))).otherwise(F.ln("value"))
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.exp(F.avg(log)), 6).alias("geometric_mean"))


@query("ud_03_one_row_to_many", """
SELECT o_orderkey, part, round(o_totalprice / 3, 4) AS amount FROM orders, (SELECT unnest([1, 2, 3]) AS part)""")
def _(spark, t):
    shares = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(
        i.alias("part"), F.round(F.col("o_totalprice") / 3, 4).alias("amount")))
    return t.orders.select("o_orderkey", F.explode(shares).alias("s")).select("o_orderkey", "s.*")


@query("ud_04_order_by_comparator_rule", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END, o_totalprice DESC, o_orderkey LIMIT 25""")
def _(spark, t):
    from tidewright.operators.relational import top_n
    first = F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)
    return top_n(t.orders, 25, first, F.desc("o_totalprice"), F.asc("o_orderkey")).select(
        "o_orderkey", "o_orderpriority", "o_totalprice")


@query("ud_05_model_scores_rows", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS q, l_extendedprice / 1000 AS y FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, round(q * (SELECT regr_slope(y, q) FROM x) + (SELECT regr_intercept(y, q) FROM x), 5) AS p FROM x""")
def _(spark, t):
    d = fe.assemble(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("q"),
                                      (F.col("l_extendedprice") / 1000).alias("label")), ["q"])
    m = md.linear(d, solver="normal")
    return m.transform(d).select("l_orderkey", "l_linenumber", "l_partkey", F.round("prediction", 5).alias("p"))
