import math

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidewright.operators import algebra, features as fe, patterns


def vecs(spark, rows, name="features"):
    return spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(rows)], ["id", name])


def lists(df, column):
    return [list(r[0]) for r in df.orderBy("id").select(vector_to_array(column)).collect()]


def test_thresholds(spark):
    df = spark.createDataFrame([(0, .1), (1, .8), (2, .2)], "id int, x double")
    assert [r["y"] for r in fe.binarize(df, "x", 0.5, "y").orderBy("id").collect()] == [0.0, 1.0, 0.0]
    inf = float("inf")
    df = spark.createDataFrame([(0, -.5), (1, -.3), (2, 0.0), (3, .2)], "id int, x double")
    assert [r["y"] for r in fe.bucketize(df, "x", [-inf, -.5, 0, .5, inf], "y").orderBy("id").collect()] == [1, 1, 2, 2]


def test_categories(spark):
    df = spark.createDataFrame(list(enumerate("abcaac")), "id int, c string")
    indexed, model = fe.index_text(df, "c", "i")
    assert list(model.labels) == ["a", "c", "b"]
    assert fe.text_of_index(indexed, "i", "back").filter("back <> c").count() == 0
    flags = lists(fe.one_hot(indexed, "i", "v")[0], "v")
    assert flags == [[1, 0], [0, 0], [0, 1], [1, 0], [1, 0], [0, 1]]


def test_vector_steps(spark):
    df = vecs(spark, [(1.0, 2.0, 3.0), (4.0, 5.0, 6.0)])
    assert lists(fe.weigh(df, "features", (0, 1, 2), "y"), "y") == [[0, 2, 6], [0, 5, 12]]
    assert lists(fe.with_bias(df, "features", "y"), "y")[0] == [1, 2, 3, 1]
    named = fe.name_components(df, "features", ["f1", "f2", "f3"])
    assert lists(fe.slice_vector(named, "features", "y", [1], ["f3"]), "y") == [[2, 3], [5, 6]]
    assert lists(fe.normalize(df, "features", "y", float("inf")), "y")[0] == [1 / 3, 2 / 3, 1]
    back = fe.cosine_transform(fe.cosine_transform(df, "features", "y"), "y", "z", inverse=True)
    assert np.allclose(lists(back, "z"), lists(df, "features"))
    constant = vecs(spark, [(1.0, 7.0), (3.0, 7.0)])
    assert lists(fe.scale_min_max(constant, "features", "y")[0], "y") == [[0, .5], [1, .5]]
    assert lists(fe.expand_polynomial(vecs(spark, [(2.0, 3.0)]), "features", 2, "y"), "y") == [[2, 4, 3, 6, 9]]


def test_text_steps(spark):
    df = spark.createDataFrame([(0, list("abc")), (1, list("abbca"))], "id int, text array<string>")
    assert lists(fe.count_given_terms(df, "text", "y", "abc"), "y") == [[1, 1, 1], [2, 2, 1]]
    _, model = fe.count_terms(df, "text", "y", 3, 2)
    assert sorted(model.vocabulary) == ["a", "b", "c"]
    assert [len(r["g"]) for r in fe.ngrams(df, "text", 2, "g").orderBy("id").collect()] == [2, 4]
    words = spark.createDataFrame([(["I", "saw", "the", "Red"],)], "w array<string>")
    assert fe.drop_stop_words(words, "w", "k").first()["k"] == ["saw", "Red"]
    text = spark.createDataFrame([("Hi I,heard about",)], "t string")
    assert fe.tokenize_by_pattern(text, "t").first()["words"] == ["hi", "i", "heard", "about"]


def test_term_weights(spark):
    docs = spark.createDataFrame([(0, "a a b"), (1, "a c")], "id int, text string")
    got = {(r["id"], r["term"]): r["tfidf"] for r in fe.term_weights(docs, "id", "text").collect()}
    assert got[(0, "a")] == 0.0 and math.isclose(got[(0, "b")], math.log(3 / 2))


def test_price_features(spark):
    df = spark.createDataFrame([(0, 2.0, 9.0, [0.0, 1.0])], "id int, price double, units double, flags array<double>")
    out = fe.price_features(df, F.col("price"), F.col("units"), F.lit(8.0), "flags")
    assert np.allclose(lists(out, "features")[0], [math.log(4), 0, 1])
    assert math.isclose(out.first()["label"], math.log(10))


def test_chi_squared_keeps_the_dependent_one(spark):
    rows = [(float(i % 2), Vectors.dense([float(i % 3 == 0), float(i % 2)])) for i in range(60)]
    _, model = fe.top_features(spark.createDataFrame(rows, ["label", "features"]), "features", "label", 1)
    assert list(model.selectedFeatures) == [1]


def test_singular_values_rebuild_the_matrix(spark):
    a = np.array([[1., 2, 3], [4, 5, 6], [7, 8, 10]])
    df = vecs(spark, a.tolist())
    s, v = algebra.singular_values(df, "features", 3)
    assert np.allclose(s, np.linalg.svd(a)[1])
    u = algebra.times_matrix(df, "features", v / s, "u")
    rebuilt = np.array([r["u"] for r in u.orderBy("id").collect()]) @ np.diag(s) @ v.T
    assert np.allclose(rebuilt, a)


def test_frequent_sequences(spark):
    data = [([[1, 2], [3]],), ([[1], [3, 2], [1, 2]],), ([[1, 2], [5]],), ([[6]],)]
    df = spark.createDataFrame(data, "sequence array<array<int>>")
    got = {str([sorted(s) for s in r["sequence"]]): r["freq"] for r in patterns.frequent_sequences(df).collect()}
    assert got == {"[[1]]": 3, "[[2]]": 3, "[[3]]": 2, "[[1, 2]]": 3, "[[1], [3]]": 2}


def test_frequent_sets_against_all_subsets(spark):
    from itertools import combinations
    data = ["abc", "abd", "ab", "cd", "abcd", "b"]
    rows = spark.createDataFrame([(i, c) for i, b in enumerate(data) for c in b + b[0]], "k int, c string")
    model = patterns.frequent_sets(patterns.baskets(rows, "k", "c"), support=0.3, confidence=0.6)
    want = {}
    for size in range(1, 5):
        for combo in combinations("abcd", size):
            n = sum(set(combo) <= set(b) for b in data)
            if n >= 2:
                want["".join(combo)] = n
    sets = model.freqItemsets
    assert {"".join(sorted(r["items"])): r["freq"] for r in sets.collect()} == want
    mine = {("".join(r["antecedent"]), r["consequent"]): r["confidence"] for r in patterns.rules_from_sets(sets, 0.6).collect()}
    theirs = {("".join(sorted(r["antecedent"])), r["consequent"][0]): r["confidence"] for r in model.associationRules.collect()}
    assert mine == theirs
