"""Feature steps: tables in, tables out. Fitted steps return the model beside the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import feature as ft
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.columns import log_ratio
from tidewright.operators.aggregates import word_rows
from tidewright.session import settle

# ---- vectors as rows ------------------------------------------------------------------


def as_vector(df: DataFrame, array: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.transform(array, lambda x: x.cast("double"))))


def vector_rows(df: DataFrame, keys: Sequence[str], vector: str, value: str = "x") -> DataFrame:
    """(keys, pos, value): one row per component."""
    return df.select(*keys, F.posexplode(vector_to_array(vector)).alias("pos", value))


def assemble(df: DataFrame, inputs: Sequence[str], name: str = "features") -> DataFrame:
    return ft.VectorAssembler(inputCols=list(inputs), outputCol=name).transform(df)


def with_bias(df: DataFrame, vector: str, name: str = "features") -> DataFrame:
    """The vector with a constant 1 at its end."""
    return assemble(df.withColumn("_one", F.lit(1.0)), [vector, "_one"], name).drop("_one")


# ---- numbers --------------------------------------------------------------------------


def binarize(df: DataFrame, column: str, threshold: float, name: str) -> DataFrame:
    return ft.Binarizer(threshold=threshold, inputCol=column, outputCol=name).transform(df)


def bucketize(df: DataFrame, column: str, splits: Sequence[float], name: str) -> DataFrame:
    """Index of the half-open interval [lo, hi) a value falls into."""
    return ft.Bucketizer(splits=list(splits), inputCol=column, outputCol=name).transform(df)


def quantile_buckets(df: DataFrame, column: str, buckets: int, name: str, error: float = 0.001) -> DataFrame:
    """Buckets of nearly equal size. An error of 0 would hold every value in memory."""
    step = ft.QuantileDiscretizer(numBuckets=buckets, inputCol=column, outputCol=name, relativeError=error)
    return step.fit(df).transform(df)


def top_features(df: DataFrame, features: str, label: str, n: int, name: str = "selected"):
    """The n categorical features most dependent on a categorical label (chi-squared)."""
    step = ft.UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=name,
                                        selectionMode="numTopFeatures")
    model = step.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(n).fit(df)
    return model.transform(df), model


# ---- vectors --------------------------------------------------------------------------


def cosine_transform(df: DataFrame, vector: str, name: str, inverse: bool = False) -> DataFrame:
    return ft.DCT(inverse=inverse, inputCol=vector, outputCol=name).transform(df)


def weigh(df: DataFrame, vector: str, weights: Sequence[float], name: str) -> DataFrame:
    return ft.ElementwiseProduct(scalingVec=Vectors.dense(list(weights)), inputCol=vector,
                                 outputCol=name).transform(df)


def scale_min_max(df: DataFrame, vector: str, name: str):
    model = ft.MinMaxScaler(inputCol=vector, outputCol=name).fit(df)
    return model.transform(df), model


def scale_deviation(df: DataFrame, vector: str, name: str):
    """Divide by the sample standard deviation; the mean stays."""
    model = ft.StandardScaler(withStd=True, withMean=False, inputCol=vector, outputCol=name).fit(df)
    return model.transform(df), model


def normalize(df: DataFrame, vector: str, name: str, p: float = 2.0) -> DataFrame:
    step = ft.Normalizer(inputCol=vector, outputCol=name)
    return step.transform(df, {step.p: p})


def expand_polynomial(df: DataFrame, vector: str, degree: int, name: str) -> DataFrame:
    return ft.PolynomialExpansion(degree=degree, inputCol=vector, outputCol=name).transform(df)


def principal_components(df: DataFrame, vector: str, k: int, name: str = "projected"):
    model = ft.PCA(k=k, inputCol=vector, outputCol=name).fit(df)
    return model.transform(df), model


def slice_vector(df: DataFrame, vector: str, name: str, indices: Sequence[int] = (),
                 names: Sequence[str] = ()) -> DataFrame:
    return ft.VectorSlicer(inputCol=vector, outputCol=name, indices=list(indices),
                           names=list(names)).transform(df)


def name_components(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Attach attribute names to a vector column, as `slice_vector` by name needs them."""
    attrs = {"numeric": [{"idx": i, "name": n} for i, n in enumerate(names)]}
    return df.withColumn(vector, F.col(vector).alias(
        vector, metadata={"ml_attr": {"attrs": attrs, "num_attrs": len(names)}}))


def index_vector(df: DataFrame, vector: str, name: str, max_categories: int):
    """Treat components with few distinct values as categories."""
    model = ft.VectorIndexer(inputCol=vector, outputCol=name, maxCategories=max_categories).fit(df)
    return model.transform(df), model


# ---- categories -----------------------------------------------------------------------


def index_text(df: DataFrame, column: str, name: str, invalid: str = "error"):
    """Most frequent value 0, ties in alphabetical order."""
    model = ft.StringIndexer(inputCol=column, outputCol=name, handleInvalid=invalid).fit(df)
    return model.transform(df), model


def text_of_index(df: DataFrame, column: str, name: str, labels: Sequence[str] = ()) -> DataFrame:
    step = ft.IndexToString(inputCol=column, outputCol=name)
    return (step.setLabels(list(labels)) if labels else step).transform(df)


def one_hot(df: DataFrame, column: str, name: str):
    """0/1 vector without the last category."""
    model = ft.OneHotEncoder(inputCols=[column], outputCols=[name], dropLast=True).fit(df)
    return model.transform(df), model


def formula(df: DataFrame, text: str):
    model = ft.RFormula(formula=text).fit(df)
    return model.transform(df), model


# ---- text -----------------------------------------------------------------------------


def tokenize(df: DataFrame, text: str, name: str = "words") -> DataFrame:
    return ft.Tokenizer(inputCol=text, outputCol=name).transform(df)


def tokenize_by_pattern(df: DataFrame, text: str, pattern: str = r"\W", gaps: bool = True,
                        name: str = "words") -> DataFrame:
    return ft.RegexTokenizer(inputCol=text, outputCol=name, pattern=pattern, gaps=gaps).transform(df)


def drop_stop_words(df: DataFrame, column: str, name: str, stop_words: Sequence[str] | None = None) -> DataFrame:
    step = ft.StopWordsRemover(inputCol=column, outputCol=name)
    return (step.setStopWords(list(stop_words)) if stop_words else step).transform(df)


def ngrams(df: DataFrame, column: str, n: int, name: str = "ngrams") -> DataFrame:
    return ft.NGram(n=n, inputCol=column, outputCol=name).transform(df)


def count_terms(df: DataFrame, column: str, name: str, size: int, min_docs: int = 2):
    model = ft.CountVectorizer(inputCol=column, outputCol=name, vocabSize=size, minDF=min_docs).fit(df)
    return model.transform(df), model


def count_given_terms(df: DataFrame, column: str, name: str, vocabulary: Sequence[str]) -> DataFrame:
    return ft.CountVectorizerModel.from_vocabulary(list(vocabulary), column, name).transform(df)


def hash_terms(df: DataFrame, column: str, name: str, features: int) -> DataFrame:
    return ft.HashingTF(inputCol=column, outputCol=name, numFeatures=features).transform(df)


def weigh_rare_terms(df: DataFrame, counts: str, name: str):
    model = ft.IDF(inputCol=counts, outputCol=name).fit(df)
    return model.transform(df), model


def term_weights(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf, tfidf) keyed by the term itself, so no two terms share a slot.

    The counted terms are saved once: they feed both the document frequencies and the result,
    and texts are split a single time. Texts are dealt by key while they are whole, which moves less than their terms.
    """
    tf = settle(word_rows(docs.select(key, text).repartition(key), text, keep=[key]).groupBy(key, F.col("word").alias("term")).agg(
        F.count("*").alias("tf")))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    m = docs.agg(F.count("*")).scalar()
    return tf.join(df, "term").select(
        key, "term", "tf", (F.col("tf") * F.ln((m + 1) / (F.col("df") + 1))).alias("tfidf"))


def embed_words(df: DataFrame, column: str, name: str, size: int = 3, min_count: int = 0, seed: int = 0,
                rounds: int = 1, partitions: int | None = None):
    """Document vectors as the mean of word vectors; the model also finds near words.

    Training runs in as many partitions as the cluster has cores, unless given.
    """
    partitions = partitions or df.sparkSession.sparkContext.defaultParallelism
    model = ft.Word2Vec(vectorSize=size, minCount=min_count, seed=seed, maxIter=rounds,
                        numPartitions=partitions, inputCol=column, outputCol=name).fit(df)
    return model.transform(df), model


# ---- sales ----------------------------------------------------------------------------


def price_features(df: DataFrame, price: Column, units: Column, top_price: Column | float,
                   flags: str) -> DataFrame:
    """label ln(units + 1) and features [ln(top price / price)] followed by the date flags."""
    vector = F.concat(F.array(log_ratio(top_price, price)), F.col(flags))
    return df.withColumn("label", F.ln(units + 1)).withColumn("features", array_to_vector(vector))


def schema_of(columns: Mapping[str, str]) -> str:
    """A schema text from a name-to-type mapping."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
