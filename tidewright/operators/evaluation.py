"""Quality measures as aggregates over prediction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewright.operators.relational import running_totals

# ---- two classes ----------------------------------------------------------------------


def threshold_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it (pos, neg) and at or
    above it (tp, fp). Rows are reduced to distinct scores before anything is ordered."""
    at = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) > 0.5).alias("pos"), F.count_if(F.col(label) <= 0.5).alias("neg"))
    return running_totals(at, [F.desc("threshold")], {"tp": F.col("pos"), "fp": F.col("neg")})


def _totals(counts: DataFrame) -> tuple[Column, Column]:
    return (counts.select(F.sum("pos")).scalar(), counts.select(F.sum("neg")).scalar())


def f_measure(precision: Column, recall: Column, beta: float = 1.0) -> Column:
    b = beta * beta
    total = b * precision + recall
    return F.when(total == 0, 0.0).otherwise((1 + b) * precision * recall / total)


def precision_recall(counts: DataFrame) -> DataFrame:
    """precision, recall, f1 and f2 by threshold, from `threshold_counts`."""
    pos, _ = _totals(counts)
    p = F.col("tp") / (F.col("tp") + F.col("fp"))
    r = F.col("tp") / pos
    return counts.select("threshold", p.alias("precision"), r.alias("recall")).select(
        "*", f_measure(F.col("precision"), F.col("recall")).alias("f1"),
        f_measure(F.col("precision"), F.col("recall"), 2.0).alias("f2"))


def roc(counts: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr); the curve starts at the point 0, 0, which has no threshold."""
    pos, neg = _totals(counts)
    return counts.select("threshold", (F.col("fp") / neg).alias("fpr"), (F.col("tp") / pos).alias("tpr"))


def area_under_roc(counts: DataFrame) -> DataFrame:
    """Trapezoid area: each threshold adds its negatives times the mean height over them."""
    height = F.col("tp") - F.col("pos") / 2
    return counts.agg((F.sum(F.col("neg") * height) / (F.sum("pos") * F.sum("neg"))).alias("auc"))


def best_threshold(counts: DataFrame) -> DataFrame:
    """The row of highest f1; the highest threshold wins a tie."""
    return precision_recall(counts).orderBy(F.desc("f1"), F.desc("threshold")).limit(1)


# ---- several classes ------------------------------------------------------------------


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n"))


def class_measures(table: DataFrame) -> DataFrame:
    """Per class precision, recall, f1 and false positive rate, from `confusion`."""
    actual = table.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("actual"))
    guessed = table.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("guessed"))
    right = table.filter("label = prediction").select(F.col("label").alias("class"), F.col("n").alias("tp"))
    c = (actual.join(guessed, "class", "full").join(right, "class", "left")
         .fillna(0, ["actual", "guessed", "tp"]))
    total = table.select(F.sum("n")).scalar()

    def ratio(a, b):
        return F.when(b == 0, 0.0).otherwise(a / b)

    return c.select("class", "actual", "tp", ratio(F.col("tp"), F.col("guessed")).alias("precision"),
                    ratio(F.col("tp"), F.col("actual")).alias("recall"),
                    ratio(F.col("guessed") - F.col("tp"), total - F.col("actual")).alias("fpr")).withColumn(
        "f1", f_measure(F.col("precision"), F.col("recall")))


def overall_measures(table: DataFrame) -> DataFrame:
    """Accuracy and class measures weighted by class size, one row."""
    c = class_measures(table)

    def weighted(m):
        return (F.sum(F.col(m) * F.col("actual")) / F.sum("actual")).alias(f"weighted_{m}")

    return c.agg((F.sum("tp") / F.sum("actual")).alias("accuracy"),
                 *[weighted(m) for m in ("precision", "recall", "f1", "fpr")])


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    right = F.avg(F.when(F.col(label) == F.col(prediction), 1.0).otherwise(0.0))
    return df.agg(right.alias("accuracy"), (1 - right).alias("test_error"))


# ---- label sets -----------------------------------------------------------------------


def _set_sizes(df: DataFrame) -> DataFrame:
    return df.select(F.array_distinct("prediction").alias("p"), F.array_distinct("label").alias("l")).select(
        "p", "l", F.size("p").alias("np"), F.size("l").alias("nl"),
        F.size(F.array_intersect("p", "l")).alias("both"))


def label_set_measures(df: DataFrame) -> DataFrame:
    """Measures of (prediction, label) arrays, averaged over rows, and micro measures."""
    s = _set_sizes(df)
    classes = s.select(F.explode("l").alias("c")).agg(F.count_distinct("c")).scalar()

    def mean(top, bottom):
        return F.avg(F.when(bottom == 0, 0.0).otherwise(top / bottom))

    both, np, nl = F.col("both"), F.col("np"), F.col("nl")
    wrong = np + nl - 2 * both
    return s.agg(
        mean(both, np).alias("precision"), mean(both, nl).alias("recall"), mean(2 * both, np + nl).alias("f1"),
        mean(both, np + nl - both).alias("accuracy"),
        F.avg(F.when(wrong == 0, 1.0).otherwise(0.0)).alias("subset_accuracy"),
        (F.sum(both) / F.sum(np)).alias("micro_precision"), (F.sum(both) / F.sum(nl)).alias("micro_recall"),
        (2 * F.sum(both) / (F.sum(np) + F.sum(nl))).alias("micro_f1"),
        (F.sum(wrong) / F.count("*")).alias("_wrong")).select(
        "*", (F.col("_wrong") / classes).alias("hamming_loss")).drop("_wrong")


def label_set_measures_by_label(df: DataFrame) -> DataFrame:
    """(class, precision, recall, f1) for every label, true or predicted."""
    s = _set_sizes(df)
    marks = s.select(F.explode(F.array_union("p", "l")).alias("class"), "p", "l").select(
        "class", F.array_contains("p", F.col("class")).alias("guessed"),
        F.array_contains("l", F.col("class")).alias("actual"))
    c = marks.groupBy("class").agg(
        F.count_if(F.col("guessed") & F.col("actual")).alias("tp"),
        F.count_if("guessed").alias("guessed"), F.count_if("actual").alias("actual"))

    def ratio(a, b):
        return F.when(F.col(b) == 0, 0.0).otherwise(F.col(a) / F.col(b))

    return c.select("class", ratio("tp", "guessed").alias("precision"), ratio("tp", "actual").alias("recall")
                    ).withColumn("f1", f_measure(F.col("precision"), F.col("recall")))


# ---- rankings -------------------------------------------------------------------------


def ranking_measures(predicted: DataFrame, actual: DataFrame, ks: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Precision and NDCG at each k, and mean average precision, as rows (measure, value).

    predicted: (user, pos, item) with pos from 0; actual: (user, item), distinct. Users
    present in both tables count. Lists stay as rows; a user's window holds only the hits
    among the items recommended to that user.
    """
    sizes = actual.groupBy("user").agg(F.count("*").alias("size"))
    users = sizes.join(predicted.select("user").distinct(), "user")
    hits = predicted.join(actual, ["user", "item"]).withColumn(
        "nth", F.row_number().over(Window.partitionBy("user").orderBy("pos")))
    gain = 1 / F.ln(F.col("pos") + 2)
    found = hits.groupBy("user").agg(
        F.sum(F.col("nth") / (F.col("pos") + 1)).alias("_ap"),
        *[F.count_if(F.col("pos") < k).alias(f"_hits{k}") for k in ks],
        *[F.sum(F.when(F.col("pos") < k, gain).otherwise(0.0)).alias(f"_dcg{k}") for k in ks])

    def ideal(k):
        steps = F.sequence(F.lit(0), F.least(F.col("size"), F.lit(k)).cast("int") - 1)
        return F.aggregate(steps, F.lit(0.0), lambda acc, i: acc + 1 / F.ln(i + 2))

    per_user = users.join(found, "user", "left").fillna(0)
    wide = per_user.agg(
        *[F.avg(F.col(f"_hits{k}") / k).alias(f"precision_at_{k}") for k in ks],
        *[F.avg(F.col(f"_dcg{k}") / ideal(k)).alias(f"ndcg_at_{k}") for k in ks],
        F.avg(F.col("_ap") / F.col("size")).alias("mean_average_precision"))
    return wide.unpivot([], wide.columns, "measure", "value")


# ---- numbers --------------------------------------------------------------------------


def regression_measures(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """mse, rmse, mae, r2 and explained variance in one pass."""
    y, p = F.col(label), F.col(prediction)
    mse = F.avg(F.pow(y - p, 2))
    return df.agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(y - p)).alias("mae"),
                  (1 - mse / F.var_pop(y)).alias("r2"),
                  (F.var_pop(p) + F.pow(F.avg(p) - F.avg(y), 2)).alias("explained_variance"))
