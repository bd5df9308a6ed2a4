"""Frequent patterns."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth, PrefixSpan
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.session import settle


def baskets(df: DataFrame, key: str, item: str) -> DataFrame:
    """(key, items): the distinct items of each basket. Meant for item kinds of bounded number."""
    return df.select(key, item).distinct().groupBy(key).agg(F.sort_array(F.collect_set(item)).alias("items"))


def frequent_sets(df: DataFrame, items: str = "items", support: float = 0.3, confidence: float = 0.8,
                  partitions: int | None = None):
    """FP-growth model: `freqItemsets` (items, freq) and `associationRules`. Baskets are written once, since a fit reads them
    three times; the sets are kept, since rules read them three times."""
    step = FPGrowth(itemsCol=items, minSupport=support, minConfidence=confidence)
    model = (step.setNumPartitions(partitions) if partitions else step).fit(settle(df.select(items)))
    model.freqItemsets.persist()
    return model


def rules_from_sets(sets: DataFrame, confidence: float = 0.8) -> DataFrame:
    """Rules (antecedent, consequent, confidence) with one consequent, from an itemset table.

    Every itemset is joined to the itemset it becomes without one of its items.
    """
    parts = sets.filter(F.size("items") > 1).select(
        "items", F.col("freq").alias("both"), F.explode("items").alias("consequent")).select(
        F.array_sort(F.array_except("items", F.array("consequent"))).alias("antecedent"), "consequent", "both")
    bases = sets.select(F.array_sort("items").alias("antecedent"), "freq")
    return parts.join(bases, "antecedent").select(
        "antecedent", "consequent", (F.col("both") / F.col("freq")).alias("confidence")).filter(
        F.col("confidence") >= confidence)


def frequent_sequences(df: DataFrame, sequence: str = "sequence", support: float = 0.5,
                       max_length: int = 5) -> DataFrame:
    """(sequence, freq) of an array<array<item>> column."""
    return PrefixSpan(minSupport=support, maxPatternLength=max_length,
                      sequenceCol=sequence).findFrequentSequentialPatterns(df)
