"""Quality rules with line frequencies across documents, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import SPACE, text_of
from tidewright.session import Scratch

#: Limits of the rules.
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5
#: A line of a host is boilerplate in more than this many different documents, however many the host has.
LINE_DOCS = 20
#: A document is depleted if less than this share of its words is left.
LEFT_PERCENT = 50


def measures(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """One pass over the texts: the row's own measures, and (hash, words) of its distinct normalised lines.

    Normalised: lower case, runs of digits as 0, blanks between words as one.
    """
    whole = docs.select(F.col(key).alias("key"), F.col(host).alias("host"), text_of(text).alias("text"))
    split = whole.select(
        "*", F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("raw"),
        F.transform(F.split(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[\x20\x09\x0B-\x0D]+", " "), "[0-9]+", "0"), "\n"),
                    F.trim).alias("normal"))
    hashed = split.select(
        "key", "host", F.xxhash64("text").alias("content"), F.size("words").cast("long").alias("n_words"),
        (F.char_length("text") - F.regexp_count("text", F.lit(SPACE))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("w"),
        F.transform(F.filter("normal", lambda x: x != ""), lambda x: F.struct(
            F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).alias("words"))).alias("lines"))
    windowed = hashed.withColumn("v", F.when(F.size("w") >= WINDOW, F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - (WINDOW - 1), F.lit(1))),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("w"), i + k) for k in range(1, WINDOW)])))
        .otherwise(F.array().cast("array<bigint>"))).drop("w")
    # Nearly all texts repeat no window, which a set of hashes tells without sorting.
    sorted_ = windowed.withColumn("at", F.when(F.size(F.array_distinct("v")) < F.size("v"), F.sort_array(
        F.transform("v", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("v")
    same = lambda x, k: F.get(F.col("at"), k)["h"].eqNullSafe(x["h"])
    starts = sorted_.withColumn("starts", F.sort_array(F.transform(
        F.filter("at", lambda x, k: ((k > 0) & same(x, F.greatest(k - 1, F.lit(0)))) | same(x, k + 1)),
        lambda x: x["i"]))).drop("at")
    gaps = F.transform("starts", lambda i, k: F.least(
        F.coalesce(F.get(F.col("starts"), k + 1) - i, F.lit(WINDOW)), F.lit(WINDOW)))
    return starts.withColumn("n_repeat_words", F.coalesce(
        F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g), F.lit(0)).cast("long")).drop("starts")


def check_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
                line_docs: int = LINE_DOCS, left_percent: float = LEFT_PERCENT) -> DataFrame:
    """Per row of `docs`: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_words,
    base_failed, kept.

    A line of a host that stands in more than `line_docs` documents of different text is removed; a document that keeps
    under `left_percent` of its words is depleted. Exact copies count once in line frequencies, so that a much copied
    document is not taken for boilerplate. The limit is a number and no share, so further documents of a host never bring a
    removed line back.

    Line hashes are counted with partial sums before the shuffle; only (hash, host, row, words) of lines
    move, never texts. A line in a third of all documents is one row of counts, and the join that finds
    its documents is one that Spark splits by size.

    Null text has no words and fails; a null host is a host; rows that repeat are rows of their own; an
    empty table gives an empty result. Other columns are not looked at.
    """
    scratch = Scratch(docs.sparkSession)
    base = scratch.settle(measures(docs, key, text, host).withColumn("row", F.monotonically_increasing_id()))
    first = base.groupBy("host", "content").agg(F.min("row").alias("row")).select("row")
    counted = base.join(first, "row", "left_semi")
    lines = counted.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    frequent = scratch.settle(lines.groupBy("host", "line").agg(F.count("*").alias("n")).filter(
        F.col("n") > line_docs).select("host", "line"))
    own = base.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.words")
    hit = (F.col("g.line") == F.col("p.line")) & F.col("g.host").eqNullSafe(F.col("p.host"))
    removed = (own.alias("g").join(frequent.alias("p"), hit, "left_semi")
               .groupBy("row").agg(F.sum("words").cast("long").alias("removed_words")))
    out = base.drop("lines", "content", "host").join(removed, "row", "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    depleted = (F.col("n_words") - F.col("removed_words")) * 100 < F.col("n_words") * left_percent
    scratch.keep(base, frequent)
    return out.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "removed_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"))
