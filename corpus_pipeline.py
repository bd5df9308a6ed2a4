"""From raw documents to packed sequences: five stages, each one of the corpus operators.

A stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. Stages are written as
Parquet and read again in between, so each starts from a table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import jaccard, language, mixing, packing, suffixes
from tidewright.session import Scratch, prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text is rejected when fewer than this share of its n-grams are known in any one language, to filters that other texts
#: taught. Of the held-out documents of the given tables, the least score is 0.60 and one in a thousand is under 0.76.
LEAST_SCORE = 0.5
#: Near duplicates share this percentage of their runs of five words.
WORDS, PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages that the labelled rows teach.

    Rows are in two halves by text, and each half is judged by filters that the other half taught, so no text speaks for
    itself or for its exact copies. Where a half teaches nothing, as in a table of one text, all rows teach.

    Null texts and texts without a letter go, as does a text whose language stands in its own half only; a label of its
    own, or none, changes nothing for a row; repeated rows stay or go together; texts of any length are read whole; an
    empty table gives an empty result; columns other than those of documents are left out.
    """
    half = F.pmod(F.xxhash64("text"), F.lit(2))
    halves = [docs.filter(F.coalesce(half, F.lit(0)) == k).select(*COLUMNS) for k in (0, 1)]
    learned = [language.train(h) for h in halves]
    if not all(x.langs for x in learned):
        learned = [language.train(docs)] * 2
    judged = [language.predict(h, other) for h, other in zip(halves, reversed(learned))]
    return judged[0].union(judged[1]).filter(
        (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that near-duplicate links join, the one with the smallest doc_id; rows without doc_id stay.

    Different rows under one doc_id are documents of their own, so only whole repeats and linked texts go. Null and empty
    texts link with nothing and stay; of rows with equal doc_id and linked texts the one of least mark stays; texts of
    any length count whole; an empty table gives an empty result; columns other than those of documents are left out.
    """
    scratch = Scratch(spark)
    mark = F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS])
    marked = docs.filter("doc_id IS NOT NULL").select(*COLUMNS, mark.alias("_mark"))
    # A doc_id of one row is that row's node; other rows are nodes by their mark.
    shared = scratch.settle(marked.groupBy(F.col("doc_id").alias("_of")).agg(
        F.min("_mark").alias("low"), F.max("_mark").alias("high")).filter("low < high").select("_of"))
    nodes = marked.join(shared, F.col("doc_id") == F.col("_of"), "left").withColumn(
        "_node", F.when(F.col("_of").isNull(), F.col("doc_id").cast("long")).otherwise(F.col("_mark")))
    groups = jaccard.jaccard_components(nodes, key="_node", words=WORDS, percent=PERCENT).select("_node", "component_id")
    names = nodes.filter("_of IS NOT NULL").select(F.col("_node").alias("_named"), F.col("doc_id").alias("_id")).distinct()
    first = F.min(F.struct(F.coalesce("_id", "_node").alias("id"), F.col("_node").alias("node")))
    stay = groups.join(names, F.col("_node") == F.col("_named"), "left").groupBy("component_id").agg(
        first.alias("first")).select(F.col("first.node").alias("_stays"))
    known = nodes.join(stay, F.col("_node") == F.col("_stays"), "left_semi").dropDuplicates(["_node"])
    scratch.keep(shared)
    return known.select(*COLUMNS).union(docs.filter("doc_id IS NULL").select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand anywhere twice; a text that is nothing else goes.

    A character of which a byte is removed is removed whole. Null, empty and short texts are as they were and stay;
    repeated rows repeat each other's passages, so of texts long enough none stays; texts of any length count whole; an
    empty table gives an empty result; columns other than those of documents are left out.
    """
    cut = suffixes.remove_repeats(docs, keep=[F.col(c) for c in COLUMNS])
    whole = F.col("n_removed") == 0
    rest = F.decode_utf8(F.col("kept_bytes")) if hasattr(F, "decode_utf8") else F.col("kept_bytes").cast("string")
    text = F.when(whole, F.col("text")).otherwise(F.regexp_replace(rest, "�", ""))
    return cut.withColumn("text", text).filter(whole | (F.length(F.trim("text")) > 0)).withColumn(
        "n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Rows equal in all columns, nulls included, are one document that occurs as often as all of them together; rows
    that differ anywhere are documents of their own, told apart by two 64-bit marks. Null and empty texts have no words
    and are never taken; a null source is a source; texts of any length count whole; an empty table gives an empty
    result; columns other than those of documents are left out.
    """
    # A hash leaves nulls out, so which columns are null is hashed too.
    parts = [*COLUMNS, *[F.col(c).isNull() for c in COLUMNS]]
    marked = docs.select(*COLUMNS, F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")).alias("_mark"))
    taken = mixing.mix(marked, key="_mark").groupBy(F.col("_mark").alias("_of")).agg(
        F.sum("copies").cast("int").alias("_copies")).filter("_copies > 0")
    rows = marked.dropDuplicates(["_mark"]).join(taken, F.col("_mark") == F.col("_of"))
    return rows.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).drop("_copy")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens.

    Null and empty texts are their end mark alone; a null source is a queue; repeated rows are packed as often as they
    stand; texts of any length are cut freely; an empty table has no pieces; other columns are not looked at.
    """
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", in_a_language),
    ("ngram_jaccard", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

#: Learned filters, exact links, rates and tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        old, docs = docs, scratch.settle(out, name)
        scratch.drop(old)
    return docs
