"""Registered queries of the corpus operators, and the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import (bpe, embeddings, jaccard, language, line_rules, mixing, packing, periods, scoring, sharding, spelling,
                            suffixes, twins, warc)
from tidewright.llm.common import WORD
from tidewright.session import fresh_path, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SHARDS = [f"shard-{i:03d}" for i in range(64)]
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def keep(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_ngram_jaccard", twins.SETS)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, folder, "documents"))


@query("op2_lm_scoring")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    return scoring.score(table(spark, folder, "documents"), good, leave_out=True)


@query("op3_suffix_dedup", twins.REPEATS)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    done = suffixes.remove_repeats(table(spark, folder, "documents"), keep=[F.col("doc_id")])
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


@query("op4_language")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = language.train(docs.filter(~held_out()))
    return language.predict(docs, learned, keep=[F.col("doc_id"), held_out().alias("held_out")])


@query("op5_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(TOKENIZER))


@query("op6_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


LINE_SQL = r"""
WITH w AS (SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
  win AS (SELECT doc_id, i, words[i:i+4] AS g FROM (
      SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w WHERE len(words) >= 5)),
  dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
  rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (
      SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM dup) GROUP BY doc_id),
  raw AS (SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines FROM (SELECT doc_id, l, count(*) AS n FROM (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
      WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id, l) GROUP BY doc_id),
  norm AS (SELECT doc_id, source, line, len(string_split(line, ' ')) AS k FROM (
      SELECT doc_id, source, trim(unnest(string_split(regexp_replace(regexp_replace(lower(text),
        '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g'), chr(10)))) AS line FROM w) WHERE line <> ''),
  firsts AS (SELECT min(doc_id) AS doc_id FROM w GROUP BY source, text),
  freq AS (SELECT source, line FROM norm SEMI JOIN firsts USING (doc_id) GROUP BY source, line
      HAVING count(DISTINCT doc_id) > 20),
  cut AS (SELECT doc_id, sum(k)::BIGINT AS removed_words FROM norm SEMI JOIN freq USING (source, line) GROUP BY doc_id),
  m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
      (length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')))::BIGINT AS word_chars,
      len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
      coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
      coalesce(removed_words, 0)::BIGINT AS removed_words
    FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN raw USING (doc_id) LEFT JOIN cut USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT (n_words - removed_words) * 100 < n_words * 50 AS kept
FROM m"""


@query("op7_line_rules", LINE_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.check_lines(table(spark, folder, "documents"))


@query("op8_sharding")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS).select("doc_id", "slot", "shard")


@query("op9_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
  f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
  h AS (SELECT page_id, first, strlen(html) AS n, sha1(html) AS hx FROM p JOIN f USING (html)),
  b AS (SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (('0x' || substr(hx, 1 + 5 * (i // 4), 5))::INT >> (5 * (3 - i % 4))) % 32, 1), '' ORDER BY i) AS d
    FROM h, range(32) t(i) GROUP BY page_id)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM h JOIN b USING (page_id)""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path)
    back = warc.read_archive(spark, path)
    return back.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_embedding_near_dups", twins.VECTORS)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


def slip(run: str, checksum: int) -> str:
    """The run without one of its code points, for one in 97."""
    if checksum % 97:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1:]


@query("op11_spelling_variants", twins.VARIANTS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, folder, "documents"), edit=slip))


@query("op12_byte_bpe")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    ids = bpe.encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN, keep=[F.col("doc_id")])
    back = bpe.decode(ids, path, public_tokenizers.PATTERN)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("bytes", 256).alias("decoded_sha256"))


def repeating(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which every tenth document, by checksum, repeats some of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when((h % 10 == 0) & (F.regexp_count("text", F.lit(WORD)) > 0), F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    n = F.size("_words")
    rest = docs.select("doc_id", "text", words.alias("_words"), F.floor(h / 10).alias("_g"))
    start = rest.withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
    period = start.withColumn("_p", (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    at = F.col("_a")
    changed = F.transform("_words", lambda w, i: F.when(i < at, w).otherwise(F.get(F.col("_words"), at + (i - at) % F.col("_p"))))
    return period.select("doc_id", F.when(F.col("_words").isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs", twins.RUNS)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    found = periods.find_runs(repeating(table(spark, folder, "documents")), keep=[F.col("doc_id")])
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    # A run's rank: most words first, then least start, then least period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
