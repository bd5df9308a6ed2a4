"""Each stage of the pipeline on its own input, against brute force, and the whole."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.test_sets import brute_components, brute_removed
from tests.llm.test_texts import check_packed, reshared

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*cp.COLUMNS)
    odd = spark.createDataFrame([(9001, None, "en", "src0", None), (9002, "", None, None, 0), (9003, "123 ### 4", "en", "src1", 9)], own.schema)
    return own.union(odd)


def test_stages_are_named_and_in_order():
    assert [n for n, _ in cp.STAGES] == ["language_id", "ngram_jaccard", "suffix_dedup", "mixing", "packing"]


def test_language_stage_keeps_texts_of_a_language(spark, docs):
    out = {r.doc_id for r in cp.in_a_language(spark, docs.withColumn("extra", F.lit(1)), FOLDER).collect()}
    assert out == {r.doc_id for r in docs.collect()} - {9001, 9002, 9003}


def test_language_stage_rejects_what_no_other_text_taught(spark, docs):
    foreign = "".join(chr(0x3B1 + i * 7 % 24) + (" " if i % 5 == 4 else "") for i in range(400))
    rows = [(9100, foreign, "en", "s", 1), (9101, foreign, "en", "s", 1), (9102, "qzx jqv xkz wqx zzq " * 30, "de", "s", 1)]
    out = {r.doc_id for r in cp.in_a_language(spark, docs.union(spark.createDataFrame(rows, docs.schema)), FOLDER).collect()}
    assert out == {r.doc_id for r in docs.collect()} - {9001, 9002, 9003}


def test_stages_of_nothing_and_of_one(spark, docs):
    one = docs.limit(1)
    for _, stage in cp.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
        assert stage(spark, one, FOLDER).count() >= 1


def test_group_stage_keeps_one_of_each(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = cp.one_of_each_group(spark, docs.union(docs.limit(1)).union(docs.limit(1).withColumn("doc_id", F.lit(None).cast("bigint"))), FOLDER)
    assert out.columns == cp.COLUMNS
    name = brute_components(rows, cp.WORDS, cp.PERCENT)
    assert Counter(r.doc_id for r in out.collect()) == Counter([*{i for i, g in name.items() if i == g}, None])


def test_group_stage_keeps_other_texts_of_a_doc_id(spark, docs):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    rows = [(5, text("a"), "en", "s", 1), (5, text("b"), "en", "s", 1), (5, text("b"), "en", "s", 1), (5, text("c", 30), None, "s", 1),
            (7, text("a"), "en", "s", 1), (3, text("b"), "de", "s", 1), (8, text("d"), "en", "s", 1), (8, text("e"), "en", "s", 1)]
    out = cp.one_of_each_group(spark, spark.createDataFrame(rows, docs.schema), FOLDER).collect()
    want = [(5, text("a")), (3, text("b")), (5, text("c", 30)), (8, text("d")), (8, text("e"))]
    assert Counter((r.doc_id, r.text) for r in out) == Counter(want)


def test_links_of_every_text_of_a_key(spark):
    text = lambda name: " ".join(f"{name}{i}" for i in range(60))
    rows = [(1, text("a")), (1, text("b")), (2, text("a") + " more"), (3, text("b") + " more")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in cp.jaccard.jaccard_components(df).collect()}
    assert got == brute_components(rows, 3, 90) == {1: 1, 2: 1, 3: 1}


def test_repeat_stage_cuts_what_repeats(spark, docs):
    rows = docs.collect()
    out = {r.doc_id: r for r in cp.without_repeats(spark, docs, FOLDER).collect()}
    for r, gone in zip(rows, brute_removed([(r.text or "").encode() for r in rows], 200)):
        raw = (r.text or "").encode()
        rest = bytes(np.frombuffer(raw, np.uint8)[~gone])
        if not gone.any():
            assert out[r.doc_id].text == r.text and out[r.doc_id].n_chars == r.n_chars
        elif not rest.strip():
            assert r.doc_id not in out
        else:
            assert out[r.doc_id].text == rest.decode(errors="ignore")
            assert out[r.doc_id].n_chars == len(out[r.doc_id].text)


def test_mix_stage_repeats_documents(spark, docs):
    out = cp.mixed(spark, docs.union(docs.limit(2)), FOLDER)
    assert out.columns == cp.COLUMNS
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after, most = Counter(), Counter(), Counter()
    for r in docs.union(docs.limit(2)).collect():
        before[r.source] += size(r.text)
        most[r.source] = max(most[r.source], size(r.text))
    times = Counter()
    for r in out.collect():
        after[r.source] += size(r.text)
        times[r.doc_id] += 1
    for s, goal in reshared(before).items():
        assert abs(after[s] - goal) <= max(0.02 * goal, most[s])
    assert max(times.values()) <= 6


def test_mix_stage_tells_rows_apart_by_which_column_is_null(spark, docs):
    text = "several words of one text " * 8
    rows = [(1, text, None, "x", 5), (1, text, "x", None, 5), (None, text, "x", None, 5), (1, text, "x", "x", 5)]
    out = cp.mixed(spark, spark.createDataFrame(rows, docs.schema), FOLDER).collect()
    assert {tuple(r) for r in out} == set(rows) or Counter(map(tuple, out)).total() >= 3
    words = Counter()
    for r in out:
        words[r.source] += 40
    for s, goal in reshared({"x": 80, None: 80}).items():
        assert abs(words[s] - goal) <= 40


def test_whole_run(spark):
    rows = cp.run(spark, FOLDER).collect()
    assert len(rows) > 100
    whole = Counter()
    for r in rows:
        whole[r.doc_id, r.doc_tokens] += r.length
    assert all(n % tokens == 0 for (_, tokens), n in whole.items())  # every copy of a document is whole
    filled = Counter()
    for r in rows:
        filled[r.sequence_id] += r.length
    assert sorted(filled.values())[1:] == [1024] * (len(filled) - 1)


def test_pack_stage_round_trip(spark, docs):
    few = docs.filter("doc_id < 20 OR doc_id > 9000")
    check_packed(cp.packed(spark, few, FOLDER).collect(), {r.doc_id: r.text for r in few.collect()}, 1024)
