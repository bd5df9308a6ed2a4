import os

import pytest
from pyspark.sql import functions as F

from tidewright.session import CLEAN_SHUFFLES, Scratch, owned, release, save_bucketed, shared_dir, shuffles_removed


def folders(spark):
    base = shared_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(base) if f.startswith("settled-")}


def test_scratch_leaves_nothing_behind(spark):
    before = folders(spark)
    with Scratch(spark) as scratch:
        one = scratch.settle(spark.range(10))
        two = scratch.settle(one.withColumn("x", F.col("id") * 2))
        assert len(folders(spark) - before) == 2
        scratch.drop(one)
        assert len(folders(spark) - before) == 1
        assert two.agg(F.sum("x")).first()[0] == 90
    assert folders(spark) == before


def test_scratch_keeps_what_a_result_reads(spark):
    with Scratch(spark) as scratch:
        kept = scratch.settle(spark.range(3))
        scratch.keep(kept)
    assert kept.count() == 3


def test_scratch_cleans_up_after_an_error(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), Scratch(spark) as scratch:
        scratch.settle(spark.range(3))
        raise ZeroDivisionError
    assert folders(spark) == before


def test_partitions_follow_size(spark):
    with Scratch(spark) as scratch:
        table = scratch.settle(spark.range(100_000))
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert scratch.parts(table) == least
        assert scratch.parts(table, target=1000) > 10 * least


def test_shuffle_setting_is_put_back(spark):
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    with shuffles_removed(spark):
        assert spark.conf.get(CLEAN_SHUFFLES) == "true"
    assert spark.conf.get(CLEAN_SHUFFLES, None) == before


def test_release_removes_all_that_the_session_wrote(spark):
    base = shared_dir(spark).removeprefix("file:")
    table = save_bucketed(spark.range(100), "bucketed_for_a_test", 2, "id")
    Scratch(spark).settle(spark.range(3))
    mine = {p.rsplit("/", 1)[-1] for p in owned(spark)}
    assert table.count() == 100 and len(mine & set(os.listdir(base))) >= 2
    release(spark)
    assert not mine & set(os.listdir(base)) and owned(spark) == []
    assert not [t for t in spark.catalog.listTables() if t.name == "bucketed_for_a_test"]
