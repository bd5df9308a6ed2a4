import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewright import session
from tidewright.plans.flights import parse_flights, us_airports
from tidewright.sinks import tables as sink
from tidewright.sources import delimited, files, generated, jdbc, live


def values(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_quoted_titles_stay_whole(spark, tmp_path):
    (tmp_path / "m.csv").write_text('movieId,title,genres\n1,"Heat, the ""film"" (1995)",Crime\n')
    r = files.read_csv(spark, str(tmp_path), "movieId int, title string, genres string").first()
    assert r["title"] == 'Heat, the "film" (1995)' and r["genres"] == "Crime"


def test_survey_blanks(spark, tmp_path):
    (tmp_path / "s.csv").write_text("RT,ST,VALP\nH,4,\nH,5,12\nH,x,3.7\n")
    zero = delimited.read_survey(spark, str(tmp_path), ("RT",)).collect()
    assert [tuple(r) for r in zero] == [("H", 4, 0), ("H", 5, 12), ("H", 0, 3)]
    null = delimited.read_survey(spark, str(tmp_path), ("RT",), blank="null").collect()
    assert null[0]["VALP"] is None


def test_sales_records(spark):
    good = "1|111|7|x|2013-07-01|07:28:21|SALE|1122334|2|EA|10.50|21.00"
    df = values(spark, good, good.replace("SALE", "VOID"), good.replace("|2|", "|0|"), "junk")
    rows = delimited.parse_sales(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["product_id"], r["store_id"], str(r["date"]), r["units"], r["price"]) == ("1122334", "7", "2013-07-01", 2.0, 10.5)
    assert r["time"].strftime("%H:%M:%S") == "07:28:21"


def test_ratings_of_wrong_arity(spark):
    assert tuple(delimited.parse_ratings(values(spark, "1::2::3.5::9")).first()) == (1, 2, 3.5, 9)
    assert tuple(delimited.parse_ratings(values(spark, "1,2,3.5"), sep=",").first()) == (1, 2, 3.5, None)
    with pytest.raises(PySparkException, match="not a rating"):
        delimited.parse_ratings(values(spark, "1::2")).collect()
    kept = delimited.parse_ratings(values(spark, "1::2"), broken="keep").first()
    assert kept["problem"] == "1::2" and kept["user"] is None


def test_vectors_and_points(spark):
    assert list(delimited.parse_vectors(values(spark, " 0.5  1 ")).first()["features"]) == [0.5, 1.0]
    p = delimited.parse_points(values(spark, "-0.4,1.5 2 -3")).first()
    assert p["label"] == -0.4 and list(p["features"]) == [1.5, 2.0, -3.0]


def test_flight_lines(spark):
    cells = [str(i) for i in range(18)]
    late, unknown = list(cells), list(cells)
    late[15], unknown[15] = "-10", "NA"
    rows = parse_flights(values(spark, ",".join(late) + "\n" + ",".join(unknown) + "\n")).collect()
    assert [tuple(r) for r in rows] == [("8", "9", -10, "16", "17"), ("8", "9", 0, "16", "17")]


def test_airports_of_a_country(spark):
    df = spark.createDataFrame([("A", "US", "A1"), ("Penn Station", "US", "P"), ("B", "US", None), ("C", "UK", "C1")],
                               "name string, country string, code string")
    assert [r["name"] for r in us_airports(df, "US").collect()] == ["A"]


def test_literal_rows_and_json(spark, tmp_path):
    df = files.from_objects(spark, [{"first": "Darth", "last": "Vader"}, {"first": "Luke", "last": "S"}], "first string, last string")
    sink.save_json(df, str(tmp_path / "j"))
    sink.save_json(df.limit(1), str(tmp_path / "j"))
    assert files.read_json(spark, str(tmp_path / "j"), df.schema).count() == 1
    texts = spark.createDataFrame([(1, '{"k": 5}'), (2, "broken")], "id int, j string")
    assert [tuple(r) for r in files.parse_json(texts, "j", "k int").orderBy("id").collect()] == [(1, 5), (2, None)]


def test_libsvm_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.0, 2.5, 0.0]), (0, [1.0, 0.0, 3.0])], "label int, v array<double>")
    lines = files.libsvm_lines(df, "label", "v")
    assert {r["value"] for r in lines.collect()} == {"1.0 2:2.5", "0.0 1:1.0 3:3.0"}
    lines.write.text(str(tmp_path / "l"))
    assert {tuple(r["features"].toArray()) for r in files.read_libsvm(spark, str(tmp_path / "l"), 3).collect()} == {(0, 2.5, 0), (1, 0, 3)}


def test_generated_rows(spark):
    a, b = generated.normal_rows(spark, 5, 3, 2).collect(), generated.normal_rows(spark, 5, 3, 2).collect()
    assert a == b and len(generated.normal_vectors(spark, 4, 3).first()["vector"]) == 3


def test_connection_options():
    assert live.topic_options("h:9092", "t", "g")["kafka.group.id"] == "g"
    assert live.socket_options("h", 7) == {"host": "h", "port": "7"}
    got = files.object_store_settings("s", "spark", {"username": "u"})
    assert got == {"spark.hadoop.fs.s.service.spark.username": "u"}


@pytest.mark.parametrize("low,high,parts", [(0, 9, 3), (5, 5, 4), (-3, 20, 7), (0, 1, 10)])
def test_key_ranges_cover_every_key_once(spark, low, high, parts):
    keys = spark.range(low - 2, high + 3).selectExpr("id AS k").union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    ranges = jdbc.key_ranges("k", low, high, parts)
    assert len(ranges) <= parts
    hits = [{r["k"] for r in keys.filter(p).collect()} for p in ranges]
    assert sum(map(len, hits)) == len(set().union(*hits)) == keys.count()


def test_materialize_builds_once_and_after_a_broken_write(spark, tmp_path):
    built, path = [], str(tmp_path / "t")

    def build():
        built.append(1)
        return spark.range(3)

    for _ in range(2):
        assert sink.materialize(spark, path, build).count() == 3
    assert len(built) == 1
    (tmp_path / "t" / "_SUCCESS").unlink()
    sink.materialize(spark, path, build)
    sink.materialize(spark, path, build, rebuild=True)
    assert len(built) == 3


def test_counters(spark, tmp_path):
    df = spark.range(10).withColumn("x", F.col("id").cast("double"))
    assert sink.save_counted(df, str(tmp_path / "c"), n=F.count("*"), s=F.sum("x")) == {"n": 10, "s": 45.0}
    assert sink.side_effect_total(df, "x") == 45.0


def test_shared_folder_is_needed_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_actions(spark):
    df = spark.range(6)
    assert df.count() == 6 and df.first()["id"] == 0 and len(df.take(2)) == 2 and df.head()["id"] == 0
    assert [r["id"] for r in df.limit(2).collect()] == [0, 1]
