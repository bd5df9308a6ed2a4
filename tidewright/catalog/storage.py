"""Sources and sinks: each query writes table data in a format and reads it back."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewright.catalog import query
from tidewright.functions.columns import day_key
from tidewright.session import fresh_path
from tidewright.sinks import tables as sink
from tidewright.sources import delimited, files, generated


@query("src_01_text_lines", """
SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
GROUP BY line""")
def _(spark, t):
    path = fresh_path(spark, "lines")
    t.documents.select("text").write.option("lineSep", "\n").text(path)
    return (files.read_lines(spark, f"{path}/*.txt", line_sep="\n")
            .groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n")))


@query("src_02_csv_with_header", """
SELECT c_custkey, '"' || c_name || '", ' || c_mktsegment AS title, c_nationkey,
       CAST(floor(c_acctbal) AS INTEGER) AS balance FROM customer""")
def _(spark, t):
    path = fresh_path(spark, "csv")
    title = F.concat(F.lit('"'), "c_name", F.lit('", '), "c_mktsegment")
    (t.customer.select("c_custkey", title.alias("title"), "c_nationkey", F.floor("c_acctbal").alias("balance"))
     .write.option("header", True).option("escape", '"').csv(path))
    return files.read_csv(spark, path, "c_custkey bigint, title string, c_nationkey int, balance int")


@query("src_02b_header_names_blank_as_zero", """
SELECT CAST(c_custkey AS INTEGER) AS custkey, c_mktsegment AS segment,
       CASE WHEN c_acctbal < 5000 THEN 0 ELSE CAST(floor(c_acctbal) AS INTEGER) END AS balance FROM customer""")
def _(spark, t):
    path = fresh_path(spark, "survey")
    blanked = F.when(F.col("c_acctbal") >= 5000, F.col("c_acctbal"))
    (t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"),
                       blanked.alias("balance")).write.option("header", True).csv(path))
    return delimited.read_survey(spark, path, texts=("segment",))


def sale_lines(t):
    """Pipe-separated sales records from line items; returns are records of another type."""
    filler = F.lit("x")
    kind = F.when(F.col("l_returnflag") == "R", "RETURN").otherwise("SALE")
    price = F.col("l_extendedprice")
    fields = [filler, filler, F.col("l_suppkey"), filler, day_key(F.col("l_shipdate")),
              F.format_string("%02d:30:00", F.col("l_linenumber")), kind, F.col("l_partkey"),
              F.col("l_quantity"), filler, price, filler]
    return t.lineitem.select(F.concat_ws("|", *[f.cast("string") for f in fields]).alias("value"))


@query("src_03_pipe_records", """
SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS store_id,
       strftime(l_shipdate, '%Y-%m-%d') AS date, strftime(l_shipdate, '%Y-%m-%d') || ' 0' || l_linenumber || ':30' AS time,
       l_quantity AS units, l_extendedprice AS price, 'SALE' AS type
FROM lineitem WHERE l_returnflag <> 'R'""")
def _(spark, t):
    path = fresh_path(spark, "sales")
    sale_lines(t).write.text(path)
    return (delimited.parse_sales(files.read_lines(spark, path))
            .withColumn("date", F.col("date").cast("string"))
            .withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm")))


@query("src_04_double_colon_ratings", """
SELECT CAST(o_custkey AS INTEGER) AS user, CAST(l_partkey AS INTEGER) AS item, l_quantity AS rating,
       epoch(l_shipdate)::BIGINT AS at, CAST(NULL AS VARCHAR) AS problem
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT NULL, NULL, NULL, NULL, r_name FROM region""")
def _(spark, t):
    path = fresh_path(spark, "ratings")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.join(o, "l_orderkey").select(F.concat_ws(
        "::", "o_custkey", "l_partkey", "l_quantity", F.unix_timestamp("l_shipdate")).alias("value"))
    lines.union(t.region.select("r_name")).write.text(path)
    return delimited.parse_ratings(files.read_lines(spark, path), broken="keep")


VECTOR_ROWS_SQL = """
SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, round(CAST(embedding[pos] AS DOUBLE), 6) AS x
FROM embeddings, range(1, 65) r(pos)"""


def vector_rows(df, key, vector):
    return df.select(key, F.posexplode(vector_to_array(vector)).alias("pos", "x")).withColumn(
        "x", F.round("x", 6))


@query("src_05_space_separated_vectors", VECTOR_ROWS_SQL)
def _(spark, t):
    path = fresh_path(spark, "vectors")
    text = F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), " ")
    t.embeddings.select(F.concat_ws(",", "vec_id", text).alias("value")).write.text(path)
    points = delimited.parse_points(files.read_lines(spark, path))
    return vector_rows(points.withColumn("vec_id", F.col("label").cast("bigint")), "vec_id", "features")


@query("src_06_libsvm", VECTOR_ROWS_SQL + " WHERE embedding[pos] <> 0")
def _(spark, t):
    path = fresh_path(spark, "libsvm")
    files.libsvm_lines(t.embeddings, "vec_id", "embedding").write.text(path)
    points = files.read_libsvm(spark, path, 64).withColumn("vec_id", F.col("label").cast("bigint"))
    # What is 0 is told before rounding: numbers that round to 0 are kept.
    rows = points.select("vec_id", F.posexplode(vector_to_array("features")).alias("pos", "x")).filter("x <> 0")
    return rows.withColumn("x", F.round("x", 6))


@query("src_07_json_lines", """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events""")
def _(spark, t):
    path = fresh_path(spark, "json")
    e = t.events.select("event_id", "user_id", "event_type", "value",
                        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    sink.save_json(e, path)
    return files.read_json(spark, path, "event_id bigint, user_id bigint, event_type string, "
                                        "value double, ts string")


@query("src_08_json_texts", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _(spark, t):
    return files.parse_json(t.events.select("event_id", "props"), "props", "k int")


@query("src_09_parquet_pruned_read", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000")
def _(spark, t):
    return t.orders.filter("o_totalprice > 300000").select("o_orderkey", "o_totalprice")


@query("src_13_reload_typed_rows", """
SELECT o_orderstatus, o_orderkey, o_custkey, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def _(spark, t):
    path = fresh_path(spark, "typed")
    sink.save_table(t.orders, path, partition_by=("o_orderstatus",))
    return spark.read.parquet(path).select(
        "o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice",
        F.to_date("o_orderdate").cast("string").alias("day"))


@query("src_15_normal_generators", """
SELECT count(*) AS n, TRUE AS mean_near_0, TRUE AS deviation_near_1, TRUE AS components_unrelated FROM lineitem""")
def _(spark, t):
    v = generated.with_normal_vector(t.lineitem.select("l_orderkey"), 2, seed=11)
    a, b = F.get("vector", 0), F.get("vector", 1)
    return v.agg(F.count("*").alias("n"), (F.abs(F.avg(a)) < 0.05).alias("mean_near_0"),
                 (F.abs(F.stddev(b) - 1) < 0.05).alias("deviation_near_1"),
                 (F.abs(F.corr(a, b)) < 0.05).alias("components_unrelated"))


@query("src_19_reference_rows_by_predicate", """
SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE n_name = 'NATION_5' AND NOT (contains(s_name, 'Station') OR contains(s_name, 'Train')
  OR contains(s_name, 'Amtrak')) AND s_name <> ''""")
def _(spark, t):
    from tidewright.plans.flights import us_airports
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("s_name").alias("name"), F.col("n_name").alias("country"),
        F.col("s_name").alias("code"))
    return us_airports(places, "NATION_5").select(
        "s_suppkey", F.col("name").alias("s_name"), F.col("country").alias("n_name"))


@query("snk_01_json_overwrite", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, t):
    path = fresh_path(spark, "json")
    sink.save_json(t.region, path)
    sink.save_json(t.nation, path)
    return files.read_json(spark, path, t.nation.schema)


@query("snk_03_typed_overwrite", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(spark, t):
    path = fresh_path(spark, "typed")
    sink.save_table(t.nation, path)
    sink.save_table(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return spark.read.parquet(path)


@query("snk_05_build_once_then_reuse", """
SELECT o_orderstatus, count(*) AS n, CAST(1 AS BIGINT) AS builds_first, CAST(2 AS BIGINT) AS builds_forced
FROM orders GROUP BY o_orderstatus""")
def _(spark, t):
    path, built = fresh_path(spark, "derived"), []

    def build():
        built.append(1)
        return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))

    sink.materialize(spark, path, build)
    sink.materialize(spark, path, build)
    first = len(built)
    again = sink.materialize(spark, path, build, rebuild=True)
    return again.select("o_orderstatus", "n", F.lit(first).cast("bigint").alias("builds_first"),
                        F.lit(len(built)).cast("bigint").alias("builds_forced"))


@query("snk_06_persist", "SELECT count(*) AS n, round(sum(l_tax), 2) AS tax FROM lineitem")
def _(spark, t):
    kept = t.lineitem.select("l_orderkey", "l_tax").persist()
    kept.count()
    return kept.agg(F.count("*").alias("n"), F.round(F.sum("l_tax"), 2).alias("tax"))


@query("snk_08_counted_save", """
SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, count(*) FILTER (o_orderstatus = 'F') AS finished FROM orders""")
def _(spark, t):
    seen = sink.save_counted(
        t.orders, fresh_path(spark, "counted"), n=F.count("*"), total=F.round(F.sum("o_totalprice"), 2),
        finished=F.count_if(F.col("o_orderstatus") == "F"))
    return spark.createDataFrame([seen], "n bigint, total double, finished bigint")
