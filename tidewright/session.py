"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE = os.path.dirname(os.path.abspath(__file__))
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Zone-less Parquet timestamps load as instants, so watermarks accept them and
    # filters on them still reach the scan (a cast in the plan would block both).
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # A shuffled join with a small filtered side sifts the large side by a filter of its keys first,
    # from this size of scan on.
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "32MB",
    # A bucket of one file is read in the order it was sorted in.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # What Python functions are given at once, in bytes and in rows: wide rows would fill an executor otherwise.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
#: Settings of the context: checkpoints go when nothing refers to them any more.
CONTEXT_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every function here relies on. Sizing is left to the cluster."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once, so that Python functions of its modules load
    there wherever the program was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewright_shipped", False):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tidewright-"))
    archive = os.path.join(folder, "tidewright.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    sc.addPyFile(archive)
    sc._tidewright_shipped = True


def build_session(app: str = "tidewright", master: str | None = None,
                  **settings: str) -> SparkSession:
    """A session with the settings above; `settings` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **CONTEXT_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from `spark.checkpoint.dir`.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would lose data with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="tidewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used yet. What is written there is the session's: `release` removes it,
    and so does the end of the program."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    owned(spark).append(path)
    return path


def owned(spark: SparkSession) -> list[str]:
    """Paths that this session has been given and that have not been removed."""
    sc = spark.sparkContext
    if not hasattr(sc, "_tidewright_owned"):
        sc._tidewright_owned = []
        atexit.register(lambda: release(spark) if sc._jsc is not None else None)
    return sc._tidewright_owned


def release(spark: SparkSession) -> None:
    """Remove all that functions here have written in the shared folder and that results may still read. Results that
    were not saved elsewhere can't be read any more."""
    for name in list(getattr(spark.sparkContext, "_tidewright_tables", [])):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sparkContext._tidewright_tables = []
    for path in list(owned(spark)):
        remove(spark, path)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df`: write it as parquet in the shared folder and read it back.

    Unlike a checkpoint of rows the copy is columnar, and its size is known to the planner.
    """
    path = fresh_path(df.sparkSession, "settled")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries planned inside remove their shuffle files when they end, instead of whenever
    the driver collects its garbage. For writes, whose plans are run once."""
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)


class Scratch:
    """Tables written in the shared folder, each removed when it is no longer read.

    `with Scratch(spark) as scratch:` removes all that are left at the end; a result that
    still reads some of them keeps them with `scratch.keep(df)`.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.tables: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*[df for df, _ in self.tables.values()])

    def path(self, label: str) -> str:
        return fresh_path(self.spark, label)

    def settle(self, df: DataFrame, label: str = "settled") -> DataFrame:
        """Write `df` as parquet and read it back: lineage, and the shuffles before it, end here."""
        path = self.path(label)
        with shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.tables[id(back)] = (back, path)
        return back

    def parts(self, df: DataFrame, target: int = 128 << 20) -> int:
        """How many partitions of about `target` stored bytes a settled table needs, and never fewer than
        `spark.sql.shuffle.partitions`."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.tables[id(df)][1])
        size = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // target))

    def keep(self, *dfs: DataFrame) -> None:
        """Leave these tables in place, for a result that reads them."""
        for df in dfs:
            self.tables.pop(id(df), None)

    def drop(self, *dfs: DataFrame) -> None:
        """Remove tables through the file system they are in."""
        for df in dfs:
            _, path = self.tables.pop(id(df), (None, None))
            if path:
                remove(self.spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, whatever file system that is."""
    if path in owned(spark):
        owned(spark).remove(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def save_bucketed(df: DataFrame, name: str, parts: int, *keys: str) -> DataFrame:
    """Save `df` as a table in `parts` buckets, each one file sorted by `keys`, which the planner knows: a join on these keys
    neither moves nor sorts this side, under adaptive planning too, in this call and in later ones."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.repartition(parts, *keys).sortWithinPartitions(*keys).write.option("path", path).option("compression", "zstd").bucketBy(
        parts, *keys).sortBy(*keys).saveAsTable(name)
    spark.sparkContext._tidewright_tables = [*getattr(spark.sparkContext, "_tidewright_tables", []), name]
    return spark.table(name)


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Drop a table of `save_bucketed` with its files."""
    places = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Location"]
    spark.sql(f"DROP TABLE {name}")
    held = getattr(spark.sparkContext, "_tidewright_tables", [])
    spark.sparkContext._tidewright_tables = [x for x in held if x != name]
    for place in places:
        for path in [p for p in owned(spark) if p.rsplit("/", 1)[-1] == place.rsplit("/", 1)[-1]]:
            remove(spark, path)
