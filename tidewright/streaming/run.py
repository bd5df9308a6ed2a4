"""Starting, draining and stopping streaming queries. Every query has its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery


def start_files(stream: DataFrame, path: str, checkpoint: str, interval: str | None = None,
                name: str | None = None) -> StreamingQuery:
    """Append to parquet files, exactly once. With `interval` ("2 seconds") it runs on;
    without, it handles what is there and ends."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    return _start(writer.option("path", path), checkpoint, interval, name)


def start_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", interval: str | None = None, name: str | None = None) -> StreamingQuery:
    """Call `handle(batch, id)` for every micro-batch. A batch may come again after a failure,
    with the same id."""
    return _start(stream.writeStream.outputMode(mode).foreachBatch(handle), checkpoint, interval, name)


def _start(writer, checkpoint, interval, name):
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return (writer.queryName(name) if name else writer).start()


def batch_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch to a folder of its own, replacing it when it is
    replayed, so a repeated batch leaves no double rows. Read back with `spark.read`:
    the batch number is the column `batch`."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def latest_rows(saved: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The newest version of every key from the batches of an update-mode stream."""
    newest = saved.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col("batch")).alias("_v"))
    return newest.select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values])


def drain(queries: Iterable[StreamingQuery]) -> None:
    """Wait until all given queries end; raise the error of one that failed."""
    for q in queries:
        q.awaitTermination()


def stop_all(queries: Iterable[StreamingQuery], seconds: int = 5) -> None:
    """Stop each query and give it a few seconds to finish its batch."""
    for q in queries:
        q.stop()
        q.awaitTermination(seconds)


class LateRows(StreamingQueryListener):
    """Counts what came too late for its window, by query, as long as the session runs.

    `spark.streams.addListener(counter)` starts it; `counter.of(query)` is the number so far. Rows are counted where the
    watermark drops them: behind the sums that tasks make of their own rows, so equal keys and windows of one task
    count once.
    """

    def __init__(self):
        self.counts: dict[str, int] = {}

    def of(self, query: StreamingQuery) -> int:
        return self.counts.get(str(query.id), 0)

    def onQueryStarted(self, event) -> None:
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        own = str(event.progress.id)
        self.counts[own] = self.counts.get(own, 0) + sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_rows(query: StreamingQuery) -> int:
    """The same of a query that has ended, from the progress it has kept (its last hundred batches by default)."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
