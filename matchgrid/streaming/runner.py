"""Running windowed analytics as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from matchgrid.operators.windows import latest_by
from matchgrid.plans.incremental import incremental_merge
from matchgrid.sources.files import as_messages


def run_stream(
    df: DataFrame,
    sink: str,
    checkpoint: str,
    mode: str = "update",
    options: Mapping[str, str] | None = None,
    available_now: bool = False,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a checkpointed query; ``available_now`` processes what is there and stops."""
    writer = df.writeStream.format(sink).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.options(**(options or {}))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def publish(df: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Every result row as one JSON message on a topic."""
    options = {
        "kafka.bootstrap.servers": servers, "topic": topic, "kafka.max.block.ms": "5000", "kafka.retries": "3",
        "kafka.retry.backoff.ms": "500",
    }
    return run_stream(as_messages(df), "kafka", checkpoint, mode, options)


def version_sink(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Update-mode results as Parquet, one folder per micro-batch.

    A batch that is run again after a failure overwrites its own folder, so every change is kept once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_versions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of every key written by :func:`version_sink`."""
    return latest_by(spark.read.parquet(path), keys, ["batch_id"]).drop("batch_id")


def merge_sink(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], by: Sequence[str], checkpoint: str
) -> StreamingQuery:
    """Merge every micro-batch into a partitioned table by key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        incremental_merge(batch.sparkSession, path, batch, keys, order, by)

    writer = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(availableNow=True).start()


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: str | StructType,
    path: str,
    checkpoint: str,
    by: Sequence[str] = (),
    pattern: str = "*.parquet",
) -> StreamingQuery:
    """Append the Parquet files that appeared in a folder since the last run to a table."""
    files = spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(source)
    writer = files.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.partitionBy(*by) if by else writer).trigger(availableNow=True).start()


def drop_repeats(df: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Messages delivered again within ``delay`` are dropped (idempotent ingest)."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


class LateRows(StreamingQueryListener):
    """Rows dropped for being older than the watermark, added up over all progress reports of each query run.

    Register it with ``spark.streams.addListener`` before the queries start; reports arrive shortly after their batch.
    """

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        late = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        self.dropped[run] = self.dropped.get(run, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def of(self, query: StreamingQuery) -> int:
        """Rows of one run of a query dropped so far; all of them once it is among ``ended``."""
        return self.dropped.get(str(query.runId), 0)


def with_event_time(messages: DataFrame, column: str = "timestamp", ts: str = "ts") -> DataFrame:
    """Event time from an epoch-seconds field (arrival time is not used)."""
    return messages.withColumn(ts, F.timestamp_micros((F.col(column).cast("double") * 1_000_000).cast("bigint")))
