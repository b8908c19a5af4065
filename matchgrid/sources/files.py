"""Readers and writers.  Sink formats are parameters; Parquet tables partitioned by day are the default."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = ("partition_year", "partition_month", "partition_day")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local temporary folder stands in only in local mode, where nothing else is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = os.path.join(tempfile.gettempdir(), f"matchgrid-{spark.sparkContext.applicationId}")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.java.net.URI(path) if ":/" in path else path
    target = spark._jvm.org.apache.hadoop.fs.Path(where)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether there is data: leftovers of a failed first load (names in ``_`` or ``.``) are none."""
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return False
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return any("=" in n or not n.startswith(("_", ".")) for n in names)


def read_folders(spark: SparkSession, path: str, schema: StructType, folders: list[str]) -> DataFrame:
    """The partitions of the table at ``path`` that lie in ``folders`` (URIs); no other file is listed or opened."""
    if not folders:
        return spark.createDataFrame([], schema)
    plain = [_hadoop(spark, f)[1].toString() for f in folders]
    return spark.read.schema(schema).option("basePath", path).parquet(*plain)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic from now on; lost offsets do not stop the query."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    defaults = {"startingOffsets": "latest", "failOnDataLoss": "false", **options}
    return reader.options(**defaults).load()


def decode_json(messages: DataFrame, schema: str | StructType, value: str = "value", keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, quarantined rows): JSON in ``value`` by a fixed schema.

    Text that is no JSON object lands in quarantine with ``value`` unchanged instead of becoming an all-NULL row.
    """
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    data = F.from_json(
        F.col(value).cast("string"),
        f"{ddl}, _corrupt_record STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    # a generator of one element, so that the filters below test the parsed text instead of parsing again
    parsed = messages.select("*", F.explode_outer(F.array(data)).alias("_data"))
    bad = F.col("_data").isNull() | F.col("_data._corrupt_record").isNotNull()
    good = parsed.filter(~bad).select(*keep, "_data.*").drop("_corrupt_record")
    return good, parsed.filter(bad).drop("_data")


def read_json_day(spark: SparkSession, root: str, day: str, name: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Raw documents of one day (``<root>/<day>/<name>``) by an explicit schema; an absent day reads as empty."""
    path = f"{root.rstrip('/')}/{day}/{name}"
    fs, target = _hadoop(spark, path)
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_with_file_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files below a path with their name and modification time."""
    files = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    return files.select(
        "*",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("last_modified"),
    )


def align_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns matched to the target by name regardless of case; missing ones NULL, unknown ones left out."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`").cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def merge_columns(*frames: DataFrame) -> DataFrame:
    """UNION ALL that appends the columns new frames bring; older rows get NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def append_partitioned(df: DataFrame, path: str, by: Sequence[str] = DAY) -> None:
    """Append to a partitioned table; rows are grouped by partition first so each task writes few files.

    Rows of one partition are spread over tasks by AQE when the partition is large.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode("append").partitionBy(*by).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str] = DAY) -> None:
    """Rewrite exactly the partitions present in ``df``: a rerun of a day leaves the same table."""
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def full_refresh(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files may have gained columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def create_table(spark: SparkSession, name: str, schema: str, by: Sequence[str] = DAY, location: str | None = None) -> None:
    """Create a partitioned Parquet table unless it exists; ``schema`` includes the partition columns."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet PARTITIONED BY ({', '.join(by)}){place}")


def as_messages(df: DataFrame) -> DataFrame:
    """Each row as one JSON message in ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))

