"""Files brought into a table by column name, whatever columns each of them has."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchgrid.sources.files import align_columns, has_files

LEDGER = "file STRING, batch INT, schema STRING"


def file_schemas(files: DataFrame) -> DataFrame:
    """(file, schema as JSON) of Parquet ``files``: their footers are read in tasks, no row is."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            schemas = []
            for file in batch["file"]:
                local = file.startswith(("file:", "/"))
                where, path = (fs.LocalFileSystem(), "/" + file.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(file)
                found = pq.read_schema(path, filesystem=where)
                written = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                schemas.append(written.decode() if written else from_arrow_schema(found, prefer_timestamp_ntz=True).json())
            yield pd.DataFrame({"file": batch["file"], "schema": schemas})

    few = max(1, files.sparkSession.sparkContext.defaultParallelism)
    return files.select("file").repartition(few).mapInPandas(footers, "file STRING, schema STRING")


def fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of one type is a value of the other."""
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if have == want or isinstance(have, T.NullType):
        return True
    if isinstance(want, T.StringType):
        return not isinstance(have, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    if type(have) in order and type(want) in order:
        return order.index(type(have)) <= order.index(type(want))
    if isinstance(want, T.DoubleType):
        return isinstance(have, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    return isinstance(have, T.DateType) and isinstance(want, T.TimestampType)


def grown(target: T.StructType, new: T.StructType, name: str = "") -> T.StructType:
    """``target`` and the columns that only ``new`` has, compared regardless of case; raises where a type does not fit."""
    have = {f.name.lower(): f for f in target}
    if len({f.name.lower() for f in new}) < len(new):
        raise ValueError(f"columns of {name} differ in case only: {new.names}")
    for f in new:
        known = have.get(f.name.lower())
        if known is not None and not fits(f.dataType, known.dataType):
            raise ValueError(f"{f.name} of {name} is {f.dataType.simpleString()}, the table has {known.dataType.simpleString()}")
    fresh = [T.StructField(f.name, f.dataType) for f in new if f.name.lower() not in have]
    return T.StructType([*target.fields, *fresh])


def ingested_files(spark: SparkSession, ledger: str) -> DataFrame:
    """(file, batch, schema of the table after it) of everything that has been brought in."""
    return spark.read.schema(LEDGER).parquet(ledger) if has_files(spark, ledger) else spark.createDataFrame([], LEDGER)


def ingest_by_name(spark: SparkSession, source: str, path: str, ledger: str, by: Sequence[str] = (), pattern: str = "*.parquet") -> int:
    """Append the Parquet files below ``source`` that are not in the ``ledger`` yet; returns how many there were.

    Each file's schema comes from its own footer, and files of one schema are read together.  Columns are matched by name,
    whatever their case and order; absent ones are NULL, new ones join the end of the table, in order of file name.  A type
    that the table's cannot hold stops the run before anything is written.

    A run fills one folder ``batch=<n>`` of ``path`` and then notes its files.  A run that fails in between is made up by the
    next one, which has the same number and replaces the folder, so no file is lost or brought in twice.  One run at a time.
    File names and different schemas pass through the driver, as they do for any read of files; rows do not.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(source)
    known = ingested_files(spark, ledger)
    fresh = file_schemas(listed.select(F.col("path").alias("file")).join(known.select("file"), "file", "left_anti"))
    groups: dict[str, list[str]] = {}
    for file, schema in sorted(fresh.collect()):
        groups.setdefault(schema, []).append(file)
    if not groups:
        return 0
    last = known.agg(F.max("batch"), F.max_by("schema", "batch")).first()
    number = 0 if last[0] is None else last[0] + 1
    target = T.StructType([]) if last[0] is None else T.StructType.fromJson(json.loads(last[1]))
    kinds = {schema: T.StructType.fromJson(json.loads(schema)) for schema in groups}
    for schema, files in groups.items():
        target = grown(target, kinds[schema], files[0])
    target = T.StructType([T.StructField(f.name, f.dataType) for f in target])
    parts = [align_columns(spark.read.schema(kinds[schema]).parquet(*files), target) for schema, files in groups.items()]
    rows = reduce(DataFrame.unionByName, parts)
    if by:
        rows = rows.hint("rebalance", *[F.col(c) for c in by])
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/batch={number}")
    notes = [(file, target.json()) for files in groups.values() for file in files]
    noted = spark.createDataFrame(notes, "file STRING, schema STRING").select("file", F.lit(number).alias("batch"), "schema")
    noted.coalesce(1).write.mode("append").parquet(ledger)
    return len(notes)


def read_ingested(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """The table as of the last finished run: its newest columns, NULL where a batch has none; unfinished batches are left out."""
    runs = [tuple(r) for r in ingested_files(spark, ledger).groupBy("batch").agg(F.first("schema")).collect()]
    if not runs:
        return spark.createDataFrame([], T.StructType([]))
    schema = T.StructType.fromJson(json.loads(max(runs)[1]))
    folders = [f"{path}/batch={n}" for n, _ in sorted(runs)]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*[f"`{c}`" for c in schema.names])
