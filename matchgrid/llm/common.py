"""What the operators share: input tables, written intermediate tables, code on the executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from matchgrid.sources.files import shared_folder

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable on the executors, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(), "matchgrid_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and readable again after an executor is lost."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def free(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
