"""Ingest by column name: renamed case, added and absent columns, reruns, a run that failed half way, types that do not fit."""

import pytest
from pyspark.sql import types as T

from matchgrid.plans import ingest


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def table(spark, path, ledger):
    return {tuple(r) for r in ingest.read_ingested(spark, path, ledger).collect()}


def test_three_schemas_and_reruns(spark, tmp_path):
    source, path, ledger = (str(tmp_path / n) for n in ("in", "table", "ledger"))
    put(spark, source, "a", [(1, "x")], "id INT, Name STRING")
    put(spark, source, "b", [("y", 2, 0.5)], "NAME STRING, ID INT, score DOUBLE")
    put(spark, source, "c", [(3,), (None,)], "id INT")
    assert ingest.ingest_by_name(spark, source, path, ledger) == 3
    want = {(1, "x", None), (2, "y", 0.5), (3, None, None), (None, None, None)}
    assert table(spark, path, ledger) == want
    assert ingest.ingest_by_name(spark, source, path, ledger) == 0
    assert table(spark, path, ledger) == want
    put(spark, source, "d", [(True, 7)], "flag BOOLEAN, Id SMALLINT")
    assert ingest.ingest_by_name(spark, source, path, ledger) == 1
    got = ingest.read_ingested(spark, path, ledger)
    assert got.columns == ["id", "Name", "score", "flag"]
    assert {tuple(r) for r in got.collect()} == {(*r, None) for r in want} | {(7, None, None, True)}
    assert ingest.ingested_files(spark, ledger).groupBy("file").count().filter("count > 1").count() == 0


def test_failed_run_is_made_up(spark, tmp_path, monkeypatch):
    source, path, ledger = (str(tmp_path / n) for n in ("in", "table", "ledger"))
    put(spark, source, "a", [(1,)], "id INT")
    ingest.ingest_by_name(spark, source, path, ledger)
    put(spark, source, "b", [(2,)], "id INT")
    with monkeypatch.context() as m:  # the rows are written, the note is not
        m.setattr(ingest.T.StructType, "json", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.ingest_by_name(spark, source, path, ledger)
    assert table(spark, path, ledger) == {(1,)}
    put(spark, source, "c", [(3,)], "id INT")
    assert ingest.ingest_by_name(spark, source, path, ledger) == 2
    assert sorted(r.id for r in ingest.read_ingested(spark, path, ledger).collect()) == [1, 2, 3]


def test_types_and_partitions(spark, tmp_path):
    source, path, ledger = (str(tmp_path / n) for n in ("in", "table", "ledger"))
    put(spark, source, "a", [(1, "x"), (2, None)], "id INT, kind STRING")
    assert ingest.ingest_by_name(spark, source, path, ledger, ["kind"]) == 1
    assert table(spark, path, ledger) == {(1, "x"), (2, None)}
    put(spark, source, "b", [("1",)], "ID STRING")
    with pytest.raises(ValueError, match="ID of .* is string, the table has int"):
        ingest.ingest_by_name(spark, source, path, ledger, ["kind"])
    assert table(spark, path, ledger) == {(1, "x"), (2, None)}
    twice = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ID", T.IntegerType())])
    with pytest.raises(ValueError, match="differ in case only"):
        ingest.grown(T.StructType([]), twice, "f")
    assert ingest.fits(T.FloatType(), T.DoubleType()) and not ingest.fits(T.LongType(), T.DoubleType())


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert ingest.ingest_by_name(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "l")) == 0
    assert ingest.read_ingested(spark, str(tmp_path / "t"), str(tmp_path / "l")).columns == []
