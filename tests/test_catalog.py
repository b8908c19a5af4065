"""Every registered query against its SQL on the smallest tables, and the contract of the entry module."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, key, rows_of

SF = "/root/testdata/sf0.001"
ORACLE = {n: s for n, s in entry.oracle_sql().items() if entry.queries()[n].__module__.startswith("catalog.")}
QUERIES = {n: f for n, f in entry.queries().items() if f.__module__.startswith("catalog.")}  # others are tested where they are


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "movement_significance" in df.columns


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        assert cols
        return
    cur = con.execute(ORACLE[name])
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert cols == want_cols
    assert [key(r) for r in rows] == [key(r) for r in want]


@pytest.mark.parametrize("name", ["nba_staged_games", "nfl_staged_games"])
def test_both_versions_of_a_game_come_from_one_parse(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") >= 1 and plan.count("Relation [") == 1


def test_methods_of_game_messages_are_small_enough_to_be_compiled(spark):
    from catalog.quality import _game_messages
    from matchgrid.operators import quality

    judged = _game_messages(spark, SF).withColumn("status", quality.first_failure(quality.game_message_rules()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        judged = judged.select("*")
        text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(judged._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:([0-9]+)", text)]
    assert sizes and max(sizes) < 8000
