import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchgrid.operators import filters, odds, quality
from matchgrid.operators.windows import Frame, Running, running
from matchgrid.plans import batch, incremental
from matchgrid.sources import files

T = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(60)]
DDL = "game_id string, bookmaker_key string, bookmaker_last_update timestamp, home_price int, away_price int, partition_year int, partition_month int, partition_day int, ingestion_timestamp timestamp"


def quote(game, at, home, away=100):
    return (game, "b", T[at], home, away, T[at].year, T[at].month, T[at].day, T[at])


def shown(df):
    return sorted(str(r) for r in df.collect())


def test_incremental_movement_equals_full_refresh(spark, tmp_path):
    old = spark.createDataFrame([quote("g1", 0, 100), quote("g1", 5, 120), quote("g2", 1, -150), quote("g3", 30, 90)], DDL)
    new = spark.createDataFrame([quote("g1", 40, 150), quote("g4", 41, 110)], DDL)
    everything, path = old.unionByName(new), str(tmp_path / "movement")
    keys, order = ["game_id", "bookmaker_key", "bookmaker_last_update"], ["ingestion_timestamp"]
    files.replace_partitions(odds.odds_movement(old), path)
    incremental.refresh_by_key(spark, path, everything, new, ["game_id", "bookmaker_key"], odds.odds_movement, keys, order, files.DAY)
    full = odds.odds_movement(everything)
    assert shown(files.read_table(spark, path).select(full.columns)) == shown(full)


def test_merge_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a", 1, "x y/z"), (2, "b", 1, "x y/z"), (3, "c", 1, "other"), (4, "d", 1, None)]
    ddl = "id int, v string, version int, part string"
    merge = lambda updates: incremental.incremental_merge(spark, path, spark.createDataFrame(updates, ddl), ["id"], ["version"], ["part"])
    merge(rows)
    merge([(1, "A", 2, "other"), (2, "B", 2, "new"), (4, "D", 2, "other"), (3, "stale", 0, "other"), (5, "e", 1, "new"), (5, "E", 3, "new")])
    expected = {(1, "A", "other"), (2, "B", "new"), (3, "c", "other"), (4, "D", "other"), (5, "E", "new")}
    assert {(r.id, r.v, r.part) for r in files.read_table(spark, path).collect()} == expected
    merge([(1, "A", 2, "other")])  # running an update again changes nothing
    assert {(r.id, r.v, r.part) for r in files.read_table(spark, path).collect()} == expected


def test_merge_adds_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    incremental.incremental_merge(spark, path, spark.createDataFrame([(1, 1, "p")], "id int, version int, part string"), ["id"], ["version"], ["part"])
    incremental.incremental_merge(spark, path, spark.createDataFrame([(2, 1, "p", "n")], "id int, version int, part string, extra string"), ["id"], ["version"], ["part"])
    assert {(r.id, r.extra) for r in files.read_table(spark, path).collect()} == {(1, None), (2, "n")}


def test_rerun_of_a_day_is_idempotent(spark, tmp_path):
    path, day = str(tmp_path / "t"), spark.createDataFrame([quote("g", 1, 1), quote("g", 30, 1)], DDL)
    files.replace_partitions(day, path)
    files.replace_partitions(day.filter("partition_day = 1"), path)
    assert files.read_table(spark, path).count() == 2
    files.append_partitioned(day.filter("partition_day = 1"), path)
    assert files.read_table(spark, path).count() == 3


def test_new_rows(spark):
    source = spark.createDataFrame([quote("g", 1, 1), quote("g", 5, 1)], DDL)
    assert filters.new_rows(source, source.filter("false")).count() == 2
    assert filters.new_rows(source, source.filter(F.col("ingestion_timestamp") == T[1])).count() == 1


def test_gate(spark, tmp_path):
    rules = {"no price": F.col("home_price").isNotNull(), "small": F.col("home_price") > 10}
    rows = spark.createDataFrame([quote("a", 1, 100), quote("b", 1, 5), quote("c", 1, None)], DDL)
    path, bad = str(tmp_path / "curated"), str(tmp_path / "bad")
    for _ in range(2):
        counts = batch.gated_merge(spark, rows, rules, path, ["game_id"], ["ingestion_timestamp"], quarantine=bad)
        assert counts == {"Valid": 1, "small": 1, "no price": 1}
    assert files.read_table(spark, path).count() == 1 and spark.read.parquet(bad).count() == 2  # a repeated run adds no row twice
    assert batch.gate_counts(rows, rules).first().asDict() == {"all_rows": 3, "valid_rows": 1, "no price": 1, "small": 1}
    with pytest.raises(ValueError):
        batch.gated_merge(spark, rows.filter("game_id <> 'a'"), rules, path, ["game_id"], ["ingestion_timestamp"])
    assert batch.gated_merge(spark, rows.filter("false"), rules, path, ["game_id"], ["ingestion_timestamp"]) == {}


def test_reports_build_from_staged_games(spark):
    from catalog.feeds import _staged
    from matchgrid.operators import leaders

    staged = {"NBA": _staged(spark, "/root/testdata/sf0.001", "NBA"), "NHL": _staged(spark, "/root/testdata/sf0.001", "NHL")}
    reports = batch.game_reports(staged)
    assert {"games_fact", "nba_team_trends", "nhl_leader_trends", "dim_dates"} <= set(reports)
    assert reports["games_fact"].count() == sum(df.filter("status_detail not in ('Postponed', 'Canceled')").count() for df in staged.values())
    players = reports["nhl_leader_trends"]
    assert players.count() == leaders.leader_stats(staged["NHL"], leaders.NHL_LEADERS).count()


def test_file_metadata(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "d"))
    (tmp_path / "d" / "notes.txt").write_text("not a table")
    row = files.read_with_file_metadata(spark, str(tmp_path / "d")).first()
    assert row.file_name.endswith(".parquet") and row.last_modified.year >= 2024


def test_shared_folder_comes_from_the_session(spark):
    assert files.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_align_columns(spark):
    target = spark.createDataFrame([], "Id int, Name string, Note string").schema
    row = files.align_columns(spark.createDataFrame([("n", 7, 1.5)], "NAME string, id bigint, other double"), target).first()
    assert row.asDict() == {"Id": 7, "Name": "n", "Note": None}


def test_violations_count_unknown_as_failure(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    assert quality.violations(df, F.col("v") > 0).count() == 1


def test_merge_reads_only_touched_partitions(spark, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "t"), "id int, version int, part string"
    merge = lambda updates: incremental.incremental_merge(spark, path, spark.createDataFrame(updates, ddl), ["id"], ["version"], ["part"])
    merge([(1, 1, "a b"), (2, 1, "10:00%"), (3, 1, None), (4, 1, "other"), (5, 1, "é")])
    opened, read = [], incremental.read_folders

    def noted(*args):
        out = read(*args)
        opened.extend(out.inputFiles())
        return out

    monkeypatch.setattr(incremental, "read_folders", noted)
    merge([(1, 2, "10:00%"), (6, 1, None), (5, 2, "é")])
    assert len({f.rsplit("/", 1)[0] for f in opened}) == 4 and not any("other" in f for f in opened)
    rows = {tuple(r) for r in spark.read.parquet(path).select("id", "version", "part").collect()}
    assert rows == {(1, 2, "10:00%"), (2, 1, "10:00%"), (3, 1, None), (4, 1, "other"), (5, 2, "é"), (6, 1, None)}


def test_merge_recovers_from_a_failed_first_load(spark, tmp_path):
    (tmp_path / "t" / "_temporary" / "0").mkdir(parents=True)
    (tmp_path / "t" / ".spark-staging-1").mkdir()
    path = str(tmp_path / "t")
    incremental.incremental_merge(spark, path, spark.createDataFrame([(1, 1, "p")], "id int, version int, part string"), ["id"], ["version"], ["part"])
    assert spark.read.parquet(path).count() == 1


def test_refresh_reads_the_touched_rows_once(spark, tmp_path):
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)
    ddl = "id int, at int, part string"

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(i % 3, i, "p") for i in range(30)], ddl).coalesce(1)
    source = rows.mapInArrow(noted, ddl)
    form = lambda df: running(df, [Frame(["id"], ["at"], {"n": Running("count")})])
    files.replace_partitions(form(rows.filter("at < 20")), path, ["part"])
    incremental.refresh_by_key(spark, path, source, rows.filter("at >= 20"), ["id"], form, ["id", "at"], ["at"], ["part"], unique=True)
    assert seen.value == 30
    assert sorted((r.id, r.at, r.n) for r in files.read_table(spark, path).collect()) == sorted((i % 3, i, i // 3 + 1) for i in range(30))


def test_merge_takes_the_newest_of_several_updates(spark, tmp_path):
    """The older update goes to a partition of its own, which the key does not get."""
    path, ddl = str(tmp_path / "t"), "id int, version int, part string"
    files.replace_partitions(spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 1, "c")], ddl), path, ["part"])
    updates = spark.createDataFrame([(1, 2, "c"), (1, 3, "d"), (2, 0, "c"), (4, 1, "e"), (4, 0, "f")], ddl)
    incremental.incremental_merge(spark, path, updates, ["id"], ["version"], ["part"])
    assert sorted(map(tuple, files.read_table(spark, path).select("id", "version", "part").collect())) == [(1, 3, "d"), (2, 1, "b"), (3, 1, "c"), (4, 1, "e")]
    assert {p.name for p in (tmp_path / "t").glob("part=*")} == {"part=b", "part=c", "part=d", "part=e"}


def test_refresh_of_unique_rows_replaces_those_of_touched_keys(spark, tmp_path):
    """Rows move to other partitions, and a partition that they leave empty goes."""
    path, ddl = str(tmp_path / "t"), "id int, at int, part string"
    files.replace_partitions(spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "b"), (None, 1, "c")], ddl), path, ["part"])
    source = spark.createDataFrame([(1, 1, "d"), (1, 2, "d"), (1, 3, "e"), (2, 1, "b"), (None, 1, "c"), (None, 2, "c")], ddl)
    updates = source.filter("at = 3 or id is null and at = 2")
    incremental.refresh_by_key(spark, path, source, updates, ["id"], lambda df: df, ["id", "at"], ["at"], ["part"], unique=True)
    assert sorted(map(str, files.read_table(spark, path).select("id", "at", "part").collect())) == sorted(map(str, source.collect()))
    assert {p.name for p in (tmp_path / "t").glob("part=*")} == {"part=b", "part=c", "part=d", "part=e"}


def test_curated_load_parses_its_documents_once(spark, monkeypatch):
    from catalog import quality as gates, tables_io

    sf, seen, parsed = "/root/testdata/sf0.001", spark.sparkContext.accumulator(0), gates._curated

    def noted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = parsed(spark, sf)
    monkeypatch.setattr(gates, "_curated", lambda *_: rows.mapInArrow(noted, rows.schema))
    tables_io._curated_load(spark, sf).count()
    assert seen.value == rows.count() > 0
