import pytest
from pyspark.sql import functions as F

from matchgrid.operators import quality


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(1, "a", 5.0), (2, None, 50.0), (2, "zz", None), (None, "b", -1.0)], "id int, s string, v double")


def ids(df, col="id"):
    return sorted((r[col] for r in df.collect()), key=repr)


def test_column_checks(rows):
    assert {(r.id, r.missing) for r in quality.not_null(rows, ["id", "s"]).collect()} == {(2, "s"), (None, "id")}
    assert [(r.id, r.occurrences) for r in quality.unique(rows, ["id"]).collect()] == [(2, 2)]
    assert ids(quality.accepted_values(rows, "s", ["a", "b"]), "s") == ["zz"]
    assert quality.accepted_values(rows, "s", ["a", "b"], F.col("v") > 0).count() == 0
    assert ids(quality.between(rows, "v", 0, 10), "v") == [-1.0, 50.0]
    assert ids(quality.between(rows, "v", high=10), "v") == [50.0]
    assert ids(quality.matches(rows, "s", "^[a-z]$"), "s") == ["zz"]
    assert ids(quality.length_between(rows, "s", 2, 3), "s") == ["a", "b"]


def test_relationships(spark, rows):
    parents = spark.createDataFrame([(1,), (1,), (7,)], "id int")
    assert ids(quality.relationships(rows, parents, "id")) == [2, 2]


def test_severity(rows):
    rules = {"id": F.col("id").isNotNull(), "v": F.col("v") < 100, "s": F.col("s").isNotNull() & (F.col("s") == "a")}
    got = {r.rule: (r.failures, r.severity) for r in quality.evaluate(rows, rules, warn_if=1, error_if=3).collect()}
    assert got == {"id": (1, "warn"), "v": (1, "warn"), "s": (3, "error")}


def test_split_keeps_every_row(rows):
    valid, bad = quality.split_valid(rows, {"no id": F.col("id").isNotNull(), "no value": F.col("v").isNotNull()})
    assert valid.count() + bad.count() == rows.count()
    assert {r.validation_status for r in bad.collect()} == {"no id", "no value"}


def test_split_with_store_derives_and_judges_each_row_once(spark, rows, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def look(v):
        seen.add(1)
        return v

    looked = rows.withColumn("v", F.udf(look, "double")("v"))
    valid, bad = quality.split_valid(looked, {"no id": F.col("id").isNotNull(), "no value": F.col("v").isNotNull()}, f"{tmp_path}/judged")
    assert ids(valid) == [1, 2] and {(r.id, r.validation_status) for r in bad.collect()} == {(2, "no value"), (None, "no id")}
    assert valid.columns == rows.columns and seen.value == rows.count()


def test_reconcile_reports_missing_days(spark):
    raw = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01"), ("c", "2024-01-02")], "k string, d string")
    done = raw.filter("k = 'a'")
    got = {(str(r.game_date), r.raw_count, r.processed_count) for r in quality.reconcile(raw, done, "k", "d").collect()}
    assert got == {("2024-01-01", 2, 1), ("2024-01-02", 1, 0)}


def test_record_format_and_limits(spark):
    df = spark.createDataFrame([("10-0", 10, 0), ("41-9-3", 41, 9), ("-", None, None), (None, None, None), ("80-10", 80, 10)], "r string, w int, l int")
    assert ids(quality.record_format(df, "r"), "r") == ["-"]
    assert ids(quality.season_record_limit(df, "w", "l", 82), "r") == ["80-10"]


def test_price_range_boundary(spark):
    df = spark.createDataFrame([(100001, 5), (100002, 5), (5, -100002), (None, 5)], "home_price int, away_price int")
    assert quality.odds_price_range(df).count() == 2


def test_market_metrics(spark):
    ddl = "avg_vig double, min_vig double, max_vig double, favorite_changes int, price_updates int, avg_probability_spread double, max_probability_spread double"
    good, bad, hole = (4.0, 3.0, 5.0, 1, 2, 10.0, 20.0), (6.0, 3.0, 5.0, 1, 2, 10.0, 20.0), (4.0, 3.0, 5.0, 1, None, 10.0, 20.0)
    assert quality.market_metrics(spark.createDataFrame([good, bad, hole], ddl)).count() == 2


def test_periods(spark):
    ddl = "game_id string, total_periods int, " + ", ".join(f"{s}_q{i}_score int" for s in ("home", "away") for i in range(1, 5)) + ", home_ot_scores array<int>, away_ot_scores array<int>"
    rows = [("ok", 5, *[1] * 8, [1], [1]), ("short", 4, *[1] * 3, None, *[1] * 4, None, None), ("late", 4, *[1] * 8, [2], [2])]
    assert ids(quality.periods_match_linescores(spark.createDataFrame(rows, ddl)), "game_id") == ["late", "short"]


def test_leader_reasons_come_in_order(spark):
    ddl = "leader_type string, stat_value int, avg_stat_value double, season_high int, exceptional_performance int"
    rows = [
        ("POINTS", 101, 200.0, 50, 7), ("RATING", 121, None, None, None), ("POINTS", 100, 51.0, 50, 7), ("X", 1, 1.0, 1, 7), ("X", None, None, 1, 0), ("X", 1, None, None, 0),
        ("X", 1, 1.0, None, None), ("X", 1, 1.0, 1, None), ("ASSISTS", 30, 1.0, 1, 1),
    ]
    got = [r.failure_reason for r in quality.nba_leader_limits(spark.createDataFrame(rows, ddl).coalesce(1)).collect()]
    assert got == [
        "Points exceed maximum (100)", "Rating exceeds maximum (50)", "Average exceeds season high", "Invalid exceptional performance flag", "Null stat value",
        "Null average stat value", "Null season high", "Null exceptional performance",
    ]
    ddl = "leader_type string, stat_value int, performance_milestone string, total_hat_tricks int, games_as_leader int"
    rows = [("GOALS", 6, "Trick", None, 1), ("POINTS", 9, None, None, 1), ("POINTS", 8, "Trick", None, 1), ("GOALS", 1, None, None, 1), ("GOALS", 1, "Brace", 1, None), ("GOALS", 5, "Brace", 1, 1)]
    got = [r.failure_reason for r in quality.nhl_leader_limits(spark.createDataFrame(rows, ddl).coalesce(1)).collect()]
    assert got == ["Goals exceed maximum (5)", "Points exceed maximum (8)", "Invalid performance milestone", "Null performance milestone", "Null games as leader"]
