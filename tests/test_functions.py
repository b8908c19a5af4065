import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from matchgrid import functions as fn


def test_wind_sectors(values):
    degrees = [0, 45, 90, 135, 180, 225, 270, 315, 360, -45, 405, -360, 22.5, 67.5, 337.5, 11.25, 348.75, None]
    expected = "N NE E SE S SW W NW N NW NE N NE NE NW NE N None".split()
    assert values([(None if d is None else float(d),) for d in degrees], "d double", fn.wind_direction(F.col("d"))) == expected


def test_weather_condition(values):
    rows = [(1.0, 1.0, 90.0), (0.0, 1.0, 90.0), (0.0, 0.0, 90.0), (None, None, 50.0), (0.0, 0.0, 10.0), (None, None, None)]
    cols = (F.col("snow"), F.col("rain"), F.col("clouds"))
    assert values(rows, "snow double, rain double, clouds double", fn.weather_condition(*cols)) == [
        "Snow", "Rain", "Cloudy", "Partly Cloudy", "Clear", "Clear",
    ]


def test_severity_uses_kilometres(values):
    rows = [(4.0, 25.0, 90.0), (10.0, 5.0, 10.0), (None, None, None)]
    got = values(rows, "v double, w double, c double", fn.severity_points(F.col("v"), F.col("w"), F.col("c")))
    assert got == [5, 0, 0]


def test_american_and_decimal_probability(values):
    rows = [(150.0,), (-110.0,), (0.0,), (None,), (10001.0,)]
    got = values(rows, "p double", fn.implied_probability(F.col("p"), "american"))
    assert got[0] == pytest.approx(0.4) and got[1] == pytest.approx(110 / 210) and got[2] is None and got[3] is None
    assert 0 < got[4] < 0.01
    dec = values([(2.0,), (0.0,), (None,)], "p double", fn.implied_probability(F.col("p"), "decimal"))
    assert dec == [0.5, None, None]
    with pytest.raises(ValueError):
        fn.implied_probability(F.lit(1), "fractional")


def test_odds_value_falls_back(values):
    rows = [(1.95, None), (None, -110.0), (None, None)]
    assert values(rows, "price double, odds double", fn.odds_value(F.col("price"), F.col("odds"))) == [1.95, -110.0, 0.0]


def test_overtime_scores(values):
    rows = [([],), ([1, 2, 3],), ([1, 2, 3, 4],), ([1, 2, 3, 4, 5],), ([1, 2, 3, 4, 5, 6, 7],), (None,)]
    got = values(rows, "s array<int>", fn.overtime_scores(F.col("s"), 4))
    assert got == [None, None, None, [5], [5, 6, 7], None]
    assert values(rows, "s array<int>", fn.overtime_count(F.col("s"), 4)) == [0, 0, 0, 1, 3, 0]
    assert values(rows, "s array<int>", fn.period_score(F.col("s"), 4)) == [None, None, 4, 4, 4, None]


def test_records(values):
    rows = [("-",), ("10-0",), ("41-9-3",), (None,)]
    assert values(rows, "r string", fn.record_wins(F.col("r"))) == [None, 10, 41, None]
    assert values(rows, "r string", fn.record_losses(F.col("r"))) == [None, 0, 9, None]


def test_unbeaten_team_can_be_favourite(values):
    rows = [("10-0", "9-1"), ("1-9", "5-5"), ("5-5", "1-1"), ("-", "1-1"), ("0-0", "3-1")]
    got = values(rows, "h string, a string", fn.record_favorite(F.col("h"), F.col("a")))
    assert got == ["HOME_FAVORED", "AWAY_FAVORED", "", "", ""]


def test_linescore_cast(values):
    rows = [([1.0, 2.9],), (None,), ([],)]
    assert values(rows, "s array<double>", fn.int_scores(F.col("s"))) == [[1, 2], [], []]


def test_season_types_wrap_over_new_year(values):
    days = [(dt.date(2024, m, 15),) for m in (2, 4, 8, 10)]
    assert values(days, "d date", fn.nba_season_type(F.col("d"))) == ["Regular Season", "Regular Season", "Off Season", "Regular Season"]
    assert values([(dt.date(2024, 5, 1),)], "d date", fn.nhl_season_type(F.col("d"))) == ["Stanley Cup Playoffs"]
    assert values(days, "d date", fn.nfl_season_type(F.col("d"))) == ["Super Bowl", "Off Season", "Off Season", "Regular Season"]
    assert values(days, "d date", fn.cfb_season_type(F.col("d"))) == ["Off Season", "Off Season", "Regular Season", "Regular Season"]


def test_season_weeks(values):
    # 2024-09-01 is a Sunday, so its Monday week starts on 2024-08-26
    days = [(dt.date(2024, 9, 1),), (dt.date(2024, 9, 2),), (dt.date(2025, 1, 5),), (dt.date(2024, 6, 1),)]
    assert values(days, "d date", fn.nfl_week(F.col("d"))) == [1, 2, 19, None]


def test_day_of_week(values):
    days = [(dt.date(2024, 12, 8),), (dt.date(2024, 12, 9),)]
    assert values(days, "d date", fn.day_of_week(F.col("d"))) == [0, 1]


def test_odds_window_minutes(values):
    now = dt.datetime(2024, 1, 1, 12)
    rows = [(now + dt.timedelta(hours=h), s) for h, s in ((5, "pre"), (4, "pre"), (3.5, "pre"), (2, "pre"), (1, "pre"), (0.5, "pre"), (9, "in"))]
    got = values(rows, "t timestamp, s string", fn.odds_window_minutes(F.col("t"), F.lit(now), F.col("s")))
    assert got == [35, 35, 30, 25, 20, 15, 15]


def test_news_dates(values):
    default = F.lit("2030-01-01").cast("timestamp")
    rows = [
        ("Wed, 14 Mar 2024 15:30:00 +0000",), ("2024-03-14T15:30:00+02:00",), ("2024-03-14 15:30:00",), ("2024-03-14T15:30:00Z",), ("garbage",), (None,),
        ("2024-03-14T15:30:00.250Z",),
    ]
    utc = values(rows, "t string", F.date_format(fn.news_date(F.col("t"), default), "yyyy-MM-dd HH:mm:ss"))
    assert utc == [
        "2024-03-14 15:30:00", "2024-03-14 13:30:00", "2024-03-14 15:30:00", "2024-03-14 15:30:00", "2030-01-01 00:00:00", "2030-01-01 00:00:00",
        "2024-03-14 15:30:00",
    ]


def test_game_start_accepts_minutes_and_seconds(values):
    rows = [("2024-12-09T00:30Z",), ("2024-12-09T00:30:15Z",), ("2024-13-09T00:30Z",), ("soon",), (None,)]
    got = values(rows, "t string", F.date_format(fn.game_start(F.col("t")), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-12-09 00:30:00", "2024-12-09 00:30:15", None, None, None]


def test_ids(values):
    url = "http://a.b/c"
    digest = hashlib.md5(url.encode()).hexdigest()
    assert values([(url,)], "u string", fn.news_id(F.col("u"))) == [f"news_{digest}"]
    rows = [("Hawks", None)]
    assert values(rows, "a string, b string", fn.surrogate_key(F.col("a"), F.col("b"))) == [hashlib.md5(b"Hawks").hexdigest()]
    when = [("g", "b", m, dt.datetime(2024, 1, 1)) for m in ("m1", "m2", "m1")]
    a, b, c = values(when, "g string, b string, m string, t timestamp", fn.odds_id(F.col("g"), F.col("b"), F.col("m"), F.col("t")))
    assert a != b and a == c
