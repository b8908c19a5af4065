"""The driver tables projected to the shapes the operators expect: odds quotes, games, leaders, live messages.

Every projection reads all rows of its table.  ``*_SQL`` states the same projection for the SQL side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchgrid.sources.files import shared_folder

SPORT_CODE = {"NBA": 0, "NFL": 1, "NHL": 2, "CFB": 3}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # windows and date functions are defined in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Rows of a driver table for one task.  What is derived of a row may be fifty times as wide, and aggregates of texts and structs sort it.
TASK_ROWS = 250_000


def tasks(df: DataFrame) -> int:
    """How many tasks the rows of ``df`` take; a table is counted by its footers."""
    return max(1, -(-df.count() // TASK_ROWS))


def spread(df: DataFrame, least: int | None = None) -> DataFrame:
    """A table read as fewer splits than there are cores (or ``least``) or as splits of very many rows, dealt anew before costly per-row work.

    A split is cut by bytes, of which narrow columns take few, so the memory of a task is bounded by rows.  Only the columns that
    are used later are dealt.  Tables with enough splits are left where they are.
    """
    n = max(least or df.sparkSession.sparkContext.defaultParallelism, tasks(df))
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame) -> DataFrame:
    """Rows as they would be read from a topic or a table of their own.

    The offset keeps the optimizer from folding later filters into the expressions that derive the columns.
    """
    return df.selectExpr("*", "monotonically_increasing_id() as offset").filter("offset >= 0").drop("offset")


def present(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result columns in types both engines print alike: rounded doubles, zone-free times, text lists."""
    out = []
    for f in df.schema:
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            c = F.round(c.cast("double"), digits)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        elif kind == "date":
            c = c.cast("string")
        elif kind == "array":
            c = F.concat_ws(",", F.transform(c, lambda x: x.cast("string")))
        out.append(c.alias(f.name))
    return df.select(*out)


# -- odds ------------------------------------------------------------------------------------------------------


def odds(spark: SparkSession, sf: str, every: str = "") -> DataFrame:
    """Quotes from events: game = user, bookmaker = event type, prices from value and props.

    ``every`` truncates the update time, so several quotes share a key.
    """
    ts = "cast(ts as timestamp)"
    update = f"date_trunc('{every}', {ts})" if every else ts
    rows = table(spark, sf, "events").selectExpr(
        "event_id", "event_type", "user_id", "value", f"{ts} as ts", f"{update} as bookmaker_last_update",
        "cast(floor(value) as bigint) as v", "cast(get_json_object(props, '$.k') as bigint) as k",
    )
    return rows.selectExpr(
        "event_id",
        "concat('g', user_id) as game_id",
        "element_at(array('NBA', 'NFL', 'NHL', 'CFB'), cast(user_id % 4 as int) + 1) as sport_type",
        "concat('T', user_id % 30) as home_team",
        "concat('T', (user_id * 7 + 1) % 30) as away_team",
        "event_type as bookmaker_key",
        "upper(event_type) as bookmaker_title",
        "bookmaker_last_update",
        "'h2h' as market_key",
        "case when event_id % 2 = 0 then -(105 + v) else 100 + v end as home_price",
        "case when event_id % 2 = 0 then 100 + k else -(110 + k) end as away_price",
        "value * 10 as volume",
        "value * 8 as matched",
        "ts + interval 5 minutes as ingestion_timestamp",
        "year(ts) as partition_year",
        "month(ts) as partition_month",
        "day(ts) as partition_day",
    )


def odds_sql(every: str = "") -> str:
    update = f"date_trunc('{every}', ts)" if every else "ts"
    return f"""odds AS (
  SELECT event_id, 'g' || user_id AS game_id, ['NBA', 'NFL', 'NHL', 'CFB'][user_id % 4 + 1] AS sport_type,
    'T' || (user_id % 30) AS home_team, 'T' || ((user_id * 7 + 1) % 30) AS away_team, event_type AS bookmaker_key,
    upper(event_type) AS bookmaker_title, {update} AS bookmaker_last_update, 'h2h' AS market_key,
    CASE WHEN event_id % 2 = 0 THEN -(105 + floor(value)::BIGINT) ELSE 100 + floor(value)::BIGINT END AS home_price,
    CASE WHEN event_id % 2 = 0 THEN 100 + (props->>'$.k')::BIGINT ELSE -(110 + (props->>'$.k')::BIGINT) END AS away_price,
    value * 10 AS volume, value * 8 AS matched, ts + INTERVAL 5 MINUTE AS ingestion_timestamp,
    year(ts) AS partition_year, month(ts) AS partition_month, day(ts) AS partition_day
  FROM events)"""


# -- games -----------------------------------------------------------------------------------------------------

_UNIT = "case k % 4 when 0 then 36 when 2 then 4 else 15 end"
_REG = "case when k % 4 = 2 then 3 else 4 end"
_HOME = [f"(k * {6 + i} + c * {i + 2}) % unit" for i in range(1, 8)]
_AWAY = [f"(k * {9 + i} + c * {2 * i + 1} + {i}) % unit" for i in range(1, 8)]

_BASE = [
    ("k", "o_orderkey"),
    ("c", "o_custkey"),
    ("p", "cast(floor(o_totalprice) as bigint)"),
    ("st", "o_orderstatus"),
    ("unit", _UNIT.replace("k ", "o_orderkey ")),
    ("reg", _REG.replace("k ", "o_orderkey ")),
]
_SCORES = [(f"h{i}", e) for i, e in enumerate(_HOME, 1)] + [(f"a{i}", e) for i, e in enumerate(_AWAY, 1)]
_SCORES += [
    ("n", "case when k % 43 = 0 then 2 when k % 6 = 0 then reg + 1 + c % 3 else reg end"),
    ("hid", "c % 30 + 30 * (k % 4)"),
    ("aid", "(c * 7 + 11) % 30 + 30 * (k % 4)"),
]


def _total(side: str) -> str:
    return " + ".join(f"case when n >= {i} then {side}{i} else 0 end" for i in range(1, 8))


# columns whose text is the same for both engines
_SHARED = [
    ("game_id", "'m' || k"),
    ("sport_type", "case k % 4 when 0 then 'NBA' when 1 then 'NFL' when 2 then 'NHL' else 'CFB' end"),
    ("status_state", "case when st = 'P' then case when k % 2 = 0 then 'in' else 'pre' end else 'post' end"),
    (
        "status_detail",
        "case when k % 31 = 0 then 'Postponed' when k % 37 = 0 then 'Canceled' when k % 97 = 0 then null else 'Final' end",
    ),
    ("status_description", "'game ' || st"),
    ("period", "case when k % 41 = 0 then reg when k % 101 = 0 then n + 1 else n end"),
    ("clock", "'0:' || (k % 60)"),
    ("home_id", "'T' || hid"),
    ("home_name", "'Team ' || hid"),
    ("home_abbreviation", "'A' || hid"),
    ("home_score", _total("h")),
    (
        "home_record",
        "case when k % 53 = 0 then '-' when k % 59 = 0 then null when k % 5 = 0 "
        "then (k % 50) || '-' || (c % 30) || '-' || (k % 4) else (k % 50) || '-' || (c % 30) end",
    ),
    ("away_id", "'T' || aid"),
    ("away_name", "'Team ' || aid"),
    ("away_abbreviation", "'A' || aid"),
    ("away_score", _total("a")),
    ("away_record", "case when k % 61 = 0 then '-' else (p % 45) || '-' || (k % 25) end"),
    ("home_rebounds", "case when k % 211 = 0 then 0 else 30 + k % 25 end"),
    ("away_rebounds", "28 + c % 27"),
    ("home_assists", "10 + (k + c) % 25"),
    ("away_assists", "8 + (k * 3) % 23"),
    ("home_fg_pct", "35 + (p % 250) / 8e0"),
    ("away_fg_pct", "33 + ((p + k) % 250) / 8e0"),
    ("home_3p_pct", "20 + ((p + k) % 300) / 8e0"),
    ("away_3p_pct", "18 + ((p + c) % 300) / 8e0"),
    ("home_ft_pct", "60 + ((p + c) % 300) / 8e0"),
    ("away_ft_pct", "58 + (p % 300) / 8e0"),
    ("home_goals", _total("h")),
    ("away_goals", _total("a")),
    ("home_saves", "20 + p % 25"),
    ("away_saves", "18 + (p + k) % 25"),
    ("home_points", "(k + p) % 20"),
    ("away_points", "(c + p) % 20"),
    ("venue_name", "'Arena ' || hid"),
    ("venue_city", "'City ' || (hid % 25)"),
    ("venue_state", "'S' || (hid % 10)"),
    ("is_indoor", "hid % 2 = 0"),
]
_KEPT = ["k", "c", "p"]


def _select(pairs: list[tuple[str, str]], cast: str = "{}") -> str:
    return ", ".join(f"{cast.format(e)} AS {n}" for n, e in pairs)


_HOUR = ("o_orderdate", "(o_orderkey % 24)", "(o_custkey % 60)")


def games(spark: SparkSession, sf: str, sport: str | None = None, costly: bool = False, scored_first: bool = False) -> DataFrame:
    """Games from orders: scores and statistics derived from order key, customer and price.

    ``costly`` announces expensive work per row (building and parsing documents).  With ``scored_first`` all rows are dealt for that
    work when their numbers are known, not as they are read: scores and texts together are one generated method of more than
    8000 bytes, which the JVM does not compile.
    """
    orders = table(spark, sf, "orders")
    if scored_first:
        dealt = max(spark.sparkContext.defaultParallelism, tasks(orders))
    elif costly:
        orders = spread(orders)
    if sport:
        orders = orders.filter(F.col("o_orderkey") % 4 == SPORT_CODE[sport])
    start = "cast(o_orderdate as timestamp) + make_dt_interval(0, cast(o_orderkey % 24 as int), cast(o_custkey % 60 as int))"
    base = orders.selectExpr(*[f"{e} as {n}" for n, e in _BASE], f"{start} as start_time")
    scored = base.selectExpr("k", "c", "p", "st", "reg", "start_time", *[f"{e} as {n}" for n, e in _with_unit(_SCORES)])
    total = {_total("h"): "h_total", _total("a"): "a_total"}
    scored = scored.selectExpr("*", *[f"{e} as {n}" for e, n in total.items()])
    if scored_first:
        scored = scored.repartition(dealt)
    lines = [
        f"case when k % 41 = 0 then null else slice(array({', '.join(f'cast({s}{i} as int)' for i in range(1, 8))}), 1, cast(n as int)) end as {name}_linescores"
        for s, name in (("h", "home"), ("a", "away"))
    ]
    doubles = {"home_fg_pct", "away_fg_pct", "home_3p_pct", "away_3p_pct", "home_ft_pct", "away_ft_pct"}
    shared = [f"cast({e} as double) as {n}" if n in doubles else f"{total.get(e, e)} as {n}" for n, e in _SHARED]
    return scored.selectExpr(
        *_KEPT, *shared, *lines, "start_time", "home_saves_ / 64e0 as home_save_pct", "away_saves_ / 64e0 as away_save_pct",
        "array('TV' || (k % 5)) as broadcasts",
        "year(start_time) as partition_year", "month(start_time) as partition_month", "day(start_time) as partition_day",
        "start_time + interval 3 hours as ingestion_timestamp",
    )


def _with_unit(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [*pairs, ("home_saves_", "cast(20 + p % 25 as double)"), ("away_saves_", "cast(18 + (p + k) % 25 as double)")]


def games_sql(sport: str | None = None) -> str:
    where = f" WHERE o_orderkey % 4 = {SPORT_CODE[sport]}" if sport else ""
    lists = [
        f"CASE WHEN k % 41 = 0 THEN NULL ELSE [{', '.join(f'{s}{i}' for i in range(1, 8))}][1:n] END AS {name}_linescores"
        for s, name in (("h", "home"), ("a", "away"))
    ]
    return f"""g0 AS (SELECT {_select(_BASE)},
    o_orderdate + to_hours(o_orderkey % 24) + to_minutes(o_custkey % 60) AS start_time FROM orders{where}),
  g1 AS (SELECT k, c, p, st, reg, start_time, {_select(_with_unit(_SCORES))} FROM g0),
  games AS (SELECT {', '.join(_KEPT)}, {_select(_SHARED)}, {', '.join(lists)}, start_time,
    home_saves_ / 64e0 AS home_save_pct, away_saves_ / 64e0 AS away_save_pct, ['TV' || (k % 5)] AS broadcasts,
    year(start_time) AS partition_year, month(start_time) AS partition_month, day(start_time) AS partition_day,
    start_time + INTERVAL 3 HOUR AS ingestion_timestamp FROM g1)"""


# leader value per category, the same text for both engines
LEADER_VALUES = {
    "NBA": {"points": "5 + k % 45", "rebounds": "(k + {o}) % 20", "assists": "(k + 2 * {o}) % 14", "rating": "(p + {o}) % 60"},
    "NHL": {"goals": "(k + {o}) % 5", "assists": "(c + {o}) % 4", "points": "(p + {o}) % 6"},
    "NFL": {"passing": "(k * 7) % 450", "rushing": "(k * 5) % 180", "receiving": "(p * 3) % 170"},
}
LEADER_VALUES["CFB"] = LEADER_VALUES["NFL"]


def _leader(sport: str, kind: str, side: int) -> dict[str, str]:
    value = LEADER_VALUES[sport][kind].format(o=side + 1)
    team = ("hid", "aid")[side].replace("hid", "home_id").replace("aid", "away_id")
    return {
        "name": f"case when k % 89 = 0 then null else 'P' || ((c + {side + len(kind)}) % 400) end",
        "value": f"cast({value} as int)",
        "display_value": f"({value}) || ' {kind}'",
        "team": team,
    }


def games_with_leaders(spark: SparkSession, sf: str, sport: str, costly: bool = False) -> DataFrame:
    """Games of one sport with their leader structs, as staged."""

    def struct(kinds: list[str], side: int) -> str:
        parts = []
        for kind in kinds:
            fields = ", ".join(f"'{n}', {e}" for n, e in _leader(sport, kind, side).items())
            parts.append(f"'{kind}', named_struct({fields})")
        return f"named_struct({', '.join(parts)})"

    kinds = list(LEADER_VALUES[sport])
    g = games(spark, sf, sport, costly)
    if sport in ("NFL", "CFB"):
        return g.selectExpr("*", f"{struct(kinds, 0)} as leaders")
    return g.selectExpr("*", f"{struct(kinds, 0)} as home_leaders", f"{struct(kinds, 1)} as away_leaders")


def leaders_sql(sport: str, name: str = "leaders") -> str:
    """Leader rows written out as one branch per side and category."""
    branches = []
    sides = ((0, "NULL"),) if sport in ("NFL", "CFB") else ((0, "'HOME'"), (1, "'AWAY'"))
    for side, label in sides:
        for kind in LEADER_VALUES[sport]:
            f = _leader(sport, kind, side)
            branches.append(
                f"SELECT game_id, sport_type, start_time, {label} AS team_type, '{kind.upper()}' AS leader_type, {f['name']} AS player_name, "
                f"{f['value']} AS stat_value, {f['display_value']} AS display_value, {f['team']} AS team_id, "
                "partition_year, partition_month, partition_day, ingestion_timestamp FROM games"
            )
    return f"{name} AS (" + " UNION ALL ".join(branches) + ")"


# -- leaders from line items -----------------------------------------------------------------------------------

_KINDS = {
    "NBA": ("POINTS", "REBOUNDS", "ASSISTS"),
    "NHL": ("GOALS", "ASSISTS", "POINTS"),
    "FOOTBALL": ("PASSING", "RUSHING", "RECEIVING"),
}
_VALUE = {"NBA": "cast(l_quantity as int)", "NHL": "cast(l_quantity as int) % 7", "FOOTBALL": "cast(l_quantity as int) * 9"}


def _leader_columns(family: str) -> list[tuple[str, str]]:
    a, n, r = _KINDS[family]
    sport = "case when l_suppkey % 2 = 0 then 'NFL' else 'CFB' end" if family == "FOOTBALL" else f"'{family}'"
    return [
        ("game_id", "l_orderkey"),
        ("sport_type", sport),
        ("player_name", "'P' || l_suppkey"),
        ("team_id", "'T' || (l_suppkey % 30)"),
        ("leader_type", f"case l_returnflag when 'A' then '{a}' when 'N' then '{n}' else '{r}' end"),
        ("stat_value", _VALUE[family]),
        ("line", "l_linenumber"),
        ("part", "l_partkey"),
    ]


LEADER_ORDER = ("start_time", "game_id", "line", "part")


def leaders(spark: SparkSession, sf: str, family: str) -> DataFrame:
    """Leader rows from line items: player = supplier, category = return flag, value = quantity."""
    start = "cast(l_shipdate as timestamp)"
    return table(spark, sf, "lineitem").selectExpr(
        *[f"{e} as {n}" for n, e in _leader_columns(family)], f"{start} as start_time", "year(l_shipdate) as partition_year"
    )


def lineitem_leaders_sql(family: str) -> str:
    cols = _select(_leader_columns(family))
    return f"leaders AS (SELECT {cols}, l_shipdate AS start_time, year(l_shipdate) AS partition_year FROM lineitem)"
