"""Histories: stored versions, change feeds between two states of a table, growth of the active users, news and weather of games."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.tables import odds, odds_sql, present, scratch, spread, table
from matchgrid.operators import history
from matchgrid.operators.asof import asof_join
from matchgrid.operators.mentions import mentions, news_before_games, words
from matchgrid.plans import versions
from matchgrid.sources import files

_BOOK, _BAND = ["game_id", "bookmaker_key"], ["band", "home_team"]


def _observations(spark, sf):
    return odds(spark, sf, "hour").selectExpr(
        "event_id", "game_id", "if(event_id % 29 = 0, null, bookmaker_key) as bookmaker_key", "bookmaker_last_update as at", "home_price div 60 as band", "home_team",
        "event_id % 31 = 0 as withdrawn",
    )


def _stored(spark, sf):
    """Quotes brought in by three increments, the middle of time last, the first one twice; one quote in 31 is withdrawn."""
    path, rows = scratch(spark, "versions"), _observations(spark, sf)
    increments = ["event_id % 3 = 2", "event_id % 3 = 0", "event_id % 3 = 2", "event_id % 3 = 1"]
    for some in increments:
        versions.apply_observations(spark, path, rows.filter(some), _BOOK, "at", _BAND, F.col("withdrawn"))
    return files.read_table(spark, path)


def _states(spark, sf):
    """Orders before and after a day's work: rows gone, changed, added, doubled and without a key; one status untouched."""
    old = table(spark, sf, "orders").selectExpr("if(o_orderkey % 101 = 0, null, o_orderkey) as o_orderkey", "o_totalprice", "o_orderstatus as status")
    busy = F.col("status") != "P"
    key = F.coalesce(F.col("o_orderkey"), F.lit(1))
    kept = old.filter(~busy | (key % 13 != 0))
    price = F.when(busy & (key % 7 == 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copies = F.when(busy & (key % 17 == 0), 3).otherwise(1)
    now = kept.withColumn("o_totalprice", price).withColumn("_n", F.explode(F.sequence(F.lit(1), copies))).drop("_n")
    added = old.filter(busy & (key % 11 == 0)).select((-F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", "status")
    return old, now.unionByName(added)


def _feed(spark, sf):
    old, new = _states(spark, sf)
    feed = history.change_feed(old, new, ["o_orderkey"], ["status"])
    images = [F.col(f"{image}.{c}").alias(f"{image}_{c}") for image in ("before", "after") for c in ("o_orderkey", "o_totalprice", "status")]
    return present(feed.select("change_type", *images, "copies"))


def _applied(spark, sf):
    """The feed brought into the old state; it gives the new one."""
    old, new = _states(spark, sf)
    return present(history.applied(old, history.change_feed(old, new, ["o_orderkey"], ["status"])))


def _growth(spark, sf):
    """Periods of six hours; a user is active in about a third of them."""
    events = table(spark, sf, "events")
    return present(history.growth_accounting(events, ["user_id"], F.expr("unix_seconds(cast(ts as timestamp)) div 21600")))


def _played(spark, sf):
    """Scores of 20 venues with the weather at that time: the newest report of the last six hours; one venue is half of all."""
    events = table(spark, sf, "events")
    venue = F.expr("if(event_id % 2 = 0, 20, user_id % 20)").alias("venue")
    at = F.col("ts").cast("timestamp")
    games = events.filter("event_id % 3 = 0").select("event_id", venue, at.alias("played"), F.expr("event_id % 120 + (event_id * 7) % 110").alias("points"))
    reports = events.filter("event_id % 15 = 7").select(venue, at.alias("reported"), F.expr("floor(value) / 8").alias("temperature"), F.expr("event_id % 37").alias("wind"))
    return asof_join(games, reports, ["venue"], "played", "reported", ["temperature", "wind"], F.expr("interval 6 hours"))


def _mentions(spark, sf):
    """The first words of every document are a name; every name is searched in every document."""
    texts = spread(table(spark, sf, "documents")).selectExpr(
        "doc_id", "text", "timestamp'2024-01-01' + make_dt_interval(0, doc_id * 37 % 720) as published", "case when doc_id % 5 <> 0 then doc_id % 16 / 16 end as mood"
    )
    # the first words are among the first pieces, so the rest of a text is not cut for them
    start = words(F.col("text"), pieces=4)
    names = texts.select(F.array_join(F.slice(start, 1, 2 + (F.col("doc_id") % 2).cast("int")), " ").alias("name")).distinct()
    listed = names.withColumn("team", F.length("name") % 20)
    return mentions(texts, listed, "text", "name", ["doc_id", "published", "mood"], scratch(spark, "names"))


def _news_and_points(spark, sf):
    """The points of a team's games with its news of the two days before."""
    folder = scratch(spark, "mentions")  # read several times below; the texts are searched once
    _mentions(spark, sf).groupBy("doc_id", "published", "mood", "team").agg(F.sum("mentions").alias("mentions")).write.parquet(folder)
    found = spark.read.parquet(folder)
    games = table(spark, sf, "events").selectExpr("event_id", "cast(user_id % 20 as int) as team", "cast(ts as timestamp) as played", "event_id % 120 as points")
    return news_before_games(games, found, "team", "played", "published", F.expr("interval 2 days"), "mood")


QUERIES = {
    "news_mentions": lambda s, sf: present(_mentions(s, sf).select("doc_id", "name", "mentions")),
    "news_before_games": lambda s, sf: present(_news_and_points(s, sf)),
    "news_points_correlation": lambda s, sf: present(history.correlation(_news_and_points(s, sf), "mentions", "points", ["team"]), 4),
    "stored_versions": lambda s, sf: present(versions.versions(_stored(s, sf), _BOOK, _BAND)),
    "versions_as_of": lambda s, sf: present(versions.as_of(_stored(s, sf), F.lit("2024-01-12 06:30:00").cast("timestamp"))),
    "change_feed": _feed,
    "change_feed_applied": _applied,
    "growth_accounting": _growth,
    "weather_at_game_time": lambda s, sf: present(_played(s, sf)),
    "weather_at_game_correlation": lambda s, sf: present(history.correlation(_played(s, sf), "temperature", "points", ["venue"]), 4),
}

_SEEN = f"""WITH {odds_sql('hour')}, o AS (SELECT game_id, CASE WHEN event_id % 29 <> 0 THEN bookmaker_key END AS bookmaker_key, bookmaker_last_update AS valid_from,
  home_price // 60 AS band, home_team, event_id % 31 = 0 AS deleted FROM odds),
s AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY game_id, bookmaker_key, valid_from ORDER BY deleted DESC, band DESC, home_team DESC) = 1),
c AS (SELECT *, lead(valid_from) OVER w AS next_at, coalesce((deleted, band, home_team) <> lag((deleted, band, home_team)) OVER w, true) AS changed FROM s
  WINDOW w AS (PARTITION BY game_id, bookmaker_key ORDER BY valid_from))"""
_STATES = """old AS (SELECT CASE WHEN o_orderkey % 101 <> 0 THEN o_orderkey END AS k, o_totalprice AS p, o_orderstatus AS s FROM orders),
o AS (SELECT *, coalesce(k, 1) AS c, s <> 'P' AS busy FROM old),
new AS (
  SELECT k, CASE WHEN busy AND c % 7 = 0 THEN p + 1 ELSE p END AS p, s FROM (SELECT *, unnest(range(CASE WHEN busy AND c % 17 = 0 THEN 3 ELSE 1 END)) FROM o WHERE NOT busy OR c % 13 <> 0)
  UNION ALL SELECT -k, p, s FROM o WHERE busy AND c % 11 = 0
)"""
_PLAYED = """WITH v AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 20 ELSE user_id % 20 END AS venue FROM events),
g AS (SELECT event_id, venue, ts AS played, event_id % 120 + (event_id * 7) % 110 AS points FROM v WHERE event_id % 3 = 0),
w AS (SELECT venue, ts AS reported, max(struct_pack(temperature := floor(value) / 8, wind := event_id % 37)) AS s FROM v WHERE event_id % 15 = 7 GROUP BY ALL),
j AS (SELECT event_id, g.venue, played, points, CASE WHEN reported >= played - INTERVAL 6 HOUR THEN reported END AS matched_at,
  CASE WHEN reported >= played - INTERVAL 6 HOUR THEN s END AS s FROM g ASOF LEFT JOIN w ON g.venue = w.venue AND g.played >= w.reported),
p AS (SELECT * EXCLUDE (s), s.temperature AS temperature, s.wind AS wind FROM j)"""
_MENTIONS = """WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT DISTINCT array_to_string(ws[1:2 + doc_id % 2], ' ') AS name FROM d WHERE len(ws) > 0),
r AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS name FROM d, (SELECT unnest([1, 2, 3]) AS k)),
m AS (SELECT doc_id, name, count(*) AS mentions FROM r JOIN n USING (name) GROUP BY ALL)"""
_BEFORE = f"""{_MENTIONS},
f AS (SELECT doc_id, length(name) % 20 AS team, TIMESTAMP '2024-01-01' + to_hours(doc_id * 37 % 720) AS published, CASE WHEN doc_id % 5 <> 0 THEN (doc_id % 16) / 16e0 END AS mood,
  sum(mentions) AS mentions FROM m GROUP BY ALL),
p AS (SELECT event_id, g.user_id % 20 AS team, g.ts AS played, event_id % 120 AS points, max(published) AS last_published, count(doc_id) AS articles,
  coalesce(sum(mentions), 0)::BIGINT AS mentions, round(avg(mood), 6) AS avg_sentiment
  FROM events g LEFT JOIN f ON f.team = g.user_id % 20 AND published <= g.ts AND published > g.ts - INTERVAL 2 DAY GROUP BY ALL)"""

ORACLE = {
    "news_mentions": f"{_MENTIONS} SELECT * FROM m",
    "news_before_games": f"{_BEFORE} SELECT * FROM p",
    "news_points_correlation": f"""{_BEFORE} SELECT team, count(*) AS pairs, CASE WHEN stddev_pop(mentions) * stddev_pop(points) > 0 THEN round(corr(mentions::DOUBLE, points::DOUBLE), 4) END AS correlation
FROM p GROUP BY 1""",
    "weather_at_game_time": f"{_PLAYED} SELECT * REPLACE (round(temperature, 6) AS temperature) FROM p",
    "weather_at_game_correlation": f"""{_PLAYED} SELECT venue, count(*) AS pairs, CASE WHEN stddev_pop(temperature) * stddev_pop(points) > 0 THEN round(corr(temperature, points::DOUBLE), 4) END AS correlation FROM p
WHERE temperature IS NOT NULL GROUP BY 1""",
    "stored_versions": f"""{_SEEN} SELECT game_id, bookmaker_key, band, home_team, valid_from, until AS valid_to, until IS NULL AS is_current
FROM (SELECT *, lead(valid_from) OVER (PARTITION BY game_id, bookmaker_key ORDER BY valid_from) AS until FROM c WHERE changed) WHERE NOT deleted""",
    "versions_as_of": f"""{_SEEN} SELECT game_id, bookmaker_key, band, home_team, valid_from, next_at AS valid_to FROM c
WHERE NOT deleted AND valid_from <= TIMESTAMP '2024-01-12 06:30:00' AND (next_at IS NULL OR next_at > TIMESTAMP '2024-01-12 06:30:00')""",
    "change_feed": f"""WITH {_STATES},
net AS (SELECT k, p, s, sum(n) AS n FROM (SELECT *, -1 AS n FROM old UNION ALL SELECT *, 1 FROM new) GROUP BY ALL HAVING sum(n) <> 0),
g AS (SELECT *, sum(greatest(n, 0)) OVER (PARTITION BY k) = 1 AND sum(greatest(-n, 0)) OVER (PARTITION BY k) = 1 AS pair FROM net)
SELECT 'UPDATE' AS change_type, a.k AS before_o_orderkey, round(a.p, 6) AS before_o_totalprice, a.s AS before_status, b.k AS after_o_orderkey,
  round(b.p, 6) AS after_o_totalprice, b.s AS after_status, 1 AS copies
FROM (SELECT * FROM g WHERE pair AND n < 0) a JOIN (SELECT * FROM g WHERE pair AND n > 0) b ON a.k IS NOT DISTINCT FROM b.k
UNION ALL SELECT 'DELETE', k, round(p, 6), s, NULL, NULL, NULL, -n FROM g WHERE NOT pair AND n < 0
UNION ALL SELECT 'INSERT', NULL, NULL, NULL, k, round(p, 6), s, n FROM g WHERE NOT pair AND n > 0""",
    "change_feed_applied": f"WITH {_STATES} SELECT k AS o_orderkey, round(p, 6) AS o_totalprice, s AS status FROM new",
    "growth_accounting": """WITH a AS (SELECT DISTINCT user_id, CAST(floor(epoch(ts)) AS BIGINT) // 21600 AS p FROM events),
b AS (SELECT *, lag(p) OVER w AS before, lead(p) OVER w AS after FROM a WINDOW w AS (PARTITION BY user_id ORDER BY p)),
e AS (
  SELECT p, 1 AS active, before IS NULL AS new, coalesce(before = p - 1, false) AS retained, coalesce(before < p - 1, false) AS returned, 0 AS lost FROM b
  UNION ALL SELECT p + 1, 0, false, false, false, 1 FROM b WHERE coalesce(after <> p + 1, true) AND p < (SELECT max(p) FROM a)
)
SELECT p AS period, sum(active) AS active, count_if(new) AS new, count_if(retained) AS retained, count_if(returned) AS returned, sum(lost) AS lost FROM e GROUP BY 1""",
}
