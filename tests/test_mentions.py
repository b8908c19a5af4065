"""Names in texts and news before games, against plain code."""

import random
import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from matchgrid.operators import mentions as module
from matchgrid.operators.mentions import marked, mentions, news_before_games, words

TEXTS = [(1, "The Red Sox beat the RED-SOX; red sox!"), (2, "Redsox, sox red"), (3, None), (4, ""), (5, "New York Rangers in New York"), (6, "Ünïted 76ers ünïted")]
NAMES = [("a", "Red Sox"), ("b", "red  sox"), ("c", "New York"), ("d", "new york rangers"), ("e", "ÜNÏTED"), ("f", "--"), ("g", None), ("h", "76ers")]


def test_whole_words_in_any_case(spark):
    articles = spark.createDataFrame(TEXTS, "id long, text string")
    names = spark.createDataFrame(NAMES, "team string, name string")
    got = {(r.id, r.team): r.mentions for r in mentions(articles, names, "text", "name", ["id"]).collect()}
    assert got == {(1, "a"): 3, (1, "b"): 3, (5, "c"): 2, (5, "d"): 1, (6, "e"): 2, (6, "h"): 1}


def test_no_names_and_no_texts(spark):
    articles = spark.createDataFrame(TEXTS, "id long, text string")
    names = spark.createDataFrame(NAMES, "team string, name string")
    for a, n in ((articles, names.limit(0)), (articles.limit(0), names)):
        out = mentions(a, n, "text", "name", ["id"])
        assert out.columns == ["id", "team", "name", "mentions"] and out.collect() == []


def test_runs_that_are_no_name_are_left_out_before_the_shuffle(spark, tmp_path, monkeypatch):
    """Every name is found through the marks, also when they are few and all set, and hardly any other run passes them."""
    said = spark.range(40000).selectExpr("concat('w', id) as p")
    listed = spark.range(0, 40000, 100).selectExpr("concat('w', id) as p")
    left = {r.p for r in marked(said, listed, "p").collect()}
    assert {r.p for r in listed.collect()} <= left and len(left) < 500
    articles = spark.createDataFrame(TEXTS, "id long, text string")
    names = spark.createDataFrame(NAMES, "team string, name string")
    monkeypatch.setattr(module, "MARKS", 1)
    got = {(r.id, r.team): r.mentions for r in mentions(articles, names, "text", "name", ["id"], str(tmp_path / "names")).collect()}
    assert got == {(1, "a"): 3, (1, "b"): 3, (5, "c"): 2, (5, "d"): 1, (6, "e"): 2, (6, "h"): 1}


def test_first_words(values):
    texts = [("-- A b, c d e",), ("a",), ("",), (None,), ("a b c d e",), ("..",)]
    assert values(texts, "t string", words(F.col("t"), pieces=4)) == [["a", "b", "c"], ["a"], [], [], ["a", "b", "c", "d"], []]


def test_news_before_games(spark):
    """One team has most of the news; instants on both ends of the span, ties, nulls."""
    rng, day = random.Random(3), datetime(2024, 1, 1)
    hour = lambda: day + timedelta(hours=rng.randrange(200))
    team = lambda: rng.choice(["x"] * 6 + ["y", "z", None])
    news = [(team(), rng.choice([hour(), None]) if k % 20 == 0 else hour(), rng.randrange(1, 5), rng.choice([None, 0.25, 0.5, -1.0])) for k in range(3000)]
    games = [(k, team(), hour() if k % 15 else None) for k in range(200)] + [(999, "nobody", day)]
    found = spark.createDataFrame(news, "team string, published timestamp, mentions long, mood double")
    played = spark.createDataFrame(games, "game long, team string, played timestamp")
    out = news_before_games(played, found, "team", "played", "published", F.expr("interval 12 hours"), "mood").collect()
    assert len(out) == len(games)
    for r in out:
        own = [n for n in news if r.team is not None and r.played and n[0] == r.team and n[1] and r.played - timedelta(hours=12) < n[1] <= r.played]
        mood = [n[3] for n in own if n[3] is not None]
        assert (r.articles, r.mentions) == (len(own), sum(n[2] for n in own))
        assert r.last_published == max((n[1] for n in own), default=None)
        assert (r.avg_sentiment is None) == (not mood)
        if mood:
            assert abs(r.avg_sentiment - sum(mood) / len(mood)) < 1e-9
