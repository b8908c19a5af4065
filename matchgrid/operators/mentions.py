"""News against performance: names found in texts, and what was said of a team before each of its games."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from matchgrid.operators.asof import asof_join
from matchgrid.operators.windows import Frame, Running, running


def words(text: Column, pieces: int | None = None) -> Column:
    """Lower-cased runs of letters and digits; NULL has none.

    Only the first ``pieces`` parts are cut off, if given: they hold one word less at least, as the first may be empty.
    """
    lower, edge = F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"
    cut = F.split(lower, edge) if pieces is None else F.slice(F.split(lower, edge, pieces + 1), 1, pieces)
    return F.array_remove(cut, "")


def phrase(text: Column) -> Column:
    return F.array_join(words(text), " ")


#: Words of 64 bits in which the hashes of all names are marked; the marks are sent to every task, so their number is bounded.
MARKS = 1 << 20


def marked(said: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """The rows of ``said`` whose ``column`` may occur in ``listed``: all that do, and few others.

    Each value of ``listed`` sets one of ``64 * MARKS`` bits, so at most ``MARKS`` rows are broadcast, however many values there
    are; more values only let more other rows through (2 of 100 for 1.5 million values).
    """
    hashed = F.xxhash64(column)
    slot = F.shiftrightunsigned(hashed, 6).bitwiseAND(MARKS - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), hashed.bitwiseAND(63).cast("int"))
    marks = listed.select(slot.alias("_slot"), bit.alias("_bit")).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    near = said.withColumns({"_slot": slot, "_bit": bit}).join(F.broadcast(marks), "_slot")
    return near.filter(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*said.columns)


def mentions(articles: DataFrame, names: DataFrame, text: str, name: str, keep: Sequence[str], store: str | None = None) -> DataFrame:
    """(``keep``, columns of ``names``, mentions): how often each name occurs in each text, as whole words in any case.

    All names are searched at once: a text gives one row for each different run of words that is as long as some name, and
    these rows meet the names in one equality join, so its cost does not grow with the number of names.  Runs that are no name
    are left out in the task that reads the text (:func:`marked`), so little more than what is found is shuffled.  Names inside
    longer names count too; equal names of several rows count for each; a name without words is never found.  Rows of
    ``articles`` that agree in ``keep`` are one text.  Only the different lengths of names, few numbers, pass through the driver.

    The names are looked at three times; with a ``store`` folder they are written there first and worked out once.
    """
    listed = names.withColumn("_phrase", phrase(F.col(name)))
    if store is not None:
        listed.write.mode("overwrite").parquet(store)
        listed = names.sparkSession.read.schema(listed.schema).parquet(store)
    listed = listed.filter("_phrase <> ''")
    lengths = sorted(r[0] for r in listed.select(F.size(F.split("_phrase", " "))).distinct().collect())
    if not lengths:
        schema = articles.select(*keep).schema
        for field in names.schema:
            schema.add(field)
        return articles.sparkSession.createDataFrame([], schema.add("mentions", LongType()))

    # one row for each word, with the runs that begin at it; a run beyond the end of its text is NULL and meets no name
    at = articles.select(*keep, words(F.col(text)).alias("_words")).select("*", F.posexplode("_words").alias("_at", "_word"))

    def run(n: int) -> Column:
        following = [F.get("_words", F.col("_at") + i) for i in range(1, n)]
        return F.concat(F.col("_word"), *[part for word in following for part in (F.lit(" "), word)])

    said = at.select(*keep, F.explode(F.array(*[run(n) for n in lengths])).alias("_phrase"))
    counted = marked(said, listed, "_phrase").groupBy(*keep, "_phrase").agg(F.count(F.lit(1)).alias("mentions"))
    return counted.join(listed, "_phrase").select(*keep, *names.columns, "mentions")


def news_before_games(
    games: DataFrame, found: DataFrame, team: str, played: str, published: str, span: Column, sentiment: str | None = None
) -> DataFrame:
    """``games`` with the news of their team in the ``span`` up to the game: articles, mentions and mean sentiment.

    ``found`` has one row per article and team.  Totals up to an instant are running sums, looked up at the game and one span
    before it; what lies between is their difference.  No article is paired with a game, and a team with very much news is
    cut by time.  A game without news has zeros and a NULL sentiment; NULL sentiments do not count, NULL teams and instants
    have no news.
    """
    score = F.col(sentiment).cast("decimal(18,9)") if sentiment else F.lit(None).cast("decimal(18,9)")
    at = found.filter(F.col(published).isNotNull() & F.col(team).isNotNull()).groupBy(team, published)
    by_time = at.agg(
        F.count(F.lit(1)).alias("_articles"), F.sum("mentions").alias("_mentions"), F.count(score).alias("_scored"), F.coalesce(F.sum(score), F.lit(0)).alias("_score")
    )
    totals = ["articles", "mentions", "scored", "score"]
    upto = running(by_time, [Frame([team], [published], {f"_upto_{c}": Running("sum", f"_{c}") for c in totals})])
    upto = upto.select(team, F.col(published).alias("_published"), *[f"_upto_{c}" for c in totals])
    now = asof_join(games, upto, [team], played, "_published", [f"_upto_{c}" for c in totals], at="last_published")
    start = now.withColumns({f"_now_{c}": F.coalesce(f"_upto_{c}", F.lit(0)) for c in totals}).drop(*[f"_upto_{c}" for c in totals])
    start = start.withColumn("_start", F.col(played) - span)
    both = asof_join(start, upto, [team], "_start", "_published", [f"_upto_{c}" for c in totals], at="_at")
    new = {c: F.col(f"_now_{c}") - F.coalesce(f"_upto_{c}", F.lit(0)) for c in totals}
    inside = F.when(F.col("last_published") > F.col("_start"), F.col("last_published"))
    mean = F.when(new["scored"] > 0, new["score"].cast("double") / new["scored"])
    return both.select(*games.columns, inside.alias("last_published"), new["articles"].alias("articles"), new["mentions"].alias("mentions"), mean.alias("avg_sentiment"))
