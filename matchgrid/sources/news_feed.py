"""News of three dialects to one schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchgrid.functions.dates import news_date
from matchgrid.functions.ids import news_id
from matchgrid.sources.parse import explode_parsed, parse_once

# The entity kinds news is tagged with.
ENTITY_KINDS = ["teams", "players", "locations", "organizations"]

# Fields of an article document. ``category`` and the source of the article are read as text and
# parsed on demand because dialects write them as a string, a list or an object.
ARTICLE = (
    "title STRING, description STRING, content STRING, url STRING, author STRING, image STRING, id STRING, "
    "publishedAt STRING, published_at STRING, language STRING, category STRING, source STRING, tags ARRAY<STRING>, "
    "entities STRING, sentiment STRUCT<score: DOUBLE>, relevance DOUBLE, score DOUBLE, "
    "related_games ARRAY<STRING>, link STRING, summary STRING, published STRING, feed_name STRING, feed_id STRING, "
    "guid STRING, categories ARRAY<STRING>"
)


def parse_articles(raw: DataFrame, value: str = "value") -> DataFrame:
    """One row per article document, its fields as columns beside the existing ones."""
    return parse_once(raw, value, ARTICLE, "_doc").select("*", "_doc.*").drop("_doc")


def text_list(value: Column) -> Column:
    """A field that is a list or a single string as an array (empty when missing)."""
    listed = F.from_json(value, "array<string>")
    return F.when(value.isNull(), F.array().cast("array<string>")).when(
        value.startswith("["), F.coalesce(listed, F.array().cast("array<string>"))
    ).otherwise(F.array(value))


def categories(category: Column, tags: Column) -> Column:
    """Distinct categories and tags, sorted."""
    both = F.concat(text_list(category), F.coalesce(tags, F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(F.array_compact(both)))


def entity_buckets(entities: Column) -> Column:
    """Entity map with exactly the known kinds; a kind that is missing or not a list is empty."""
    parsed = F.from_json(entities, "map<string, string>")
    empty = F.array().cast("array<string>")
    pairs: list[Column] = []
    for kind in ENTITY_KINDS:
        value = parsed[kind]
        listed = F.when(value.startswith("["), F.from_json(value, "array<string>"))
        pairs += [F.lit(kind), F.coalesce(listed, empty)]
    return F.create_map(*pairs)


def relevance(rel: Column, score: Column) -> Column:
    return F.coalesce(rel, score).cast("float")


def _text(values: dict[str, Column]) -> Column:
    pairs: list[Column] = []
    for name, value in values.items():
        pairs += [F.lit(name), value.cast("string")]
    return F.create_map(*pairs)


def _fields(dialect: str, as_of: Column | None) -> dict[str, Column]:
    """The common columns of one dialect, over the columns of :func:`parse_articles`."""
    empty, none = F.lit(""), F.array().cast("array<string>")
    language = F.coalesce("language", F.lit("en"))
    shared = {
        "title": F.col("title"),
        "entities": entity_buckets(F.col("entities")),
        "relevance_score": relevance(F.col("relevance"), F.col("score")),
        "related_games": F.col("related_games"),
    }
    if dialect == "rss":
        meta = {
            "feed_id": F.col("feed_id"), "guid": F.col("guid"), "language": language,
            "categories": F.to_json(F.coalesce("categories", none)),
        }
        return {
            "news_id": news_id(F.col("link")),
            "source": F.coalesce("feed_name", F.lit("RSS")),
            "published_date": news_date(F.col("published"), as_of),
            "content": F.coalesce("summary", empty),
            "url": F.col("link"),
            "author": F.col("author"),
            "categories": F.coalesce("tags", none),
            "sentiment_score": F.lit(None).cast("float"),
            "metadata": _text(meta),
            **shared,
        }
    if dialect not in ("newsapi", "gnews"):
        raise ValueError(f"unknown news dialect {dialect!r}")
    origin = F.from_json("source", "struct<id: string, name: string>")
    common = {
        "news_id": news_id(F.col("url")),
        "published_date": news_date(F.col("publishedAt"), as_of),
        "url": F.col("url"),
        "categories": categories(F.col("category"), F.col("tags")),
        "sentiment_score": F.col("sentiment.score").cast("float"),
        **shared,
    }
    if dialect == "newsapi":
        meta = {"source_id": origin["id"], "article_id": F.col("id"), "language": language, "category": F.col("category")}
        return {
            **common,
            "source": F.coalesce(origin["name"], F.lit("NewsAPI")),
            "content": F.coalesce("content", "description", empty),
            "author": F.col("author"),
            "metadata": _text(meta),
        }
    return {
        **common,
        "source": F.coalesce(origin["name"], F.lit("GNews")),
        "content": F.coalesce("description", empty),
        "author": origin["name"],
        "metadata": _text({"source_id": origin["id"], "language": language, "image_url": F.col("image")}),
    }


# Columns of the common schema, in order.
NEWS_COLUMNS = [
    "news_id", "source", "published_date", "title", "content", "url", "author", "categories", "entities",
    "sentiment_score", "relevance_score", "related_games", "metadata",
]


def normalise_news(articles: DataFrame, dialect: str, as_of: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Articles of one dialect (``newsapi``, ``gnews``, ``rss``) in the common schema.

    A date that cannot be read becomes ``as_of`` (now).
    """
    fields = _fields(dialect, as_of)
    return articles.select(*keep, *[fields[c].alias(c) for c in NEWS_COLUMNS])


def route_news(
    articles: DataFrame, dialect: str = "dialect", as_of: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Articles of all dialects in one pass, each normalised by the dialect its row names.

    Rows of an unknown dialect pass through: what they have in columns of the common schema's names and types stays, the
    rest is NULL.
    """
    by_dialect = {name: _fields(name, as_of) for name in ("newsapi", "gnews", "rss")}
    out = []
    for c in NEWS_COLUMNS:
        choice: Column | None = None
        for name, fields in by_dialect.items():
            test = F.col(dialect) == name
            choice = F.when(test, fields[c]) if choice is None else choice.when(test, fields[c])
        out.append(choice)
    known = articles.select(*[choice.alias(c) for c, choice in zip(NEWS_COLUMNS, out)]).schema
    own = {f.name for f in articles.schema if f.name in NEWS_COLUMNS and f.dataType == known[f.name].dataType}
    passed = [choice.otherwise(F.col(c)) if c in own else choice for c, choice in zip(NEWS_COLUMNS, out)]
    return articles.select(*keep, *[choice.alias(c) for c, choice in zip(NEWS_COLUMNS, passed)])


_ARTICLE_LIST = (
    "status STRING, totalResults INT, totalArticles INT, articles ARRAY<STRUCT<source: STRUCT<id: STRING, name: STRING, "
    "url: STRING>, author: STRING, title: STRING, description: STRING, url: STRING, image: STRING, "
    "publishedAt: STRING, content: STRING>>"
)
_FEED = (
    "feed STRUCT<title: STRING, link: STRING, description: STRING, language: STRING>, entries ARRAY<STRUCT<title: STRING, "
    "link: STRING, description: STRING, published: STRING, author: STRING, tags: ARRAY<STRUCT<term: STRING>>>>"
)


def article_rows(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per article of search responses."""
    rows = explode_parsed(parse_once(raw.select(*keep, value), value, _ARTICLE_LIST, "_d"), "_d.articles", "_a")
    total = F.coalesce("_d.totalResults", "_d.totalArticles").alias("total_articles")
    fields = ["author", "title", "description", "content", "url", "image"]
    return rows.select(
        *keep,
        total,
        F.col("_a.source.name").alias("source"),
        F.col("_a.source.url").alias("source_url"),
        *[F.col(f"_a.{f}").alias(f) for f in fields],
        F.col("_a.publishedAt").alias("published_at"),
    )


def feed_rows(raw: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per entry of syndication feeds, tag terms as a list."""
    rows = explode_parsed(parse_once(raw.select(*keep, value), value, _FEED, "_d"), "_d.entries", "_e")
    fields = ["title", "link", "description", "published", "author"]
    terms = F.transform(F.coalesce("_e.tags", F.array().cast("array<struct<term:string>>")), lambda t: t["term"])
    return rows.select(
        *keep,
        F.col("_d.feed.title").alias("feed_title"),
        F.col("_d.feed.language").alias("language"),
        *[F.col(f"_e.{f}").alias(f) for f in fields],
        terms.alias("tags"),
    )
