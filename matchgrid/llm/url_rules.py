"""URL filter: fixed host and path rules first, then association rules over URL tokens mined with FP-growth.

URLs that a fixed rule judges are the labelled examples.  FP-growth finds the frequent token combinations of these examples
together with their verdict; rules of any length that pass support and confidence, and that no shorter rule makes
superfluous, are kept.  Tokens that stand in the same examples count as one.  An inverted index holds each rule under its
rarest token, so a URL meets only rules that share that token with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchgrid.llm.common import table, written

# Fixed values: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUPPORT, LEAST, CONFIDENCE = 0.01, 5, 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for what has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r), reverse=False):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Distinct runs of a-z and digits, in lower case; a run of digits alone is ``#``."""
    parts = F.split(F.translate(url, UPPER, LOWER), "[^a-z0-9]+")
    named = F.transform(F.filter(parts, lambda t: t != ""), lambda t: F.when(t.rlike("^[0-9]+$"), F.lit("#")).otherwise(t))
    return F.array_distinct(named)


def classes(examples: DataFrame) -> DataFrame:
    """(token, item): tokens that stand in exactly the same examples share one item, the first of them.

    Which examples hold a token is compared by their number and two sums of hashes, which tasks add up on their own.  Long
    URLs that occur often have many such tokens; as one item they do not multiply the combinations.
    """
    row = F.array_sort("tokens")
    each = examples.select(F.xxhash64(row, "verdict").cast("decimal(38,0)").alias("a"), F.xxhash64(F.lit(1), row, "verdict").cast("decimal(38,0)").alias("b"), F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))
    first = held.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return held.join(first, ["n", "a", "b"]).select("token", "item", "n")


def as_items(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, items) of rows, one for each ``keys``: the distinct items of their ``tokens``; rows without any are left out."""
    each = rows.select(*keys, F.explode("tokens").alias("token")).join(known, "token")
    return each.groupBy(*keys).agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine(examples: DataFrame, support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(rules, known) from (tokens, verdict) rows: rules (items, rarest, verdict, confidence, freq) of any number of items, and
    (token, item) as :func:`classes` finds them, of tokens that are frequent enough.

    A rule holds for at least ``least`` examples and the share ``support`` of all of them, and its verdict for the share
    ``confidence`` of those that have its items.  A rule is dropped if one with one item less gives the same verdict with
    no less confidence; as that one fits wherever this one does and ranks no lower, no verdict depends on it.
    """
    n = examples.count()
    few = max(least, -int(-support * n // 1))
    found = written(classes(examples), "classes")
    known = found.filter(F.col("n") >= few).select("token", "item")
    sizes = found.filter(F.col("n") >= few).groupBy("item").agg(F.max("n").alias("n"))
    grouped = examples.groupBy(F.array_sort("tokens").alias("tokens"), "verdict").agg(F.count("*").alias("copies"))
    grouped = as_items(grouped.withColumn("basket", F.col("tokens")), known, ["basket", "verdict", "copies"])
    # one basket an example, in runs of bounded size
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / 4096))).alias("run")
    each = grouped.select("items", "verdict", "copies", runs)
    each = each.select("items", "verdict", F.explode(F.sequence(F.col("run") * 4096, F.least(F.col("run") * 4096 + 4095, F.col("copies") - 1))))
    baskets = written(each.select(F.concat("items", F.array(F.concat(F.lit("="), "verdict"))).alias("items")), "baskets")
    held = baskets.count()
    if not held:
        schema = T.StructType.fromDDL("items array<string>, rarest string, verdict string, confidence double, freq long")
        return examples.sparkSession.createDataFrame([], schema), known
    # a share just below the wanted count, so that rounding up gives the count itself
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, (few - 0.5) / held))).fit(baskets)
    own, told = F.array_sort(F.filter("items", lambda t: ~t.startswith("="))), F.filter("items", lambda t: t.startswith("="))
    sets = written(model.freqItemsets.select(own.alias("items"), F.try_element_at(told, F.lit(1)).alias("v"), "freq"), "itemsets").filter(F.size("items") > 0)
    whole = sets.filter("v is null").select("items", F.col("freq").alias("all"))
    rules = sets.filter("v is not null").join(whole, "items").select("items", F.expr("substring(v, 2)").alias("verdict"), (F.col("freq") / F.col("all")).alias("confidence"), "freq")
    rules = written(rules.filter(F.col("confidence") >= confidence), "rules")
    parts = rules.select("*", F.explode("items").alias("item")).withColumn("rest", F.array_remove("items", F.col("item")))
    shorter = rules.select(F.col("items").alias("rest"), "verdict", F.col("confidence").alias("rest_confidence"))
    parts = parts.join(shorter, ["rest", "verdict"], "left").join(sizes, "item")
    better = F.coalesce(F.col("rest_confidence") >= F.col("confidence"), F.lit(False))
    kept = parts.groupBy("items", "verdict", "confidence", "freq").agg(F.min(F.struct("n", "item")).alias("r"), F.max(better).alias("worse"))
    return kept.filter(~F.col("worse")).select("items", F.col("r.item").alias("rarest"), "verdict", "confidence", "freq"), known


def judged(urls: DataFrame, rules: DataFrame, known: DataFrame, default: str = "allow") -> DataFrame:
    """(url, verdict) of distinct URLs with their tokens: the most confident rule that fits, then the more frequent, then the
    later verdict by name; ``default`` where none fits."""
    index = rules.select(F.col("rarest").alias("t"), F.col("items").alias("needs"), F.col("verdict").alias("v"), "confidence", "freq")
    met = as_items(urls, known, ["url"]).select("url", "items", F.explode("items").alias("t")).join(index, "t").filter(F.size(F.array_except("needs", "items")) == 0)
    best = met.groupBy("url").agg(F.max(F.struct("confidence", "freq", "v")).alias("best"))
    return best.select("url", F.coalesce("best.v", F.lit(default)).alias("verdict"))


def filtered(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow", **options) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    A null URL has empty host and path and no tokens; it gets ``default``.  URLs that no fixed rule judges are judged once
    each, however often they occur.
    """
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    base = base.select("*", rule.alias("rule"), verdict.alias("fixed"))
    rules_, known = mine(base.filter("rule is not null").select(tokens(F.col("url")).alias("tokens"), F.col("fixed").alias("verdict")), **options)
    # rows that are judged already, or have no URL, are not dealt by it
    settled = base.filter("rule is not null or url is null").withColumn("verdict", F.coalesce("fixed", F.lit(default)))
    open_ = base.filter("rule is null and url is not null")
    found = judged(open_.select("url").distinct().select("url", tokens(F.col("url")).alias("tokens")), rules_, known, default)
    rest = open_.join(found, "url", "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    columns = ["page_id", "host", "path", "rule", "verdict"]
    return settled.select(*columns).unionByName(rest.select(*columns))


def op9_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    return filtered(table(spark, sf, "pages"))


ORACLE_SQL = rf"""
WITH RECURSIVE r(h, p, v) AS (VALUES {', '.join(str(x) for x in RULES)}),
b AS (
  SELECT row_number() OVER () AS n, page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
u AS (
  SELECT n, page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path,
    list_distinct(list_transform(list_filter(regexp_split_to_array(translate(coalesce(url, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]+'), lambda t: t <> ''),
      lambda t: CASE WHEN regexp_full_match(t, '[0-9]+') THEN '#' ELSE t END)) AS toks
  FROM b
),
f AS (
  SELECT u.*, (SELECT max(struct_pack(l := length(h || p), rule := h || p, v := v)) FROM r WHERE (host = h OR host LIKE '%.' || h) AND starts_with(path, p)) AS best FROM u
),
x AS (SELECT n, unnest(toks) AS t, best.v AS v FROM f WHERE best IS NOT NULL),
few AS (SELECT greatest({LEAST}, ceil({SUPPORT} * count(*))) AS k FROM f WHERE best IS NOT NULL),
often AS (SELECT t, list(n ORDER BY n) AS ns FROM x GROUP BY t HAVING count(*) >= (SELECT k FROM few)),
item AS (SELECT t, min(t) OVER (PARTITION BY ns) AS i FROM often),
y AS (SELECT n, v, list_sort(list(DISTINCT i)) AS its FROM x JOIN item USING (t) GROUP BY n, v),
sets AS (
  SELECT n, v, its, [i] AS s FROM (SELECT n, v, its, unnest(its) AS i FROM y)
  UNION ALL SELECT n, v, its, list_append(s, i) FROM (SELECT n, v, its, s, unnest(its) AS i FROM sets) WHERE i > s[-1]
),
total AS (SELECT s, count(*) AS k FROM sets GROUP BY s),
mined AS (
  SELECT s, v, c.k AS freq, c.k / total.k AS conf FROM (SELECT s, v, count(*) AS k FROM sets GROUP BY s, v) c JOIN total USING (s), few
  WHERE c.k >= few.k AND c.k / total.k >= {CONFIDENCE}
),
has AS (SELECT f.n, list(DISTINCT i) AS its FROM (SELECT n, unnest(toks) AS t FROM f WHERE best IS NULL) f JOIN item USING (t) GROUP BY f.n),
m AS (SELECT n, max(struct_pack(c := conf, f := freq, v := mined.v)).v AS v FROM has JOIN mined ON list_has_all(has.its, mined.s) GROUP BY n)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, m.v, 'allow') AS verdict FROM f LEFT JOIN m USING (n)
"""

QUERIES = {"op9_url_rules": op9_url_rules}
ORACLE = {"op9_url_rules": ORACLE_SQL}
