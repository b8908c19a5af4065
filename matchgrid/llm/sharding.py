"""Weighted rendezvous hashing: each record goes to the shard that wins its draw, one draw per record key and shard.

A draw depends on the key and the shard alone, so a further shard takes records only into itself and a removed one gives
away only its own.  Everything is column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchgrid.llm.common import table, written

SHARDS = 16
#: Runs of records, by a hash, into which each shard's records are cut for numbering; no task orders a whole shard.
RUNS = 1024


def _key(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(""))


def _draw(key: Column, shard: int, weight: float) -> Column:
    """An exponential waiting time of rate ``weight``, from 52 bits of a digest; the shortest wins."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{shard}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(float(weight))


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; ``weights`` has one positive share per shard, ties go to the smaller shard.

    A null key counts as the empty string.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    draws = F.array(*(F.struct(_draw(_key(key), s, w).alias("draw"), F.lit(s).alias("shard")) for s, w in enumerate(weights)))
    return F.array_min(draws)["shard"]


def with_shard(df: DataFrame, key: str, weights: Sequence[float] = (1.0,) * SHARDS, name: str = "shard") -> DataFrame:
    """``df`` with the shard of each record; no shuffle."""
    return df.withColumn(name, winner(F.col(f"`{key}`"), weights))


def _run(*values: Column) -> Column:
    """By key and what else tells rows apart, so that the different rows of one key are dealt over all runs."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *map(_key, values))), 14, 3), 16, 10).cast("int") / F.lit(4096 // RUNS)).cast("int")


def numbered(rows: DataFrame, shard: str, key: str, ties: Sequence[str]) -> DataFrame:
    """``rows`` with ``slot``: a gapless number from 0 within each shard, in the order of run, key and ``ties``.

    Equal rows are counted before anything is shuffled by key and unfolded at the end, so a row that is repeated very often
    does not burden one task.  A column ``slot`` that is there already is replaced.  Each run is numbered by itself and starts where the runs before it end.
    """
    # columns travel under names of their own, so whatever they are called, nothing clashes
    names = [c for c in rows.columns if c.lower() != "slot"]
    short = {c: f"c{k}" for k, c in enumerate(names)}
    packed = rows.select(*(F.col(f"`{c}`").alias(n) for c, n in short.items()), F.col(f"`{shard}`").alias("shard"), F.col(f"`{key}`").alias("key"))
    counted = written(packed.withColumn("run", _run(F.col("key"), *(F.col(short[t]) for t in ties))).groupBy(*short.values(), "shard", "key", "run").agg(F.count("*").alias("n")), "shards")
    inside = Window.partitionBy("shard", "run").orderBy(F.col("key").asc_nulls_first(), *(short[t] for t in ties), *short.values())
    before = Window.partitionBy("shard").orderBy("run")
    upto = (Window.unboundedPreceding, -1)
    starts = counted.groupBy("shard", "run").agg(F.sum("n").alias("all")).withColumn("first", F.coalesce(F.sum("all").over(before.rowsBetween(*upto)), F.lit(0))).drop("all")
    placed = counted.withColumn("at", F.coalesce(F.sum("n").over(inside.rowsBetween(*upto)), F.lit(0))).join(starts, ["shard", "run"])
    # 4096 rows at a time: no array grows with the number of repeats beyond that share of it
    parts = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / 4096))))
    low = F.col("part") * 4096
    each = parts.withColumn("k", F.explode(F.sequence(low, F.least(low + 4095, F.col("n") - 1))))
    return each.select(*(F.col(n).alias(c) for c, n in short.items()), (F.col("first") + F.col("at") + F.col("k")).alias("slot"))


def op6_rendezvous_shards(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = with_shard(with_shard(rows, "doc_id"), "doc_id", (1.0,) * (SHARDS + 1), "grown_shard")
    return numbered(rows, "shard", "doc_id", ["text_crc32", "size"]).withColumn("law", F.lit("key"))


def _winner_sql(shards: int) -> str:
    draws = ", ".join(f"{{'draw': -ln((CAST('0x' || substr(md5(k || '|{s}'), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0), 'shard': {s}}}" for s in range(shards))
    return f"list_min([{draws}]).shard"


ORACLE_SQL = f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes
  FROM documents
),
c AS (
  SELECT doc_id, k, size, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295) AS text_crc32
  FROM d, crc
),
s AS (
  SELECT *, CAST('0x' || substr(md5(k || '|' || text_crc32 || '|' || size), 14, 3) AS BIGINT) // {4096 // RUNS} AS run,
    {_winner_sql(SHARDS)} AS shard, {_winner_sql(SHARDS + 1)} AS grown_shard
  FROM c
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY run, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM s
"""

QUERIES = {"op6_rendezvous_shards": op6_rendezvous_shards}
ORACLE = {"op6_rendezvous_shards": ORACLE_SQL}
