"""Training samples and held-out folds of labelled documents."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchgrid.llm.common import ship


def fold(id_col: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null ids fall in no fold."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def sampled(docs: DataFrame, labels: DataFrame, label: str, learn, rows: int, longest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y): at most ``rows`` labelled documents, half of each class as far as there are enough.

    Ids are taken in the order of a hash, so the sample depends on the data alone.  Only ids and labels are sorted; the list
    that goes to the executors has at most ``rows`` entries.  Texts of more than ``longest`` bytes, null labels and ids with
    contradicting labels are left out of the sample (of training only: every text is scored).
    """
    own = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).filter(F.col("id").isNotNull() & F.col("y").isin(0, 1))
    own = own.filter(learn("id")).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z")).filter("y = z").drop("z")
    order = [F.xxhash64("id", F.lit(17)), F.col("id")]
    picked = None
    for y in (0, 1):
        part = own.filter(F.col("y") == y).orderBy(*order).limit(rows // 2)
        picked = part if picked is None else picked.unionByName(part)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(F.octet_length("text") <= longest)
    met = texts.join(F.broadcast(picked), "id")
    # of an id with several texts the first by a hash, so that no more rows than ids come together
    return met.groupBy("id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("id", "text", "y")


def _featured(sample: DataFrame, features: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    ship(sample.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield features(batch)

    return sample.mapInArrow(run, schema)


def _ordered(rows: list) -> list:
    return sorted(rows, key=lambda r: (r["id"], bytes(r["keys"])))


def collected(sample: DataFrame, features: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> list:
    """Feature rows of a bounded sample, made on the executors, in a fixed order."""
    return _ordered(_featured(sample, features, schema).collect())


def fitted(sample: DataFrame, features: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, train: Callable[[list], object]):
    """What ``train`` makes of the feature rows of a bounded sample, in a fixed order.

    It learns in a task, so only the model comes to the driver, whose memory does not hold the features.
    """

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(_ordered(rows)))], pa.binary())], names=["model"])

    found = _featured(sample, features, schema).repartition(1).mapInArrow(learn, "model binary").collect()
    # without rows there may be no task
    return pickle.loads(found[0]["model"]) if found else train([])


def scored(docs: DataFrame, score: Callable[[pa.Array], pa.Array], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text; ``score`` maps a text column to doubles."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), score(batch.column(1))], names=["id", "score"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, score double")


def kept(docs: DataFrame, passes: Callable[[pa.Array], pa.Array], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose whole text passes."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(passes(batch.column(place)))

    return docs.mapInArrow(run, docs.schema)
