"""Held-out accuracy of both classifiers, and that scores depend on the text alone."""

import zlib

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from matchgrid.llm import quality, sampling, text, toxicity

SF = "/root/testdata/sf0.1"


def held_out(spark, query, label, folds, fold):
    got = {r.doc_id: r for r in query(spark, SF).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % folds == fold) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    pairs = [(got[i].score, got[i].predicted, y) for i, y in labels.items() if got[i].held_out]
    return np.array(pairs).T


def test_quality(spark):
    score, predicted, y = held_out(spark, quality.op2_quality, "quality", 5, 0)
    assert (predicted == y).mean() > 0.98
    assert (predicted[y == 1] == 1).mean() > 0.995


def test_toxicity(spark):
    score, predicted, y = held_out(spark, toxicity.op4_toxicity, "toxic", 4, 2)
    assert (predicted == y).mean() > 0.96
    assert (predicted[y == 0] == 0).mean() > 0.98


def labelled(spark, n=240):
    """Bad texts insult someone; mentions of groups are bad more often than not, but never by themselves."""
    rng = np.random.default_rng(2)
    terms = ["women", "men", "girls", "boys"]
    docs, labels = [], []
    for k in range(n):
        words = [f"w{int(i)}" for i in rng.integers(0, 40, 12)]
        bad = k % 2
        if bad:
            words[3] = ["idiot", "scum"][k // 2 % 2]
        if rng.random() < (0.8 if bad else 0.2):
            words[6] = terms[0] if bad else terms[1 + k % 3]
        docs.append((k, " ".join(words)))
        labels.append((k, bad))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactual_pairs_level_the_scores(spark):
    docs, labels = labelled(spark)
    gaps = []
    for pairing in (0.0, 1.0):
        model = toxicity.fit(docs, labels, margin=2.0, pairing=pairing)
        a, b, bad = model.score(pa.array(["w1 w2 women w3", "w1 w2 men w3", "w1 idiot w3"])).to_pylist()
        assert bad > 0.5
        gaps.append(abs(a - b))
    assert gaps[1] < gaps[0] / 2


def test_edge_cases(spark):
    docs, labels = labelled(spark)
    odd = spark.createDataFrame([(None, "null id"), (1000, None), (1001, ""), (1002, "x" * 70_000 + " " + "word " * 500_000), (1003, "same"), (1003, "same")], "doc_id long, text string")
    every = docs.unionByName(odd).selectExpr("*", "1 as id", "2 as y", "3 as score", "4 as quality")
    labels = labels.unionByName(labels.limit(3)).unionByName(spark.createDataFrame([(None, 1), (5, 0), (1000, None), (1001, 1), (1002, 0), (99999, 1)], labels.schema))
    model = toxicity.fit(every, labels)
    found = toxicity.score(every, model).filter("id is null or id >= 1000").collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.id in (1000, 1001)}) == 1 and len({r.score for r in found if r.id == 1003}) == 1
    kind = quality.fit(every, labels.withColumnRenamed("toxic", "quality"), rows=60)
    found = quality.score(every, kind).filter("id is null or id >= 1000").collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    assert quality.accepted(every, kind, 0.0).count() == every.count() and quality.accepted(every, kind, 1.1).count() == 0
    assert quality.accepted(every, kind).columns == every.columns
    none = labels.limit(0)
    assert {r.score for r in toxicity.score(odd, toxicity.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in quality.score(odd, quality.fit(docs, none.withColumnRenamed("toxic", "quality"))).collect()} == {0.5}
    assert quality.score(docs.limit(0), kind).collect() == [] and toxicity.score(docs.limit(0), model).collect() == []


def test_scores_do_not_depend_on_batches(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{int(i)}" for i in rng.integers(0, 30, rng.integers(0, 60))) for _ in range(50)] + ["", None]
    model = quality.Model(rng.normal(size=1 << 12).astype(np.float32), 0.1, 12)
    together = model.score(pa.array(texts)).to_numpy()
    alone = np.concatenate([model.score(pa.array([t], pa.string())).to_numpy() for t in texts])
    assert np.allclose(together, alone, atol=1e-12)
    keys = np.unique(text.mix(rng.integers(1, 1 << 60, 50).astype(np.uint64)))
    table = toxicity.Model.of(np.unique(np.concatenate([keys, toxicity.distinct_keys("w1 w2 w3 w17 w29")])), np.ones(len(keys) + 5), -2.0)
    logit = lambda p: np.log(p / (1 - p))
    for t, p in zip(texts, table.score(pa.array(texts)).to_numpy()):
        assert round(logit(p) + 2) == len(set((t or "").split()) & {"w1", "w2", "w3", "w17", "w29"})


def test_linear_scoring_equals_averaged_vectors():
    """Folding vectors with the output weights changes nothing."""
    rows = quality.features(10)(pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["good text here", "BAD!! BAD!! BAD!!"]), pa.array([1, 0], pa.int32())], names=["id", "text", "y"])).to_pylist()
    model = quality.train(rows, bits=10)
    for r, p in zip(rows, model.score(pa.array(["good text here", "BAD!! BAD!! BAD!!"])).to_pylist()):
        z = np.frombuffer(r["shares"], np.float32) @ model.weight[np.frombuffer(r["keys"], np.int32)] + model.bias
        assert abs(p - 1 / (1 + np.exp(-z))) < 1e-5


def test_every_text_has_a_counterfactual_copy(spark):
    """On registered data, where no text mentions a group: one pair a text, and a neutral mention moves no score."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    sample = sampling.sampled(docs, labels, "toxic", lambda c: sampling.fold(c, 4) != 2, 6000, 1 << 16)
    rows = sampling.collected(sample, toxicity.features(toxicity.IDENTITY_TERMS), "id long, y int, keys binary, swapped binary, inserted binary")
    assert len(rows) > 1000 and all((r["swapped"] is None) != (r["inserted"] is None) for r in rows)
    assert len({r["inserted"] for r in rows}) > 60
    model = toxicity.train(rows)
    own = [r.text for r in docs.filter("doc_id < 60").collect()]
    before = model.score(pa.array(own)).to_numpy()
    for term in ("women", "muslims", "refugees", "deaf", "hommes", "turkish"):
        after = model.score(pa.array([f"{t} {term}" for t in own])).to_numpy()
        assert np.abs(after - before).max() < 0.05


def test_one_text_of_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    rows = sampling.sampled(docs, labels, "toxic", lambda c: F.lit(True), 100, 1000).collect()
    assert sorted(r.id for r in rows) == [1, 2]


def test_only_models_come_to_the_driver(spark, monkeypatch):
    docs, labels = labelled(spark)
    learned = labels.withColumnRenamed("toxic", "quality")
    plain = quality.train(sampling.collected(sampling.sampled(docs, learned, "quality", lambda c: F.lit(True), 60, 1000), quality.features(12), "id long, y int, keys binary, shares binary"), 12)
    brought, collect = [], type(docs).collect

    def counted(df):
        brought.append(collect(df))
        return brought[-1]

    monkeypatch.setattr(type(docs), "collect", counted)
    model = quality.fit(docs, learned, rows=60, longest=1000, bits=12)
    toxicity.fit(docs, labels)
    assert [len(rows) for rows in brought] == [1, 1]
    assert np.allclose(model.weight, plain.weight, atol=1e-5) and abs(model.bias - plain.bias) < 1e-5
