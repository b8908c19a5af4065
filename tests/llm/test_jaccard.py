"""Groups of near copies against all pairs, and the pipeline's stage on copies that op10's fingerprints do not link."""

import random

import numpy as np
import pytest

import corpus_pipeline
from matchgrid.llm import jaccard

SF = "/root/testdata/sf0.001"


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def grouped(texts):
    sets, label = [grams(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if label[i] != label[j] and similar(sets[i], sets[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def cases():
    """Chains of copies that lie around the limit, short texts and texts without words."""
    rng = random.Random(4)
    out = [None, "", " \n", "one", "One", "a b c d", "a b c d", "a b c d e"]
    for k in range(8):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(8, 300))]
        for _ in range(25):
            for _ in range(rng.randrange(1, 1 + max(1, len(words) // 40))):
                words = list(words)
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("cap", [400, 4_000_000])
def test_groups(spark, cap):
    texts = cases()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as node", "2 as root")
    got = {r.id: r.component for r in jaccard.near_copies(df, cap=cap).collect()}
    assert [got[k] for k in range(len(texts))] == grouped(texts)
    assert 10 < len(set(got.values())) < len(texts)


def framed(texts, frame=130, own=150):
    rng = random.Random(9)
    common = [f"f{k}" for k in range(frame)]
    return [" ".join(common + [f"o{rng.randrange(10**9)}" for _ in range(own)]) for _ in range(texts)]


def test_a_common_frame_ties_nothing(spark):
    """Texts of one frame leave the large group before they are compared; copies among them stay together."""
    texts = framed(300)
    copies = [t.replace(t.split()[-1], "changed") for t in texts[:40]]
    sets = [(k, 0, len(g), g.tobytes()) for k, g in enumerate(jaccard.shingles(t.encode()) for t in texts + copies)]
    df = spark.createDataFrame(sets, "node long, root long, n long, grams binary")
    got = {}
    for r in jaccard.retied(df, 1000).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == [[k, 300 + k] for k in range(40)]
    assert jaccard.retied(df, 10**6).collect() == df.collect()


def test_repeated_rows_null_ids_and_a_long_text(spark):
    long = " ".join(f"w{k * k % 99991}" for k in range(60_000))
    texts = [long, long + " end", "a b c d e f", "a b c d e f", None, ""]
    rows = [(1, texts[0]), (1, texts[0]), (None, texts[1]), (None, texts[2]), (None, texts[2]), (7, texts[4]), (3, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for cap in (1000, 4_000_000):
        got = sorted(((r.id, r.component) for r in jaccard.near_copies(docs, cap=cap).collect()), key=str)
        assert got == sorted([(1, 1), (1, 1), (None, 1), (None, None), (None, None), (7, 3), (3, 3)], key=str)


def test_links_without_the_first_texts():
    """Copies that no compared text is near to are found by their rarest shingles."""
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64)) for _ in range(30)]
    sets = base + [np.unique(np.append(b[:95], rng.integers(0, 1 << 60, 5).astype(np.uint64))) for b in base]
    label = np.arange(len(sets))
    a, b = jaccard.linked(sets, label)
    assert sorted(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())) == [(k, k + 30) for k in range(30)]
    assert label.tolist() == [*range(30), *range(30)]


def test_empty_table(spark):
    assert jaccard.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_stage_takes_copies_of_0_8(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id in (1, 177, 5)")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert similar(grams(texts[1]), grams(texts[177]))
    assert sorted(r.doc_id for r in corpus_pipeline.distinct(spark, docs, SF).collect()) == [1, 5]


def test_stage_takes_linked_fingerprints(spark):
    """One text repeated with different ends: hardly a common share of distinct shingles, but one fingerprint."""
    frame = " ".join(f"w{i}" for i in range(60))
    ends = [" ".join(f"{c}{i}" for i in range(40)) for c in "ab"]
    rows = [(3, f"{frame} " * 200 + ends[0]), (2, f"{frame} " * 200 + ends[1]), (5, " ".join(f"z{i}" for i in range(90)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.distinct(spark, docs, SF).collect()) == [2, 5]


def test_stage_deals_out_texts_for_the_last_join_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = corpus_pipeline.distinct(spark, docs, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1
