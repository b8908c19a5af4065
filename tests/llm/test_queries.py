"""Queries with SQL against it; sharding, search and URL rules on odd tables; the pipeline against plain code."""

from fractions import Fraction
from math import floor

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_decontaminate import plain as contaminated
from test_jaccard import grouped
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from matchgrid.llm import mtree, pii, quality, queries, sharding, url_rules
from tools.check import TABLES, key, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLE)
def test_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols, rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry.oracle_sql()[name])
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert cols == want_cols and [key(r) for r in rows] == [key(r) for r in want]


def test_all_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names and set(queries.QUERIES) <= set(names)


# ---- sharding


def test_growth_takes_only_into_the_new_shard(spark):
    df = spark.range(20_000)
    weights = [1.0, 2.0, 3.0, 2.0]
    rows = sharding.with_shard(sharding.with_shard(df, "id", weights, "a"), "id", [*weights, 2.0], "b").collect()
    assert all(r.b in (r.a, 4) for r in rows)
    share = np.bincount([r.b for r in rows]) / len(rows)
    assert np.allclose(share, np.array([*weights, 2.0]) / 10, atol=0.015)
    with pytest.raises(ValueError):
        sharding.with_shard(df, "id", [1.0, 0.0])


def test_slots_are_gapless(spark, monkeypatch):
    rows = [(None, "n"), (None, "n"), *((k % 50, None if k % 7 else "") for k in range(400)), *[(7, "hot")] * 9000]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("run", F.lit(2)).withColumn("key", F.lit(3)).withColumn("slot", F.lit(4))
    out = sharding.numbered(sharding.with_shard(df, "doc_id"), "shard", "doc_id", ["text"]).collect()
    assert len(out) == len(rows)
    for shard in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(sum(r.shard == shard for r in out)))
    assert sharding.numbered(sharding.with_shard(df.limit(0), "doc_id"), "shard", "doc_id", ["text"]).collect() == []


def test_different_rows_of_one_key_are_dealt(spark):
    df = spark.createDataFrame([(7, f"text {k}") for k in range(3000)], "doc_id long, text string")
    keyed = df.select(sharding._run(F.col("doc_id"), F.col("text")).alias("run"))
    assert keyed.distinct().count() > 900
    out = sharding.numbered(sharding.with_shard(df, "doc_id"), "shard", "doc_id", ["text"]).collect()
    assert sorted(r.slot for r in out) == list(range(3000)) and len({r.shard for r in out}) == 1


# ---- search


def nearest(rows, k, is_query):
    rows = [(i, [floor(Fraction(x) * 256) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in rows:
        if is_query(q):
            scores = sorted((-max(1 - 2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in rows if i != q)[:k]
            out |= {(q, r + 1, i, int(-s)) for r, (s, i) in enumerate(scores)}
    return out


@pytest.mark.parametrize("cap", [60, 32_768])
def test_search_over_many_trees(spark, cap):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 8))
    rows = [(k, (centres[k % 6] + 0.2 * rng.normal(size=8)).tolist()) for k in range(700)] + [(1000 + k, [0.5] * 8) for k in range(300)]
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8), (2004, [0.25, 0.5]), (2005, []), (None, [1.0] * 8), (2010, [-9.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("v", F.lit(2))
    got = {tuple(r) for r in mtree.top_k(df, F.col("id") % 25 == 0, cap=cap, block=16, pivots=7).select("query_id", "rank", "id", "score").collect()}
    assert got == nearest(rows, 5, lambda q: q % 25 == 0)


def test_search_in_small_tables(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in mtree.top_k(df, F.col("id") == 0).select("query_id", "rank", "id", "score").collect())
    assert got == [(0, 1, 1, 131072), (0, 2, 1, 131072)]
    assert mtree.top_k(df.limit(0), F.col("id") == 0).collect() == []


@pytest.mark.parametrize("large", [33_000.0, 1e7, 1e15, 1e30, 1e120])
def test_scores_beyond_doubles(spark, large):
    """Large components cost exactness nowhere; scores that no long holds are the nearest long."""
    rng = np.random.default_rng(2)
    rows = [(k, (rng.normal(size=4) * (large if k % 50 == 7 else 3 if k % 2 else large / 7)).tolist()) for k in range(300)] + [(400, [large] * 4), (401, [large] * 4), (425, [-large] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in mtree.top_k(df, F.col("id") % 25 == 0, pivots=3).select("query_id", "rank", "id", "score").collect()}
    assert got == nearest(rows, 5, lambda q: q % 25 == 0)


def test_search_over_several_levels():
    """Pages of pages, with ties and floors, against all products; most pages stay closed."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(30, 6)) * 400
    points = np.floor(np.concatenate([centres[rng.integers(0, 30, 9000)] + 20 * rng.normal(size=(9000, 6)), np.full((500, 6), 90.0)]))
    ids = rng.permutation(len(points))
    longest = float((points * points).sum(axis=1).max())
    tree = mtree.Tree(ids, mtree._lift(points, longest))

    def depth(page):
        children = tree.pages[page][1]
        return 1 if children is None else 1 + max(map(depth, children))

    assert depth(tree.root) >= 3
    for q in list(range(0, 9000, 600)) + [9100, 9400]:
        scores = points @ points[q]
        order = [k for k in np.lexsort((ids, -scores)) if k != q][:5]
        want = [(int(scores[k]), int(ids[k])) for k in order]
        reach = (points[q] @ points[q] + longest) / 2
        assert tree.search(int(ids[q]), points[q], reach, 5, None) == want
        assert tree.search(int(ids[q]), points[q], reach, 5, want[2][0]) == [w for w in tree.search(int(ids[q]), points[q], reach, 5, want[2][0]) if w[0] >= want[2][0]]
        assert set(want[:3]) <= set(tree.search(int(ids[q]), points[q], reach, 5, want[2][0]))


def test_tree_bounds_hold():
    rng = np.random.default_rng(8)
    points = mtree._lift(np.floor(rng.normal(size=(900, 5)) * 90), 400_000.0)
    tree = mtree.Tree(np.arange(900), points)

    def below(page):
        _, children, entries, extra, *_ = tree.pages[page]
        return entries if children is None else np.concatenate([below(c) for c in children])

    for page, (centre, children, entries, extra, away, low, cover) in enumerate(tree.pages):
        assert (np.linalg.norm(below(page) - centre, axis=1) <= cover + 1e-6).all()
        assert np.allclose(np.linalg.norm(entries - centre, axis=1), away)
    assert len(below(tree.root)) == 900


# ---- URLs


def test_url_parts_and_fixed_rules(spark):
    rows = {
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://net/": ("net", "/", "net/", "block"),
        "https://net": ("net", "", None, "allow"),
        "x://notnet/a": ("notnet", "/a", None, "allow"),
        "http://example.com/de/#q": ("example.com", "/de/", "example.com/de/", "block"),
        "http://a.org/fr/x://y": ("a.org", "/fr/x://y", "org/fr/", "allow"),
        "a.net/en/": ("", "", None, "allow"),
        "http://?q": ("", "", None, "allow"),
        "ÉÀ://Ü.NET/Ä": ("Ü.net", "/Ä", "net/", "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(k, u) for k, u in enumerate(rows)] + [(1, "https://net/"), (None, "https://net/")], "page_id int, url string")
    df = df.selectExpr("*", "1 as host", "2 as tokens", "3 as verdict")
    got = url_rules.filtered(df).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        want = list(rows.values())[r.page_id if r.page_id is not None else 1]
        assert (r.host, r.path, r.rule, r.verdict) == want
    assert url_rules.filtered(df.limit(0)).collect() == []


def test_mined_rules_judge_the_rest(spark):
    rows = [(k, f"http://ads{k % 3}.example.net/offer/{k}") for k in range(60)] + [(100 + k, f"http://w.org/fr/news{k % 4}/{k}") for k in range(60)]
    rows += [(300, "http://a.com/offer/9"), (301, "http://a.com/news1/9"), (302, "http://b.com/other")] + [(303, "http://b.com/offer")] * 50
    got = {r.page_id: r.verdict for r in url_rules.filtered(spark.createDataFrame(rows, "page_id int, url string")).collect()}
    assert (got[300], got[301], got[302], got[303]) == ("block", "allow", "allow", "block")


def test_rules_of_three_tokens(spark):
    """Two tokens tell nothing, three do; the third kind of URL has each pair of them with the other verdict."""
    block = [(k, f"http://x.net/a/b/c/{k}") for k in range(40)]
    pairs = [p for p in ("a/b", "a/c", "b/c")]
    allow = [(100 + k, f"http://y.org/fr/{pairs[k % 3]}/{k}") for k in range(90)]
    asked = [(500, "http://z.com/a/b/c"), (501, "http://z.com/a/b"), (502, "http://z.com/c/b")]
    rows = spark.createDataFrame(block + allow + asked, "page_id int, url string")
    got = {r.page_id: r.verdict for r in url_rules.filtered(rows).collect()}
    examples = spark.createDataFrame([(["a", "b", "c"], "block")] * 40 + [(p.split("/"), "allow") for p in pairs] * 30, "tokens array<string>, verdict string")
    rules, known = url_rules.mine(examples)
    found = {(tuple(r["items"]), r.verdict) for r in rules.collect()}
    assert (("a", "b", "c"), "block") in found and got[500] == "block"
    assert {r.token: r["item"] for r in known.collect()} == {"a": "a", "b": "b", "c": "c"}


def test_long_hot_urls(spark):
    """Forty parts in one URL that many rows have are one item; a part of them is enough to be judged."""
    path = "/".join(f"part{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40))
    rows = [(k, f"http://a.net/{path}") for k in range(200)] + [(300 + k, f"http://b.org/fr/news{k}") for k in range(100)] + [(900, "http://c.com/partab"), (901, "http://c.com/" + "x" * 300_000), (None, None), (None, None)]
    got = {r.page_id: r.verdict for r in url_rules.filtered(spark.createDataFrame(rows, "page_id int, url string")).collect()}
    assert (got[0], got[900], got[901], got[None]) == ("block", "block", "allow", "allow")
    examples = spark.createDataFrame([(path.split("/"), "block")] * 20 + [(["news"], "allow")] * 20, "tokens array<string>, verdict string")
    assert {tuple(r["items"]) for r in url_rules.mine(examples)[0].collect()} == {("partaa",), ("news",)}


# ---- pipeline


def stages(spark, docs):
    """(name, rows) after every stage."""
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        yield name, docs


def test_pipeline(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(None, None), (None, ""), (10**9, "the same row"), (10**9, "the same row"), (10**9 + 1, "the same row"), (10**9 + 2, " ".join(f"word{k}" for k in range(60_000)))]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", None, None) for i, t in extra], docs.schema)).withColumn("text", F.col("text"))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    before = docs
    for name, after in stages(spark, docs):
        old, new = before.collect(), after.collect()
        if name != "tokens":
            assert after.schema == before.schema
        if name == "quality":
            score = quality.fit(before, labels).score(pa.array([r.text for r in old], pa.string())).to_pylist()
            want = [r for r, s in zip(old, score) if s >= 0.3]
        elif name == "near_copies":
            rows = sorted(old, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
            label = grouped([r.text for r in rows])
            assert len(new) == len(set(label))
            kept = {(r.doc_id, r.text) for r in new}
            for k in set(label):
                own = [r for r, x in zip(rows, label) if x == k]
                assert [r.doc_id for r in own if (r.doc_id, r.text) in kept][:1] == [own[0].doc_id]
            want = new
        elif name == "benchmark":
            hit = {(d, h) for d, (_, _, h, _) in zip(range(len(old)), [contaminated([(0, r.text)], items)[0] for r in old]) if h}
            want = [r for k, r in enumerate(old) if not any(k == d for d, _ in hit)]
        elif name == "personal":
            model = pii.fit(before)
            want = []
            for r in old:
                text = r.text if r.text is None else pii.masked(r.text, model.spans([r.text])[1][0])
                want.append(type(r)(**{**r.asDict(), "text": text, "n_chars": r.n_chars if text is None else len(text)}))
        else:
            want = [(r.doc_id, r.lang, r.source, len(i), i) for r in old for i in [library.encode(r.text or "", add_special_tokens=False).ids]]
        assert sorted(map(str, map(tuple, new))) == sorted(map(str, map(tuple, want))), name
        before = after


def test_pipeline_of_nothing(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
