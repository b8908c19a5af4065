"""Base spans against the patterns as given, the trees, and what the method adds."""

import hashlib
import re

import numpy as np
from hypothesis import example, given, settings
from hypothesis import strategies as st

from matchgrid.llm import pii

SF = "/root/testdata/sf0.001"
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            valid = True
            if kind == 1:
                valid = all(int(p) <= 255 for p in m[0].split("."))
            elif kind == 2:
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(digits[::-1])]
                valid = 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
            elif kind == 3:
                valid = 9 <= len(digits) <= 15
            if valid:
                out.append((kind, m.start(), m.end()))
    return sorted(out)


PART = st.sampled_from(["a", "Z9", "@", ".", "-", " ", "+", "+1", "(", ")", "1", "25", "256", "4111111111111111", "4111 1111 1111 1111", "10.0.0.1", "x@y.de", "_%", "é", "٣", "\n", "555", "0", "00", "-1"])


@settings(max_examples=500, deadline=None)
@given(st.lists(PART, max_size=25).map("".join))
@example("a@b.c@d.e x@@y.z 1.2.3.4.5.6.7.8 999.1.1.1 +1 (853) 555-6478 + 1 4111-1111-1111-1111 .@-.-")
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_are_quick():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + "(" * 200_000, "@a" * 50_000, "1 " * 100_000, "(1" * 50_000):
        pii.Model().spans([text])
        list(pii.proposals(text))


def test_neighbouring_numbers_are_proposed():
    def of(text, kind):
        return {text[s:e] for k, s, e in pii.proposals(text) if k == kind}

    assert {"7536784127813050", "4845168114407329"} <= of("7536784127813050 4845168114407329", 2)
    phones = [f"({200 + k}) 555-{1000 + k}" for k in range(30)]
    for mark in (" ", "-", " / "):
        assert set(phones) <= of("call " + mark.join(phones), 3)
    assert {"10.0.0.1", "10.0.0.2"} <= of("10.0.0.1 10.0.0.2", 1)


def test_many_proposals_are_scored_in_parts(monkeypatch):
    texts = ["853 555 6478 " * 50, "", "1 " * 300, "7536784127813050 4845168114407329"]
    rows = np.array([pii.features(t, *p) for t in texts for p in pii.proposals(t)], float)
    model = pii.Model(pii.boost(rows, (rows[:, 2] % 10 == 0).astype(int), np.ones(len(rows)), rounds=5), [0.3] * 4)
    whole = model.added(texts, [[] for _ in texts])
    monkeypatch.setattr(pii, "CHUNK", 7)
    assert model.added(texts, [[] for _ in texts]) == whole and any(whole)
    for spans in whole:
        ordered = sorted((s, e) for _, s, e in spans)
        assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))


def test_trees_learn():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(int)
    model = pii.boost(x[:2000], y[:2000], np.ones(2000))
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def corpus():
    rng = np.random.default_rng(5)
    out = []
    for k in range(400):
        body = 400000000000000 + int(rng.integers(10**14))
        card = next(f"{body}{d}" for d in range(10) if pii.luhn(f"{body}{d}"))
        out.append((k, f"word word{k} mail a{k}.b@mail{k % 9}.example.com then +1 ({200 + k % 700}) 555-{1000 + k} or {card} at {k % 250}.7.{k % 99}.1 ok 2024-01-{k % 28 + 1:02d} no {k}{k * 7919}"))
    return out


def test_adds_other_forms_and_leaves_clean_text(spark):
    model = pii.fit(spark.createDataFrame(corpus(), "doc_id long, text string"))
    assert model.trees is not None
    texts = ["call (853) 555-6478 now", "write jo.doe23 at mail3 dot example dot com please", "the cat sat at home. It was 12 May 2024, page 1234.", "token a038f8b93202544b5d4b500d8cce257d12d61a70 and 4111111111111112"]
    base, every = model.spans(texts)
    assert base == [[], [], [], []]
    assert any(k == 3 for k, _, _ in every[0]) and any(k == 0 for k, _, _ in every[1])
    assert every[2:] == [[], []]


def test_real_neighbours_and_loose_forms_are_no_counterexamples(spark):
    """Loose forms that the corpus itself holds do not lift the thresholds; addresses with colons are learned."""
    rows = [(k, f"{text} or ({300 + k % 600}) 555-{2000 + k} and ({301 + k % 600}) 555-{3000 + k}") for k, text in corpus()]
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert max(model.limits) < 1

    def found(text):
        return [(pii.KINDS[k], text[s:e]) for k, s, e in model.spans([text])[1][0]]

    assert found("call (853) 555-6478 now") == [("phone", "(853) 555-6478")]
    assert found("paid 7536784127813050 4845168114407329 then") == [("card", "7536784127813050"), ("card", "4845168114407329")]
    assert found("from 2001:db8:85a3:8d3:1319:8a2e:370:7348 today") == [("ip", "2001:db8:85a3:8d3:1319:8a2e:370:7348")]
    assert found("on 2024-01-12 at 12:30:45:10 the mac 00:1a:2b:3c:4d:5e") == []


def test_masking():
    text = "é x@y.de, +1 (853) 555-6478 end"
    assert pii.masked(text, pii.base_spans(text)) == "é [EMAIL], [PHONE] end"
    assert pii.masked("abcdef", [(0, 1, 4), (3, 2, 6)]) == "a[EMAIL]"


def test_query(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = pii.op5_pii(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain(rows[r.doc_id])
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for k, _, _ in base) for j in range(4)]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_edge_cases(spark):
    rows = [(None, "null a@b.c"), (1, None), (2, ""), (3, "x" * 100_000 + " a@b.c"), (4, "a@b.c"), (4, "a@b.c")]
    df = spark.createDataFrame(rows, "doc_id int, text string").selectExpr("*", "1 as id", "2 as base", "3 as spans")
    got = sorted(((r.id, r.base, r.spans) for r in pii.found_spans(df, pii.fit(df)).collect()), key=str)
    assert [r[1] for r in got] == ["", "", "email:100001:100006", "email:0:5", "email:0:5", "email:5:10"]
    none = df.limit(0)
    assert pii.found_spans(none, pii.fit(none)).collect() == []
    out = pii.redacted(df, pii.Model())
    assert out.schema == df.schema and sorted(str(r.text)[-7:] for r in out.filter("doc_id = 4 or doc_id = 1").collect()) == ["None", "[EMAIL]", "[EMAIL]"]


def test_long_spelled_addresses_are_whole():
    name = "a" * 70
    for text in (f"write to {name} at example.org today", f"{name}(at)example(dot)org"):
        assert any(k == 0 and text[s:e].startswith(name) for k, s, e in pii.proposals(text))
    assert sum(1 for _ in pii.proposals("a" * 200_000 + " at b.c")) == 1


def test_learning_keeps_different_texts(spark):
    """Rows of one id, or without one, are no group of their own: texts are drawn by id and text."""
    rows = [(1, f"call +49 170 {1000000 + k} or mail a{k}@b.de") for k in range(300)] + [(None, "call +49 170 1234567")] * 50
    model = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"), rows=20, examples_kept=500)
    assert model.spans(["mail a5@b.de"])[0][0] == [(0, 5, 12)]
