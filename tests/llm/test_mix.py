import random

import numpy as np
import pytest

from tapeloom.llm.mix import Classifier, features, mix

TARGETS = "source string, target_weight double, max_repeats int"
DOCS = "doc_id bigint, text string, source string"


def docs(n=900, seed=1):
    rnd = random.Random(seed)
    words = {"news": ["rose", "fell", "shares", "close"], "forum": ["涨停", "跌了", "加仓", "核按钮"], "log": ["INFO", "rows=10", "ERROR", "load"]}
    out = []
    for i in range(n):
        kind = rnd.choice(["news"] * 6 + ["forum"] * 3 + ["log"])
        label = rnd.choice([kind, kind.upper(), f" {kind} ", None] if i % 9 == 0 else [kind])
        out.append((i, " ".join(rnd.choice(words[kind]) for _ in range(rnd.randrange(1, 60))), label))
    return out


def run(spark, rows, targets, **kw):
    m = mix(spark.createDataFrame(rows, DOCS), spark.createDataFrame(targets, TARGETS), "doc_id", "text", "source", **kw)
    return [r.asDict() for r in m.documents.collect()], {r["source"]: r.asDict() for r in m.shares.collect()}


def test_shares_and_caps(spark):
    documents, shares = run(spark, docs(), [("news", 0.3, 1), ("forum", 0.5, 2), ("none-such", 0.2, 3)])
    assert len(documents) == 900
    drawn = sum(s["drawn"] for s in shares.values())
    assert shares["news"]["drawn"] / drawn == pytest.approx(0.3 / 0.8, abs=0.03) and shares["forum"]["drawn"] / drawn == pytest.approx(0.5 / 0.8, abs=0.03)
    assert shares["none_such"]["drawn"] == 0 and shares["log"]["drawn"] == 0
    assert max(d["copies"] for d in documents if d["source"] == "forum") <= 2 and max(d["copies"] for d in documents if d["source"] == "news") <= 1
    assert all(d["copies"] <= 1 for d in documents if d["source"] is None) and sum(s["share"] for s in shares.values()) == pytest.approx(1, abs=1e-4)
    for d in documents:
        assert d["rate"] >= 0 and abs(d["copies"] - d["rate"]) <= 1 or d["n_tokens"] < 20


def test_any_number_of_sources(spark):
    """200 stated sources, 70 of them targets: all targets are told apart, the others belong to none."""
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["rose", "fell", "涨停"]) for _ in range(rnd.randrange(5, 40))), f"s{i % 200:03d}") for i in range(4000)]
    m = mix(spark.createDataFrame(rows, DOCS), spark.createDataFrame([(f"s{k:03d}", 1 / 70, 1) for k in range(70)], TARGETS), "doc_id", "text", "source")
    shares = {r["source"]: r for r in m.shares.collect()}
    assert len(shares) == 200 and all((shares[f"s{k:03d}"]["drawn"] > 0) == (k < 70) for k in range(200))
    assert all(abs(shares[f"s{k:03d}"]["share"] - 1 / 70) < 0.004 for k in range(70)) and m.residual <= 1e-4


def test_asked_total(spark):
    _, shares = run(spark, docs(), [("news", 0.5, 1), ("forum", 0.5, 1)], tokens=4000)
    assert shares["news"]["drawn"] == pytest.approx(2000, rel=0.1) and shares["forum"]["drawn"] == pytest.approx(2000, rel=0.1)


def test_nulls_empty_and_repeats(spark):
    rows = [(1, None, "news"), (2, "", "news"), (None, "some text", "news"), (3, "some text", None), (4, "some text", "news"), (4, "some text", "news"), (5, "x" * 100_000, "news")]
    documents, shares = run(spark, rows, [("news", 1.0, 2)])
    assert len(documents) == 7 and shares["news"]["documents"] == 6 and shares["news"]["share"] > 0.99
    documents, shares = run(spark, [], [("news", 1.0, 2)])
    assert documents == [] and shares["news"]["drawn"] == 0
    documents, shares = run(spark, rows, [])
    assert len(documents) == 7 and all(d["copies"] == 0 for d in documents)


def test_bad_targets(spark):
    for targets in ([(None, 1.0, 1)], [("a", 0.5, 1), ("A", 0.5, 1)]):
        with pytest.raises(ValueError):
            run(spark, docs(10), targets)


def test_extra_columns(spark):
    df = spark.createDataFrame([(*d, 1, "t") for d in docs(50)], DOCS + ", n_tokens int, id string")
    assert mix(df, spark.createDataFrame([("news", 1.0, 1)], TARGETS), "doc_id", "text", "source").documents.count() == 50


def test_classifier_on_held_out_texts():
    rows = [r for r in docs(1200, 3) if r[2] in ("news", "forum", "log")]
    names = ["forum", "log", "news"]
    x, y = np.stack([features(t) for _, t, _ in rows]), np.array([names.index(s) for _, _, s in rows])
    model = Classifier.fit(x[:600], y[:600], names, np.full(3, 1 / 3))
    assert (model.posterior(x[600:]).argmax(1) == y[600:]).mean() > 0.95
    assert features(None).sum() == 0 and features("a").sum() == 0
