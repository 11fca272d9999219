import itertools
import json

import numpy as np
import pytest

from tapeloom.operators import drift
from tapeloom.operators.drift import Node, assign, edit_scripts, plain_value, previous_files, script, unify

FOOTER = "batch_id string, target_table string, file_seq bigint, gcs_uri string, ordinal bigint, column_name string, column_type string"
ROW = "gcs_uri string, row_no bigint, payload string"


def test_assign_is_optimal():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 5):
        for _ in range(30):
            c = rng.integers(0, 6, (n, n)).astype(float)
            best = min(sum(c[i, p[i]] for i in range(n)) for p in itertools.permutations(range(n)))
            a = assign(c)
            assert sorted(a) == list(range(n)) and sum(c[i, j] for i, j in enumerate(a)) == best


@pytest.mark.parametrize("a,b", [("1,234.50", 1234.5), ("000907.SZ", 907), ("SH600000", 600000), ("2024-01-02 00:00:00", 20240102), ("20240102", "2024/01/02"), ("--", None), (" ", None), (True, 1), ("true", 1)])
def test_plain_values(a, b):
    assert plain_value(a) == plain_value(b)


def steps(before, after, tail=(), head=()):
    return {s for s in script(before, after, [json.dumps(x) for x in tail], [json.dumps(x) for x in head]) if s[0] != "kept"}


def test_rename_by_values_and_type():
    tail = [{"code": "600000.SH", "px": 1.25, "w": 3.0}, {"code": "000001.SZ", "px": 2.5, "w": 4.0}]
    head = [{"kode": 600000, "last": "1.25", "v": 9}, {"kode": 1, "last": "2.50", "v": 8}]
    got = steps([("code", "string"), ("px", "double"), ("w", "double")], [("last", "string"), ("v", "int64"), ("kode", "int64")], tail, head)
    assert got == {("renamed", "code", "kode"), ("retyped", "code", "kode"), ("renamed", "px", "last"), ("retyped", "px", "last"), ("removed", "w", ""), ("added", "", "v")}


def test_values_overrule_names_and_names_help_without_values():
    cols = lambda n: [("id", "string"), (n, "double")]
    same, other = [{"id": "x", "vol": 5.0}, {"id": "y", "vol": 7.0}], [{"id": "x", "volume": 1.0}, {"id": "y", "volume": 2.0}]
    assert steps(cols("vol"), cols("volume"), same, other) == {("removed", "vol", ""), ("added", "", "volume")}
    assert steps(cols("VOL"), cols("vol_raw")) == {("renamed", "VOL", "vol_raw")}
    assert steps(cols("VOL"), cols("vol_raw"), [{"id": "x", "VOL": 5.0}, {"id": "y", "VOL": 7.0}], [{"id": "x", "vol_raw": 5.0}, {"id": "y", "vol_raw": 2.0}]) == {("removed", "VOL", ""), ("added", "", "vol_raw")}
    assert steps(cols("abc"), cols("xyz")) == {("removed", "abc", ""), ("added", "", "xyz")}


def test_flags_do_not_prove_a_rename():
    tail, head = [{"id": "x1", "is_st": 1, "p": 5.5}, {"id": "x2", "is_st": 0, "p": 6.5}], [{"id": "x1", "limit_up": 1, "p": 5.5}, {"id": "x2", "limit_up": 0, "p": 6.5}]
    assert steps([("id", "string"), ("is_st", "int64"), ("p", "double")], [("id", "string"), ("limit_up", "int64"), ("p", "double")], tail, head) == {("removed", "is_st", ""), ("added", "", "limit_up")}


def test_nested_trees_and_moves():
    before = [("a", "struct<x:int,y:struct<u:string,v:double>>"), ("b", "array<struct<k:int>>")]
    after = [("b", "array<struct<k:bigint,m:string>>"), ("a", "struct<x:int,y:struct<v:double>>"), ("u", "string")]
    assert steps(before, after) == {("retyped", "b.element.k", "b.element.k"), ("added", "", "b.element.m"), ("moved", "a.y.u", "u")}
    assert Node("a", before[0][1]).size == 5


def test_order_is_no_change_and_broken_records():
    cols = [("a", "int"), ("b", "int")]
    assert steps(cols, cols[::-1]) == set()
    assert {s for s in script(cols, cols, ["{", None, "[1]"], ["nonsense"]) if s[0] != "kept"} == set()


def test_previous_files_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(drift, "SEQ_BLOCK", 3)
    files = [("x", s, f"x{s}") for s in (1, 2, 5, 6, 14)] + [(None, 1, "n1"), (None, 4, "n4"), ("y", 9, "y9"), ("y", None, "yn")]
    got = {tuple(r) for r in previous_files(spark.createDataFrame(files, "batch_id string, file_seq bigint, gcs_uri string")).collect()}
    assert got == {("x2", "x1"), ("x5", "x2"), ("x6", "x5"), ("x14", "x6"), ("n4", "n1")}


def test_scripts_and_one_table(spark):
    footer = [("b", "t", 1, "f1", 1, "code", "string"), ("b", "t", 1, "f1", 2, "close", "double"), ("b", "t", 2, "f2", 1, "Code", "string"), ("b", "t", 2, "f2", 2, "last_px", "string"), ("b", "t", 2, "f2", 3, "gcs_uri", "string"), ("b", "t", 3, "f3", 1, "symbol", "int64"), ("b", "t", 3, "f3", 2, "last_px", "string")]
    rows = [("f1", 1, '{"code": "600000.SH", "close": 1.5}'), ("f1", 2, '{"code": "000002.SZ", "close": 1.25}'), ("f2", 1, '{"Code": "000002.SZ", "last_px": "1.250", "gcs_uri": "own"}'), ("f2", 2, '{"Code": "000003.SZ", "last_px": "1,002.5"}'), ("f3", 1, '{"symbol": 3, "last_px": "1002.50"}'), ("f3", 2, None), ("f9", 1, '{"z": 1}')]
    f, r = spark.createDataFrame(footer + footer[:1], FOOTER), spark.createDataFrame(rows, ROW)
    scripts = edit_scripts(f, r).cache()
    changes = {(s["gcs_uri"], s["kind"], s["old"], s["new"]) for s in scripts.where("kind <> 'kept'").collect()}
    assert changes == {("f2", "renamed", "code", "Code"), ("f2", "renamed", "close", "last_px"), ("f2", "retyped", "close", "last_px"), ("f2", "added", "", "gcs_uri"), ("f3", "renamed", "Code", "symbol"), ("f3", "retyped", "Code", "symbol"), ("f3", "removed", "gcs_uri", "")}
    out = unify(f, r, scripts)
    assert out.columns == ["gcs_uri", "row_no", "code", "gcs_uri_in", "last_px"]
    assert {tuple(x) for x in out.collect()} == {("f1", 1, "600000.SH", None, "1.5"), ("f1", 2, "000002.SZ", None, "1.25"), ("f2", 1, "000002.SZ", "own", "1.250"), ("f2", 2, "000003.SZ", None, "1,002.5"), ("f3", 1, "3", None, "1002.50"), ("f3", 2, None, None, None), ("f9", 1, None, None, None)}


def test_batches_of_other_names_come_together_by_proofs(spark):
    """Batch a shows that px is last; batch b, which begins with last, gets the same column. high and low, side by side in a file, never do."""
    cols = lambda batch, seq, *names: [(batch, "t", seq, f"{batch}{seq}", i, n, "double") for i, n in enumerate(names)]
    footer = cols("a", 1, "code", "px", "high") + cols("a", 2, "code", "last", "high") + cols("b", 1, "code", "last", "low") + cols("c", 1, "code", "high", "low") + cols("c", 2, "code", "low")
    row = lambda file, n, **kw: (file, n, json.dumps(kw))
    rows = [row("a1", 1, code=1, px=5.5, high=7.25), row("a1", 2, code=2, px=6.5, high=8.25), row("a2", 1, code=2, last=6.5, high=8.25), row("b1", 1, code=3, last=9.5, low=1.5), row("c1", 1, code=4, high=2.5, low=3.5), row("c2", 1, code=4, low=2.5)]
    f, r = spark.createDataFrame(footer, FOOTER), spark.createDataFrame(rows, ROW)
    out = unify(f, r, edit_scripts(f, r))
    assert out.columns == ["gcs_uri", "row_no", "code", "high", "last", "low"]
    assert sorted(x["last"] for x in out.where("last IS NOT NULL").collect()) == [5.5, 6.5, 6.5, 9.5]


def test_proofs_serve_files_without_values(spark):
    cols = lambda batch, seq, *names: [(batch, "t", seq, f"{batch}{seq}", i, n, "double") for i, n in enumerate(names)]
    footer = cols("a", 1, "code", "px") + cols("a", 2, "code", "last") + cols("b", 1, "code", "px") + cols("b", 2, "code", "last") + cols("c", 1, "code", "px") + cols("c", 2, "code", "last")
    rows = [("a1", 1, '{"code": 1, "px": 5.5}'), ("a2", 1, '{"code": 1, "last": 5.5}'), ("b1", 1, '{"code": 7, "px": null}'), ("b2", 1, '{"code": 7, "last": 3.5}'), ("c1", 1, '{"code": 99, "px": 4.5}'), ("c2", 1, '{"code": 99, "last": 8.5}')]
    got = {(s["gcs_uri"], s["kind"], s["old"], s["new"]) for s in edit_scripts(spark.createDataFrame(footer, FOOTER), spark.createDataFrame(rows, ROW)).where("kind <> 'kept'").collect()}
    assert got == {("a2", "renamed", "px", "last"), ("b2", "renamed", "px", "last"), ("c2", "removed", "px", ""), ("c2", "added", "", "last")}


def test_empty(spark):
    f, r = spark.createDataFrame([], FOOTER), spark.createDataFrame([], ROW)
    scripts = edit_scripts(f, r)
    assert scripts.collect() == [] and unify(f, r, scripts).collect() == []


@pytest.mark.parametrize("shared", [8, 9, 40])
def test_overlap_of_any_length(spark, shared):
    footers = [("b", "t", i, f"f{i}", k, name, kind) for i, names in enumerate((["code", "px"], ["code", "zz"])) for k, (name, kind) in enumerate(zip(names, ("string", "double")))]
    record = lambda i, name: json.dumps({"code": f"{600000 + i}.SH", name: 10.5 + 3 * i})
    rows = [("f0", i, record(i, "px")) for i in range(shared + 5)] + [("f1", i, record(i + 5, "zz")) for i in range(shared + 7)]
    got = {(r["kind"], r["old"], r["new"]) for r in edit_scripts(spark.createDataFrame(footers, FOOTER), spark.createDataFrame(rows, ROW)).collect()}
    assert got == {("kept", "code", "code"), ("renamed", "px", "zz")}
