import random

from tapeloom.operators.archive import index, pack, plan_blocks, record_files, records, small_files, unpack

LOADS = "gcs_uri string, object_size bigint, object_generation string, status string"
SIZES = "gcs_uri string, size bigint"


def small(spark, loads, sizes, limit=100):
    return {tuple(r) for r in small_files(spark.createDataFrame(loads, LOADS), spark.createDataFrame(sizes, SIZES), limit).collect()}


def test_small_files(spark):
    loads = [
        ("a", 10, "9", "loaded"), ("a", 500, "10", "loaded"),  # newest by number
        ("b", 500, "9", "loaded"), ("b", 0, "10", "loaded"),
        ("c", 5, "1", " Invalid "), ("d", None, "1", "failed"), ("e", None, "1", "loaded"), ("f", 99, None, None), ("g", 100, "1", "x"),
        ("h", 1, "1", "loaded"), ("h", 1, "1", "loaded"), (None, 1, "1", "loaded"),
    ]
    assert small(spark, loads, [("d", 7), ("d", 7), ("a", 1), (None, 3), ("e", None)]) == {("b", 0), ("d", 7), ("f", 99), ("h", 1)}
    assert small(spark, [], []) == set()


def test_blocks_do_not_overlap(spark):
    rnd = random.Random(2)
    files = [(f"f{i % 900}", rnd.choice([0, 1, 50, 99])) for i in range(1000)] + [("z", None)]
    rows = plan_blocks(spark.createDataFrame(files, "path string, size bigint"), block_bytes=400).collect()
    assert len(rows) == 1001
    blocks = {}
    for r in rows:
        blocks.setdefault(r["block_id"], []).append((r["offset"], r["length"]))
    for spans in blocks.values():
        spans.sort()
        at = 0
        for offset, length in spans:
            assert offset == at
            at += length
        assert at < 400 + 99
    assert len(blocks) < 2.5 * sum(s or 0 for _, s in files) / 400 + 4
    assert plan_blocks(spark.createDataFrame([], "path string, size bigint")).collect() == []


def test_round_trip(spark):
    rnd = random.Random(3)
    files = [(f"p{i}", i % 3, rnd.randbytes(rnd.choice([0, 1, 1000, 5000]))) for i in range(300)]
    files += [("p1", 1, b"again"), ("p1", 1, b"again"), ("ü\n", 0, b"x"), (None, None, b"null path"), ("big", 0, rnd.randbytes(200_000)), ("none", 0, None)]
    blocks = pack(spark.createDataFrame(files, "path string, part bigint, data binary"), block_bytes=20_000).cache()
    got = unpack(blocks).collect()
    assert all(r["intact"] for r in got)
    key = lambda x: (x[0] or "", x[1] or 0, bytes(x[2]))
    assert sorted(((r["path"], r["part"], bytes(r["data"])) for r in got), key=key) == sorted(((p, n, b or b"") for p, n, b in files), key=key)
    assert index(blocks).count() == len(files) and 20 < blocks.count() < 60


def test_record_files(spark):
    schema = "gcs_uri string, row_no bigint, payload string"
    rows = [("a", i, f'{{"k": "{i}\n"}}') for i in range(50)] + [("b", 1, None), ("b", 2, ""), ("b", 3, "x" * 100_000), ("ß", 1, " \t é\\n"), ("c", None, "n")]
    df = spark.createDataFrame(rows, schema)
    got = records(unpack(pack(record_files(df, part_rows=7)))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rows, key=repr)
    assert records(unpack(pack(record_files(spark.createDataFrame([], schema))))).collect() == []


def test_found_files_are_planned(spark, data, monkeypatch):
    from tapeloom.plans import prepared

    kept = {}
    monkeypatch.setattr(prepared, "materialize", lambda df, name: kept.setdefault(name, df))
    prepared.p5_found(spark, data)
    assert {"path", "block_id", "offset", "length"} <= set(kept["p5-plan"].columns)


def test_files_of_a_folder_come_back_one_by_one(spark, tmp_path):
    """Real files, nested and of odd names: packed, written, looked up by path; only the blocks of that path are read."""
    from tapeloom.operators.archive import lookup, read_files, write_archive

    rnd, files = random.Random(4), {}
    for i in range(60):
        path = tmp_path / "in" / f"d{i % 7}" / f"file {i} ü.bin"
        path.parent.mkdir(parents=True, exist_ok=True)
        files[f"file:{path}"] = rnd.randbytes(rnd.choice([0, 1, 700, 9_000]))
        path.write_bytes(files[f"file:{path}"])
    (tmp_path / "in" / "large.bin").write_bytes(b"x" * 50_000)
    blocks = pack(read_files(spark, f"file://{tmp_path}/in", limit=20_000), block_bytes=30_000)
    write_archive(blocks, f"file://{tmp_path}/out")
    rows = spark.read.parquet(f"{tmp_path}/out/index").collect()
    names = {r["path"] for r in rows}
    assert names == set(files) and len(rows) == 60 and not any("large" in n for n in names)
    for name in rnd.sample(sorted(names), 12):
        assert lookup(spark, f"file://{tmp_path}/out", name) == files[name]
    assert lookup(spark, f"file://{tmp_path}/out", "none") is None


def test_a_broken_entry_is_an_error(spark):
    from pyspark.sql import functions as F

    blocks = pack(spark.createDataFrame([("a", 0, b"one"), ("b", 0, b"two")], "path string, part bigint, data binary"))
    spoilt = blocks.withColumn("data", F.expr("cast(replace(cast(data as string), 'two', 'tow') as binary)"))
    assert {r["path"]: r["intact"] for r in unpack(spoilt, check=False).collect()} == {"a": True, "b": False}
    try:
        unpack(spoilt).collect()
        raise AssertionError("no error")
    except Exception as e:  # noqa: BLE001
        assert "checksum differs: b part 0" in str(e)
