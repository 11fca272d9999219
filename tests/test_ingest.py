import datetime as dt
import zipfile

from pyspark.sql import functions as F

from tapeloom.functions import clean
from tapeloom.sources import ingest


def test_csv_and_zip_to_months(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "sub").mkdir(parents=True)
    (raw / "a.csv").write_bytes("﻿日期, 股票代码,收盘\n2024-01-02,600000,1.5\n2024/02/03,000001,\nbroken,row\n20240204,sh600001,2\n".encode())
    (raw / "sub" / "b_20231231.csv").write_bytes("code,备注\n430001,北交\n".encode("gb18030"))
    (raw / "empty.csv").write_bytes(b"")
    with zipfile.ZipFile(raw / "z.zip", "w") as z:
        z.writestr("in/x.csv", "date,code,source_file\n2024-03-01,300001_sz,own\n")
        z.writestr("in/readme.txt", "no")
    rows = ingest.read_raw(spark, str(raw)).cache()
    names = ingest.columns_of(rows)
    assert rows.count() == 5 and names == sorted(["日期", "股票代码", "收盘", "code", "备注", "date", "source_file"])
    out = ingest.enrich(rows, names)
    ingest.write_months(out, str(tmp_path / "out"), ["security_code"])
    got = {(r["security_code"], str(r["partition_month"]), r["收盘"], r["source_file_in"], ingest.file_name(r["source_file"]), r["source_entry"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert ("600000.SH", "202401", "1.5", None, "a.csv", None) in got and ("600001.SH", "202402", "2", None, "a.csv", None) in got
    assert {g[0] for g in got if g[1] == "202402"} == {"000001.SZ", "600001.SH"} or len(got) == 5
    assert any(g[1] == "202312" and g[4] == "b_20231231.csv" for g in got) and any(g[3] == "own" and g[5] == "in/x.csv" for g in got)
    listed = {(r["partition_month"], r["format"], r["status"]) for r in ingest.manifest(spark, str(tmp_path / "out")).where("format IS NOT NULL").collect()}
    assert listed == {(m, "PARQUET", "pending") for m in ("202401", "202402", "202403", "202312")}


def test_manifest_rules(spark):
    rows = [("t", "202401", "gs://b/t/partition_month=202401/a.parquet", 5, 3), ("t", "202413", "gs://b/t/partition_month=202413/a.parquet", 0, 3), ("t", "all", "x", None, None), ("t", "all", "x", 1, 1), (None, None, None, 1, 1)]
    df = spark.createDataFrame(rows, "target_table string, partition_month string, gcs_uri string, size bigint, rows bigint")
    assert {r["rule"]: r["failures"] for r in ingest.audit_manifest(df).collect()} == {"month is YYYYMM or all": 2, "size is positive": 2, "rows are positive": 1, "path holds table and month": 3, "path is unique": 1}


def test_log_rows(spark):
    lines = ["x DAY_SUMMARY date=20200102 nav=1.5 note=a=b", "DAY_SUMMARY date=20200103 nav=2", "noise date=1", "y DAY_SUMMARY date=20200102 nav=3", "DAY_SUMMARY nav=9", "DAY_SUMMARY date=20200104 date=20200104 k"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no bigint, value string")
    assert {r["date"]: r["fields"].get("nav") for r in ingest.log_rows(df, "DAY_SUMMARY", "date").collect()} == {"20200102": "3", "20200103": "2", "20200104": None}


def test_cleaners(spark):
    row = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    L = F.lit
    assert [row(clean.loose_date(L(x))) for x in ("20231231.0", "202402", "2023", "2024-13-01", " 2024/05/06 ", "20240506 10:00", "x", "")] == [dt.date(2023, 12, 31), dt.date(2024, 2, 1), dt.date(2023, 12, 31), None, dt.date(2024, 5, 6), dt.date(2024, 5, 6), None, None]
    assert [row(clean.truth(L(x))) for x in (" 是 ", "N", "最新", "0", "maybe", "")] == [True, False, True, False, None, None]
    assert [row(clean.streak_count(L(x))) for x in ("首板", "3连板", "2", "none", "")] == [1, 3, 2, None, None]
    assert [row(clean.finite(L(x))) for x in ("1.5", "NaN", "Infinity", "x")] == [1.5, None, None, None]
    assert str(row(clean.number(L(" 1.25 ")))) == "1.250000000" and row(clean.number(L("1,2"))) is None
    assert row(ingest.path_date(L("full/202401/x_20240230/2024-03-05_y.csv"))) == dt.date(2024, 3, 5) and row(ingest.path_date(L("none"))) is None
    assert clean.first_existing(["a", "b"], ["c", "b"]) == "b" and clean.first_existing(["a", "b"], ["c"], 1) == "a" and clean.first_existing(["a"], ["c"], 5) is None
