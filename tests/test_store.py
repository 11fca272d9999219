"""The store, ingest of statements, loads and audits on small folders."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tapeloom.functions.codes import strict_code
from tapeloom.operators.bars import bars
from tapeloom.sources import ingest, store

D = dt.date


def test_months_between():
    assert store.months_between("20200101", "20200315") == [202001, 202002, 202003] and store.months_between("20191215", "20200115") == [201912, 202001]
    assert store.months_between("20200401", "20200315") == []
    with pytest.raises(ValueError):
        store.months_between("2020", "20200315")


def test_a_table_by_month_is_pruned(spark, tmp_path):
    rows = [(D(2024, m, 5), 202400 + m, "600000.SH", "qfq", float(m)) for m in range(1, 13)] + [(D(2024, 3, 6), None, "600000.SH", "qfq", 9.0)]
    spark.createDataFrame(rows, "date date, partition_month bigint, equity_code string, adjust_type string, close double").write.partitionBy("partition_month").parquet(f"{tmp_path}/k.parquet")
    df = store.in_range(spark.read.parquet(f"{tmp_path}/k.parquet"), "20240301", "20240415").select("date", "close")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*partition_month.*202403", plan) and "PushedFilters" in plan and "ReadSchema: struct<date:date,close:double>" in plan
    assert sorted(r["close"] for r in df.collect()) == [3.0, 4.0, 9.0]
    assert len(df._jdf.queryExecution().executedPlan().toString()) and df.rdd.getNumPartitions() <= 3


def test_strict_codes(spark):
    df = spark.createDataFrame([("600000",), ("600000.0",), ("sz000001",), ("600000_sh",), ("x1",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(strict_code(F.col("c"))).collect()] == ["600000.SH", "600000.SH", "000001.SZ", "600000.SH", None, None, None]
    with pytest.raises(Exception, match="no code"):
        df.select(strict_code(F.col("c"), fail=True)).collect()


def test_statement_by_candidate_headers(spark):
    df = spark.createDataFrame([("000001", "20240328", "20231231", "1,000.5", "--", "x")], ["股票代码", "公告日期", "报告期", "营业总收入", "净利润", "other"])
    fields = {"revenue": ["total_revenue", "营业总收入"], "profit": ["净利润"], "missing": ["none"]}
    out = ingest.statement(df, fields, ["code", "股票代码"], ["实际公告日期", "公告日期"], ["报告期"])
    assert tuple(out.first()) == ("000001.SZ", D(2024, 3, 28), "20231231", 1000.5, None, None)
    assert "other" not in out._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    late = ingest.statement(df.drop("公告日期"), fields, ["股票代码"], ["实际公告日期"], ["报告期"]).first()
    assert late["announcement_date"] is None and late["report_period"] == "20231231"
    assert ingest.map_fields(df, {"股票代码": "code", "营业总收入": "other"}).columns == ["code", "公告日期", "报告期", "营业总收入", "净利润", "other"]


def test_load_batch_and_create_table(spark, tmp_path):
    for i in range(4):
        spark.createDataFrame([(i, 202401 + i % 2)], "k bigint, partition_month bigint").write.parquet(f"{tmp_path}/in/f{i}")
    files = [(f"{tmp_path}/in/f{i}", "pending", 1) for i in range(4)] + [(f"{tmp_path}/in/none", "pending", 2), (f"{tmp_path}/in/bad", "invalid", 3)]
    records = spark.createDataFrame(files, "gcs_uri string, status string, extra int")
    done = ingest.load_batch(spark, records, f"{tmp_path}/out", chunk=1)
    got = {r["gcs_uri"].rpartition("/")[2]: (r["status"], r["error"] is None, r["extra"]) for r in done.collect()}
    assert got == {"f0": ("loaded", True, 1), "f1": ("loaded", True, 1), "f2": ("loaded", True, 1), "f3": ("loaded", True, 1), "none": ("failed", False, 2), "bad": ("invalid", True, 3)}
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2, 3]
    again = ingest.load_batch(spark, done.drop("error"), f"{tmp_path}/out", chunk=1)  # only the failed one is tried, nothing is loaded twice
    assert spark.read.parquet(f"{tmp_path}/out").count() == 4 and again.where("status = 'failed'").count() == 1
    table = ingest.create_table(spark.read.parquet(f"{tmp_path}/out"), f"{tmp_path}/t", cluster=["k"])
    assert table.count() == 4 and sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["partition_month=202401", "partition_month=202402"]
    assert ingest.create_table(table.where("k = 0"), f"{tmp_path}/t2", append=True).count() == 1
    assert tuple(ingest.audit_table(table, ["k", "z"], "t").first()) == ("t", "z", False) and ingest.audit_table(table.limit(0), ["k"], "e").first()["is_empty"]


def test_paths(spark):
    df = spark.createDataFrame([("a/周线/x.csv",), ("a/daily_QFQ.zip",), ("月K/y",), ("z",), (None,)], "p string")
    assert [r[0] for r in df.select(ingest.timeframe(F.col("p"))).collect()] == ["1w", "1d", "1mo", None, None]
    assert [r[0] for r in df.select(ingest.classify_path(F.col("p"), {"q": ["QFQ"], "w": ["周线", "a/"]})).collect()] == ["w", "q", "unknown", "unknown", "unknown"]
    lineage = spark.createDataFrame([("daily_qfq.zip", None), ("x.zip", "后复权.csv"), (None, None)], "source_file string, source_entry string")
    assert [r[0] for r in lineage.select(ingest.adjust_type()).collect()] == ["qfq", "hfq", "none"]


def bar_rows(spark, n=3, start=1):
    return spark.createDataFrame([("a", D(2024, 1, start + i), 10.0 + i, 12.0 + i, 9.0 + i, 11.0 + i, 4800.0, 96.0) for i in range(n)], "code string, date date, open double, high double, low double, close double, volume double, amount double")


def test_intraday(spark):
    daily = bar_rows(spark)
    for minutes in (1, 5, 15):
        out = store.intraday(daily, minutes)
        assert out.count() == 3 * 240 // minutes
        day = out.where("to_date(time) = '2024-01-02'").orderBy("time").collect()
        assert day[0]["open"] == 11.0 and abs(day[-1]["close"] - 12.0) < 1e-9 and abs(sum(r["volume"] for r in day) - 4800) < 1e-6
        assert all(10.0 <= r["low"] <= r["close"] <= r["high"] <= 13.0 for r in day) and all(abs(a["close"] - b["open"]) < 1e-12 for a, b in zip(day, day[1:]))
        assert day[0]["time"].time() == (dt.datetime(2024, 1, 2, 9, 30) + dt.timedelta(minutes=minutes)).time() and day[-1]["time"].time() == dt.time(15)
    assert [tuple(r) for r in store.intraday(daily, 15).orderBy("code", "time").collect()] == [tuple(r) for r in store.intraday(daily.repartition(3), 15).orderBy("code", "time").collect()]


def test_remembered_bars(spark, tmp_path):
    store.remember(spark, str(tmp_path), "a_qfq", bar_rows(spark, 3))
    kept = store.remember(spark, str(tmp_path), "a_qfq", bar_rows(spark, 3, start=3).withColumn("close", F.lit(99.0)))
    got = {r["date"].day: r["close"] for r in kept.collect()}
    assert got == {1: 11.0, 2: 12.0, 3: 99.0, 4: 99.0, 5: 99.0}
    assert store.covers(kept, "20240101", "20240105") and not store.covers(kept, "20240101", "20240106")


def test_labelled_counts_rows_after_filters(spark):
    rows = bar_rows(spark, 12).withColumn("close", F.when(F.dayofmonth("date") == 3, 0.0).otherwise(F.col("close")))
    got = {r["date"].day: r["label_return"] for r in store.labelled(rows, "20240101", "20240104", horizon=2).collect()}
    assert set(got) == {1, 2, 4}
    import math

    assert abs(got[1] - math.log(14 / 11)) < 1e-12  # the row of day 3 is left out, so two rows on is day 4


def test_store_of_tables(spark, data):
    s = store.Store(spark, data)
    some = [r[0] for r in bars(s.table("equity"), "qfq").select("code").distinct().limit(3).collect()]
    by_list, by_frame = s.bars(some, "20251001", "20251231"), s.bars(spark.createDataFrame([(c,) for c in some], "c string"), "20251001", "20251231")
    assert by_list.count() > 0 and sorted(map(tuple, by_list.collect())) == sorted(map(tuple, by_frame.collect()))
    assert s.bars([], "20251001", "20251231").count() == 0 and s.stock_list(inactive=True).count() >= s.stock_list("20251101").count()
