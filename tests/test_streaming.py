from pyspark.sql import functions as F

from tapeloom.streaming import bars as stream


def ticks(spark, folder, parts):
    for i, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "k string, id bigint, ts string, v double").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(str(folder))


SCHEMA = "k string, id bigint, ts timestamp, v double"


def test_bars_of_a_stream_equal_those_of_a_table(spark, tmp_path):
    rows = [(k, i, f"2024-01-01 10:{i:02d}:30", float((i * 7) % 11)) for i in range(50) for k in "ab"]
    ticks(spark, tmp_path / "in", [rows[:40], rows[40:], [("z", 1, "2024-01-01 12:00:00", 0.0)], [("z", 2, "2024-01-01 13:00:00", 0.0)]])
    source = stream.read_ticks(spark, str(tmp_path / "in"), SCHEMA)
    stream.write_available(stream.stream_bars(source, "k", "ts", "v", "id"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).where("k <> 'z'").collect()}
    table = spark.read.parquet(str(tmp_path / "in")).where("k <> 'z'")
    assert got == {tuple(r) for r in stream.stream_bars(table, "k", "ts", "v", "id").collect()} and len(got) == 20


def test_running_totals_are_idempotent(spark, tmp_path):
    ticks(spark, tmp_path / "in", [[("a", 1, "2024-01-01 10:00:00", 1.0)], [("a", 2, "2024-01-01 10:01:00", 2.0), ("b", 3, "2024-01-01 10:01:00", 5.0)]])
    for _ in range(2):  # the second run finds nothing new
        source = stream.read_ticks(spark, str(tmp_path / "in"), SCHEMA)
        stream.fold_batches(source, ["k"], ["v"], str(tmp_path / "state"), str(tmp_path / "cp"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "state" / "batch=1")).collect()} == {("a", 3.0, 2), ("b", 5.0, 1)}
