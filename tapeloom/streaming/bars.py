"""Bars from a stream of ticks, and an idempotent running state by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_bars(ticks: DataFrame, key: str, at: str, price: str, order: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Bars (key, start, open, high, low, close, volume, n) of tumbling windows; a window is given out once the watermark has passed it.

    ``ticks`` may be a stream or a table. Rows later than ``late`` behind the greatest time seen are left out by the watermark. State is
    one row of aggregates for each open window and key.
    """
    moment = F.struct(at, order)
    marked = ticks.withWatermark(at, late)
    return marked.groupBy(F.col(key), F.window(at, width).alias("w")).agg(
        F.min_by(price, moment).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, moment).alias("close"), F.sum(price).alias("volume"), F.count(F.lit(1)).alias("n")
    ).select(key, F.col("w.start").alias("start"), "open", "high", "low", "close", "volume", "n")


def read_ticks(spark: SparkSession, folder: str, schema: str | StructType, files_per_trigger: int = 1) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def write_available(stream: DataFrame, folder: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that has arrived and stop; with the same checkpoint, a later call goes on where this one ended."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).format("parquet").trigger(availableNow=True).start(folder)
    query.awaitTermination()


def fold_batches(stream: DataFrame, key: list[str], sums: list[str], state: str, checkpoint: str) -> None:
    """Running totals by key over all batches, kept as one table a batch under ``state``; a batch that is run again changes nothing.

    Batch n is merged into the table of batch n - 1 and written as that of batch n, so a repeat writes the same again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.groupBy(*key).agg(*[F.sum(s).alias(s) for s in sums], F.count(F.lit(1)).alias("n"))
        if number:
            fresh = spark.read.parquet(f"{state}/batch={number - 1}").unionByName(fresh).groupBy(*key).agg(*[F.sum(s).alias(s) for s in (*sums, "n")])
        fresh.write.mode("overwrite").parquet(f"{state}/batch={number}")

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
