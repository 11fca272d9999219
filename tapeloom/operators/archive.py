"""Many small files into few archive blocks: original bytes with path, offset, length and checksum."""

from __future__ import annotations

import math
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions.codes import strip

#: Files under this size count as small.
SMALL_BYTES = 8 * 1024 * 1024
#: A block is closed by the file that fills it to this size, so it ends under BLOCK_BYTES plus one file.
BLOCK_BYTES = 32 * 1024 * 1024
#: Blocks and entries planned together in one task.
SHARD_BLOCKS, SHARD_ENTRIES = 4, 500_000
#: Rows of a record file that make up one archive entry.
PART_ROWS = 4096


def small_files(loads: DataFrame, sizes: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """(path, size) of the files whose newest load record is valid and whose size is under ``limit``, zero included.

    The newest record of a ``gcs_uri`` has the greatest ``object_generation`` as a number (no digits: least); of equal ones that with the
    greatest other fields. A status of ``invalid``, in any case and with outer blanks, leaves the file out; a null status doesn't. The
    size is ``object_size`` of that record or, if null, the greatest ``size`` of ``sizes``; a file with neither is left out. Null paths
    are ignored, repeated records count once, and empty inputs give no rows.
    """
    newest = loads.where("gcs_uri IS NOT NULL").groupBy("gcs_uri").agg(
        F.max(F.struct(F.expr("try_cast(object_generation AS DECIMAL(38, 0))").alias("generation"), "object_size", "status")).alias("r")
    )
    valid = newest.where(F.coalesce(F.lower(strip(F.col("r.status"))) != "invalid", F.lit(True)))
    other = sizes.where("gcs_uri IS NOT NULL").groupBy("gcs_uri").agg(F.max("size").alias("listed"))
    sized = valid.join(other, "gcs_uri", "left").select(F.col("gcs_uri").alias("path"), F.coalesce("r.object_size", "listed").alias("size"))
    return sized.where(F.col("size") < limit)


def plan_blocks(entries: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``entries`` (with ``path`` and ``size``, and any others) with ``block_id``, ``offset`` in the block and ``length``.

    Entries are spread over shards of about SHARD_BLOCKS blocks by a hash of their path and laid end to end inside a shard in the order of
    their paths; a block takes the entries that start within ``block_bytes`` of its beginning. The shard count follows from the total
    size and number of the entries, so no task sees more than its shard. Null sizes count as zero; repeated entries are laid out one
    after the other; empty input gives no rows.
    """
    total, number = entries.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(1, math.ceil(total / (SHARD_BLOCKS * block_bytes)), math.ceil(number / SHARD_ENTRIES))
    ties = [c for c, kind in entries.dtypes if c not in ("path", "size") and kind in ("string", "bigint", "int")]
    ordered = Window.partitionBy("__shard").orderBy("path", *ties, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.coalesce("size", F.lit(0)).cast("bigint")
    laid = (
        entries.withColumn("__shard", F.pmod(F.xxhash64("path", *ties), F.lit(shards)))
        .withColumn("length", length)
        .withColumn("__start", F.sum("length").over(ordered) - F.col("length"))
        .withColumn("__no", F.floor(F.col("__start") / F.lit(block_bytes)))
    )
    inside = Window.partitionBy("__shard", "__no")
    return laid.select(
        *entries.columns, F.concat_ws("-", F.lpad(F.col("__shard").cast("string"), 6, "0"), F.lpad(F.col("__no").cast("string"), 4, "0")).alias("block_id"),
        (F.col("__start") - F.min("__start").over(inside)).alias("offset"), "length",
    )


def pack(contents: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Archive blocks of ``contents`` (path, part, data): (block_id, data, entries), one row a block.

    ``data`` holds the original bytes end to end, ``entries`` the block's index: path, part, offset, length and sha256 of each. The bytes
    are shuffled once, by shard, and a block's row is bounded by ``block_bytes`` plus one entry; entries must each be small. Null data is
    packed as an entry of length zero, so it comes back empty. Nothing is lost or doubled: repeated paths stay repeated.
    """
    sized = contents.select("path", "part", F.coalesce("data", F.lit(b"")).alias("data")).withColumn("size", F.length("data").cast("bigint"))
    planned = plan_blocks(sized, block_bytes)
    entry = F.struct("offset", "length", "path", "part", F.sha2("data", 256).alias("sha256"))
    return planned.select("block_id", "offset", "data", entry.alias("entry")).groupBy("block_id").agg(
        F.expr("listagg(data) WITHIN GROUP (ORDER BY offset, entry.length)").alias("data"), F.array_sort(F.collect_list("entry")).alias("entries")
    )


def index(blocks: DataFrame) -> DataFrame:
    """(path, part, block_id, offset, length, sha256) of every entry; reads no bytes."""
    e = blocks.select("block_id", F.explode("entries").alias("e"))
    return e.select("e.path", "e.part", "block_id", "e.offset", "e.length", "e.sha256")


def unpack(blocks: DataFrame, check: bool = True) -> DataFrame:
    """(path, part, data, intact): the original bytes of every entry, cut out of its block, and whether they still have their checksum.

    ``check`` makes an entry that has another checksum an error that names it; without it such entries come out with ``intact`` false.
    Each block is read by itself: no join, no shuffle.
    """
    cut = F.transform(
        "entries",
        lambda e: F.struct(
            e["path"].alias("path"), e["part"].alias("part"), F.substring(F.col("data"), (e["offset"] + 1).cast("int"), e["length"].cast("int")).alias("data"), e["sha256"].alias("sha256")
        ),
    )
    out = blocks.select(F.explode(cut).alias("e")).select("e.path", "e.part", "e.data", (F.sha2("e.data", 256) == F.col("e.sha256")).alias("intact"))
    if not check:
        return out
    broken = F.raise_error(F.concat(F.lit("checksum differs: "), F.coalesce("path", F.lit("null")), F.lit(" part "), F.coalesce(F.col("part").cast("string"), F.lit("null"))))
    return out.select("path", "part", F.when(F.col("intact"), F.col("data")).otherwise(broken.cast("binary")).alias("data"), "intact")


def write_archive(blocks: DataFrame, folder: str) -> None:
    """Blocks as Parquet files of one block each, in folders of their ``block_id``, and the index beside them, sorted by path."""
    blocks.repartition("block_id").write.mode("errorifexists").partitionBy("block_id").parquet(f"{folder}/blocks")
    index(blocks.sparkSession.read.schema(blocks.schema).parquet(f"{folder}/blocks")).repartitionByRange("path").sortWithinPartitions("path", "part").write.mode("errorifexists").parquet(f"{folder}/index")


def lookup(spark: SparkSession, folder: str, path: str) -> bytes | None:
    """The bytes of one file of a written archive; None if it isn't there, checked against its checksums.

    The index is sorted, so few of its row groups are read, and then only the blocks that hold parts of the file, by their folders. The
    file is put together on the driver, so it has to fit there.
    """
    found = spark.read.parquet(f"{folder}/index").where(F.col("path") == path).select("block_id").distinct().collect()
    if not found:
        return None
    blocks = spark.read.option("basePath", f"{folder}/blocks").option("recursiveFileLookup", "false").parquet(*[f"{folder}/blocks/block_id={r[0]}" for r in found])
    rows = unpack(blocks).where(F.col("path") == path).orderBy("part").select("data").collect()
    return b"".join(bytes(r[0]) for r in rows)


def read_files(spark: SparkSession, folder: str, limit: int = SMALL_BYTES) -> DataFrame:
    """(path, part, data) of the files under ``limit`` bytes in a folder and the folders below it, each as one part: what :func:`pack`
    takes. Greater files are left where they are. Scans pass over files of no bytes, so those are taken from the listing, which the
    driver holds anyway, and come out with empty data."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    listed = spark.createDataFrame([(unquote(name).replace("file:///", "file:/"),) for name in files.inputFiles()], "path STRING")
    empty = listed.join(files.select("path"), "path", "left_anti").select("path", F.lit(0).cast("bigint").alias("part"), F.lit(b"").alias("data"))
    return files.where(F.col("length") < limit).select("path", F.lit(0).cast("bigint").alias("part"), F.col("content").alias("data")).unionByName(empty)


def record_files(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(path, part, data) of the record files in ``rows`` (gcs_uri, row_no, payload): a line of JSON for each record, in order.

    A file is cut into entries of ``part_rows`` row numbers, so a file with any share of all rows is never gathered as one.
    """
    line = F.to_json(F.struct("row_no", "payload"))
    part = F.floor(F.coalesce("row_no", F.lit(0)) / F.lit(part_rows)).alias("part")
    grouped = rows.select(F.col("gcs_uri").alias("path"), part, "row_no", line.alias("line")).groupBy("path", "part")
    return grouped.agg(F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY row_no, line)").cast("binary").alias("data"))


def records(unpacked: DataFrame) -> DataFrame:
    """The rows (gcs_uri, row_no, payload) of unpacked record files."""
    lines = unpacked.select("path", F.explode(F.split(F.col("data").cast("string"), "\n")).alias("line")).where("line <> ''")
    return lines.select(F.col("path").alias("gcs_uri"), F.from_json("line", "row_no BIGINT, payload STRING").alias("r")).select("gcs_uri", "r.row_no", "r.payload")
