"""Raw files into month-partitioned text tables, and the manifests and audits that go with them."""

from __future__ import annotations

import csv
import io
import posixpath
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import clean
from tapeloom.functions.codes import equity_code
from tapeloom.functions.names import col, keep_clear

#: Encodings tried in this order on a raw file.
ENCODINGS = ("utf-8-sig", "utf-8", "gb18030")
#: Records of one raw entry that are handed on at once.
CHUNK = 20_000
# Column names that hold a row's date, in order of preference, and parts of names that may.
DATE_NAMES = ("date", "trade_date", "交易日期", "日期", "公告日期", "实际公告日期")
DATE_PARTS = ("日期", "报告期", "年度")
CODE_NAMES = ("equity_code", "security_code", "code", "ts_code", "symbol", "股票代码", "证券代码")


def decode(data: bytes) -> str:
    """Text of a raw file by the first encoding that fits; what fits none is read as the last with replacement marks."""
    for encoding in ENCODINGS:
        try:
            return data.decode(encoding)
        except UnicodeDecodeError:
            continue
    return data.decode(ENCODINGS[-1], errors="replace")


def _entries(path: str, content: bytes) -> Iterator[tuple[str | None, bytes]]:
    if path.lower().endswith(".zip"):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for name in sorted(archive.namelist()):
                if name.lower().endswith(".csv"):
                    yield name, archive.read(name)
    else:
        yield None, content


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, source_entry, row_no, fields): every record of the CSV files, and of those inside ZIP files, under a folder.

    ``fields`` maps stripped header names to text. Files are read whole, one a task, as archives cannot be split; records of more or
    fewer fields than the header are left out, as are records before a header; an empty field stays empty text. Of header names that
    are alike, the last one counts. Row numbers count the kept records of an entry from 1.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).where(F.lower("path").rlike(r"\.(csv|zip)$"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                for entry, data in _entries(path, content):
                    rows = csv.reader(io.StringIO(decode(data)))
                    header = [h.replace("﻿", "").strip() for h in next(rows, [])]
                    good = (dict(zip(header, row)) for row in rows if len(row) == len(header))
                    number = 0
                    while chunk := [r for _, r in zip(range(CHUNK), good)]:
                        yield pd.DataFrame({"source_file": path, "source_entry": entry, "row_no": range(number + 1, number + len(chunk) + 1), "fields": chunk})
                        number += len(chunk)

    return files.select("path", "content").mapInPandas(work, "source_file string, source_entry string, row_no bigint, fields map<string,string>")


def columns_of(raw: DataFrame, most: int = 2_000) -> list[str]:
    """The names of all fields, sorted; more than ``most`` raise ValueError, as the driver has to know them."""
    names = [r[0] for r in raw.select(F.explode(F.map_keys("fields")).alias("name")).distinct().orderBy("name").limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} columns")
    return names


def date_columns(names: list[str]) -> list[str]:
    """The columns that may hold a row's date: the preferred names in their order, then those that look like one."""
    return [*[n for n in DATE_NAMES if n in names], *[n for n in names if n not in DATE_NAMES and any(p in n for p in DATE_PARTS)]]


def enrich(raw: DataFrame, names: list[str]) -> DataFrame:
    """One text column for each of ``names``, with lineage, ``security_code`` and ``partition_month``.

    Files name their columns differently, so a row's code and date are taken from the first of the known names that has a value.
    The month is that of the row's date or, without one, the last date in the file's path; ``all`` if there is none at all. Fields called
    as an added column come out with the suffix ``_in``.
    """
    added = ["source_file", "source_entry", "source_hash", "security_code", "partition_month"]
    wide = keep_clear(raw.select(*[F.try_element_at("fields", F.lit(n)).alias(n) for n in names], F.col("source_file").alias("\u0001f"), F.col("source_entry").alias("\u0001e"), F.to_json("fields").alias("\u0001j")), added)
    have = wide.columns
    none = F.lit(None).cast("string")
    from_row = F.coalesce(*[clean.loose_date(col(c)) for c in date_columns(have)], none.cast("date"))
    code = F.coalesce(*[clean.blank_to_null(col(c)) for c in (*CODE_NAMES, "security_code_in") if c in have], none)
    month = F.coalesce(clean.month_number(from_row).cast("string"), F.date_format(path_date(F.concat_ws("/", col("\u0001f"), col("\u0001e"))), "yyyyMM"), F.lit("all"))
    return wide.select(
        *[col(c) for c in have if not c.startswith("\u0001")], col("\u0001f").alias("source_file"), col("\u0001e").alias("source_entry"), F.sha2(col("\u0001j"), 256).alias("source_hash"),
        equity_code(code).alias("security_code"), month.alias("partition_month"),
    )


def path_date(path: Column) -> Column:
    """The last valid date YYYYMMDD (or with - or _ between) in a path; null without one."""
    found = F.regexp_extract_all(path, F.lit(r"((?:19|20)\d{2}[-_]?\d{2}[-_]?\d{2})"), 1)
    dates = F.filter(F.transform(found, lambda x: F.try_to_timestamp(F.regexp_replace(x, "[-_]", ""), F.lit("yyyyMMdd")).cast("date")), lambda x: x.isNotNull())
    return F.try_element_at(dates, F.lit(-1))


def write_months(df: DataFrame, folder: str, sort: list[str] | None = None, rows_per_file: int = 5_000_000) -> None:
    """Write by month, compressed with zstd; months that are there already and come again are replaced, others stay.

    Rows are shuffled by month and a hash of the sort columns, so that a large month is spread over tasks; files are cut at ``rows_per_file``.
    """
    spread = df.repartition("partition_month", *(sort or []))
    ordered = spread.sortWithinPartitions("partition_month", *(sort or []))
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("maxRecordsPerFile", rows_per_file).partitionBy("partition_month").parquet(folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, modified, target_table, partition_month, format, status, reason): the files under a folder, read from listings alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    month = F.nullif(F.regexp_extract("path", r"/partition_month=(\d{6}|all)/", 1), F.lit(""))
    name = F.nullif(F.regexp_extract("path", r"/([^/]+)/partition_month=", 1), F.lit(""))
    kind = F.upper(F.nullif(F.regexp_extract("path", r"\.(parquet|csv|json)(?:\.gz)?$", 1), F.lit("")))
    reason = F.when(kind.isNull(), "unknown format").when(month.isNull(), "no partition_month").when((F.substring(month, 5, 2) > "12") & (month != "all"), "bad month").when(F.col("size") == 0, "empty")
    return files.select("*", name.alias("target_table"), month.alias("partition_month"), kind.alias("format"), F.when(reason.isNull(), "pending").otherwise("invalid").alias("status"), reason.alias("reason"))


def audit_manifest(records: DataFrame) -> DataFrame:
    """(rule, failures) of a manifest (target_table, partition_month, gcs_uri, size, rows): each rule with the number of records that break it."""
    month = F.col("partition_month").cast("string")
    rules = {
        "month is YYYYMM or all": ~month.rlike(r"^(\d{4}(0[1-9]|1[0-2])|all)$") | month.isNull(),
        "size is positive": F.coalesce(F.col("size") <= 0, F.lit(True)),
        "rows are positive": F.coalesce(F.col("rows") <= 0, F.lit(True)),
        "path holds table and month": ~F.coalesce(F.col("gcs_uri").contains(F.concat(F.lit("/"), F.col("target_table"), F.lit("/partition_month="), month, F.lit("/"))), F.lit(False)),
    }
    counts = records.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    twice = records.groupBy("gcs_uri").count().where("count > 1").agg(F.count(F.lit(1)).alias("path is unique"))
    long = counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), col(n).alias("failures")) for n in rules])).alias("r")).select("r.*")
    return long.unionByName(twice.select(F.lit("path is unique").alias("rule"), F.col("path is unique").alias("failures")))


def log_rows(lines: DataFrame, marker: str, key: str) -> DataFrame:
    """Key-value rows of the log lines that hold ``marker`` (``... MARKER a=1 b=x``): (key, fields), the last line of each key.

    ``lines`` has line_no and value. Lines without the key are left out.
    """
    text = F.trim(F.regexp_extract("value", r"(?:^|\s)" + marker + r"\s+(.*)$", 1))
    pairs = F.filter(F.split(text, r"\s+"), lambda p: p.contains("="))
    fields = F.map_from_entries(F.array_distinct(F.transform(pairs, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)), F.regexp_replace(p, "^[^=]*=", "")))))
    found = lines.where(F.col("value").contains(marker)).select("line_no", fields.alias("fields")).withColumn(key, F.try_element_at("fields", F.lit(key)))
    return found.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("fields", "line_no").alias("fields"))


def adjust_type(file: str = "source_file", entry: str = "source_entry") -> Column:
    """qfq, hfq or none, as a row's lineage tells."""
    text = F.lower(F.concat(F.coalesce(F.col(file), F.lit("")), F.lit("/"), F.coalesce(F.col(entry), F.lit(""))))
    return F.when(text.rlike("前复权|qfq"), "qfq").when(text.rlike("后复权|hfq"), "hfq").otherwise("none")


def classify_path(path: Column, rules: dict[str, list[str]], other: str = "unknown") -> Column:
    """The first kind of ``rules`` of which the path holds a word; a null path is ``other``."""
    out = F.lit(other)
    for kind, words in reversed(rules.items()):
        held = F.lit(False)
        for w in words:
            held = held | F.coalesce(path.contains(w), F.lit(False))
        out = F.when(held, kind).otherwise(out)
    return out


# The words of a path that tell the length of its bars.
TIMEFRAMES = {"1w": ["weekly", "周线", "周k"], "1mo": ["monthly", "月线", "月k"], "1d": ["daily", "日线", "日k"]}


def timeframe(path: Column) -> Column:
    return F.nullif(classify_path(F.lower(path), TIMEFRAMES, ""), F.lit(""))


def map_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """``df`` with its columns renamed by ``mapping``, but for those whose new name is there already."""
    taken = set(df.columns)
    return df.select(*[col(c).alias(mapping[c]) if c in mapping and mapping[c] not in taken else col(c) for c in df.columns])


def statement(df: DataFrame, fields: dict[str, list[str]], code: list[str], announced: list[str], period: list[str]) -> DataFrame:
    """(equity_code, announcement_date, report_period, fields): typed statements from text columns of varying headers.

    Each field is read from the first of its candidate headers that ``df`` has, so that only those columns are scanned; a field without
    one is null. A statement without an announcement header has null dates rather than its period's, as nobody knew it then. Rows
    without a code are left out.
    """
    def pick(names: list[str]) -> Column:
        name = clean.first_existing(df.columns, names)
        return F.lit(None).cast("string") if name is None else col(name).cast("string")

    period_day = clean.loose_date(pick(period))
    return df.select(
        equity_code(pick(code)).alias("equity_code"), clean.loose_date(pick(announced)).alias("announcement_date"), F.date_format(period_day, "yyyyMMdd").alias("report_period"),
        *[clean.number(F.replace(pick(names), F.lit(","), F.lit("")), "double").alias(f) for f, names in fields.items()],
    ).where("equity_code IS NOT NULL")


def create_table(df: DataFrame, folder: str, partition: str | None = "partition_month", cluster: list[str] | None = None, append: bool = False) -> DataFrame:
    """Write ``df`` as a table of Parquet files, by partition and sorted by ``cluster`` inside, in place of what was there, or after it."""
    spread = df.repartition(*[c for c in (partition, *(cluster or [])) if c]) if partition or cluster else df
    ordered = spread.sortWithinPartitions(*[c for c in (partition, *(cluster or [])) if c]) if partition or cluster else spread
    writer = ordered.write.mode("append" if append else "overwrite").option("compression", "zstd")
    (writer.partitionBy(partition) if partition else writer).parquet(folder)
    return df.sparkSession.read.parquet(folder)


def load_batch(spark: SparkSession, records: DataFrame, folder: str, chunk: int = 500) -> DataFrame:
    """Load the pending and failed files of one table's load records (gcs_uri, status) into a folder: the first chunk in place of what was
    there unless some files are loaded already, the others after it. Returns the records with their new status and error.

    A chunk that fails is marked ``failed`` with its error and tried again by the next call; invalid and loaded files are passed over.
    File names go over the driver, in chunks, as a load job's list does; their bytes do not.
    """
    todo = records.where(~F.col("status").isin("loaded", "invalid")).select("gcs_uri").distinct().orderBy("gcs_uri")
    first = records.where("status = 'loaded'").isEmpty()
    done: list[tuple[str, str, str | None]] = []
    names = todo.toLocalIterator()
    while some := [r[0] for _, r in zip(range(chunk), names)]:
        try:
            spark.read.parquet(*some).write.mode("overwrite" if first else "append").parquet(folder)
            done += [(n, "loaded", None) for n in some]
            first = False
        except Exception as e:  # noqa: BLE001 - kept with the record
            done += [(n, "failed", str(e)[:500]) for n in some]
    new = spark.createDataFrame(done, "gcs_uri STRING, __status STRING, __error STRING")
    kept = [c for c in records.columns if c not in ("status", "error")]
    return records.join(new, "gcs_uri", "left").select(*kept, F.coalesce("__status", "status").alias("status"), F.col("__error").alias("error"))


def audit_table(df: DataFrame, required: list[str], name: str) -> DataFrame:
    """One row: name, the required columns that are missing, and whether there is any row at all."""
    missing = [c for c in required if c not in df.columns]
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(",".join(missing)).alias("missing"), (F.col("n") == 0).alias("is_empty"))


def file_name(path: str) -> str:
    return posixpath.basename(path)
