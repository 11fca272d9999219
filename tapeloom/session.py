"""Session helpers: tables, the shared scratch folder, written intermediate results and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its rows, at the width given by its schema, fit into this many bytes.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024

_WRITTEN: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data directory."""
    return spark.read.parquet(f"{directory}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session. Where that is unset a local one is made on a local master,
    as in tests; on any other it would be a folder of its own on each machine, so RuntimeError is raised."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='tapeloom-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
        _WRITTEN.append((spark, folder))
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the scratch folder, removed by :func:`release`."""
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def materialize(df: DataFrame, name: str = "part") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage like a reliable checkpoint, but runs the plan once only, keeps the columnar form and survives the loss of any
    executor. The files are removed by :func:`release`, at the latest when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(keep: int = 0) -> None:
    """Remove what was written to the scratch folder, but for the first ``keep`` paths; results that still read it are lost with it."""
    for spark, path in reversed(_WRITTEN[keep:]):
        if path.startswith("file:/"):
            shutil.rmtree("/" + path[5:].lstrip("/"), ignore_errors=True)
            continue
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # noqa: BLE001 - the session may be gone already
            pass
    del _WRITTEN[keep:]


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """A block at whose end the scratch files of all queries made in it are removed; read or write their results inside."""
    scratch(spark)
    before = len(_WRITTEN)
    try:
        yield
    finally:
        release(before)


atexit.register(release)


def row_bytes(df: DataFrame) -> int:
    """A generous width of one row: 16 bytes for a fixed-width column, 96 for any other."""
    fixed = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}
    return sum(16 if kind in fixed else 96 for _, kind in df.dtypes) or 16


def small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if a count proves that it is small, else ``df`` itself, left to a shuffled join.

    ``df`` should be materialized, as it is counted here.
    """
    return F.broadcast(df) if df.count() * row_bytes(df) <= limit else df
