import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "3g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture(scope="session")
def compare(spark, data):
    """Runs a query and its SQL over the small tables and compares the rows as multisets."""
    import duckdb

    con = duckdb.connect()
    for path in Path(data).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")

    def plain(value):
        if value is None or value != value:
            return None
        if isinstance(value, float):
            return round(value, 6) + 0.0
        return value

    def run(query, sql):
        df = query(spark, data)
        names = sorted(df.columns)
        ours = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
        found = con.sql(sql)
        assert sorted(found.columns) == names
        at = [found.columns.index(c) for c in names]
        theirs = sorted((tuple(plain(row[i]) for i in at) for row in found.fetchall()), key=repr)
        assert ours == theirs

    return run
