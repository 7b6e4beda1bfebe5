import os

import duckdb
import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g").config("spark.checkpoint.dir", f"file://{shared}").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return c


def rows(table):
    """An Arrow table's rows as sorted lists of text, by column name."""
    columns = sorted(table.column_names)
    return columns, sorted([str(r[c]) for c in columns] for r in table.to_pylist())
