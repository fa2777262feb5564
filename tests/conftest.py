import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

from baleflow.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        # Not UTC on purpose: no result may depend on the session time zone.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def skewed(tmp_path_factory):
    """A third of all lines in one order, a tenth exact copies of one line of another."""
    import duckdb

    folder = tmp_path_factory.mktemp("skewed")
    source = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(
        f"""CREATE TABLE lines AS
          SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey)
          FROM '{source}/lineitem.parquet'
          UNION ALL
          SELECT one.* REPLACE (8 AS l_orderkey)
          FROM (SELECT * FROM '{source}/lineitem.parquet' ORDER BY ALL LIMIT 1) one, range(600)"""
    )
    # Several files, so that the hot order comes from several map tasks.
    (folder / "lineitem.parquet").mkdir()
    for part in range(8):
        con.execute(
            f"""COPY (SELECT * FROM lines WHERE rowid % 8 = {part})
                TO '{folder}/lineitem.parquet/part-{part}.parquet'"""
        )
    con.execute(f"COPY (SELECT * FROM '{source}/orders.parquet') TO '{folder}/orders.parquet'")
    return str(folder)
