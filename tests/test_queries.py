"""Every registered query against DuckDB, and golden numbers of the larger tables."""

import duckdb
import pytest
from check import oracle_rows, spark_rows

from __spark_entry__ import entry
from baleflow.plans.oracle import SQL
from baleflow.plans.queries import registered as queries


def oracle_sql():
    return SQL


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, small, name):
    assert spark_rows(queries()[name](spark, small)) == oracle_rows(small, oracle_sql()[name])


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry_is_the_totals(spark, small):
    names, rows = spark_rows(entry(spark))
    assert names == ["amount", "event_time", "id"]
    assert len(rows) > 0


GOLDEN = {
    "raw_orders": 60000,
    "unpriced_orders": 5914,
    "order_totals": 14571,
    "order_running_totals": 54086,
}


@pytest.mark.parametrize("name", GOLDEN)
def test_row_counts(spark, name):
    assert queries()[name](spark, "/root/testdata/sf0.01").count() == GOLDEN[name]


def test_known_totals(spark):
    totals = queries()["order_totals"](spark, "/root/testdata/sf0.01")
    rows = {row.id: (row.amount, row.event_time) for row in totals.where("id < 2").collect()}
    assert rows == {
        0: (65920, "1998-10-03 00:04:04"),
        1: (110260, "1997-05-28 00:07:44"),
    }


SCHEMAS = {
    "raw_orders": "id:bigint csmcode:string orddate:string ordtime:string prdtid:string "
    "quantity:int seq:bigint",
    "orders": "id:bigint csmcode:string orddate:date ordtime:string prdtid:string quantity:int "
    "weight:int amount:int eventtime:timestamp_ntz",
    "products": "id:string name:string stock:int restock:int unitweight:int",
    "pricelist": "id:string prdtid:string uom:string price:int",
    "order_totals": "id:bigint amount:bigint event_time:string",
    "order_running_totals": "id:bigint seq:bigint amount:bigint event_time:string",
    "order_messages": "value:string",
}


@pytest.mark.parametrize("name", SCHEMAS)
def test_schema(spark, small, name):
    dtypes = queries()[name](spark, small).dtypes
    assert " ".join(":".join(column) for column in dtypes) == SCHEMAS[name]


@pytest.fixture(scope="module")
def empty(tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    con = duckdb.connect()
    for table in ("lineitem", "orders"):
        con.execute(
            f"""COPY (SELECT * FROM '/root/testdata/sf0.001/{table}.parquet' LIMIT 0)
                TO '{folder}/{table}.parquet'"""
        )
    return str(folder)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_on_empty_tables(spark, small, empty, name):
    result = queries()[name](spark, empty)
    assert result.count() == 0
    assert sorted(result.columns) == oracle_rows(small, oracle_sql()[name])[0]
