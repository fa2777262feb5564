"""The physical plans: pruned scans, pushed filters, and no shuffle that is not needed."""

import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def plan(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return re.findall(r"Exchange (\w+)", text)


def scanned(text):
    return re.findall(r"FileScan parquet \[([^\]]*)\]", text)


def test_totals_shuffle_each_table_once(spark, no_broadcast):
    text = plan(spark, "order_totals")
    assert exchanges(text) == ["hashpartitioning"] * 2
    assert "SortAggregate" not in text
    assert [len(columns.split(",")) for columns in scanned(text)] == [4, 2]
    assert "IsNotNull(l_quantity)" in text


def test_running_totals_shuffle_each_table_once(spark, no_broadcast):
    text = plan(spark, "order_running_totals")
    assert exchanges(text) == ["hashpartitioning"] * 2
    assert text.count("Window [") == 1
    # One sort for the window, one a table for a join that adaptive execution turns into a hash join.
    assert text.count("Sort [") == 3


def test_products_read_two_columns(spark, no_broadcast):
    text = plan(spark, "products")
    assert [len(columns.split(",")) for columns in scanned(text)] == [2, 1]
    assert "Window" not in text


def test_head_is_a_top_k(spark, no_broadcast):
    text = plan(spark, "orders_head")
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text and "Window" not in text
    # Dates are parsed on the rows that are kept, not below the top-k.
    assert "raise_error" not in text.split("TakeOrderedAndProject", 1)[1].split("\n", 1)[1]


@pytest.mark.parametrize("name", ["orders", "order_messages", "parsed_orders", "order_totals"])
def test_no_python_in_batch_plans(spark, name):
    assert "Python" not in plan(spark, name) and "Pandas" not in plan(spark, name)
