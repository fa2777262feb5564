"""Orders too long for one task: a third of all lines in one order, and a group of copies."""

import pytest
from check import oracle_rows, spark_rows
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql
from baleflow import session
from baleflow.operators import prepare, totals
from baleflow.operators.long_keys import long_keys, number_apart, number_short
from baleflow.plans import queries as plans
from baleflow.sources import staging, topics

ROWS = 100


def sales(spark, folder, task_rows=ROWS):
    lines = staging.numbered_lines(spark, folder, task_rows)
    return totals.as_sales(prepare.priced_orders(prepare.prepare_orders(lines)))


@pytest.fixture(params=["broadcast", "no broadcast"])
def broadcast(request, monkeypatch):
    if request.param == "no broadcast":
        monkeypatch.setattr(session.broadcast_if_small, "__defaults__", (0,))


def test_long_keys_are_found(spark, skewed):
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet")
    keys = long_keys(lines, "l_orderkey", ROWS)
    assert sorted(row.l_orderkey for row in keys.collect()) == [7, 8]
    assert long_keys(lines, "l_orderkey", 1_000_000) is None


def test_numbers_of_long_orders(spark, skewed, broadcast):
    numbered = staging.numbered_lines(spark, skewed, ROWS)
    assert numbered.where("long").select("id").distinct().count() == 2
    raw = numbered.drop("long")
    assert spark_rows(raw) == oracle_rows(skewed, oracle_sql()["raw_orders"])


def test_running_totals_of_long_orders(spark, skewed, broadcast):
    running = totals.running_totals(sales(spark, skewed), ROWS, marked=True)
    assert spark_rows(running) == oracle_rows(skewed, oracle_sql()["order_running_totals"])


def test_running_totals_without_mark(spark, skewed):
    unmarked = sales(spark, skewed, 1_000_000).drop("long")
    want = oracle_rows(skewed, oracle_sql()["order_running_totals"])
    assert spark_rows(totals.running_totals(unmarked, ROWS)) == want
    assert spark_rows(totals.running_totals(unmarked)) == want


def test_no_task_gets_a_long_order(spark, skewed):
    """The hot order is cut into ranges, and into blocks of ROWS lines."""
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet").where("l_orderkey IN (7, 8)")
    keys = long_keys(lines, "l_orderkey", ROWS)
    cut = staging.number_long(
        lines.withColumn("copy", F.monotonically_increasing_id()),
        "l_orderkey", [*staging.ARRIVAL, "copy"], keys, ROWS,
    )
    blocks = cut.groupBy("l_orderkey", F.expr(f"(seq - 1) div {ROWS}")).count()
    assert blocks.agg(F.max("count")).first()[0] == ROWS
    held = lines.count()
    assert cut.select("seq").count() == held
    parts = spark.read.parquet(*cut.inputFiles()).selectExpr("shiftright(place, 33) AS part")
    counts = parts.where("part IS NOT NULL").groupBy("part").count().collect()
    sizes = [row["count"] for row in counts]
    assert sum(sizes) == held and max(sizes) < held / 2


@pytest.mark.parametrize("name", ["order_totals", "order_running_totals_stream", "sales_stream", "products"])
def test_queries_on_skewed_tables(spark, skewed, name, monkeypatch):
    monkeypatch.setattr(topics, "WAVE_ROWS", 500)
    assert spark_rows(plans.QUERIES[name](spark, skewed)) == oracle_rows(
        skewed, oracle_sql()[name]
    )


@pytest.mark.parametrize("name", ["orders", "order_totals"])
def test_skewed_join_partition_is_split(spark, skewed, name):
    """Also under an aggregate on the join key, which would keep the partition whole."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.files.maxPartitionBytes": "16KB",
        "spark.sql.files.openCostInBytes": "16KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        result = plans.QUERIES[name](spark, skewed)
        assert spark_rows(result) == oracle_rows(skewed, oracle_sql()[name])
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


@pytest.mark.parametrize("task_rows", [1, 3])
def test_most_orders_long(spark, skewed, broadcast, task_rows):
    """All lines go the way of long orders, dealt by order once, not for each kind of order."""
    numbered = staging.numbered_lines(spark, skewed, task_rows)
    assert numbered.where("NOT long").count() == 0
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "l_suppkey" not in plan  # what orders the lines is not shuffled again
    assert spark_rows(numbered.drop("long")) == oracle_rows(skewed, oracle_sql()["raw_orders"])
    running = totals.running_totals(sales(spark, skewed, task_rows), task_rows, marked=True)
    assert spark_rows(running) == oracle_rows(skewed, oracle_sql()["order_running_totals"])


def test_only_keys_cut_by_a_range_have_spans(spark, skewed):
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet")
    lines = lines.withColumn("copy", F.monotonically_increasing_id())
    order = [*staging.ARRIVAL, "copy"]
    whole, cut, cut_keys = number_apart(lines, "l_orderkey", order, lines.count(), 4, ["copy"])
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 0 < cut_keys.count() < ranges
    assert (7,) in [tuple(row) for row in cut_keys.collect()]
    assert whole.join(cut_keys, "l_orderkey", "left_semi").count() == 0
    want = number_short(lines, "l_orderkey", order).select("l_orderkey", "copy", "seq")
    assert spark_rows(whole.select(want.columns).unionByName(cut)) == spark_rows(want)


def test_only_later_blocks_are_carried_into(spark):
    rows = [(key, seq, key + seq, f"2000-01-0{seq} 00:00:00") for key in range(5) for seq in range(1, 8 - key)]
    table = spark.createDataFrame(rows, "id BIGINT, seq BIGINT, amount BIGINT, event_time STRING")
    table = table.withColumn("event_time", F.expr("CAST(event_time AS TIMESTAMP_NTZ)"))
    blocks = totals._running_in_blocks(table, 3)
    plan = blocks._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" in plan and "> 0" in plan
    assert spark_rows(blocks) == spark_rows(totals._running(table, "id"))
