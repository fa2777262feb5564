"""Raw order lines out of the `lineitem` and `orders` test tables (o_orderkey is unique)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.operators.first_seen import PLACE, with_arrival
from baleflow.operators.long_keys import (
    TASK_ROWS,
    long_keys,
    number_apart,
    number_long,
    number_short,
    split,
)
from baleflow.session import broadcast_if_small, tune, written

# Product codes by part number; ZZZ999 has no price on purpose.
CODES = [
    "AJA001", "SOK001", "DUN001", "LOT001", "PEM001",
    "BAB001", "MAI001", "SMA001", "UMI001", "ZZZ999",
]

# Arrival order of the lines of one order; leaves no ties.
ARRIVAL = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
]

KEY = "l_orderkey"

# What `_raw` makes of a line, beside its key.
USED = ["l_linenumber", "l_partkey", "l_quantity"]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/lineitem.parquet").select(KEY, *ARRIVAL)


def _headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = F.col("o_custkey").cast("string")
    padded = F.when(F.length(customer) < 6, F.lpad(customer, 6, "0")).otherwise(customer)
    day = F.col("o_orderdate").cast("date").cast("string")
    return orders.select(
        F.col("o_orderkey").alias(KEY),
        F.concat(F.lit("C"), padded).alias("csmcode"),
        F.translate(F.substring(day, 3, 8), "-", "/").alias("orddate"),
    )


def _two(number: str) -> Column:
    """Two digits of a number below 60, looked up: cheaper than formatting it."""
    digits = F.array(*[F.lit(f"{value:02d}") for value in range(60)])
    return F.element_at(digits, F.expr(f"cast({number} AS INT) + 1"))


def _raw(lines: DataFrame, headers: DataFrame, *keep: str) -> DataFrame:
    second = F.expr(f"({KEY} * 37 + l_linenumber * 61) % 86400")
    joined = lines.join(headers, KEY).withColumn("second", second)
    return joined.select(
        F.col(KEY).alias("id"),
        "csmcode",
        "orddate",
        F.concat_ws(
            ":",
            _two("second div 3600"),
            _two("second % 3600 div 60"),
            _two("second % 60"),
        ).alias("ordtime"),
        F.element_at(
            F.array(*map(F.lit, CODES)), (F.col("l_partkey") % len(CODES) + 1).cast("int")
        ).alias("prdtid"),
        F.col("l_quantity").cast("int").alias("quantity"),
        *keep,
    )


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders without `seq`, with the arrival columns: a join, nothing is numbered."""
    return _raw(_lines(spark, sf_dir), _headers(spark, sf_dir), *ARRIVAL)


def long_orders(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame | None:
    """The orders of more than `task_rows` lines, None if there are none."""
    return long_keys(_lines(spark, sf_dir), KEY, task_rows)


def arriving_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with `file`, `block` and `place`, which order the lines as they are stored."""
    lines = with_arrival(tune(spark).read.parquet(f"{sf_dir}/lineitem.parquet"))
    return _raw(lines.select(KEY, *ARRIVAL, *PLACE), _headers(spark, sf_dir), *PLACE)


def numbered_lines(spark: SparkSession, sf_dir: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Raw orders with `seq`; `long` marks lines of orders of more than `task_rows` lines, if any, or all
    lines where those are most.

    `task_rows` is what one task may be given of one order; results do not depend on it. Lines are
    numbered before the join, so that numbering, join and a later window by id share one shuffle. Long
    orders go another way, see `number_long`.
    """
    keys = long_orders(spark, sf_dir, task_rows)
    if keys is None:
        numbered = number_short(_lines(spark, sf_dir), KEY, ARRIVAL)
        return _raw(numbered, _headers(spark, sf_dir), "seq")
    return mark_and_number(spark, sf_dir, keys, task_rows)


def mark_and_number(
    spark: SparkSession, sf_dir: str, keys: DataFrame, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Raw orders with `seq` and `long`, which marks lines of the orders in `keys`, or all lines where
    these orders have most of them."""
    # Numbered at the scan, where it is repeatable: tells exact copies of a line apart.
    lines = _lines(spark, sf_dir).withColumn("copy", F.monotonically_increasing_id())
    headers = _headers(spark, sf_dir)
    held, total = keys.agg(F.sum("held")).first()[0], lines.count()
    if 2 * held > total:
        return _number_all(lines, headers, total, task_rows)
    short, long = split(lines, KEY, keys)
    short = number_short(short, KEY, ARRIVAL)
    long = number_long(long, KEY, [*ARRIVAL, "copy"], keys, task_rows)
    long_headers = written(split(headers, KEY, keys)[1], "long-headers")
    return _raw(short, headers, "seq", F.lit(False).alias("long")).unionByName(
        _raw(long, broadcast_if_small(long_headers), "seq", F.lit(True).alias("long"))
    )


def _number_all(lines: DataFrame, headers: DataFrame, total: int, task_rows: int) -> DataFrame:
    """All orders numbered as long ones, and marked so: the lines are dealt into ranges once, and once
    by order with their headers, and not before that for each kind of order."""
    order = [*ARRIVAL, "copy"]
    whole, cut, cut_keys = number_apart(lines, KEY, order, total, task_rows, USED)
    cut_headers = written(headers.join(F.broadcast(cut_keys), KEY, "left_semi"), "cut-headers")
    long = F.lit(True).alias("long")
    return _raw(whole, headers, "seq", long).unionByName(
        _raw(cut, broadcast_if_small(cut_headers), "seq", long)
    )
