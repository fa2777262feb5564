"""Row numbers within a key when a few keys hold a large part of all rows.

Keys of at most `task_rows` rows are numbered by a plain window. Rows of longer keys are
range-partitioned on the whole order, so that one key spreads over many tasks; a row's number is
its place in its partition plus the rows of its key in the partitions before. Only the few keys that
end one partition and begin the next have such rows.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baleflow.session import broadcast_if_small, written

# Rows of one key a single task may be given.
TASK_ROWS = 1_000_000

# A sorted range may hold this many rows: it is streamed and spills.
RANGE_ROWS = 8 * TASK_ROWS


def long_keys(rows: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame | None:
    """Keys with more than `task_rows` rows and their row counts, None if there are none.

    Holds at most rows / task_rows keys. The rows are counted once, by a job that reads the key column
    only.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("held"))
    keys = written(counts.where(F.col("held") > task_rows), "long-keys")
    return None if keys.isEmpty() else keys


def split(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the other keys, and rows of `keys`."""
    keys = broadcast_if_small(keys.select(key))
    return rows.join(keys, key, "left_anti"), rows.join(keys, key, "left_semi")


def number_short(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add `seq`, 1, 2, ... within each key, by a window."""
    number = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("seq", number.cast("bigint"))


def number_apart(
    rows: DataFrame,
    key: str,
    order: list[str],
    total: int,
    task_rows: int = TASK_ROWS,
    keep: list[str] | None = None,
    few: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`number_long` of about `total` rows: those of keys that lie in one range, those of keys that
    lie in several, and these keys, at most one for each range.

    Of the rows the columns `keep` are written, all if None. `few` keys are counted, to be broadcast if
    they are.
    """
    # As many ranges as the session shuffles into, within sensible sizes of a range.
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(ceil(total / RANGE_ROWS), min(ceil(total / task_rows), partitions))
    sorted_rows = rows.repartitionByRange(ranges, key, *order).sortWithinPartitions(key, *order)
    # Place = partition number in the upper bits, row number in the partition in the lower 33.
    kept = sorted_rows.withColumn("place", F.monotonically_increasing_id())
    placed = written(kept if keep is None else kept.select(key, *keep, "place"), "placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))

    # A key lies in several ranges only where it ends one and begins the next.
    edges = placed.groupBy("part").agg(F.min(key).alias("first"), F.max(key).alias("last"))
    edges = edges.select("part", F.explode(F.array_distinct(F.array("first", "last"))).alias(key))
    cut_keys = written(edges.groupBy(key).count().where("count > 1").select(key), "split-keys")
    whole = placed.join(F.broadcast(cut_keys), key, "left_anti")
    cut = placed.join(F.broadcast(cut_keys), key, "left_semi")

    # Of the others the first place is all there is to know.
    starts = whole.groupBy(key).agg(F.min("place").alias("start"))
    if few:
        starts = broadcast_if_small(written(starts, "starts"))
    whole = whole.join(starts, key).withColumn("seq", F.col("place") - F.col("start") + 1)

    # One row per key and range it touches: at most two for each range.
    spans = cut.groupBy(key, "part").agg(
        F.min("place").alias("start"), F.count(F.lit(1)).alias("rows")
    )
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before: Column = F.coalesce(F.sum("rows").over(earlier), F.lit(0))
    shift = before - F.col("start") + 1
    spans = written(spans.select(key, "part", shift.alias("shift")), "spans")
    cut = cut.join(F.broadcast(spans), [key, "part"])
    cut = cut.withColumn("seq", F.col("place") + F.col("shift"))
    return whole.drop("place", "part", "start"), cut.drop("place", "part", "shift"), cut_keys


def number_long(
    rows: DataFrame, key: str, order: list[str], keys: DataFrame, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add `seq` as `number_short` does, without bringing the rows of a key into one task.

    Rows equal in all columns of `order` share a range, so its last column should tell copies
    apart.
    """
    total = keys.agg(F.sum("held")).first()[0]
    whole, cut, _ = number_apart(rows, key, order, total, task_rows, few=True)
    return whole.select(cut.columns).unionByName(cut)


def number_by(
    rows: DataFrame, key: str, order: list[str], task_rows: int = TASK_ROWS
) -> DataFrame:
    """Add `seq` within each key, and `long` for rows of keys of more than `task_rows` rows.

    `rows` should come straight from files, so that exact copies can be told apart repeatably.
    """
    keys = long_keys(rows, key, task_rows)
    if keys is None:
        return number_short(rows, key, order).withColumn("long", F.lit(False))
    short, long = split(rows.withColumn("copy", F.monotonically_increasing_id()), key, keys)
    short = number_short(short, key, order).withColumn("long", F.lit(False))
    long = number_long(long, key, [*order, "copy"], keys, task_rows)
    return short.unionByName(long.withColumn("long", F.lit(True))).drop("copy")
