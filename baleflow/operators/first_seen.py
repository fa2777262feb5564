"""Distinct values in the order in which they are stored first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.operators.long_keys import number_by

#: Columns that order the rows of a table as its files hold them.
PLACE = ["file", "block", "place"]


def with_arrival(rows: DataFrame) -> DataFrame:
    """Add the PLACE columns. `rows` must come straight from files, of any format.

    Files go by name. A split of a file is read by one task from its start on, so within a block
    the running number of the scan is the order of the rows.
    """
    return rows.withColumns(
        {
            "file": F.col("_metadata.file_path"),
            "block": F.col("_metadata.file_block_start"),
            "place": F.monotonically_increasing_id(),
        }
    )


def first_seen(rows: DataFrame, column: str, number: str = "first_seen") -> DataFrame:
    """The distinct values of a column (null is one) with their places, from 1, in first-seen order.

    The first occurrence of each value is an aggregate that is partly done before the shuffle. Only one
    row for each value is sorted, over many tasks where there are many (`number_by`).
    """
    first = F.min(F.struct(*PLACE)).alias("first")
    seen = rows.groupBy(column).agg(first).select(F.lit(0).alias("all"), column, "first.*")
    return number_by(seen, "all", PLACE).select(column, F.col("seq").alias(number))
