"""Lookup of a code in a fixed set of values, or in a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baleflow.session import broadcast_if_small, written


def look_up(code: Column, values: dict) -> Column:
    """Value for `code`, null for an unknown code. For constants of a handful of entries:
    the map is a literal in the plan, so there is no join and nothing to ship."""
    entries = [F.lit(part) for entry in values.items() for part in entry]
    return F.try_element_at(F.create_map(*entries), code)


def unique_values(table: DataFrame, code: str, value: str) -> DataFrame:
    """One row for each code of a table, which may repeat rows; two values of one code fail the job.

    A null value counts as none. Partly aggregated before the shuffle, so a code that many rows have
    does not come together in one task.
    """
    known = table.where(F.col(code).isNotNull()).groupBy(code)
    ends = known.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    message = F.concat(F.lit(f"two values of {value} for {code} "), F.col(code).cast("string"))
    same = F.when(F.col("low").eqNullSafe(F.col("high")), F.col("low"))
    return ends.select(code, same.otherwise(F.raise_error(message)).alias(value))


def look_up_in(rows: DataFrame, code: str, table: DataFrame, table_code: str, value: str) -> DataFrame:
    """`rows` with the column `value` of the row of `table` that has their code, null if there is none.

    No row is lost or doubled. The unique codes are written and counted: few are broadcast, many are
    joined by shuffle, where adaptive execution splits a code that many rows have.
    """
    known = written(unique_values(table, table_code, value), "lookup")
    known = known.select(F.col(table_code).alias(code), value)
    return rows.join(broadcast_if_small(known), code, "left")
