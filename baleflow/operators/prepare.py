"""Cleaning and enriching raw order lines, and the tables derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baleflow.functions.lookups import look_up, look_up_in
from baleflow.functions.times import (
    event_time,
    parse_date,
    parse_time,
    valid_date,
    valid_time,
)
from baleflow.schemas import (
    LIST_PRICES,
    ORDER_PRICES,
    PRICELIST_ID,
    PRICELIST_UOM,
    PRODUCT_NAMES,
    RESTOCK,
    STOCK,
    UNIT_WEIGHT,
)


def with_weight(raw: DataFrame) -> DataFrame:
    return raw.withColumn("weight", F.col("quantity") * UNIT_WEIGHT)


def with_amount(raw: DataFrame) -> DataFrame:
    """Unit price times quantity; null for a product without price."""
    return raw.withColumn("amount", look_up(F.col("prdtid"), ORDER_PRICES) * F.col("quantity"))


def with_amount_from(raw: DataFrame, pricelist: DataFrame) -> DataFrame:
    """As `with_amount`, with the unit prices of a price list that may repeat its rows.

    A product with two prices fails; one without is a miss, as one that is not there.
    """
    priced = look_up_in(raw, "prdtid", pricelist, "prdtid", "price")
    return priced.withColumn("amount", F.col("price") * F.col("quantity")).drop("price")


def with_event_time(raw: DataFrame) -> DataFrame:
    """Parse order date and time, and put both together into the event time."""
    # In one projection, where equal expressions are evaluated once.
    date, time = parse_date(F.col("orddate")), parse_time(F.col("ordtime"))
    return raw.withColumns({"orddate": date, "ordtime": time, "eventtime": event_time(date, time)})


def prepare_orders(raw: DataFrame) -> DataFrame:
    """Raw order lines to the `orders` columns; any other columns are kept."""
    return with_event_time(with_amount(with_weight(raw)))


def usable_line() -> Column:
    """An id, and a date and time that parse."""
    parses = valid_date(F.col("orddate")) & valid_time(F.col("ordtime"))
    return F.col("id").isNotNull() & F.coalesce(parses, F.lit(False))


def accepted_lines(raw: DataFrame) -> DataFrame:
    """Raw lines with an id, whose date and time parse."""
    return raw.where(usable_line())


def rejected_lines(raw: DataFrame) -> DataFrame:
    """Raw lines that `prepare_orders`, or the messages made of them, would fail on."""
    return raw.where(~usable_line())


def priced_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("amount").isNotNull())


def unpriced_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("amount").isNull())


def products(raw: DataFrame) -> DataFrame:
    """One row per order line, as the price list: nothing is made distinct."""
    return (
        raw.select("prdtid")
        .withColumns(
            {
                "name": look_up(F.col("prdtid"), PRODUCT_NAMES),
                "stock": F.lit(STOCK),
                "restock": F.lit(RESTOCK),
                "unitweight": F.lit(UNIT_WEIGHT),
            }
        )
        .withColumnRenamed("prdtid", "id")
    )


def pricelist(raw: DataFrame, prices: dict[str, int] = LIST_PRICES) -> DataFrame:
    return (
        raw.select("prdtid")
        .withColumns(
            {
                "id": F.lit(PRICELIST_ID),
                "uom": F.lit(PRICELIST_UOM),
                "price": look_up(F.col("prdtid"), prices).cast("int"),
            }
        )
        .select("id", "prdtid", "uom", "price")
    )


def distinct_products(raw: DataFrame) -> DataFrame:
    return raw.select("prdtid").distinct()


def first_rows(rows: DataFrame, count: int, *order: str) -> DataFrame:
    """The first `count` rows in the given order, as a top-k per task and a merge."""
    return rows.orderBy(*order).limit(count)
