"""The four jobs end to end: prepare and load, publish, process, print.

The stream jobs take any stream of messages, such as `topics.subscribe` or
`topics.subscribe_kafka`, and any function that publishes a batch of them, such as
`topics.publish_epoch` or `topics.publish_kafka`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from baleflow.functions.messages import (
    accepted_orders,
    order_messages,
    parse_orders,
    sales_messages,
)
from baleflow.operators import prepare
from baleflow.operators.long_keys import number_by
from baleflow.schemas import ORDER_COLUMNS, ORDERS, RAW_ORDERS
from baleflow.session import tune, written
from baleflow.sources import topics
from baleflow.sources.csv_files import FILE, LINE, read_csv, read_csv_leniently, write_csv
from baleflow.sources.tables import load_csv, load_key, load_once
from baleflow.streaming import jobs


def prepare_and_load(
    spark: SparkSession,
    orders_csv: str,
    folder: str,
    overwrite: bool = False,
    set_aside: bool = False,
    once: bool = False,
) -> dict[str, DataFrame]:
    """Clean and enrich raw orders, save the three CSV sets below `folder`, load the tables.

    A second run appends to the tables unless `overwrite` is set; with `once` it adds what a run that
    failed has left out, and nothing if all was loaded, see `tables.load_once`. A line with a bad date
    or time, a wrong number of cells or a cell of a wrong type fails the job; with `set_aside` such
    lines go to Rejected.csv, with their file and, where cells were wrong, their text, and the others
    are loaded. Returns the loaded tables.
    """
    spark = tune(spark)
    key = load_key(spark, orders_csv) if once else None
    if set_aside:
        # Parsed once, for the lines that are loaded and for those that are not.
        usable = prepare.usable_line() & F.col(LINE).isNull()
        raw = read_csv_leniently(spark, orders_csv, RAW_ORDERS)
        parsed = written(raw.withColumn("usable", usable), "raw-lines")
        write_csv(parsed.where(~F.col("usable")).drop("usable"), f"{folder}/Rejected.csv")
        raw = parsed.where("usable").drop("usable", FILE, LINE)
    else:
        raw = read_csv(spark, orders_csv, RAW_ORDERS)

    def load(name: str, rows: DataFrame) -> DataFrame:
        path = f"{folder}/{name.capitalize()}.csv"
        write_csv(rows, path)
        if once:
            return load_once(spark, name, path, name, key=key)
        return load_csv(spark, name, path, name, overwrite=overwrite)

    # Products and price list have a row for each order line: they are made of the file of the
    # orders, which has the product codes, and the raw lines are not parsed again.
    orders = load("orders", prepare.prepare_orders(raw).select(ORDER_COLUMNS))
    lines = read_csv(spark, f"{folder}/Orders.csv", ORDERS.replace("VARCHAR(10)", "STRING"))
    return {
        "orders": orders,
        "products": load("products", prepare.products(lines)),
        "pricelist": load("pricelist", prepare.pricelist(lines)),
    }


def publish_orders(
    orders: DataFrame, topic: str, after_wave: Callable[[], None] | None = None
) -> None:
    """Publish the priced rows of an orders table.

    A table keeps no arrival order, so the lines of an order go by event time, then product. A
    publisher that failed may be run again, see `topics.publish_ordered`. With `after_wave` long orders
    go wave by wave, and it runs after each, see `topics.publish_in_waves`.
    """
    lines = number_by(prepare.priced_orders(orders), "id", ["eventtime", "prdtid", "quantity"])
    messages = order_messages(lines, "id", "seq")
    if after_wave:
        topics.publish_in_waves(messages, topic, after_wave)
    else:
        topics.publish_ordered(messages, topic)


def process_orders(
    messages: DataFrame,
    publish: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    skip_broken: bool = False,
) -> StreamingQuery:
    """Running total of each order, from a stream of order messages (value, seq) to a topic.

    `publish` gets the sales messages of a micro-batch and its number, for example
    `topics.publish_epoch`. A broken message fails the job; with `skip_broken` it is left out, and
    `jobs.start_quarantine` on the same stream keeps it.
    """
    tune(messages.sparkSession)
    parse = accepted_orders if skip_broken else parse_orders

    def publish_sales(totals: DataFrame, epoch: int) -> None:
        publish(sales_messages(totals), epoch)

    return jobs.start_running(parse(messages, "seq"), publish_sales, checkpoint, every)


def print_topic(messages: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Print the messages of a topic."""
    return jobs.start_print(messages.select("value"), checkpoint, every)
