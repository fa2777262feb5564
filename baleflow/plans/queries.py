"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from baleflow.functions.messages import order_messages, parse_orders, sales_messages
from baleflow.operators import prepare, totals
from baleflow.operators.first_seen import first_seen
from baleflow.plans import workflow
from baleflow.schemas import ORDER_COLUMNS, ORDER_PRICES, ORDERS
from baleflow.session import make_dir, new_dir, tune
from baleflow.sources.csv_files import read_csv, read_snapshot, write_csv, write_snapshot
from baleflow.sources.staging import (
    ARRIVAL,
    arriving_lines,
    long_orders,
    mark_and_number,
    numbered_lines,
    order_lines,
)
from baleflow.sources.tables import load_csv, load_once, loaded_rows
from baleflow.sources.topics import (
    NUMBERED_VALUES,
    publish,
    publish_epoch,
    publish_ordered,
    publish_paced,
    read_topic,
    subscribe,
)
from baleflow.streaming import jobs, pace


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_orders(order_lines(spark, sf_dir))


def _numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare_orders(numbered_lines(spark, sf_dir))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.as_sales(prepare.priced_orders(_orders(spark, sf_dir)))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered_lines(spark, sf_dir).drop("long")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, sf_dir).select(ORDER_COLUMNS)


def order_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.with_weight(numbered_lines(spark, sf_dir)).select("id", "seq", "weight")


def order_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced = prepare.with_amount(numbered_lines(spark, sf_dir))
    return priced.select("id", "seq", "prdtid", "amount")


def order_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.with_event_time(numbered_lines(spark, sf_dir)).select("id", "seq", "eventtime")


def unpriced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    unpriced = prepare.unpriced_orders(prepare.with_amount(numbered_lines(spark, sf_dir)))
    return unpriced.select("id", "seq", "prdtid", "quantity")


def orders_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "orders-csv")
    write_csv(orders(spark, sf_dir), path)
    return read_csv(spark, path, ORDERS.replace("VARCHAR(10)", "STRING"))


def load_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "pricelist-csv")
    write_csv(pricelist(spark, sf_dir), path)
    location = new_dir(spark, "pricelist")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    schema = load_csv(spark, name, path, "pricelist", location).schema
    # The rows are at the location; the name is not left in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(schema).parquet(location)


def load_table_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`load_table`, run twice: the second run finds the load in the ledger and adds nothing."""
    path, location = new_dir(spark, "pricelist-csv"), new_dir(spark, "pricelist")
    write_csv(pricelist(spark, sf_dir), path)
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    for _ in range(2):
        load_once(spark, name, path, "pricelist", location)
    # The rows are at the location; the name is not left in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return loaded_rows(spark, location, "pricelist")


def orders_csv_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders`, exported as a CSV snapshot that replaces an earlier one, and read back."""
    path = new_dir(spark, "orders-snapshots")
    write_snapshot(orders(spark, sf_dir).limit(0), path)
    write_snapshot(orders(spark, sf_dir), path)
    return read_snapshot(spark, path, ORDERS.replace("VARCHAR(10)", "STRING"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.products(order_lines(spark, sf_dir))


def pricelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.pricelist(order_lines(spark, sf_dir))


def distinct_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.distinct_products(order_lines(spark, sf_dir))


def distinct_products_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes with the place, from 1, at which each was seen first."""
    return first_seen(arriving_lines(spark, sf_dir), "prdtid")


def order_amount_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`order_amount` with the prices looked up in a loaded table instead of constants."""
    lines = numbered_lines(spark, sf_dir)
    path, location = new_dir(spark, "prices-csv"), new_dir(spark, "prices")
    write_csv(prepare.pricelist(order_lines(spark, sf_dir), ORDER_PRICES), path)
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    load_once(spark, name, path, "pricelist", location)
    spark.sql(f"DROP TABLE {name}")
    priced = prepare.with_amount_from(lines, loaded_rows(spark, location, "pricelist"))
    return priced.select("id", "seq", "prdtid", "amount")


def orders_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The arrival columns order as `seq` does, and need no numbering of the whole table.
    first = prepare.first_rows(order_lines(spark, sf_dir), 10, "id", *ARRIVAL)
    return prepare.prepare_orders(first).select(ORDER_COLUMNS)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_messages(prepare.priced_orders(_orders(spark, sf_dir)))


def order_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(spark, sf_dir)


def parsed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_orders(_messages(spark, sf_dir))


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.order_totals(_sales(spark, sf_dir))


def order_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish all messages, replay them at a fixed rate, read the last total of each id."""
    topic, out = new_dir(spark, "orders-topic"), new_dir(spark, "totals")
    # Messages of an id side by side: spread over the files, they would change its state with each.
    priced = prepare.priced_orders(_orders(spark, sf_dir)).sortWithinPartitions("id")
    publish(order_messages(priced), topic)
    checkpoint = new_dir(spark, "totals-checkpoint")
    jobs.start_totals(parse_orders(subscribe(spark, topic)), out, checkpoint).awaitTermination()
    return jobs.latest_totals(spark, out)


# Messages a second of the paced replay.
REPLAY = pace.Pace(rows=200_000)


def order_totals_paced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`order_totals_stream` with the messages replayed at the rate of REPLAY."""
    aside, topic = new_dir(spark, "orders-aside"), new_dir(spark, "orders-topic")
    publish_paced(_messages(spark, sf_dir), aside, REPLAY.rows)
    make_dir(spark, topic)
    out, checkpoint = new_dir(spark, "totals"), new_dir(spark, "totals-checkpoint")
    parsed = parse_orders(subscribe(spark, topic))
    query = jobs.start_totals(parsed, out, checkpoint, every=REPLAY.every)
    pace.replay(spark, aside, topic, REPLAY, query)
    return jobs.latest_totals(spark, out)


def order_running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = long_orders(spark, sf_dir)
    if long is None:
        return totals.numbered_running_totals(_orders(spark, sf_dir), ARRIVAL)
    lines = prepare.prepare_orders(mark_and_number(spark, sf_dir, long))
    return totals.running_totals(totals.as_sales(prepare.priced_orders(lines)), marked=True)


def _published_orders(spark: SparkSession, sf_dir: str) -> str:
    """A topic of the priced orders, those of an order in the order of `seq`."""
    topic = new_dir(spark, "orders-topic")
    priced = prepare.priced_orders(_numbered_orders(spark, sf_dir))
    publish_ordered(order_messages(priced, "id", "seq"), topic)
    return topic


def order_running_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, out = _published_orders(spark, sf_dir), new_dir(spark, "running")
    parsed = parse_orders(subscribe(spark, topic, NUMBERED_VALUES), "seq")
    checkpoint = new_dir(spark, "running-checkpoint")
    jobs.start_running_totals(parsed, out, checkpoint).awaitTermination()
    return jobs.read_running_totals(spark, out)


def sales_messages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_messages(order_running_totals(spark, sf_dir))


def sales_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales job from topic to topic: order messages in, one sales message for each out."""
    topic, sales = _published_orders(spark, sf_dir), new_dir(spark, "sales-topic")
    workflow.process_orders(
        subscribe(spark, topic, NUMBERED_VALUES),
        lambda messages, epoch: publish_epoch(messages, sales, epoch),
        new_dir(spark, "sales-checkpoint"),
    ).awaitTermination()
    return read_topic(spark, sales)


def sales_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic, out = new_dir(spark, "sales-topic"), new_dir(spark, "sales")
    publish(sales_messages_query(spark, sf_dir), topic)
    messages = subscribe(spark, topic)
    checkpoint = new_dir(spark, "sales-checkpoint")
    jobs.start_copy(messages, out, checkpoint).awaitTermination()
    return spark.read.schema(messages.schema).parquet(out)


# Lines an order may have before it is treated as long, low enough for every table to have some.
FEW = 4


def raw_orders_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`raw_orders`, numbered as long orders are."""
    return numbered_lines(spark, sf_dir, FEW).drop("long")


def order_running_totals_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`order_running_totals`, numbered and summed in blocks as long orders are."""
    lines = prepare.prepare_orders(numbered_lines(spark, sf_dir, FEW))
    return totals.running_totals(totals.as_sales(prepare.priced_orders(lines)), FEW, marked=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_orders": raw_orders,
    "raw_orders_long": raw_orders_long,
    "orders": orders,
    "order_weight": order_weight,
    "order_amount": order_amount,
    "order_event_time": order_event_time,
    "unpriced_orders": unpriced_orders,
    "orders_csv_roundtrip": orders_csv_roundtrip,
    "load_table": load_table,
    "products": products,
    "pricelist": pricelist,
    "distinct_products": distinct_products,
    "distinct_products_in_order": distinct_products_in_order,
    "order_amount_joined": order_amount_joined,
    "load_table_once": load_table_once,
    "orders_csv_snapshot": orders_csv_snapshot,
    "orders_head": orders_head,
    "order_messages": order_messages_query,
    "parsed_orders": parsed_orders,
    "order_totals": order_totals,
    "order_totals_stream": order_totals_stream,
    "order_totals_paced": order_totals_paced,
    "order_running_totals": order_running_totals,
    "order_running_totals_long": order_running_totals_long,
    "order_running_totals_stream": order_running_totals_stream,
    "sales_messages": sales_messages_query,
    "sales_stream": sales_stream,
    "sales_readback": sales_readback,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def tuned(query):
        return lambda spark, sf_dir: query(tune(spark), sf_dir)

    return {name: tuned(query) for name, query in QUERIES.items()}
