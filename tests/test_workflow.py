"""All four jobs in a row, from a raw CSV file to the sales topic."""

import json
from collections import Counter

import pytest

from baleflow.plans import workflow
from baleflow.session import new_dir
from baleflow.sources import topics

RAW = """ID,CSMCODE,ORDDATE,ORDTIME,PRDTID,QUANTITY
1,C1,23/01/05,08:14:00,AJA001,2
1,C1,23/01/05,08:15:00,MAI001,1
2,C2,99/12/31,8:4:1,SOK001,3
2,C2,99/12/31,8:4:2,ZZZ999,9
3,C3,68/12/31,23:59:59,UMI001,1
"""

SALES = [
    {"id": 1, "amount": 2500, "event_time": "2023-01-05 08:14:00"},
    {"id": 1, "amount": 3690, "event_time": "2023-01-05 08:15:00"},
    {"id": 2, "amount": 3690, "event_time": "1999-12-31 08:04:01"},
    {"id": 3, "amount": 1215, "event_time": "2068-12-31 23:59:59"},
]


def subscribe(spark, topic):
    return topics.subscribe(spark, topic, topics.NUMBERED_VALUES)


def into(topic):
    return lambda sales, epoch: topics.publish_epoch(sales, topic, epoch)


@pytest.fixture
def tables(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(RAW)
    yield workflow.prepare_and_load(spark, str(tmp_path / "orders.csv"), str(tmp_path / "out"))
    for name in ("orders", "products", "pricelist"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_tables(spark, tables):
    assert {name: table.count() for name, table in tables.items()} == {
        "orders": 5, "products": 5, "pricelist": 5,
    }
    order = spark.table("orders").where("prdtid = 'ZZZ999'").first()
    assert (order.quantity, order.weight, order.amount) == (9, 216, None)
    assert dict(spark.table("orders").dtypes)["eventtime"] == "timestamp_ntz"


def test_from_table_to_sales_topic(spark, tables):
    orders, sales, checkpoint = (new_dir(spark, name) for name in ("orders", "sales", "c"))

    def process():
        stream = subscribe(spark, orders)
        workflow.process_orders(stream, into(sales), checkpoint).awaitTermination()

    workflow.publish_orders(tables["orders"], orders, process)
    values = [row.value for row in topics.read_topic(spark, sales).collect()]
    got = Counter(json.dumps(json.loads(value)) for value in values)
    assert got == Counter(map(json.dumps, SALES))
    query = workflow.print_topic(topics.subscribe(spark, sales), new_dir(spark, "c"))
    query.awaitTermination()
    assert sum(progress.numInputRows for progress in query.recentProgress) == len(SALES)


def test_bad_lines_are_set_aside_or_fail(spark, tmp_path):
    bad = "4,C4,23/02/30,08:00:00,AJA001,1\n,C5,23/02/03,08:00:00,AJA001,1\n"
    (tmp_path / "orders.csv").write_text(RAW + bad)
    args = (spark, str(tmp_path / "orders.csv"), str(tmp_path / "out"))
    try:
        with pytest.raises(Exception, match="not a valid order date"):
            workflow.prepare_and_load(*args)
        loaded = workflow.prepare_and_load(*args, overwrite=True, set_aside=True)
        assert {name: table.count() for name, table in loaded.items()} == dict.fromkeys(loaded, 5)
        rejected = spark.read.csv(f"{tmp_path}/out/Rejected.csv", header=True).collect()
        assert sorted(str(row.id) for row in rejected) == ["4", "None"]
    finally:
        for name in ("orders", "products", "pricelist"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_broken_cells_are_set_aside_with_their_line(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(RAW + "6,C6,23/02/03,08:00:00,AJA001\n7,C7,23/02/03,08:00:00,AJA001,x\n")
    args = (spark, str(tmp_path / "orders.csv"), str(tmp_path / "out"))
    try:
        loaded = workflow.prepare_and_load(*args, set_aside=True)
        assert {name: table.count() for name, table in loaded.items()} == dict.fromkeys(loaded, 5)
        rejected = spark.read.csv(f"{tmp_path}/out/Rejected.csv", header=True).collect()
        lines = ["6,C6,23/02/03,08:00:00,AJA001", "7,C7,23/02/03,08:00:00,AJA001,x"]
        assert sorted(row.line for row in rejected) == lines
        assert all(row.file.endswith("/orders.csv") for row in rejected)
    finally:
        for name in ("orders", "products", "pricelist"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_loads_that_stopped_are_finished_once(spark, tmp_path, monkeypatch):
    """Stopped at the second of three tables: the first is not loaded again."""
    (tmp_path / "orders.csv").write_text(RAW)
    args = (spark, str(tmp_path / "orders.csv"), str(tmp_path / "out"))
    plain = workflow.load_once

    def stopping(spark, name, *rest, **options):
        if name == "products":
            raise RuntimeError("stopped")
        return plain(spark, name, *rest, **options)

    try:
        with monkeypatch.context() as patch:
            patch.setattr(workflow, "load_once", stopping)
            with pytest.raises(RuntimeError, match="stopped"):
                workflow.prepare_and_load(*args, once=True)
        for _ in range(2):
            loaded = workflow.prepare_and_load(*args, once=True)
            assert {name: table.count() for name, table in loaded.items()} == dict.fromkeys(loaded, 5)
    finally:
        for name in ("orders", "products", "pricelist"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_broken_messages_are_skipped_or_fail(spark):
    orders, sales = new_dir(spark, "orders"), new_dir(spark, "sales")
    values = ['{"id":1,"amount":5,"event_time":"2023-01-05 08:14:00"}', '{"id":1']
    rows = [(value, seq) for seq, value in enumerate(values, 1)]
    topics.publish(spark.createDataFrame(rows, topics.NUMBERED_VALUES), orders)
    with pytest.raises(Exception, match="not an order message"):
        strict = workflow.process_orders(subscribe(spark, orders), into(sales), new_dir(spark, "c"))
        strict.awaitTermination()
    sales, checkpoint = new_dir(spark, "sales"), new_dir(spark, "c")
    stream = subscribe(spark, orders)
    workflow.process_orders(stream, into(sales), checkpoint, skip_broken=True).awaitTermination()
    got = [row.value for row in topics.read_topic(spark, sales).collect()]
    assert got == values[:1]
