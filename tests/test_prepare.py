"""Edge rows of parsing and lookups, expected values by hand."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from baleflow.functions.times import parse_date, parse_time, valid_date, valid_time
from baleflow.operators.prepare import (
    accepted_lines,
    distinct_products,
    prepare_orders,
    pricelist,
    priced_orders,
    products,
    rejected_lines,
    unpriced_orders,
)
from baleflow.schemas import ORDER_COLUMNS, RAW_ORDERS


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_ORDERS)


def line(day="23/01/05", time="08:14:00", product="AJA001", quantity=3):
    return (1, "C000001", day, time, product, quantity)


@pytest.mark.parametrize(
    "text, day",
    [
        ("68/12/31", dt.date(2068, 12, 31)),
        ("69/01/01", dt.date(1969, 1, 1)),
        ("70/01/02", dt.date(1970, 1, 2)),
        ("99/12/31", dt.date(1999, 12, 31)),
        ("00/02/29", dt.date(2000, 2, 29)),
        ("23/1/5", dt.date(2023, 1, 5)),
    ],
)
def test_dates(spark, text, day):
    row = spark.createDataFrame([(text,)], "x STRING").select(parse_date(F.col("x"))).first()
    assert row[0] == day


BAD_DATES = [
    "2023/01/05", "23-01-05", " 23/01/05", "23/01/05 ", "23/13/01", "23/02/30", "3/01/05",
    "23/001/05", "", "23/01", None,
]


@pytest.mark.parametrize("text", BAD_DATES)
def test_bad_date_fails(spark, text):
    with pytest.raises(Exception, match="not a valid order"):
        prepare_orders(raw(spark, line(day=text))).collect()


@pytest.mark.parametrize("text, time", [("8:4:1", "08:04:01"), ("23:59:59", "23:59:59")])
def test_times(spark, text, time):
    row = spark.createDataFrame([(text,)], "x STRING").select(parse_time(F.col("x"))).first()
    assert row[0] == time


BAD_TIMES = ["24:00:00", "08:14", "08:60:00", "23:59:60", "08:14:00.5", "008:14:00", "", None]


@pytest.mark.parametrize("text", BAD_TIMES)
def test_bad_time_fails(spark, text):
    with pytest.raises(Exception, match="not a valid order"):
        prepare_orders(raw(spark, line(time=text))).collect()


def test_bad_lines_can_be_set_aside(spark):
    bad = [line(day=text) for text in BAD_DATES] + [line(time=text) for text in BAD_TIMES]
    lines = raw(spark, line(), *bad)
    assert rejected_lines(lines).count() == len(bad)
    assert prepare_orders(accepted_lines(lines)).count() == 1


def test_bad_values_fail_without_ansi_too(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a valid order"):
            prepare_orders(raw(spark, line(day="23/02/30"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_prepared_line(spark):
    row = prepare_orders(raw(spark, line())).select(ORDER_COLUMNS).first()
    assert row.asDict() == {
        "id": 1,
        "csmcode": "C000001",
        "orddate": dt.date(2023, 1, 5),
        "ordtime": "08:14:00",
        "prdtid": "AJA001",
        "quantity": 3,
        "weight": 72,
        "amount": 3750,
        "eventtime": dt.datetime(2023, 1, 5, 8, 14),
    }


def test_time_in_a_daylight_saving_gap_is_kept(spark):
    # 02:30 did not exist that day in the session time zone of the tests.
    row = prepare_orders(raw(spark, line("97/04/06", "02:30:00"))).first()
    assert row.eventtime == dt.datetime(1997, 4, 6, 2, 30)


def test_unknown_product_has_no_amount(spark):
    orders = prepare_orders(raw(spark, line(product="ZZZ999"), line()))
    unpriced = unpriced_orders(orders).collect()
    assert [(row.prdtid, row.quantity, row.amount) for row in unpriced] == [("ZZZ999", 3, None)]
    assert [row.prdtid for row in priced_orders(orders).collect()] == ["AJA001"]


def test_product_with_two_prices_and_no_name(spark):
    lines = raw(spark, line(product="MAI001", quantity=1))
    assert prepare_orders(lines).first().amount == 1190
    assert pricelist(lines).first().asDict() == {
        "id": "PRC1", "prdtid": "MAI001", "uom": "Bale", "price": 1170,
    }
    assert products(lines).first().asDict() == {
        "id": "MAI001", "name": None, "stock": 1500, "restock": 1000, "unitweight": 24,
    }


def test_products_keep_one_row_per_line(spark):
    lines = raw(spark, line(), line(), line(product="SOK001"))
    assert products(lines).count() == pricelist(lines).count() == 3
    assert distinct_products(lines).count() == 2


def _strptime(text, shape):
    try:
        return dt.datetime.strptime(text, shape)
    except ValueError:
        return None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.from_regex(r"[0-9]{1,3}[/-][0-9]{0,2}/[0-9]{1,2}", fullmatch=True),
            st.from_regex(r"[0-9]{0,3}:[0-9]{1,2}:[0-9]{1,2}", fullmatch=True),
        ),
        min_size=200,
        max_size=200,
    )
)
def test_parsing_agrees_with_python(spark, texts):
    """Which texts parse, and to what; no leap seconds."""
    texts = [(day, time) for day, time in texts if not time.endswith((":60", ":61"))]
    frame = spark.createDataFrame(texts, "day STRING, time STRING")
    parsed = frame.select(
        "day",
        "time",
        F.when(valid_date(F.col("day")), parse_date(F.col("day"))).alias("date"),
        F.when(valid_time(F.col("time")), parse_time(F.col("time"))).alias("clock"),
    )
    for row in parsed.collect():
        day, time = _strptime(row.day, "%y/%m/%d"), _strptime(row.time, "%H:%M:%S")
        assert row.date == (day and day.date()), row.day
        assert row.clock == (time and time.strftime("%H:%M:%S")), row.time
