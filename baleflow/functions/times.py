"""Strict parsing and formatting of order dates and times.

Values that do not parse raise; `valid_*` tells beforehand whether they would. Text and
TIMESTAMP_NTZ are cast directly because `date_format` would go through the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted yy/MM/dd and HH:mm:ss (a part but the year may have one digit). They end
# in \z, since $ also matches before a final line break.
DATE_SHAPE = r"\A[0-9]{2}/[0-9]{1,2}/[0-9]{1,2}\z"
CLOCK_SHAPE = r"\A([01]?[0-9]|2[0-3]):[0-5]?[0-9]:[0-5]?[0-9]\z"

# Fixed value: event times in messages, all parts with all digits.
TIMESTAMP_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _iso_date(text: Column) -> Column:
    """yyyy-M-d text, null for another shape; the month and day may still be out of range."""
    # Two-digit years 69-99 are 19xx, 00-68 are 20xx.
    century = F.when(text >= "69", "19").otherwise("20")
    dashed = F.replace(text, F.lit("/"), F.lit("-"))
    return F.when(text.rlike(DATE_SHAPE), F.concat(century, dashed))


def _try_date(text: Column) -> Column:
    return _iso_date(text).try_cast("date")


def _try_time(text: Column) -> Column:
    padded = F.regexp_replace(text, r"\b([0-9])\b", "0$1")
    return F.when(text.rlike(CLOCK_SHAPE), F.when(F.length(text) == 8, text).otherwise(padded))


def _or_fail(value: Column, text: Column, kind: str) -> Column:
    shown = F.coalesce(text, F.lit("null"))
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"not a valid {kind}: "), shown)))


def parse_date(text: Column) -> Column:
    """`yy/MM/dd` text to DATE."""
    return _or_fail(_try_date(text), text, "order date")


def parse_time(text: Column) -> Column:
    """`HH:mm:ss` text to the same with two digits in each part."""
    return _or_fail(_try_time(text), text, "order time")


def valid_date(text: Column) -> Column:
    return _try_date(text).isNotNull()


def valid_time(text: Column) -> Column:
    return _try_time(text).isNotNull()


def event_time(date: Column, time: Column) -> Column:
    """A DATE and the text `parse_time` gives, as one TIMESTAMP_NTZ."""
    return F.concat(date.cast("string"), F.lit(" "), time).cast("timestamp_ntz")


def date_text(date: Column) -> Column:
    return date.cast("string")


def timestamp_text(timestamp: Column) -> Column:
    """TIMESTAMP_NTZ to `yyyy-MM-dd HH:mm:ss`."""
    return F.substring(timestamp.cast("string"), 1, 19)


def as_timestamp(text: Column) -> Column:
    """Text that `valid_timestamp` holds for, or null, to TIMESTAMP_NTZ."""
    return text.cast("timestamp_ntz")


def _try_timestamp(text: Column) -> Column:
    return F.when(text.rlike(TIMESTAMP_SHAPE), text.try_cast("timestamp_ntz"))


def parse_timestamp(text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` text to TIMESTAMP_NTZ."""
    return _or_fail(_try_timestamp(text), text, "event time")


def valid_timestamp(text: Column) -> Column:
    return _try_timestamp(text).isNotNull()
