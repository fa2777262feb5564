"""CSV files with a header, read with a fixed schema; a value of the wrong type fails the job.

Cells are quoted as other tools do it: a quote within a cell is doubled, blanks around a text and
backslashes are part of it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.session import names, remove, rename

TIMESTAMP = "yyyy-MM-dd HH:mm:ss"

# How cells are quoted, for reader and writer.
CELLS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str,
    null_value: str = "",
    by_position: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """The header of each file must name the columns of the schema, in any case of letters;
    `by_position` skips it unread. With `multiline` a quoted cell may hold line breaks; a file is
    then read by one task, whatever its size."""
    return spark.read.options(**CELLS).csv(
        path,
        schema=schema,
        header=True,
        mode="FAILFAST",
        nullValue=null_value,
        enforceSchema=by_position,
        dateFormat="yyyy-MM-dd",
        multiLine=multiline,
    )


#: Columns of a line that `read_csv_leniently` cannot read: its file, and its text (null for others).
FILE, LINE = "file", "line"


def read_csv_leniently(spark: SparkSession, path: str, schema: str, null_value: str = "") -> DataFrame:
    """As `read_csv`, with the columns FILE and LINE.

    A line of a wrong number of cells, or with a cell of a wrong type, does not fail the job: it comes
    with its text as LINE, and its other columns hold what could be read. Write the rows before they
    are filtered: a plan that reads a part of the columns only does not look at the others.
    """
    rows = spark.read.options(**CELLS).csv(
        path,
        schema=f"{schema}, {LINE} STRING",
        header=True,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=LINE,
        nullValue=null_value,
        enforceSchema=False,
        dateFormat="yyyy-MM-dd",
    )
    return rows.withColumn(FILE, F.col("_metadata.file_path"))


def write_csv(rows: DataFrame, path: str, multiline: bool = False) -> None:
    """Overwrite a folder of CSV files; nulls become empty cells.

    A text with a line break fails the job, as files with one cannot be split over tasks, unless
    `multiline` is set here and in `read_csv`.
    """
    if not multiline:
        rows = rows.withColumns(
            {name: _one_line(name) for name, kind in rows.dtypes if kind.startswith(("string", "char", "varchar"))}
        )
    writer = rows.write.mode("overwrite").options(**CELLS)
    writer.option("timestampNTZFormat", TIMESTAMP).csv(path, header=True)


def _one_line(name: str):
    message = F.concat(F.lit(f"line break in column {name}: "), F.col(name))
    return F.when(F.col(name).rlike(r"[\r\n]"), F.raise_error(message)).otherwise(F.col(name))


VERSION = "version="


def _versions(spark: SparkSession, path: str) -> list[int]:
    found = [name.removeprefix(VERSION) for name in names(spark, path) if name.startswith(VERSION)]
    return sorted(map(int, found))


def write_snapshot(rows: DataFrame, path: str, keep: int = 2, multiline: bool = False) -> None:
    """Write CSV files as the next version below `path`.

    A version gets its name when it is whole, so that `read_snapshot` finds the last whole one at any
    time, also while the next is written or after a write that failed. The last `keep` versions stay,
    for readers that have begun. Of two writers at once the later one fails.
    """
    spark = rows.sparkSession
    hidden = f"{path}/_{uuid.uuid4().hex}"
    write_csv(rows, hidden, multiline)
    versions = _versions(spark, path)
    number = versions[-1] + 1 if versions else 1
    rename(spark, hidden, f"{path}/{VERSION}{number}")
    for old in [*versions, number][:-keep]:
        remove(spark, f"{path}/{VERSION}{old}")


def read_snapshot(spark: SparkSession, path: str, schema: str, **options) -> DataFrame:
    """The last whole version, read as `read_csv` does."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no snapshot in {path}")
    return read_csv(spark, f"{path}/{VERSION}{versions[-1]}", schema, **options)
