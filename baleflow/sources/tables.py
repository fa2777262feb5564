"""Tables with a declared schema: create if missing, load, scan."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from baleflow.schemas import TABLES
from baleflow.session import exists, rename
from baleflow.sources.csv_files import read_csv

#: Partition column of tables whose loads are in a ledger.
LOAD = "load"


def create_table(
    spark: SparkSession, name: str, schema: str, location: str | None = None, by_load: bool = False
) -> bool:
    """Create a Parquet table unless it exists; True if it was created."""
    if spark.catalog.tableExists(name):
        return False
    place = ""
    if location:
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        place = f" LOCATION '{quoted}'"
    parts = f" PARTITIONED BY ({LOAD})" if by_load else ""
    columns = f"{schema}, {LOAD} STRING" if by_load else schema
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}{place}")
    return True


def _declared(schema: str) -> list[tuple[str, str]]:
    parts = [part.split(None, 1) for part in schema.split(", ")]
    return [(name.lower(), kind.lower()) for name, kind in parts]


def check_table(spark: SparkSession, name: str, schema: str) -> None:
    """Refuse a table whose columns have not the declared names, types and lengths in that order.

    Rows go in by position, so that text columns in another order would take each other's values.
    """
    rows = spark.sql(f"DESCRIBE TABLE {name}").collect()
    found = []
    for row in rows:
        if not row.col_name or row.col_name.startswith("#"):
            break
        found.append((row.col_name.lower(), row.data_type.lower()))
    if found != _declared(schema):
        raise ValueError(f"table {name} has columns {found}, not {_declared(schema)}")


def load_csv(
    spark: SparkSession,
    name: str,
    path: str,
    kind: str,
    location: str | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Append CSV rows to table `name`, creating it with the schema of `kind` when missing.

    Columns go by position, the text NULL is null, and loading twice appends twice unless
    `overwrite` is set; `load_once` does not. Text longer than the declared VARCHAR length is refused,
    and so is a table that is there with other columns.
    """
    schema = TABLES[kind]
    create_table(spark, name, schema, location)
    check_table(spark, name, schema)
    rows = read_csv(spark, path, _plain(schema), null_value="NULL", by_position=True)
    rows.write.insertInto(name, overwrite=overwrite)
    return spark.table(name)


def load_key(spark: SparkSession, path: str) -> str:
    """A name for the files below a path, by their names and sizes; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    each = F.xxhash64("path", "length").cast("decimal(38,0)")
    row = files.agg(
        F.count("path").alias("files"), F.sum("length").alias("bytes"), F.sum(each).alias("digest")
    ).first()
    return f"{row.files}-{row.bytes or 0}-{int(row.digest or 0) % 2**64:016x}"


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first().data_type


def load_once(
    spark: SparkSession,
    name: str,
    path: str,
    kind: str,
    location: str | None = None,
    key: str | None = None,
) -> DataFrame:
    """Append CSV rows to table `name` unless these files were loaded before; returns its rows.

    The ledger of loads is the table's own partitions, one for each load, named after the source files
    and their sizes (or by `key`, for example that of the files the CSV was made of). A load is
    written aside and comes into the table by one rename: a load that failed, or was killed, has added
    nothing, and running it again adds each row once. What it was is in `loads`.
    """
    schema = TABLES[kind]
    create_table(spark, name, schema, location, by_load=True)
    check_table(spark, name, f"{schema}, {LOAD} STRING")
    place = _location(spark, name).rstrip("/")
    key = key or load_key(spark, path)
    target = f"{place}/{LOAD}={key}"
    if not exists(spark, target):
        rows = read_csv(spark, path, _plain(schema), null_value="NULL", by_position=True)
        hidden = f"{place}/_{uuid.uuid4().hex}"
        rows.select([_fitting(*column) for column in _declared(schema)]).write.parquet(hidden)
        count = spark.read.schema(_plain(schema)).parquet(hidden).count()
        entry = spark.range(1).select(
            F.lit(key).alias("load"), F.lit(path).alias("source"), F.lit(count).alias("rows"),
            F.current_timestamp().alias("loaded"),
        )
        entry.write.json(f"{hidden}/{LEDGER}")
        rename(spark, hidden, target)
    # Also after a run that was stopped between the rename and this.
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({LOAD} = '{key}')")
    return spark.table(name).drop(LOAD)


#: Folder within a load that readers of the table do not look at.
LEDGER = "_load"


def loads(spark: SparkSession, location: str) -> DataFrame:
    """The ledger of a table: load, source, rows, loaded (the time)."""
    schema = "load STRING, source STRING, rows BIGINT, loaded TIMESTAMP"
    return spark.read.schema(schema).json(f"{location}/{LOAD}=*/{LEDGER}")


def loaded_rows(spark: SparkSession, location: str, kind: str) -> DataFrame:
    """The rows of all loads at a location, without the catalog."""
    rows = spark.read.schema(f"{_plain(TABLES[kind])}, {LOAD} STRING").parquet(location)
    return rows.drop(LOAD)


def _fitting(name: str, kind: str) -> Column:
    """A column, refused where its text is longer than a VARCHAR allows."""
    length = re.fullmatch(r"varchar\((\d+)\)", kind)
    if not length:
        return F.col(name)
    message = F.concat(F.lit(f"EXCEED_LIMIT_LENGTH: longer than {kind}: "), F.col(name))
    return F.when(F.length(name) > int(length[1]), F.raise_error(message)).otherwise(F.col(name)).alias(name)


def _plain(schema: str) -> str:
    # The reader takes plain strings; the table checks their length on insert.
    return re.sub(r"VARCHAR\(\d+\)", "STRING", schema)


def jdbc_options(url: str, table: str, column: str, low: int, high: int, parts: int) -> dict:
    """Options of a scan split over `parts` connections on a numeric column."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(parts),
        "fetchsize": "10000",
    }


def scan_jdbc(spark: SparkSession, **options: str) -> DataFrame:
    """Scan a table of an external database (user and password are options too).

    Not tested: there is no database or driver in the test environment.
    """
    return spark.read.format("jdbc").options(**options).load()
