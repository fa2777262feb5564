"""Compare a Spark result with DuckDB, order-insensitive, by column name."""

from __future__ import annotations

from pathlib import Path

import duckdb


def _sorted(columns, rows):
    places = sorted(range(len(columns)), key=lambda place: columns[place])
    names = [columns[place] for place in places]
    return names, sorted((tuple(str(row[place]) for place in places) for row in rows))


def oracle_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        files = f"{file}/*.parquet" if file.is_dir() else file
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{files}'")
    result = con.execute(sql)
    return _sorted([column[0] for column in result.description], result.fetchall())


def spark_rows(df):
    return _sorted(df.columns, df.collect())
