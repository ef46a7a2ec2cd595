"""Run a registered query in Spark and its SQL in DuckDB and compare every value."""

from __future__ import annotations

from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def duckdb_rows(con, sql):
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    types = [str(column[1]) for column in result.description]
    return names, types, result.fetchall()


SPARK_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "SMALLINT": "smallint",
    "TINYINT": "tinyint",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def spark_type(duckdb_type: str) -> str:
    return SPARK_TYPE.get(duckdb_type, duckdb_type.lower())


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((value is not None, str(value)) for value in row),
    )


def assert_same(df, con, sql):
    names, types, expected = duckdb_rows(con, sql)
    assert sorted(df.columns) == sorted(names)
    assert dict(df.dtypes) == {n: spark_type(t) for n, t in zip(names, types, strict=True)}
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(expected)
    got, want = sorted_rows(df.columns, rows), sorted_rows(names, expected)
    different = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    assert not different, f"{len(different)} of {len(got)} rows differ, first: {different[0]}"
