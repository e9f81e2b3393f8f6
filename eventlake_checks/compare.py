"""Compare a registered query with its DuckDB oracle on one scale folder."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the driver's tables as views."""
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def oracle_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


# Spark type of a column and the DuckDB types that carry the same values
_SAME = {
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty if columns, types and the bags of rows agree exactly."""
    names, expected = oracle_rows(con, sql)
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} but oracle has {sorted(names)}"]
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, (str(t) for t in relation.types)))
    notes = [
        f"{c} is {t} but oracle has {kinds[c]}"
        for c, t in df.dtypes
        if kinds[c] not in _SAME.get(t, {t.upper()})
    ]
    have = Counter(tuple(row) for row in df.select(*names).collect())
    want = Counter(expected)
    extra, lacking = have - want, want - have
    if extra or lacking:
        notes.append(
            f"{sum(extra.values())} rows only in Spark, e.g. {list(extra)[:2]}; "
            f"{sum(lacking.values())} rows only in the oracle, e.g. {list(lacking)[:2]}; columns {names}"
        )
    return notes
