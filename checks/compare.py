"""Compare a registered query with its SQL over the same tables, as sets of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pyarrow as pa
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _rows(result: pa.Table) -> tuple[list[tuple[str, str]], Counter]:
    result = result.select(sorted(result.column_names))
    kinds = [(f.name, str(f.type).replace("large_", "")) for f in result.schema]
    columns = [c.to_pylist() for c in result.columns]
    return kinds, Counter(zip(*columns, strict=True)) if columns else Counter()


def differences(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list[str]:
    """What differs; empty when schema, row counts and all values agree."""
    kinds, got = _rows(QUERIES[name](spark, sf_dir).toArrow())
    expected_kinds, expected = _rows(con.sql(ORACLES[name]).to_arrow_table())
    found = []
    if kinds != expected_kinds:
        found.append(f"schema {kinds} instead of {expected_kinds}")
    if got != expected:
        extra, lost = got - expected, expected - got
        found.append(
            f"{sum(got.values())} rows for {sum(expected.values())}; "
            f"{sum(extra.values())} extra such as {list(extra)[:2]}, {sum(lost.values())} lost such as {list(lost)[:2]}"
        )
    return found
