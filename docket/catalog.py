"""Tables of a data folder, and small literal tables for worked examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def literal(value) -> str:
    """A value as an SQL literal without escapes that engines read differently."""
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + value.replace("'", "''") + "'"


def values_sql(rows: list[tuple], columns: str) -> str:
    """Rows as a table expression that DuckDB and Spark read alike; columns are comma-separated names."""
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS v({columns}))"


def values(spark: SparkSession, rows: list[tuple], columns: str, kinds: str | None = None) -> DataFrame:
    names = [c.strip() for c in columns.split(",")]
    types = [k.strip() for k in kinds.split(",")] if kinds else ["string"] * len(names)
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in zip(names, types)))
