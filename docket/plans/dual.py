"""Queries whose SQL text both engines read.

The text names tables in braces, marks regular expressions as raw literals (r'...'), and ends a replacement that is
meant for all matches with /*g*/. Spark runs it over the parquet tables; the DuckDB twin differs in notation only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from docket import registry

_TABLE = re.compile(r"\{([a-z]+)\}")


def spark_text(sql: str, sf_dir: str) -> str:
    return _TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet`", sql)


def duck_text(sql: str) -> str:
    return re.sub(r"\br'", "'", _TABLE.sub(lambda m: m[1], sql)).replace("/*g*/", ", 'g'").replace("/*duck:", "").replace(":duck*/", "")


def dual(name: str, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(spark_text(sql, sf_dir))

    run.__name__, run.__doc__ = name, f"SQL plan {name}."
    registry.query(name, duck_text(sql))(run)
