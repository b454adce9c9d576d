"""Order-dependent operators with explicit positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fill_heading(rows: DataFrame, key: str, pos: str, is_heading: Column, heading: Column, name: str) -> DataFrame:
    """Give each item the last heading before it; headings themselves and items before the first one are dropped."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("_is_heading", is_heading)
    filled = marked.withColumn(name, F.last(F.when(F.col("_is_heading"), heading), ignorenulls=True).over(w))
    return filled.where(~F.col("_is_heading") & F.col(name).isNotNull()).drop("_is_heading")


def first_of(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def collapse_adjacent(rows: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """Drop rows that repeat the value just before them; equal values further apart stay."""
    w = Window.partitionBy(key).orderBy(pos)
    return rows.withColumn("_before", F.lag(value).over(w)).where(~F.col("_before").eqNullSafe(F.col(value)) | F.col("_before").isNull()).drop("_before")


def preceding(rows: DataFrame, key: str, pos: str, found: Column, name: str) -> DataFrame:
    """As-of lookup: the last non-null value strictly before each row."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.last(found, ignorenulls=True).over(w))
