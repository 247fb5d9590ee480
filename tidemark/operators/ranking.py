"""Rank-1 per key and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(rows: DataFrame, keys: list[str], order: list[Column], rank: str = "rn") -> DataFrame:
    """The first row of each key. Spark limits the window's groups before and after the exchange."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(f"{rank} = 1").drop(rank)


def best_by(rows: DataFrame, keys: list[str], rank: list[Column], keep: list[str]) -> DataFrame:
    """The row of least rank of each key, as an aggregate: partial minima travel, not rows."""
    parts = [c.alias(f"r{i}") for i, c in enumerate(rank)]
    best = rows.groupBy(*keys).agg(F.min(F.struct(*parts, F.struct(*keep).alias("row"))).alias("best"))
    return best.select(*keys, *[F.col(f"best.row.{c}").alias(c) for c in keep])


def top(rows: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows; order must be total for the result to be definite."""
    return rows.orderBy(*order).limit(k)
