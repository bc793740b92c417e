"""Deterministic first and last rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_by_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in a stated order. Null keys are a key of their own.

    A rank window, not dropDuplicates, which may keep any row; the rank limit is applied before the shuffle.
    """
    by = [F.col(c).desc_nulls_last() if last else F.col(c).asc_nulls_last() for c in order]
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_n = 1").drop("_n")


def first_value_per_key(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """As keep_by_order for one unique order column, by an aggregate: map-side combined, no sort of hot keys."""
    return df.groupBy(*keys).agg(F.min(F.struct(order, *columns)).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in (order, *columns)))
