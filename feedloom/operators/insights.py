"""Counts that show no small group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suppressed_counts(df: DataFrame, keys: Sequence[str], person: str, least: int = 50, where: Column | None = None) -> DataFrame:
    """(keys, n_events, n_people) of the groups with at least ``least`` people.

    People are counted exactly, in two steps: one row a person and group first,
    so that a large group is never one task's.
    """
    rows = df if where is None else df.where(where)
    each = rows.where(F.col(person).isNotNull()).groupBy(*keys, person).agg(F.count(F.lit(1)).alias("x_n"))
    return each.groupBy(*keys).agg(F.sum("x_n").alias("n_events"), F.count(F.lit(1)).alias("n_people")).where(F.col("n_people") >= least)
