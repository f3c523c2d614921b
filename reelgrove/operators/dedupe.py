"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def dedupe_by_key(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """The first row of each key in a stated order; NULL keys form one group.

    ``order`` must be total for a repeatable result; by default it is every other
    column. The rank filter is applied before the shuffle as well, so a key with very
    many copies sends one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = list(order) if order else [
        F.col(c).asc_nulls_last() for c in df.columns if c not in keys
    ]
    ranked = df.withColumn(
        "__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.where("__rn = 1").drop("__rn")
