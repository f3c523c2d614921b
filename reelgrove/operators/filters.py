"""Projections and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from reelgrove.functions import fixed_values as fixed
from reelgrove.functions.expressions import digest
from reelgrove.operators.joins import lookup_join


def derive_completed(df: DataFrame, flag: Column) -> DataFrame:
    return df.withColumn("completed", flag)


def valid_views(df: DataFrame, seconds: int = fixed.VALID_VIEW_SECONDS) -> DataFrame:
    return df.where(F.col("watch_seconds") > seconds)


def latest(df: DataFrame, ts: str) -> Column:
    """The newest timestamp of a table as a literal, NULL for an empty one.

    Found once by a job that reads this column. As a literal it reaches the scan's filters,
    which a subquery does not.
    """
    newest = df.agg(F.max(ts).cast("string").alias("t")).first()["t"]
    return F.lit(newest).cast(df.schema[ts].dataType)


def last_n_days(
    df: DataFrame, days: int, ts: str = "event_ts", as_of: Column | None = None
) -> DataFrame:
    """Rows newer than ``as_of`` minus ``days``; ``as_of`` defaults to the newest row."""
    end = latest(df, ts) if as_of is None else as_of
    return df.where(F.col(ts) > end - F.expr(f"INTERVAL {int(days)} DAYS"))


def cold_start_users(
    interactions: DataFrame, fewer_than: int = fixed.COLD_START_INTERACTIONS
) -> DataFrame:
    return (
        interactions.groupBy("user_id")
        .agg(F.count("*").alias("interaction_count"))
        .where(F.col("interaction_count") < fewer_than)
    )


def point_lookup(df: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col(key) == F.lit(value)).select(*columns)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(prefix + c) for c in df.columns])


def numeric_only(df: DataFrame, drop: Sequence[str] = (), booleans: bool = False) -> DataFrame:
    """Numeric columns outside ``drop``; with ``booleans``, those too as 0 and 1."""
    kept = []
    for field in df.schema:
        if field.name in drop:
            continue
        if isinstance(field.dataType, T.NumericType):
            kept.append(F.col(field.name))
        elif booleans and isinstance(field.dataType, T.BooleanType):
            kept.append(F.col(field.name).cast("int").alias(field.name))
    return df.select(kept)


def fill_missing(df: DataFrame, columns: Sequence[str], value=0) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def cast_bool_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in columns})


def like_prefix(df: DataFrame, value: Column, prefix: str) -> DataFrame:
    return df.where(value.startswith(prefix))


def candidate_filter(items: DataFrame, candidates: DataFrame, key: str = "content_id") -> DataFrame:
    """Items named in any candidate list (array column ``candidates``)."""
    wanted = candidates.select(F.explode("candidates").alias(key)).distinct()
    return lookup_join(items, wanted, key, "left_semi")


def capped_sample(
    df: DataFrame, identity: Sequence[str], cap: int = fixed.TRAINING_ROW_CAP
) -> DataFrame:
    """At most ``cap`` rows: those with the smallest digests of ``identity``.

    A digest threshold leaves about twice the cap before the final top-k, so that top-k
    never sees the whole table; it is raised until it lets enough rows through. The
    same rows always give the same sample.
    """
    total = df.count()
    if total <= cap:
        return df
    keyed = df.withColumn("__digest", digest(*identity))
    share = 2.0 * cap / total
    while share < 1.0:
        below = keyed.where(F.substring("__digest", 1, 12) < format(int(share * 16**12), "012x"))
        if below.count() >= cap:
            keyed = below
            break
        share *= 4
    return keyed.orderBy("__digest").limit(cap).drop("__digest")
