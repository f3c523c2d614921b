"""Tables stored by key in buckets, so that joins and sums by that key need no shuffle.

A bucket is read by one task. Rows of keys that outweigh a few average buckets, and rows
without a key, would fill single buckets, so they are stored apart, without buckets. The two
parts share no key: whatever is computed per key is computed on each part and united.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from reelgrove.operators.joins import frequent_codes, key_code
from reelgrove.session import shared_dir

# Keys with this many average buckets' rows are stored apart; at most buckets / 4 keys are.
_HOT_BUCKETS = 4.0


@dataclass(frozen=True)
class Bucketed:
    """A stored table: ``ordinary`` rows in ``buckets`` buckets of ``key``, and ``hot`` rows."""

    key: str
    buckets: int
    ordinary: DataFrame
    hot: DataFrame
    hot_codes: tuple[int, ...]

    def rows(self) -> DataFrame:
        return self.ordinary.unionByName(self.hot)


def _is_hot(df: DataFrame, key: str, codes: tuple[int, ...]):
    column = F.col(f"`{key}`")
    return column.isNull() | F.coalesce(
        key_code([f"`{key}`"], [df.schema[key].dataType]).isin(list(codes)), F.lit(False)
    )


def store(df: DataFrame, key: str, buckets: int) -> Bucketed:
    """Write the rows by key. Tables to be joined need the same number of buckets.

    The files lie in the shared folder, the table's name in the session's catalog. All
    rows and columns are kept. One shuffle brings the ordinary rows of a bucket together.
    """
    spark = df.sparkSession
    source = spark.read.parquet(_written(df, "unbucketed"))
    support = min(0.2, _HOT_BUCKETS / buckets)
    codes = tuple(frequent_codes(source.select(F.col(f"`{key}`").alias("k")), [df.schema[key].dataType], support))
    apart = _is_hot(source, key, codes)
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        source.where(~apart).repartition(buckets, F.col(f"`{key}`"))
        .write.bucketBy(buckets, key).sortBy(key)
        .option("path", shared_dir(spark, "bucketed")).format("parquet").saveAsTable(name)
    )
    hot = spark.read.parquet(_written(source.where(apart), "hot-keys"))
    return Bucketed(key, buckets, spark.table(name), hot, codes)


def _written(df: DataFrame, purpose: str) -> str:
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return path


def lookup(fact: Bucketed, facts: Bucketed, how: str = "left") -> Bucketed:
    """Join ``fact`` to ``facts``, which holds at most one row per key, bucket by bucket.

    Hot rows meet only the rows of their own keys, at most one per hot code, which are
    broadcast. Rows without a key match nothing. ``how`` is ``left`` or ``inner``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    key = fact.key
    if (key, fact.buckets) != (facts.key, facts.buckets):
        raise ValueError("both tables need the same key and number of buckets")
    if fact.ordinary.schema[key].dataType != facts.ordinary.schema[key].dataType:
        raise ValueError("both keys need the same type")
    # A key may be stored apart on one side only.
    ordinary = facts.ordinary
    if facts.hot_codes:
        ordinary = ordinary.unionByName(facts.hot)
    of_hot = facts.rows().where(F.col(f"`{key}`").isNotNull() & _is_hot(fact.hot, key, fact.hot_codes))
    return Bucketed(
        key, fact.buckets,
        fact.ordinary.join(ordinary, key, how),
        fact.hot.join(F.broadcast(of_hot), key, how),
        fact.hot_codes,
    )


def per_key(table: Bucketed, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` on both parts, united; ``run`` groups by the key (and other columns)."""
    return run(table.ordinary).unionByName(run(table.hot))
