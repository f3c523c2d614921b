"""Keeping a table of item vectors in step with the items, by what changed.

The state of an index is two keyed tables: the digest of each item's inputs as of the last
sync, and its vector. A sync compares digests, embeds the new and changed items alone,
replaces their vectors and drops those of items that are gone. Only buckets that hold such
items are written. A sync that is run again after a failure finds what is still different.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reelgrove.operators.upsert import upsert_by_key
from reelgrove.session import stored
from reelgrove.sources.tables import KeyedTable

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def digest_of(columns: Sequence[str]) -> Column:
    """A digest of some columns that tells NULL from empty and one column from the next."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    marked = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*marked), 256)


def changes_since(state: DataFrame, items: DataFrame, key: str, inputs: Sequence[str]) -> DataFrame:
    """(key, digest, change_type) of items that are new, changed or gone since ``state``."""
    now = items.where(F.col(key).isNotNull()).select(key, digest_of(inputs).alias("__now"))
    joined = state.select(key, F.col("digest").alias("__then")).join(now, key, "full_outer")
    kind = (
        F.when(F.col("__then").isNull(), INSERT)
        .when(F.col("__now").isNull(), DELETE)
        .when(F.col("__then") != F.col("__now"), UPDATE)
    )
    return (
        joined.withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        .select(key, F.col("__now").alias("digest"), "change_type")
    )


class VectorIndex:
    """Vectors of items in a folder, with the digests they were made from."""

    def __init__(self, spark: SparkSession, path: str, key: str, inputs: Sequence[str], buckets: int = 16):
        self.spark = spark
        self.key = key
        self.inputs = list(inputs)
        self.digests = KeyedTable(spark, f"{path}/digests", key, buckets)
        self.vectors = KeyedTable(spark, f"{path}/vectors", key, buckets)

    def changes(self, items: DataFrame) -> DataFrame:
        """What a sync with these items would do."""
        if self.digests.exists():
            state = self.digests.read()
        else:
            state = items.limit(0).select(self.key, F.lit("").alias("digest"))
        return changes_since(state, items, self.key, self.inputs)

    def sync(self, items: DataFrame, embed: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
        """Bring the index up to the items; returns how many rows of each kind there were.

        ``embed`` gets the new and changed items, whole rows, and returns the key and what
        the index is to hold of each. Items need one row per key; rows without a key are not
        indexed. Vectors are written before digests, so a sync cut short is made up for by the
        next one.
        """
        changed = stored(self.changes(items), "index_changes")
        counts = {r["change_type"]: r["count"] for r in changed.groupBy("change_type").count().collect()}
        if not counts:
            return counts
        live = changed.where(F.col("change_type") != DELETE)
        rows = items.join(live.select(self.key), self.key, "left_semi")
        fresh = stored(embed(rows), "fresh_vectors")
        self._apply(self.vectors, changed, fresh)
        self._apply(self.digests, changed, live.select(self.key, "digest"))
        return counts

    def _apply(self, table: KeyedTable, changed: DataFrame, fresh: DataFrame) -> None:
        gone = changed.where(F.col("change_type") == DELETE).select(self.key)

        def merge(held: DataFrame) -> DataFrame:
            left = held.join(gone, self.key, "left_anti")
            return upsert_by_key(left, fresh, self.key, check=False)

        if table.exists():
            table.rewrite(changed.select(self.key), merge)
        else:
            table.replace(fresh)

    def read(self) -> DataFrame:
        return self.vectors.read()
