"""Keyed upsert, change detection and history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.ordered import next_in_group


class DuplicateKeyError(ValueError):
    """Two source rows claim the same target row."""


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    complete = source.dropna(subset=list(keys))
    twice = complete.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1")
    found = twice.select(*keys).first()
    if found is not None:
        raise DuplicateKeyError(f"upsert source repeats key {found.asDict()}")


def upsert_by_key(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], check: bool = True
) -> DataFrame:
    """Rows of ``source`` replace target rows of the same key whole; others are added.

    Target rows that the source does not name stay. NULL keys match nothing.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if check:
        require_unique(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def change_feed(old: DataFrame, new: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows inserted, updated or deleted between two states of a keyed table.

    Updates carry the new values, deletes the old ones. Whole rows are compared, NULL
    equal to NULL, so no change can hide behind a hash collision.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    values = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*values).alias("__old"))
    after = new.select(*keys, F.struct(*values).alias("__new"))
    joined = before.join(after, keys, "full_outer")
    kind = (
        F.when(F.col("__old").isNull(), "insert")
        .when(F.col("__new").isNull(), "delete")
        .when(~F.col("__old").eqNullSafe(F.col("__new")), "update")
    )
    return (
        joined.withColumn("change_type", kind)
        .where(F.col("change_type").isNotNull())
        .withColumn("__row", F.coalesce("__new", "__old"))
        .select("change_type", *keys, *[F.col(f"__row.{c}").alias(c) for c in values])
    )


def scd2_from_cdc(
    changes: DataFrame,
    keys: str | Sequence[str],
    sequence_by: str,
    tie_break: str | None = None,
    slice_seconds: int = 3_600,
) -> DataFrame:
    """History rows with ``valid_from``, ``valid_to`` and ``is_current``.

    Of several changes to a key at one instant the last by ``tie_break`` counts.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(tie_break).desc()] if tie_break else None
    latest = dedupe_by_key(changes, [*keys, sequence_by], order)
    history = next_in_group(latest, keys, sequence_by, "valid_to", slice_seconds)
    return history.withColumnRenamed(sequence_by, "valid_from").withColumn(
        "is_current", F.col("valid_to").isNull()
    )


def scd2_apply(
    history: DataFrame, changes: DataFrame, keys: str | Sequence[str], sequence_by: str,
    tie_break: str | None = None,
) -> DataFrame:
    """Add a batch of changes to a history; late changes fall into their place."""
    earlier = history.withColumnRenamed("valid_from", sequence_by).drop("valid_to", "is_current")
    return scd2_from_cdc(
        earlier.unionByName(changes), keys, sequence_by, tie_break
    )
