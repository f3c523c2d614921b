"""Silver and gold tables from users, items and interactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.joins import lookup_join
from reelgrove.operators.quality import (
    INTERACTION_RULES,
    ITEM_RULES,
    USER_RULES,
    Rule,
    apply_rules,
)


def silver(
    bronze: DataFrame,
    rules: Sequence[Rule],
    key: str | None = None,
    observation=None,
    rules_first: bool = False,
) -> DataFrame:
    """Keep one row per key, then apply the rules, or the other way round."""
    if rules_first:
        bronze = apply_rules(bronze, rules, observation)
        return dedupe_by_key(bronze, key) if key else bronze
    deduped = dedupe_by_key(bronze, key) if key else bronze
    return apply_rules(deduped, rules, observation)


def silver_users(bronze: DataFrame, **options) -> DataFrame:
    return silver(bronze, USER_RULES, "user_id", **options)


def silver_items(bronze: DataFrame, **options) -> DataFrame:
    return silver(bronze, ITEM_RULES, "content_id", **options)


def silver_interactions(bronze: DataFrame, **options) -> DataFrame:
    """Interactions are checked but not deduplicated."""
    return silver(bronze, INTERACTION_RULES, None, **options)


def genre_enrich(
    rows: DataFrame, items: DataFrame, keys_from: DataFrame | None = None
) -> DataFrame:
    genres = items.select("content_id", "genre")
    return lookup_join(rows, genres, "content_id", keys_from=keys_from)


def gold_interactions(
    interactions: DataFrame,
    items: DataFrame,
    users: DataFrame,
    item_columns: Sequence[str] = ("genre", "release_year"),
    user_columns: Sequence[str] = ("country", "age"),
    item_keys_from: DataFrame | None = None,
) -> DataFrame:
    """Every interaction with facts about its item and its user, where known."""
    with_items = lookup_join(
        interactions,
        items.select("content_id", *item_columns),
        "content_id",
        keys_from=item_keys_from,
    )
    return lookup_join(
        with_items, users.select("user_id", *user_columns), "user_id", keys_from=interactions
    )


def gold_user_360(interactions: DataFrame, items: DataFrame) -> DataFrame:
    """Per-user totals.

    Views are summed per user and item before the genre is looked up, so the join and
    the last shuffle carry one row per pair instead of one per view, and the number of
    pairs is the distinct count. The first genre is that of the earliest view whose
    item has one, ties by item.
    """
    pairs = interactions.groupBy("user_id", "content_id").agg(
        F.count("*").alias("views"),
        F.count("watch_seconds").alias("timed"),
        F.sum("watch_seconds").alias("seconds"),
        F.min("event_ts").alias("first_ts"),
    )
    enriched = genre_enrich(pairs, items, keys_from=interactions)
    return enriched.groupBy("user_id").agg(
        F.sum("views").alias("interaction_count"),
        F.sum("seconds").alias("total_watch_seconds"),
        (F.sum("seconds") / F.sum("timed")).alias("avg_watch_seconds"),
        F.count("content_id").alias("unique_content_watched"),
        first_genre("first_ts").alias("first_genre_seen"),
    )


def first_genre(first_ts: str):
    """Aggregate: the genre of the earliest row that has one."""
    return F.min_by(
        "genre", F.when(F.col("genre").isNotNull(), F.struct(F.col(first_ts), F.col("content_id")))
    )
