"""Users, items, interactions and logs as views over the given star-schema tables."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from reelgrove.functions.expressions import completed_flag, json_field
from reelgrove.operators import medallion
from reelgrove.operators.features import item_features, user_features
from reelgrove.operators.filters import derive_completed
from reelgrove.operators.joins import lookup_join
from reelgrove.session import stored
from reelgrove.sources.tables import read_table

# Views that one task joins, sums and sorts.
TASK_VIEWS = 500_000


def users(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name"
    )
    key = F.col("c_custkey")
    return customer.join(nation, "c_nationkey").select(
        F.nullif(key, F.lit(0)).alias("user_id"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("user_"), key.cast("string"), F.lit("@example.invalid")).alias("email"),
        F.concat(F.lit("+66"), (key + 100_000_000).cast("string")).alias("phone"),
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("content_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("genre"),
        F.col("p_brand").alias("language"),
        (F.lit(1990) + F.col("p_size") % 36).alias("release_year"),
        (F.col("p_size") - 2).alias("duration_min"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("synopsis"),
    )


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "orderkey")
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_custkey"
    )
    return lookup_join(lines, orders, "orderkey", "inner").select(
        F.concat(
            F.col("orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
        ).alias("interaction_id"),
        F.nullif("o_custkey", F.lit(0)).alias("user_id"),
        F.col("l_partkey").alias("content_id"),
        F.col("l_shipdate").alias("event_ts"),
        (F.col("l_quantity") * 60).cast("bigint").alias("watch_seconds"),
        F.col("l_returnflag").alias("device"),
    )


def silver_users(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.silver_users(users(spark, folder))


def silver_items(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.silver_items(items(spark, folder))


def silver_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return medallion.silver_interactions(interactions(spark, folder))


def _watched_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Item ids as often as they are watched, without the join to orders."""
    lines = read_table(spark, folder, "lineitem")
    return lines.select(F.col("l_partkey").alias("content_id"))


def gold_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Gold interactions with ``completed``, unknown where the item was rejected."""
    gold = medallion.gold_interactions(
        silver_interactions(spark, folder),
        silver_items(spark, folder),
        silver_users(spark, folder),
        item_columns=("genre", "release_year", "duration_min"),
        item_keys_from=_watched_keys(spark, folder),
    )
    return derive_completed(gold, completed_flag("watch_seconds", "duration_min")).drop(
        "duration_min"
    )


def view_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks that hold about ``TASK_VIEWS`` views each, however many views there are."""
    views = read_table(spark, folder, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, math.ceil(views / TASK_VIEWS))


def viewed_items(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """Gold interactions without user facts, for questions that need none.

    With ``tasks`` they come dealt by item into so many, for steps that hold a task's views in
    memory several times: Spark merges shuffled partitions by their compressed size, and so a
    task's rows would grow with the table.
    """
    views = silver_interactions(spark, folder)
    joined = lookup_join(
        views if tasks is None else views.repartition(tasks, "content_id"),
        silver_items(spark, folder).select("content_id", "genre", "duration_min"),
        "content_id",
        keys_from=_watched_keys(spark, folder),
    )
    return derive_completed(joined, completed_flag("watch_seconds", "duration_min")).drop(
        "duration_min"
    )


def all_user_features(spark: SparkSession, folder: str) -> DataFrame:
    return user_features(viewed_items(spark, folder))


def all_item_features(spark: SparkSession, folder: str) -> DataFrame:
    return item_features(silver_items(spark, folder), viewed_items(spark, folder))


def feature_tables(spark, folder):
    """Gold interactions and both feature tables, stored, as models and lists read them often."""
    gold = stored(gold_interactions(spark, folder), "gold_interactions")
    items = stored(silver_items(spark, folder), "silver_items")
    return (
        gold,
        stored(user_features(gold), "user_features"),
        stored(item_features(items, gold), "item_features"),
    )


def list_tables(spark, folder):
    """Both feature tables, stored, from views without user facts."""
    views = stored(
        viewed_items(spark, folder).select(
            "user_id", "content_id", "genre", "watch_seconds", "event_ts", "completed"
        ),
        "viewed_items",
    )
    return (
        stored(user_features(views, is_stored=True), "user_features"),
        stored(item_features(silver_items(spark, folder), views), "item_features"),
    )


# ---- logs ---------------------------------------------------------------------

def _events(spark: SparkSession, folder: str, *types: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    if types:
        events = events.where(F.col("event_type").isin(*types))
    return events.withColumn("k", json_field("props", "$.k", "int"))


def served(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "view").select(
        "user_id",
        F.col("k").alias("content_id"),
        F.col("ts").alias("served_at"),
        F.col("value").alias("score"),
    )


def watched(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder, "click", "purchase").select(
        "event_id",
        "user_id",
        F.col("k").alias("content_id"),
        F.col("ts").alias("event_ts"),
        (F.col("value") * 10).cast("bigint").alias("watch_seconds"),
    )


def scored_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One scored request per event, before it is logged as JSON."""
    return _events(spark, folder).select(
        "event_id",
        F.col("ts").alias("request_time"),
        "user_id",
        F.array(
            F.struct(
                F.col("k").alias("content_id"),
                F.col("value").alias("score"),
                F.col("event_type").alias("genre"),
            )
        ).alias("recommendations"),
    )


def audit(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.col("event_type").alias("action_name"),
        F.col("props").alias("request_params"),
    )


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("content_id"), "embedding"
    )
