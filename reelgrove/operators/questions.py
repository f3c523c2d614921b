"""Fixed business questions over gold interactions and recommendation logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reelgrove.functions.expressions import age_band, is_weekend
from reelgrove.operators.filters import cold_start_users, last_n_days, latest, valid_views
from reelgrove.operators.joins import lookup_join
from reelgrove.session import stored

HOUR = 3600


def _rate() -> Column:
    return F.avg(F.col("completed").cast("int")).alias("completion_rate")


def top_shows_week(gold: DataFrame, items: DataFrame, k: int = 10, days: int = 7) -> DataFrame:
    """Most watched items of the last week; titles are looked up for the winners only."""
    top = stored(
        valid_views(last_n_days(gold, days))
        .groupBy("content_id")
        .agg(F.sum("watch_seconds").alias("watch_seconds"), F.count("*").alias("views"))
        .orderBy(F.desc("watch_seconds"), "content_id")
        .limit(k),
        "top_shows",
    )
    # Both broadcast sides hold at most k rows.
    titles = items.select("content_id", "title", "genre")
    found = titles.join(F.broadcast(top.select("content_id")), "content_id", "left_semi")
    return top.join(F.broadcast(found), "content_id", "left")


def completion_by_genre(gold: DataFrame) -> DataFrame:
    return gold.groupBy("genre").agg(
        F.count("*").alias("views"), F.count("completed").alias("rated_views"), _rate()
    )


def engagement_by_age(gold: DataFrame, genre: str) -> DataFrame:
    """Views, viewers, hours and completion per age segment for one genre."""
    return (
        gold.where(F.col("genre") == genre)
        .groupBy(age_band("age").alias("age_segment"))
        .agg(
            F.count("*").alias("views"),
            F.count_distinct("user_id").alias("viewers"),
            (F.sum("watch_seconds") / HOUR).alias("watch_hours"),
            _rate(),
        )
    )


def top_users(gold: DataFrame, k: int = 10, days: int = 7) -> DataFrame:
    return (
        last_n_days(gold, days)
        .groupBy("user_id")
        .agg(F.sum("watch_seconds").alias("watch_seconds"))
        .orderBy(F.desc("watch_seconds"), "user_id")
        .limit(k)
    )


def served_then_watched(
    watched: DataFrame, served: DataFrame, hours: int = 168, output: str | None = None
) -> DataFrame:
    """Watches that a recommendation of the same item preceded by at most ``hours``.

    Time is cut into slices as long as the look-back. Such a recommendation exists
    exactly if the first one in the watch's slice is not later than the watch, or the
    last one in the slice before is not too old. So the log shrinks to a first and a
    last time per user, item and slice, and no key multiplies rows.

    With ``output`` every watch is kept and the answer added as a boolean column.
    """
    width = hours * HOUR
    keys = ["user_id", "content_id", "__slice"]

    def micros(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    def slice_of(column: str) -> Column:
        return F.floor(micros(column) / F.lit(width * 1_000_000))

    per_slice = (
        served.select("user_id", "content_id", micros("served_at").alias("at"), slice_of("served_at").alias("__slice"))
        .groupBy(*keys)
        .agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"))
    )
    reach = F.array(
        F.struct(
            F.col("__slice").alias("slice"),
            F.col("first_at").alias("same"),
            F.lit(None).cast("bigint").alias("before"),
        ),
        F.struct(
            (F.col("__slice") + 1).alias("slice"),
            F.lit(None).cast("bigint").alias("same"),
            F.col("last_at").alias("before"),
        ),
    )
    reachable = (
        per_slice.select("user_id", "content_id", F.inline(reach))
        .withColumnRenamed("slice", "__slice")
        .groupBy(*keys)
        .agg(F.min("same").alias("__same"), F.max("before").alias("__before"))
    )
    rows = lookup_join(watched.withColumn("__slice", slice_of("event_ts")), reachable, keys)
    at = micros("event_ts")
    answer = F.coalesce(F.col("__same") <= at, F.lit(False)) | F.coalesce(
        F.col("__before") >= at - F.lit(width * 1_000_000), F.lit(False)
    )
    flagged = rows.withColumn(output or "__recommended", answer).drop("__slice", "__same", "__before")
    if output:
        return flagged
    return flagged.where("__recommended").drop("__recommended")


def recommended_share(watched: DataFrame, served: DataFrame, hours: int = 168) -> DataFrame:
    """Viewing that followed a recommendation against viewing found otherwise."""
    flagged = served_then_watched(watched, served, hours, output="recommended")
    return flagged.agg(
        F.count("*").alias("views"),
        F.count(F.when(F.col("recommended"), 1)).alias("recommended_views"),
        F.sum("watch_seconds").alias("watch_seconds"),
        F.coalesce(
            F.sum(F.when(F.col("recommended"), F.col("watch_seconds"))), F.lit(0)
        ).alias("recommended_seconds"),
    ).withColumn("recommended_share", F.col("recommended_seconds") / F.col("watch_seconds"))


def cold_start_scores(
    served: DataFrame, interactions: DataFrame, k: int = 10, days: int = 7, fewer_than: int = 5
) -> DataFrame:
    """Items with the highest score served this week to users with few interactions."""
    cold = cold_start_users(interactions, fewer_than).select("user_id")
    recent = last_n_days(served, days, ts="served_at")
    return (
        lookup_join(recent, cold, "user_id", "left_semi")
        .groupBy("content_id")
        .agg(F.max("score").alias("max_score"), F.count("*").alias("times_served"))
        .orderBy(F.desc("max_score"), "content_id")
        .limit(k)
    )


def weekday_weekend(gold: DataFrame) -> DataFrame:
    part = F.when(is_weekend("event_ts"), "weekend").otherwise("weekday")
    return gold.groupBy(part.alias("day_type")).agg(
        F.count("*").alias("views"),
        F.sum("watch_seconds").alias("watch_seconds"),
        F.avg("watch_seconds").alias("avg_watch_seconds"),
        _rate(),
    )


def top_served(served: DataFrame, k: int = 5, hours: int = 24) -> DataFrame:
    end = latest(served, "served_at")
    return (
        served.where(F.col("served_at") > end - F.expr(f"INTERVAL {int(hours)} HOURS"))
        .groupBy("content_id")
        .agg(F.count("*").alias("times_served"))
        .orderBy(F.desc("times_served"), "content_id")
        .limit(k)
    )


def interactions_by_day(gold: DataFrame) -> DataFrame:
    return gold.groupBy(F.date_trunc("day", "event_ts").alias("day")).agg(
        F.count("*").alias("interactions")
    )


def top_genres_hours(gold: DataFrame, k: int = 10) -> DataFrame:
    return (
        gold.groupBy("genre")
        .agg((F.sum("watch_seconds") / HOUR).alias("watch_hours"))
        .orderBy(F.desc("watch_hours"), "genre")
        .limit(k)
    )


def week_over_week(gold: DataFrame, days: int = 7) -> DataFrame:
    """Views and watch time per genre, this week against the week before."""
    end = latest(gold, "event_ts")
    start = end - F.expr(f"INTERVAL {int(days)} DAYS")
    recent = last_n_days(gold, 2 * days, as_of=end)
    this = F.col("event_ts") > start
    return recent.groupBy("genre").agg(
        F.count(F.when(this, 1)).alias("views_this_week"),
        F.count(F.when(~this, 1)).alias("views_last_week"),
        F.coalesce(F.sum(F.when(this, F.col("watch_seconds"))), F.lit(0)).alias("seconds_this_week"),
        F.coalesce(F.sum(F.when(~this, F.col("watch_seconds"))), F.lit(0)).alias("seconds_last_week"),
    )


def cube_engagement(gold: DataFrame) -> DataFrame:
    """Views and hours by genre and country with all subtotals.

    Rows are merged per (genre, country) first, so the cube expands only those.
    """
    cells = gold.groupBy("genre", "country").agg(
        F.count("*").alias("n"),
        F.sum("watch_seconds").alias("s"),
        F.count("completed").alias("rated"),
        F.sum(F.col("completed").cast("int")).alias("done"),
    )
    return cells.cube("genre", "country").agg(
        F.grouping("genre").cast("int").alias("all_genres"),
        F.grouping("country").cast("int").alias("all_countries"),
        F.sum("n").alias("views"),
        F.sum("s").alias("watch_seconds"),
        (F.sum("done") / F.sum("rated")).alias("completion_rate"),
    )
