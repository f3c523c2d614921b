"""Aggregations and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.operators import features, lists, medallion
from reelgrove.operators.joins import lookup_join
from reelgrove.plans.registry import query
from reelgrove.sources import sample_views as v


@query("gold_user_360", """
    SELECT user_id, count(*) AS interaction_count,
           CAST(sum(watch_seconds) AS BIGINT) AS total_watch_seconds,
           avg(watch_seconds) AS avg_watch_seconds,
           count(DISTINCT content_id) AS unique_content_watched,
           first(genre ORDER BY event_ts, content_id) FILTER (WHERE genre IS NOT NULL) AS first_genre_seen
    FROM gold_interactions GROUP BY user_id""")
def gold_user_360(spark, folder):
    return medallion.gold_user_360(
        v.silver_interactions(spark, folder), v.silver_items(spark, folder)
    )


@query("user_features", "SELECT * FROM user_features")
def user_features(spark, folder):
    return v.all_user_features(spark, folder)


@query("item_features", "SELECT * FROM item_features")
def item_features(spark, folder):
    return v.all_item_features(spark, folder)


@query("user_item_watch", "SELECT * FROM user_item_totals")
def user_item_watch(spark, folder):
    return features.user_item_watch(v.silver_interactions(spark, folder))


@query("median_watch", """
    SELECT user_id, quantile_disc(watch_seconds, 0.5) AS p50_session_seconds
    FROM silver_interactions GROUP BY user_id""")
def median_watch(spark, folder):
    return features.median_watch(v.silver_interactions(spark, folder))


@query("distinct_content", """
    SELECT user_id, count(DISTINCT content_id) AS unique_content_watched
    FROM silver_interactions GROUP BY user_id""")
def distinct_content(spark, folder):
    return features.distinct_content(v.silver_interactions(spark, folder))


@query("genres_seen", """
    SELECT user_id, coalesce(string_agg(genre, ',' ORDER BY genre), '') AS genres_seen
    FROM (SELECT DISTINCT user_id, genre FROM gold_interactions) GROUP BY user_id""")
def genres_seen(spark, folder):
    return features.genres_seen(v.viewed_items(spark, folder))


@query("first_genre", """
    SELECT user_id, first(genre ORDER BY event_ts, content_id) FILTER (WHERE genre IS NOT NULL) AS first_genre
    FROM gold_interactions GROUP BY user_id""")
def first_genre(spark, folder):
    return (
        v.viewed_items(spark, folder, v.view_tasks(spark, folder))
        .groupBy("user_id", "content_id", "genre")
        .agg(F.min("event_ts").alias("first_ts"))
        .groupBy("user_id")
        .agg(medallion.first_genre("first_ts").alias("first_genre"))
    )


@query("fav_genre_by_watch", """
    SELECT user_id, genre AS fav_genre, watch_seconds FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY watch_seconds DESC, genre) AS rn FROM (
            SELECT user_id, genre, CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds
            FROM gold_interactions WHERE genre IS NOT NULL GROUP BY user_id, genre)) WHERE rn = 1""")
def fav_genre_by_watch(spark, folder):
    return features.fav_genre_by_watch(v.viewed_items(spark, folder))


@query("windowed_counts_7d", """
    SELECT 'user' AS key_type, user_id AS key, count(*) AS views_7d FROM silver_interactions
    WHERE event_ts > (SELECT max(event_ts) FROM silver_interactions) - INTERVAL 7 DAYS GROUP BY user_id
    UNION ALL
    SELECT 'item', content_id, count(*) FROM silver_interactions
    WHERE event_ts > (SELECT max(event_ts) FROM silver_interactions) - INTERVAL 7 DAYS GROUP BY content_id""")
def windowed_counts_7d(spark, folder):
    rows = v.silver_interactions(spark, folder)

    def counts(kind: str, key: str):
        return features.windowed_counts(rows, key).select(
            F.lit(kind).alias("key_type"), F.col(key).alias("key"), "views_7d"
        )

    return counts("user", "user_id").unionByName(counts("item", "content_id"))


# ---- windows ----------------------------------------------------------------------

@query("seed_item", "SELECT * FROM seeds")
def seed_item(spark, folder):
    return features.seed_item(v.silver_interactions(spark, folder))


@query("top_k_per_user", """
    SELECT user_id, content_id, score, rank FROM (
        SELECT user_id, content_id, watch_seconds AS score,
               row_number() OVER (PARTITION BY user_id ORDER BY watch_seconds DESC, content_id) AS rank
        FROM user_item_totals) WHERE rank <= 10""")
def top_k_per_user(spark, folder):
    totals = features.user_item_watch(v.silver_interactions(spark, folder))
    scored = totals.withColumnRenamed("watch_seconds", "score")
    return lists.top_k_per_user(scored, 10).withColumn("rank", F.col("rank").cast("bigint"))


def _watch_lists(spark, folder):
    """Items of each user, scored by watch time, with genre, dealt by user.

    Windows per user, and per user and genre, then need no shuffle of their own.
    """
    tasks = v.view_tasks(spark, folder)
    rows = v.viewed_items(spark, folder, tasks)
    return (
        rows.where("genre IS NOT NULL")
        .groupBy("user_id", "content_id", "genre")
        .agg(F.sum("watch_seconds").alias("score"))
        .repartition(tasks, "user_id")
    )


_DIVERSE = """
    WITH scored AS (
        SELECT user_id, content_id, genre, CAST(sum(watch_seconds) AS BIGINT) AS score
        FROM gold_interactions WHERE genre IS NOT NULL GROUP BY user_id, content_id, genre),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY user_id, genre ORDER BY score DESC, content_id) AS g FROM scored),
    diverse AS (
        SELECT user_id, content_id, genre, score,
               row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank
        FROM best WHERE g = 1)
"""


@query("diversity_rerank", _DIVERSE + "SELECT * FROM diverse WHERE rank <= 5")
def diversity_rerank(spark, folder):
    reranked = lists.diversity_rerank(_watch_lists(spark, folder))
    return reranked.withColumn("rank", F.col("rank").cast("bigint"))


@query("recent_titles", _DIVERSE + """
    SELECT d.user_id, d.rank, t.title,
           coalesce((SELECT string_agg(t2.title, ', ' ORDER BY e.rank)
                     FROM diverse e JOIN silver_items t2 ON e.content_id = t2.content_id
                     WHERE e.user_id = d.user_id AND e.rank < d.rank AND e.rank <= 3), '') AS recent_titles
    FROM diverse d JOIN silver_items t ON d.content_id = t.content_id WHERE d.rank <= 5""")
def recent_titles(spark, folder):
    items = v.silver_items(spark, folder).select("content_id", "title")
    top = lookup_join(lists.diversity_rerank(_watch_lists(spark, folder)), items, "content_id", "inner")
    return top.withColumn("recent", lists.titles_before()).select(
        "user_id",
        F.col("rank").cast("bigint").alias("rank"),
        "title",
        F.array_join("recent", ", ").alias("recent_titles"),
    )
