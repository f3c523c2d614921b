"""Business questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.operators import governance, questions as q
from reelgrove.plans.registry import query
from reelgrove.sources import sample_views as v

AGE_SQL = """CASE WHEN age IS NULL THEN 'unknown' WHEN age < 18 THEN 'under 18' WHEN age < 25 THEN '18-24'
    WHEN age < 35 THEN '25-34' WHEN age < 50 THEN '35-49' ELSE '50 and over' END"""

# The sample users have about forty views each.
FEW_VIEWS = 35


@query("q_top_shows_week", """
    SELECT w.*, t.title, t.genre FROM (
        SELECT content_id, CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds, count(*) AS views
        FROM gold_interactions
        WHERE event_ts > (SELECT max(event_ts) FROM gold_interactions) - INTERVAL 7 DAYS AND watch_seconds > 30
        GROUP BY content_id ORDER BY watch_seconds DESC, content_id LIMIT 10) w
    LEFT JOIN silver_items t ON w.content_id = t.content_id""")
def top_shows_week(spark, folder):
    return q.top_shows_week(v.silver_interactions(spark, folder), v.silver_items(spark, folder))


@query("q_completion_by_genre", """
    SELECT genre, count(*) AS views, count(completed) AS rated_views,
           avg(CAST(completed AS INTEGER)) AS completion_rate
    FROM gold_interactions GROUP BY genre""")
def completion_by_genre(spark, folder):
    return q.completion_by_genre(v.viewed_items(spark, folder))


@query("q_engagement_by_age", f"""
    SELECT {AGE_SQL} AS age_segment, count(*) AS views, count(DISTINCT user_id) AS viewers,
           sum(watch_seconds) / 3600 AS watch_hours, avg(CAST(completed AS INTEGER)) AS completion_rate
    FROM gold_interactions WHERE genre = 'ECONOMY' GROUP BY 1""")
def engagement_by_age(spark, folder):
    return q.engagement_by_age(v.gold_interactions(spark, folder), "ECONOMY")


@query("q_top_users_7d", """
    SELECT user_id, CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds FROM gold_interactions
    WHERE event_ts > (SELECT max(event_ts) FROM gold_interactions) - INTERVAL 7 DAYS
    GROUP BY user_id ORDER BY watch_seconds DESC, user_id LIMIT 10""")
def top_users(spark, folder):
    return q.top_users(v.silver_interactions(spark, folder))


_PRECEDED = """EXISTS (SELECT 1 FROM served s WHERE s.user_id = w.user_id AND s.content_id = w.content_id
    AND s.served_at BETWEEN w.event_ts - INTERVAL 168 HOURS AND w.event_ts)"""


@query("served_then_watched", f"SELECT w.* FROM watched w WHERE {_PRECEDED}")
def served_then_watched(spark, folder):
    return q.served_then_watched(v.watched(spark, folder), v.served(spark, folder))


@query("q_recommended_share", f"""
    SELECT count(*) AS views, count(*) FILTER (WHERE recommended) AS recommended_views,
           CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds,
           CAST(coalesce(sum(watch_seconds) FILTER (WHERE recommended), 0) AS BIGINT) AS recommended_seconds,
           coalesce(sum(watch_seconds) FILTER (WHERE recommended), 0) / sum(watch_seconds) AS recommended_share
    FROM (SELECT w.*, {_PRECEDED} AS recommended FROM watched w)""")
def recommended_share(spark, folder):
    return q.recommended_share(v.watched(spark, folder), v.served(spark, folder))


@query("q_cold_start_scores", f"""
    SELECT content_id, max(score) AS max_score, count(*) AS times_served FROM served
    WHERE served_at > (SELECT max(served_at) FROM served) - INTERVAL 7 DAYS
      AND user_id IN (SELECT user_id FROM silver_interactions GROUP BY user_id HAVING count(*) < {FEW_VIEWS})
    GROUP BY content_id ORDER BY max_score DESC, content_id LIMIT 10""")
def cold_start_scores(spark, folder):
    return q.cold_start_scores(
        v.served(spark, folder), v.silver_interactions(spark, folder), fewer_than=FEW_VIEWS
    )


@query("q_weekday_weekend", """
    SELECT CASE WHEN dayofweek(event_ts) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type,
           count(*) AS views, CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds,
           avg(watch_seconds) AS avg_watch_seconds, avg(CAST(completed AS INTEGER)) AS completion_rate
    FROM gold_interactions GROUP BY 1""")
def weekday_weekend(spark, folder):
    return q.weekday_weekend(v.viewed_items(spark, folder))


@query("q_top_served_24h", """
    SELECT content_id, count(*) AS times_served FROM served
    WHERE served_at > (SELECT max(served_at) FROM served) - INTERVAL 24 HOURS
    GROUP BY content_id ORDER BY times_served DESC, content_id LIMIT 5""")
def top_served(spark, folder):
    return q.top_served(v.served(spark, folder))


@query("q_interactions_by_day", """
    SELECT CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS day, count(*) AS interactions
    FROM gold_interactions GROUP BY 1""")
def interactions_by_day(spark, folder):
    days = q.interactions_by_day(v.silver_interactions(spark, folder))
    return days.withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("q_top_genres_hours", """
    SELECT genre, sum(watch_seconds) / 3600 AS watch_hours FROM gold_interactions
    GROUP BY genre ORDER BY watch_hours DESC, genre LIMIT 10""")
def top_genres_hours(spark, folder):
    return q.top_genres_hours(v.viewed_items(spark, folder))


@query("q_week_over_week", """
    WITH bounds AS (SELECT max(event_ts) AS e FROM gold_interactions)
    SELECT genre,
           count(*) FILTER (WHERE event_ts > e - INTERVAL 7 DAYS) AS views_this_week,
           count(*) FILTER (WHERE event_ts <= e - INTERVAL 7 DAYS) AS views_last_week,
           CAST(coalesce(sum(watch_seconds) FILTER (WHERE event_ts > e - INTERVAL 7 DAYS), 0) AS BIGINT) AS seconds_this_week,
           CAST(coalesce(sum(watch_seconds) FILTER (WHERE event_ts <= e - INTERVAL 7 DAYS), 0) AS BIGINT) AS seconds_last_week
    FROM gold_interactions, bounds WHERE event_ts > e - INTERVAL 14 DAYS GROUP BY genre""")
def week_over_week(spark, folder):
    return q.week_over_week(v.viewed_items(spark, folder))


@query("cube_engagement", """
    SELECT genre, country, CAST(grouping(genre) AS INTEGER) AS all_genres,
           CAST(grouping(country) AS INTEGER) AS all_countries, count(*) AS views,
           CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds, avg(CAST(completed AS INTEGER)) AS completion_rate
    FROM gold_interactions GROUP BY CUBE (genre, country)""")
def cube_engagement(spark, folder):
    return q.cube_engagement(v.gold_interactions(spark, folder))


@query("audit_top20", """
    SELECT event_id, ts AS event_time, event_type AS action_name, props AS request_params
    FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""")
def audit_top20(spark, folder):
    return governance.newest(v.audit(spark, folder))
