"""Operators beyond the source application."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.operators import experiments, features, governance, quality, recommend, spread
from reelgrove.plans.chain import _CANDIDATES, _sample_score, _with_candidates
from reelgrove.plans.registry import query
from reelgrove.operators.joins import shuffle_partitions
from reelgrove.sources import bucketed, sample_views as v


@query("quarantine", """
    SELECT user_id, age,
           concat_ws(',', CASE WHEN user_id IS NULL THEN 'user_id_not_null' END,
                     CASE WHEN age IS NULL OR age NOT BETWEEN 5 AND 120 THEN 'valid_age' END) AS failed_rules
    FROM users WHERE user_id IS NULL OR age IS NULL OR age NOT BETWEEN 5 AND 120""")
def quarantine(spark, folder):
    failed = quality.quarantine(v.users(spark, folder), quality.USER_RULES)
    return failed.select("user_id", "age", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("exclude_seen", _CANDIDATES + """
    SELECT c.user_id, c.content_id FROM candidates c
    WHERE NOT EXISTS (SELECT 1 FROM silver_interactions s
                      WHERE s.user_id = c.user_id AND s.content_id = c.content_id)""")
def exclude_seen(spark, folder):
    users, _ = _with_candidates(spark, folder)
    pairs = users.select("user_id", F.explode("candidates").alias("content_id"))
    return recommend.exclude_seen(pairs, v.silver_interactions(spark, folder))


@query("point_in_time_features", """
    WITH states AS (SELECT user_id, served_at, max(score) AS score FROM served GROUP BY ALL)
    SELECT w.event_id, w.user_id, w.event_ts, s.score AS last_score
    FROM watched w ASOF LEFT JOIN states s ON w.user_id = s.user_id AND w.event_ts >= s.served_at""")
def point_in_time_features(spark, folder):
    """The score a user was last served before each view."""
    scores = v.served(spark, folder).withColumnRenamed("score", "last_score")
    facts = v.watched(spark, folder).select("event_id", "user_id", "event_ts")
    return features.point_in_time(facts, scores, "user_id", "event_ts", "served_at", ["last_score"])


@query("bucketed_user_items", """
    SELECT i.user_id, u.country, i.content_id, CAST(sum(i.watch_seconds) AS BIGINT) AS watch_seconds,
           count(*) AS views
    FROM silver_interactions i LEFT JOIN silver_users u ON i.user_id = u.user_id
    GROUP BY i.user_id, u.country, i.content_id""")
def bucketed_user_items(spark, folder):
    """Watch time per user and item with the user's country, from tables stored by user."""
    users = v.silver_users(spark, folder).select("user_id", "country")
    views = v.silver_interactions(spark, folder).select("user_id", "content_id", "watch_seconds")
    buckets = shuffle_partitions(views)
    by_user = bucketed.lookup(
        bucketed.store(views, "user_id", buckets), bucketed.store(users, "user_id", buckets)
    )
    return bucketed.per_key(by_user, lambda rows: rows.groupBy("user_id", "country", "content_id").agg(
        F.sum("watch_seconds").alias("watch_seconds"), F.count("*").alias("views")
    ))


# ---- lists that spread -------------------------------------------------------------------

_VALUE = f"round({spread.SCORE_SHARE}::DOUBLE * score - (1 - {spread.SCORE_SHARE}::DOUBLE) * alike, 12)"
_LIKENESS = """coalesce(round(list_dot_product(s.e, p.e)
                   / (sqrt(list_dot_product(s.e, s.e)) * sqrt(list_dot_product(p.e, p.e))), 9), 0)"""


def _greedy_steps(k: int) -> str:
    """``pick1`` to ``pick<k>``: the best of what is left, then likeness to it."""
    steps = ["""step1 AS (
        SELECT c.user_id, c.content_id, v.e, CAST(0 AS DOUBLE) AS alike,
               (7 * t.popularity_7d + (31 * c.user_id + 17 * c.content_id) % 101) / 1000 AS score
        FROM candidates c JOIN item_features t ON c.content_id = t.content_id
        LEFT JOIN vectors v ON c.content_id = v.content_id)"""]
    for n in range(1, k + 1):
        steps.append(f"""pick{n} AS (
        SELECT user_id, content_id, e, score, value AS mmr FROM (
            SELECT *, {_VALUE} AS value,
                   row_number() OVER (PARTITION BY user_id ORDER BY {_VALUE} DESC, content_id) AS rn FROM step{n})
        WHERE rn = 1)""")
        alike = _LIKENESS if n == 1 else f"greatest(s.alike, {_LIKENESS})"
        steps.append(f"""step{n + 1} AS (
        SELECT s.user_id, s.content_id, s.e, {alike} AS alike, s.score
        FROM step{n} s JOIN pick{n} p ON s.user_id = p.user_id WHERE s.content_id <> p.content_id)""")
    return ",\n".join(steps)


@query("mmr_rerank", _CANDIDATES + "," + _greedy_steps(5) + " UNION ALL ".join(
    f" SELECT user_id, content_id, round(score, 9) AS score, mmr, CAST({n} AS INTEGER) AS rank FROM pick{n}"
    for n in range(1, 6)
))
def mmr_rerank(spark, folder):
    """Five candidates of each user by score and distance from those before them."""
    users, items = _with_candidates(spark, folder)
    scored = _sample_score(recommend.user_candidate_pairs(users, items))
    picked = spread.mmr_rerank(scored, v.vectors(spark, folder))
    return picked.withColumn("score", F.round("score", 9))


# ---- versions by outcome -------------------------------------------------------------------

_DRAWN = " ".join(f"WHEN d < {limit} THEN {n}" for n, limit in enumerate(experiments.poisson_limits()))


@query("champion_decision", f"""
    WITH tried AS (
        SELECT s.user_id,
               CASE WHEN CAST(concat('0x', substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 50
                    THEN 'challenger' ELSE 'champion' END AS version,
               EXISTS (SELECT 1 FROM watched w WHERE w.user_id = s.user_id AND w.content_id = s.content_id
                       AND w.event_ts BETWEEN s.served_at AND s.served_at + INTERVAL 168 HOUR) AS hit
        FROM served s WHERE s.user_id IS NOT NULL),
    units AS (
        SELECT user_id, version, count(*) AS served, count(*) FILTER (WHERE hit) AS hits
        FROM tried GROUP BY user_id, version),
    weighed AS (
        SELECT *, CASE WHEN b = 0 THEN 1 {_DRAWN} ELSE {len(experiments.poisson_limits())} END AS w FROM (
            SELECT *, CAST(concat('0x', substr(md5(concat(CAST(user_id AS VARCHAR), '|', CAST(b AS VARCHAR))), 1, 8)) AS BIGINT) AS d
            FROM units, range(0, {experiments.REPLICATES + 1}) AS r(b))),
    sums AS (
        SELECT b, CAST(coalesce(sum(w * served) FILTER (WHERE version = 'champion'), 0) AS BIGINT) AS champion_served,
               CAST(coalesce(sum(w * hits) FILTER (WHERE version = 'champion'), 0) AS BIGINT) AS champion_hits,
               CAST(coalesce(sum(w * served) FILTER (WHERE version = 'challenger'), 0) AS BIGINT) AS challenger_served,
               CAST(coalesce(sum(w * hits) FILTER (WHERE version = 'challenger'), 0) AS BIGINT) AS challenger_hits
        FROM weighed GROUP BY b),
    rates AS (
        SELECT *, round(challenger_rate - champion_rate, 9) AS difference FROM (
            SELECT *, champion_hits / champion_served AS champion_rate,
                   challenger_hits / challenger_served AS challenger_rate FROM sums)),
    bounds AS (
        SELECT quantile_disc(difference, 0.025) AS low, quantile_disc(difference, 0.975) AS high
        FROM rates WHERE b > 0)
    SELECT champion_served, champion_hits, challenger_served, challenger_hits,
           round(champion_rate, 9) AS champion_rate, round(challenger_rate, 9) AS challenger_rate, difference, low, high,
           CASE WHEN low > 0 THEN 'better' WHEN high < 0 THEN 'worse' ELSE 'undecided' END AS verdict
    FROM rates, bounds WHERE b = 0""")
def champion_decision(spark, folder):
    """Whether users watch more of what one half was served than of what the other was."""
    served = governance.champion_challenger(v.served(spark, folder), challenger_percent=50)
    return experiments.compare_by_outcome(experiments.outcomes(served, v.watched(spark, folder)))
