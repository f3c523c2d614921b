"""Projections, filters, quality rules and deduplication."""

from __future__ import annotations

from pyspark.sql import Observation, functions as F

from reelgrove.functions.expressions import (
    completed_flag,
    completed_flag_truncated,
    dot,
    embedding_text,
    json_field,
    l2_norm,
)
from reelgrove.operators import features, filters, medallion, quality
from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.joins import lookup_join
from reelgrove.operators.lists import top_k_per_user
from reelgrove.operators.recommend import candidate_lists
from reelgrove.plans.registry import query
from reelgrove.session import shared_dir
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import read_table


@query("derive_completed", """
    SELECT interaction_id, i.content_id, watch_seconds, duration_min,
           watch_seconds >= 51 * duration_min AS completed,
           watch_seconds >= CAST(trunc(0.85::DOUBLE * duration_min * 60) AS BIGINT) AS completed_truncated
    FROM silver_interactions i JOIN silver_items t ON i.content_id = t.content_id""")
def derive_completed(spark, folder):
    rows = lookup_join(
        v.silver_interactions(spark, folder),
        v.silver_items(spark, folder).select("content_id", "duration_min"),
        "content_id",
        "inner",
    )
    flagged = filters.derive_completed(rows, completed_flag("watch_seconds", "duration_min"))
    return flagged.select(
        "interaction_id",
        "content_id",
        "watch_seconds",
        "duration_min",
        "completed",
        completed_flag_truncated("watch_seconds", "duration_min").alias("completed_truncated"),
    )


@query("valid_view_filter", "SELECT * FROM watched WHERE watch_seconds > 30")
def valid_view_filter(spark, folder):
    return filters.valid_views(v.watched(spark, folder))


@query("last_n_days", """
    SELECT * FROM silver_interactions
    WHERE event_ts > (SELECT max(event_ts) FROM silver_interactions) - INTERVAL 7 DAYS""")
def last_n_days(spark, folder):
    return filters.last_n_days(v.silver_interactions(spark, folder), 7)


@query("cold_start_users", """
    SELECT user_id, count(*) AS interaction_count FROM silver_interactions
    GROUP BY user_id HAVING count(*) < 5""")
def cold_start_users(spark, folder):
    return filters.cold_start_users(v.silver_interactions(spark, folder))


@query("point_lookup", """
    SELECT title, synopsis, genre FROM item_features WHERE content_id = 42""")
def point_lookup(spark, folder):
    return filters.point_lookup(
        v.all_item_features(spark, folder), "content_id", 42, ["title", "synopsis", "genre"]
    )


@query("project_prune", "SELECT content_id, genre FROM silver_items")
def project_prune(spark, folder):
    return v.silver_items(spark, folder).select("content_id", "genre")


@query("prefix_columns", """
    SELECT user_id AS u_user_id, age AS u_age, country AS u_country, segment AS u_segment,
           email AS u_email, phone AS u_phone FROM silver_users""")
def prefix_columns(spark, folder):
    return filters.prefix_columns(v.silver_users(spark, folder), "u_")


@query("numeric_only", """
    SELECT content_id, release_year, popularity_7d, completion_rate FROM item_features""")
def numeric_only(spark, folder):
    return filters.numeric_only(v.all_item_features(spark, folder), drop=["duration_min"])


@query("fill_missing", """
    SELECT t.content_id, coalesce(p.n, 0) AS n, coalesce(p.s, 0) AS s
    FROM silver_items t LEFT JOIN (
        SELECT content_id, count(*) AS n, CAST(sum(watch_seconds) AS BIGINT) AS s
        FROM watched GROUP BY content_id) p ON t.content_id = p.content_id""")
def fill_missing(spark, folder):
    totals = v.watched(spark, folder).groupBy("content_id").agg(
        F.count("*").alias("n"), F.sum("watch_seconds").alias("s")
    )
    items = v.silver_items(spark, folder).select("content_id")
    return filters.fill_missing(items.join(totals, "content_id", "left"), ["n", "s"])


@query("cast_bool_int", """
    SELECT interaction_id, user_id, event_ts, watch_seconds, content_id,
           CAST(completed AS INTEGER) AS completed FROM gold_interactions""")
def cast_bool_int(spark, folder):
    rows = v.viewed_items(spark, folder).select(
        "interaction_id", "user_id", "event_ts", "watch_seconds", "content_id", "completed"
    )
    return filters.cast_bool_int(rows, ["completed"])


@query("like_prefix", """
    SELECT event_id, ts AS event_time, json_extract_string(props, '$.k') AS table_arg FROM events
    WHERE json_extract_string(props, '$.k') LIKE '4%'""")
def like_prefix(spark, folder):
    named = v.audit(spark, folder).select(
        "event_id", "event_time", json_field("request_params", "$.k").alias("table_arg")
    )
    return filters.like_prefix(named, F.col("table_arg"), "4")


@query("candidate_filter", """
    SELECT content_id, title, genre FROM silver_items WHERE content_id IN (
        SELECT content_id FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY best DESC, content_id) AS rank FROM (
                SELECT user_id, content_id, max(score) AS best FROM served GROUP BY user_id, content_id))
        WHERE rank <= 3)""")
def candidate_filter(spark, folder):
    best = v.served(spark, folder).groupBy("user_id", "content_id").agg(F.max("score").alias("score"))
    candidates = candidate_lists(top_k_per_user(best, 3), "user_id")
    items = v.silver_items(spark, folder).select("content_id", "title", "genre")
    return filters.candidate_filter(items, candidates)


@query("embedding_text", """
    SELECT content_id, concat_ws(' | ', title, synopsis, genre) AS embedding_text FROM silver_items""")
def item_text(spark, folder):
    return v.silver_items(spark, folder).select(
        "content_id", embedding_text("title", "synopsis", "genre").alias("embedding_text")
    )


@query("vector_math", """
    SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 9) AS squared,
           round(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 9) AS norm
    FROM embeddings""")
def vector_math(spark, folder):
    return read_table(spark, folder, "embeddings").select(
        "vec_id",
        F.round(dot("embedding", "embedding"), 9).alias("squared"),
        F.round(l2_norm("embedding"), 9).alias("norm"),
    )


# ---- quality ----------------------------------------------------------------------

@query("expect_or_drop", """
    SELECT * FROM items WHERE content_id IS NOT NULL AND coalesce(duration_min > 0, false)""")
def expect_or_drop(spark, folder):
    return quality.expect_or_drop(v.items(spark, folder), quality.ITEM_RULES)


@query("expect_warn", "SELECT * FROM users")
def expect_warn(spark, folder):
    return quality.expect_warn(v.users(spark, folder), quality.USER_RULES, "users_quality")


@query("expect_warn_counts", """
    SELECT count(*) AS rows, count(*) FILTER (WHERE user_id IS NULL) AS user_id_not_null,
           count(*) FILTER (WHERE NOT coalesce(age BETWEEN 5 AND 120, false)) AS valid_age FROM users""")
def expect_warn_counts(spark, folder):
    """What the warnings counted while all users were written."""
    seen = Observation()
    checked = quality.expect_warn(v.users(spark, folder), quality.USER_RULES, seen)
    checked.write.parquet(shared_dir(spark, "checked"))
    names = ["rows", *[r.name for r in quality.USER_RULES]]
    return spark.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


EXPECTATION_REPORT = """
    WITH counted AS (
        SELECT 'users' AS table_name, 'user_id_not_null' AS rule, 'drop' AS action, count(*) AS rows,
               count(*) FILTER (WHERE user_id IS NULL) AS failed FROM users
        UNION ALL SELECT 'users', 'valid_age', 'warn', count(*),
               count(*) FILTER (WHERE NOT coalesce(age BETWEEN 5 AND 120, false)) FROM users
        UNION ALL SELECT 'items', 'content_id_not_null', 'drop', count(*),
               count(*) FILTER (WHERE content_id IS NULL) FROM items
        UNION ALL SELECT 'items', 'duration_positive', 'drop', count(*),
               count(*) FILTER (WHERE NOT coalesce(duration_min > 0, false)) FROM items
        UNION ALL SELECT 'interactions', 'ids_not_null', 'drop', count(*),
               count(*) FILTER (WHERE user_id IS NULL OR content_id IS NULL) FROM interactions
        UNION ALL SELECT 'interactions', 'watch_seconds_non_negative', 'warn', count(*),
               count(*) FILTER (WHERE NOT coalesce(watch_seconds >= 0, false)) FROM interactions)
    SELECT *, (rows - failed) / rows AS pass_rate FROM counted"""


@query("expectation_report", EXPECTATION_REPORT)
def expectation_report(spark, folder):
    reports = [
        quality.expectation_report(v.users(spark, folder), "users", quality.USER_RULES),
        quality.expectation_report(v.items(spark, folder), "items", quality.ITEM_RULES),
        quality.expectation_report(
            v.interactions(spark, folder), "interactions", quality.INTERACTION_RULES
        ),
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query("dedupe_by_key", """
    SELECT interaction_id, user_id, content_id, event_ts, watch_seconds, device FROM (
        SELECT *, row_number() OVER (PARTITION BY interaction_id ORDER BY event_ts NULLS LAST,
            content_id NULLS LAST, user_id NULLS LAST, watch_seconds NULLS LAST, device NULLS LAST) AS rn
        FROM interactions) WHERE rn = 1""")
def dedupe(spark, folder):
    order = [
        F.col(c).asc_nulls_last()
        for c in ("event_ts", "content_id", "user_id", "watch_seconds", "device")
    ]
    return dedupe_by_key(v.interactions(spark, folder), "interaction_id", order)


@query("capped_sample", """
    SELECT interaction_id, user_id, content_id, watch_seconds, device FROM silver_interactions
    ORDER BY md5(concat_ws('|', interaction_id, CAST(user_id AS VARCHAR), CAST(content_id AS VARCHAR),
                 CAST(watch_seconds AS VARCHAR), device))
    LIMIT 20000""")
def capped_sample(spark, folder):
    columns = ["interaction_id", "user_id", "content_id", "watch_seconds", "device"]
    rows = v.silver_interactions(spark, folder).select(*columns)
    return filters.capped_sample(rows, columns, cap=20_000)


# ---- silver -----------------------------------------------------------------------

@query("silver_users", "SELECT * FROM silver_users")
def silver_users(spark, folder):
    return v.silver_users(spark, folder)


@query("silver_items", "SELECT * FROM silver_items")
def silver_items(spark, folder):
    return v.silver_items(spark, folder)


@query("silver_interactions", "SELECT * FROM silver_interactions")
def silver_interactions(spark, folder):
    return v.silver_interactions(spark, folder)


# ---- joins ------------------------------------------------------------------------

@query("gold_interactions", "SELECT * FROM gold_interactions")
def gold_interactions(spark, folder):
    return v.gold_interactions(spark, folder)


@query("genre_enrich", """
    SELECT i.*, t.genre FROM silver_interactions i LEFT JOIN silver_items t ON i.content_id = t.content_id""")
def genre_enrich(spark, folder):
    return medallion.genre_enrich(
        v.silver_interactions(spark, folder), v.silver_items(spark, folder)
    )


@query("seed_join", """
    SELECT b.*, s.seed_content_id FROM (
        SELECT user_id, count(*) AS watch_count FROM gold_interactions GROUP BY user_id) b
    LEFT JOIN seeds s ON b.user_id = s.user_id""")
def seed_join(spark, folder):
    rows = v.silver_interactions(spark, folder)
    counts = rows.groupBy("user_id").agg(F.count("*").alias("watch_count"))
    return features.seed_join(counts, features.seed_item(rows))


@query("popularity_join", "SELECT * FROM item_features")
def popularity_join(spark, folder):
    return features.popularity_join(
        v.silver_items(spark, folder), features.popularity(v.viewed_items(spark, folder))
    )


@query("training_set", """
    SELECT g.interaction_id, g.user_id, g.content_id, g.watch_seconds,
           CAST(g.completed AS INTEGER) AS completed, g.release_year, g.age,
           u.watch_count_7d AS u_watch_count_7d, u.avg_session_seconds AS u_avg_session_seconds,
           u.p50_session_seconds AS u_p50_session_seconds, u.seed_content_id AS u_seed_content_id,
           t.release_year AS i_release_year, t.duration_min AS i_duration_min,
           t.popularity_7d AS i_popularity_7d, t.completion_rate AS i_completion_rate
    FROM gold_interactions g LEFT JOIN user_features u ON g.user_id = u.user_id
    LEFT JOIN item_features t ON g.content_id = t.content_id""")
def training_set(spark, folder):
    return features.training_set(*v.feature_tables(spark, folder))
