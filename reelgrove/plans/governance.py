"""Masking, tags, audits and request logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.functions import fixed_values as fixed
from reelgrove.operators import governance as g
from reelgrove.plans.registry import query
from reelgrove.session import shared_dir
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import read_table


@query("mask_columns", """
    SELECT 'reader' AS viewer, user_id, fav_genre, watch_count_7d FROM user_features
    UNION ALL SELECT 'other', user_id, 'REDACTED', watch_count_7d FROM user_features""")
def mask_columns(spark, folder):
    rows = v.all_user_features(spark, folder).select("user_id", "fav_genre", "watch_count_7d")

    def seen_by(viewer: str, *groups: str):
        members = F.array(*[F.lit(x) for x in groups]).cast("array<string>")
        return g.mask_columns(rows, ["fav_genre"], members).withColumn("viewer", F.lit(viewer))

    return seen_by("reader", fixed.PII_READERS_GROUP).unionByName(seen_by("other"))


@query("mask_contacts", """
    SELECT user_id, age, country, segment, regexp_replace(email, '^(.)[^@]*(@.*)$', '\\1***\\2') AS email,
           concat('+', repeat('*', length(phone) - 3), right(phone, 2)) AS phone,
           sha256(email) AS email_digest
    FROM silver_users""")
def mask_contacts(spark, folder):
    return g.mask_contacts(v.silver_users(spark, folder))


@query("tag_table", f"""
    SELECT source AS object_name, 'text' AS column_name, 'pii' AS tag, 'true' AS value FROM documents
    WHERE regexp_matches(text, '{g.EMAIL_PATTERN}') OR regexp_matches(text, '{g.PHONE_PATTERN}')
    GROUP BY source
    UNION ALL SELECT DISTINCT source, '', 'business_owner',
        CASE WHEN source LIKE 'w%' THEN 'web' ELSE 'content' END FROM documents
    UNION ALL SELECT DISTINCT source, '', 'cost_center', 'content' FROM documents""")
def tag_table(spark, folder):
    documents = read_table(spark, folder, "documents").select(
        F.col("source").alias("object_name"), F.lit("text").alias("column_name"), "text"
    )
    found = g.pii_scan(documents, "text").where("blocked")
    owned = {fixed.OWNER_TAG: "content", fixed.COST_TAG: "content"}
    tags = g.column_tags(found).unionByName(g.table_tags(documents, owned))
    web = documents.where(F.col("object_name").startswith("w"))
    return g.tag_table(tags, g.table_tags(web, {fixed.OWNER_TAG: "web"}))


@query("pii_scan", f"""
    SELECT doc_id, len(regexp_extract_all(text, '{g.EMAIL_PATTERN}')) AS emails,
           len(regexp_extract_all(text, '{g.PHONE_PATTERN}')) AS phones,
           regexp_matches(text, '{g.EMAIL_PATTERN}') OR regexp_matches(text, '{g.PHONE_PATTERN}') AS blocked
    FROM documents""")
def pii_scan(spark, folder):
    scanned = g.pii_scan(read_table(spark, folder, "documents"), "text")
    return scanned.select("doc_id", "emails", "phones", "blocked")


@query("audit_query", """
    SELECT event_id, ts AS event_time, event_type AS action_name, json_extract_string(props, '$.k') AS table_arg
    FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOURS
      AND json_extract_string(props, '$.k') LIKE '4%'
    ORDER BY ts DESC, event_id DESC LIMIT 20""")
def audit_query(spark, folder):
    return g.audit_query(v.audit(spark, folder), "4", path="$.k")


# The sample log is too quiet for the real limit.
CALLS_PER_MINUTE = 1


@query("rate_limit_audit", f"""
    SELECT CAST(date_trunc('minute', ts) AS TIMESTAMP) AS minute, count(*) AS calls
    FROM events GROUP BY 1 HAVING count(*) > {CALLS_PER_MINUTE}""")
def rate_limit_audit(spark, folder):
    return g.rate_limit_audit(v.audit(spark, folder), "event_time", CALLS_PER_MINUTE)


@query("usage_rollup", """
    SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS calls FROM events GROUP BY 1, 2""")
def usage_rollup(spark, folder):
    return g.usage_rollup(read_table(spark, folder, "events"), "ts")


@query("request_log_append", """
    SELECT event_id, ts AS request_time, concat('{"user_id":', user_id, '}') AS request,
           k AS first_content_id, CAST(ts AS DATE) AS day FROM logged""")
def request_log_append(spark, folder):
    path = shared_dir(spark, "request_log")
    scored = v.scored_requests(spark, folder)
    answered = F.col("recommendations")[0]["genre"]
    # Two appends, as two serving runs would make.
    g.append_request_log(scored.where(answered.isin("view", "click")), path)
    g.append_request_log(scored.where(~answered.isin("view", "click")), path)
    first = F.get_json_object("response", "$[0].content_id").cast("int")
    return spark.read.parquet(path).select(
        "event_id", "request_time", "request", first.alias("first_content_id"), "day"
    )


@query("parse_request_log", """
    SELECT event_id, ts AS request_time, user_id, CAST(0 AS INTEGER) AS position,
           CAST(k AS BIGINT) AS content_id, value AS score, event_type AS genre FROM logged""")
def parse_request_log(spark, folder):
    return g.parse_request_log(g.request_log_rows(v.scored_requests(spark, folder)))


@query("timestamp_column_pick", """
    SELECT event_id, 'timestamp' AS kind, ts FROM events
    UNION ALL SELECT event_id, 'milliseconds', CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) FROM events""")
def timestamp_column_pick(spark, folder):
    log = v.scored_requests(spark, folder)
    in_millis = log.select(
        "event_id", F.unix_millis(F.col("request_time").cast("timestamp")).alias("timestamp_ms")
    )

    def picked(df, kind: str):
        return g.timestamp_column_pick(df).select(
            "event_id", F.lit(kind).alias("kind"), F.col("ts").cast("timestamp_ntz").alias("ts")
        )

    return picked(log, "timestamp").unionByName(picked(in_millis, "milliseconds"))


@query("champion_challenger", """
    SELECT CASE WHEN CAST(concat('0x', substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 10
                THEN 'challenger' ELSE 'champion' END AS version,
           count(*) AS rows, count(DISTINCT user_id) AS users, round(avg(score), 6) AS mean_score
    FROM served GROUP BY 1""")
def champion_challenger(spark, folder):
    return g.compare_versions(g.champion_challenger(v.served(spark, folder)))


@query("masked_view", """
    SELECT user_id, 'REDACTED' AS email, 'REDACTED' AS age, country FROM silver_users""")
def masked_view(spark, folder):
    """What a session that names no reader group sees, a number column included."""
    v.silver_users(spark, folder).select("user_id", "email", "age", "country").createOrReplaceTempView(
        "users_with_contacts"
    )
    return g.masked_view(spark, "users_for_all", "users_with_contacts", ["email", "age"])
