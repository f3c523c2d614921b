"""Streaming jobs run to the end of their input; the query is what they wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.operators.joins import source_bytes
from reelgrove.operators.quality import USER_RULES, expect_or_drop
from reelgrove.plans.projections import EXPECTATION_REPORT
from reelgrove.plans.registry import query
from reelgrove.session import shared_dir
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import KeyedTable, write_parquet
from reelgrove.streaming import ingest, quality_log, sinks


def _events_stream(spark, folder):
    events = spark.read.option("pathGlobFilter", "events.parquet").parquet(folder)
    return (
        spark.readStream.schema(events.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )


@query("ingest_files", "SELECT * FROM interactions")
def ingest_files(spark, folder):
    """Three landings, one triggered run after each; every row arrives once."""
    base = shared_dir(spark, "ingest")
    rows = v.interactions(spark, folder)
    for part in ("device = 'A'", "device = 'N'", "device NOT IN ('A', 'N') OR device IS NULL"):
        write_parquet(rows.where(part), f"{base}/landing", mode="append")
        ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
    return ingest.read_evolved(spark, f"{base}/bronze")


@query("schema_evolve", """
    SELECT user_id, age, country, segment, email,
           CASE WHEN segment IN ('BUILDING', 'MACHINERY') THEN NULL ELSE phone END AS phone FROM users""")
def schema_evolve(spark, folder):
    """Users land without a phone column first, then with one."""
    base = shared_dir(spark, "evolve")
    rows = v.users(spark, folder)
    early = F.col("segment").isin("BUILDING", "MACHINERY")
    for part in (rows.where(early).drop("phone"), rows.where(~early)):
        write_parquet(part, f"{base}/landing", mode="append")
        ingest.ingest_files(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
    return ingest.read_evolved(spark, f"{base}/bronze")


def _medallion(spark, folder):
    """Landing to silver for all three tables, two landings; the folder and the sources."""
    base = shared_dir(spark, "medallion")
    sources = {
        "users": (v.users(spark, folder), F.col("segment") < "F", "user_id", "age"),
        "items": (v.items(spark, folder), F.col("genre") < "M", "content_id", "duration_min"),
        "interactions": (
            v.interactions(spark, folder), F.col("device") == "A", "user_id", "watch_seconds",
        ),
    }
    # One state partition per 32 MB of dimension rows, within reason for a small table.
    size = sum(source_bytes(sources[t][0]) for t in ("users", "items"))
    partitions = max(4, size // (32 * 1024 * 1024))
    for first in (True, False):
        for name, (rows, part, _, _) in sources.items():
            chosen = F.coalesce(part, F.lit(False)) == F.lit(first)
            write_parquet(rows.where(chosen), f"{base}/landing/{name}", mode="append")
        ingest.run_medallion(
            spark, f"{base}/landing", f"{base}/lake", f"{base}/checkpoints", partitions
        )
    return base, sources


@query("stream_equals_batch", """
    SELECT 'users' AS table_name, count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS key_sum,
           CAST(sum(age) AS BIGINT) AS value_sum FROM silver_users
    UNION ALL SELECT 'items', count(*), CAST(sum(content_id) AS BIGINT), CAST(sum(duration_min) AS BIGINT) FROM silver_items
    UNION ALL SELECT 'interactions', count(*), CAST(sum(user_id) AS BIGINT), CAST(sum(watch_seconds) AS BIGINT)
        FROM silver_interactions""")
def stream_equals_batch(spark, folder):
    """Landing to silver for all three tables, two landings, summed up."""
    base, sources = _medallion(spark, folder)
    sums = [
        spark.read.parquet(f"{base}/lake/silver_{name}").agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("rows"),
            F.sum(key).alias("key_sum"),
            F.sum(value).alias("value_sum"),
        )
        for name, (_, _, key, value) in sources.items()
    ]
    return sums[0].unionByName(sums[1]).unionByName(sums[2])


@query("quality_log", EXPECTATION_REPORT)
def streamed_quality(spark, folder):
    """The report of all checked rows, from the metrics that the streams stored per micro-batch."""
    base, _ = _medallion(spark, folder)
    return quality_log.logged_report(quality_log.read_quality_log(spark, f"{base}/lake/quality_log"))


_LANDED_TWICE = """
    WITH landed AS (
        SELECT * FROM users
        UNION ALL SELECT user_id, age - 1, country, segment, email, phone FROM users WHERE age % 3 = 0
        UNION ALL SELECT user_id, CAST(NULL AS INTEGER), country, 'AAA', email, phone FROM users WHERE segment < 'F'),
    firsts AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY age NULLS LAST, country NULLS LAST,
            segment NULLS LAST, email NULLS LAST, phone NULLS LAST) AS rn FROM landed)"""


@query("stream_dedupe_ordered", _LANDED_TWICE + """
    SELECT user_id, age, country, segment, email, phone FROM firsts WHERE rn = 1 AND user_id IS NOT NULL""")
def stream_dedupe_ordered(spark, folder):
    """Users land in three files with copies that differ; the silver rows are the batch job's.

    The lesser copy comes later for some users and the greater one for others.
    """
    base = shared_dir(spark, "ordered")
    rows = v.users(spark, folder)
    copies = [
        rows,
        rows.where("age % 3 = 0").withColumn("age", F.col("age") - 1),
        rows.where("segment < 'F'").withColumns({"age": F.lit(None).cast("int"), "segment": F.lit("AAA")}),
    ]
    table = KeyedTable(spark, f"{base}/least", "user_id")
    for part in copies:
        write_parquet(part, f"{base}/bronze", mode="append")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/bronze")
        sinks.stream_least(stream, table, f"{base}/checkpoint")
    return expect_or_drop(table.read(), USER_RULES)


@query("profile_daily_sketch", """
    SELECT CAST(ts AS DATE) AS day, count(*) AS rows, TRUE AS distinct_within_error, TRUE AS quartiles_within_error
    FROM events GROUP BY 1
    HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def profile_daily_sketch(spark, folder):
    """Sketched distinct counts and quartiles of closed days, each held against the exact ones.

    A quartile is right if its rank among the day's values is within the stated error.
    """
    base = shared_dir(spark, "sketch")
    sketch = ingest.daily_sketch_stream(_events_stream(spark, folder), "ts", "value")
    ingest.drain(sketch, f"{base}/profile", f"{base}/checkpoint")
    written = spark.read.parquet(f"{base}/profile")
    events = spark.read.parquet(f"{folder}/events.parquet").select(F.to_date("ts").alias("day"), "value")
    facts = events.join(F.broadcast(written.drop("rows")), "day").groupBy("day").agg(
        F.count_distinct("value").alias("exact"),
        F.count("value").alias("known"),
        *[F.count_if(F.col("value") < F.col(q)).alias(f"{q}_below") for q in ("p25", "p50", "p75")],
        *[F.count_if(F.col("value") <= F.col(q)).alias(f"{q}_upto") for q in ("p25", "p50", "p75")],
    )
    checked = written.join(facts, "day")
    slack = F.greatest(F.lit(1.0), ingest.RANK_ERROR * F.col("known"))
    right = F.lit(True)
    for q, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        rank = p * F.col("known")
        right = right & (F.col(f"{q}_below") <= rank + slack) & (F.col(f"{q}_upto") >= rank - slack)
    off = F.abs(F.col("distinct_values") - F.col("exact"))
    return checked.select(
        "day", "rows", (off <= F.greatest(F.lit(1.0), ingest.DISTINCT_ERROR * F.col("exact"))).alias("distinct_within_error"),
        right.alias("quartiles_within_error"),
    )


@query("profile_daily_stream", """
    SELECT CAST(ts AS DATE) AS day, count(*) AS rows, count(*) FILTER (WHERE value IS NULL) AS nulls,
           min(value) AS min_value, max(value) AS max_value, round(sum(value), 6) AS sum_value,
           round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS stddev_value
    FROM events GROUP BY 1
    HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def profile_daily_stream(spark, folder):
    """Days the watermark has passed; the last day is still open."""
    base = shared_dir(spark, "profile")
    profile = ingest.daily_profile_stream(_events_stream(spark, folder), "ts", "value")
    ingest.drain(profile, f"{base}/profile", f"{base}/checkpoint")
    written = spark.read.parquet(f"{base}/profile")
    return written.withColumns(
        {c: F.round(c, 6) for c in ("sum_value", "mean_value", "stddev_value")}
    )


@query("stream_upsert", """
    SELECT user_id, event_id, ts, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
def stream_upsert(spark, folder):
    """The latest event of each user as a keyed table."""
    base = shared_dir(spark, "latest")
    table = KeyedTable(spark, f"{base}/table", "user_id")
    rows = _events_stream(spark, folder).drop("props")
    sinks.stream_upsert(rows, table, sinks.latest_first("ts", "event_id"), f"{base}/checkpoint")
    return table.read()


@query("scd2_stream", """
    WITH changes AS (
        SELECT user_id, ts, event_type, value FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn FROM events)
        WHERE rn = 1)
    SELECT user_id, event_type, value, ts AS valid_from,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
           lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current
    FROM changes""")
def scd2_stream(spark, folder):
    base = shared_dir(spark, "history")
    table = KeyedTable(spark, f"{base}/table", ["user_id", "valid_from"])
    rows = _events_stream(spark, folder).drop("props")
    sinks.stream_scd2(rows, table, ["user_id"], "ts", "event_id", f"{base}/checkpoint")
    return table.read().drop("event_id")


@query("request_log_stream", """
    SELECT event_id, ts AS request_time, user_id, CAST(0 AS INTEGER) AS position,
           CAST(k AS BIGINT) AS content_id, value AS score, event_type AS genre FROM logged""")
def request_log_stream(spark, folder):
    from reelgrove.operators.governance import parse_request_log

    base = shared_dir(spark, "request-log")
    rows = _events_stream(spark, folder)
    k = F.get_json_object("props", "$.k").cast("int")
    scored = rows.select(
        "event_id",
        F.col("ts").alias("request_time"),
        "user_id",
        F.array(
            F.struct(k.alias("content_id"), F.col("value").alias("score"), F.col("event_type").alias("genre"))
        ).alias("recommendations"),
    )
    sinks.stream_request_log(scored, f"{base}/log", f"{base}/checkpoint")
    return parse_request_log(spark.read.parquet(f"{base}/log"))
