"""Masking, tags, asset log, audits and request logs as data jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from reelgrove.functions import fixed_values as fixed
from reelgrove.functions.expressions import mask_email, mask_phone, stable_bucket, visible_to
from reelgrove.operators.filters import latest
from reelgrove.operators.upsert import upsert_by_key

ASSET_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in fixed.ASSET_COLUMNS.items())
TAG_KEYS = ["object_name", "column_name", "tag"]


# ---- masking ----------------------------------------------------------------------

def mask_columns(
    df: DataFrame,
    columns: Sequence[str],
    groups: Column,
    reader_group: str = fixed.PII_READERS_GROUP,
) -> DataFrame:
    """Sensitive columns for members of the reader group, a fixed word for others."""
    return df.withColumns({c: visible_to(c, groups, reader_group) for c in columns})


def masked_view(
    spark: SparkSession,
    view: str,
    source: str,
    columns: Sequence[str],
    groups_variable: str = "reader_groups",
    reader_group: str = fixed.PII_READERS_GROUP,
) -> DataFrame:
    """A temporary view that masks by the groups in a session variable at query time."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {groups_variable} ARRAY<STRING> DEFAULT array()")
    masked = ", ".join(
        f"CASE WHEN array_contains({groups_variable}, '{reader_group}') THEN CAST(`{c}` AS STRING) "
        f"ELSE '{fixed.REDACTED}' END AS `{c}`"
        if c in columns
        else f"`{c}`"
        for c in spark.table(source).columns
    )
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} AS SELECT {masked} FROM {source}")
    return spark.table(view)


def mask_contacts(df: DataFrame, email: str = "email", phone: str = "phone") -> DataFrame:
    """Masked contacts, and a digest of the address for joining without seeing it."""
    return df.withColumns(
        {
            email: mask_email(email),
            phone: mask_phone(phone),
            f"{email}_digest": F.sha2(F.col(email), 256),
        }
    )


# ---- tags -------------------------------------------------------------------------

def column_tags(objects: DataFrame, tag: str = fixed.PII_TAG, value: str = "true") -> DataFrame:
    """Tag rows for (object_name, column_name) pairs."""
    return objects.select(
        "object_name", "column_name", F.lit(tag).alias("tag"), F.lit(value).alias("value")
    ).distinct()


def table_tags(objects: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Tag rows for whole tables; the column name is empty."""
    entries = F.array(
        *[F.struct(F.lit(k).alias("tag"), F.lit(v).alias("value")) for k, v in tags.items()]
    )
    return (
        objects.select("object_name")
        .distinct()
        .select("object_name", F.lit("").alias("column_name"), F.inline(entries))
    )


def tag_table(tags: DataFrame, more: DataFrame) -> DataFrame:
    """Add or change tags; one value per object, column and tag."""
    return upsert_by_key(tags, more, TAG_KEYS)


def tagged_with(tags: DataFrame, tag: str, value: str | None = None) -> DataFrame:
    found = tags.where(F.col("tag") == tag)
    return found if value is None else found.where(F.col("value") == value)


# ---- assets -----------------------------------------------------------------------

def asset_log(log: DataFrame, records: DataFrame) -> DataFrame:
    """Add or replace assets by type and name, the creation time included."""
    return upsert_by_key(log, records, ["asset_type", "name"])


def sorted_listing(log: DataFrame) -> DataFrame:
    return log.select(list(fixed.ASSET_COLUMNS)).orderBy("chapter", "asset_type", "name")


# ---- audits -----------------------------------------------------------------------

def audit_query(
    audit: DataFrame,
    prefix: str,
    path: str = "$.full_name_arg",
    hours: int = 24,
    limit: int = 20,
    as_of: Column | None = None,
    tie_break: str = "event_id",
) -> DataFrame:
    """The newest actions of the last hours on objects whose name starts with a prefix."""
    end = latest(audit, "event_time") if as_of is None else as_of
    return (
        audit.where(F.col("event_time") > end - F.expr(f"INTERVAL {int(hours)} HOURS"))
        .withColumn("table_arg", F.get_json_object("request_params", path))
        .where(F.col("table_arg").startswith(prefix))
        .orderBy(F.desc("event_time"), F.desc(tie_break))
        .limit(limit)
        .select("event_time", "action_name", "table_arg", tie_break)
    )


def newest(audit: DataFrame, limit: int = 20, tie_break: str = "event_id") -> DataFrame:
    return audit.orderBy(F.desc("event_time"), F.desc(tie_break)).limit(limit)


def rate_limit_audit(
    log: DataFrame, ts: str, calls: int = fixed.RATE_LIMIT_PER_MINUTE
) -> DataFrame:
    """Minutes with more calls than allowed."""
    return (
        log.groupBy(F.window(ts, "1 minute").alias("w"))
        .agg(F.count("*").alias("calls"))
        .where(F.col("calls") > calls)
        .select(F.col("w.start").alias("minute"), "calls")
    )


def usage_rollup(log: DataFrame, ts: str, caller: str = "user_id") -> DataFrame:
    return log.groupBy(F.to_date(ts).alias("day"), caller).agg(F.count("*").alias("calls"))


# ---- fixed values: what counts as personal data in free text -------------------------
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_PATTERN = r"\+?[0-9][0-9 ().-]{7,}[0-9]"
# --------------------------------------------------------------------------------------


def pii_scan(df: DataFrame, text: str) -> DataFrame:
    """Numbers of addresses and phone numbers in a text, and whether to block it."""
    counted = df.withColumns(
        {
            "emails": F.regexp_count(F.col(text), F.lit(EMAIL_PATTERN)).cast("bigint"),
            "phones": F.regexp_count(F.col(text), F.lit(PHONE_PATTERN)).cast("bigint"),
        }
    )
    return counted.withColumn("blocked", (F.col("emails") > 0) | (F.col("phones") > 0))


# ---- request log --------------------------------------------------------------------

def request_log_rows(
    scored: DataFrame, request_time: str = "request_time", key: str = "event_id"
) -> DataFrame:
    """Requests and responses as JSON text, with the day they were made."""
    return scored.select(
        key,
        F.col(request_time),
        F.to_json(F.struct("user_id")).alias("request"),
        F.to_json(F.col("recommendations")).alias("response"),
        F.to_date(request_time).alias("day"),
    )


def append_request_log(scored: DataFrame, path: str, **columns) -> None:
    """Append to a log laid out by day.

    Rebalancing gives each day few files and cuts a heavy day into several.
    """
    rows = request_log_rows(scored, **columns).hint("rebalance", "day")
    rows.write.mode("append").partitionBy("day").parquet(path)


RESPONSE_SCHEMA = "array<struct<content_id:bigint,score:double,genre:string>>"


def parse_request_log(log: DataFrame, schema: str = RESPONSE_SCHEMA) -> DataFrame:
    """One row per logged recommendation."""
    entries = F.from_json("response", schema)
    return log.select(
        *[c for c in log.columns if c not in ("request", "response", "day")],
        F.get_json_object("request", "$.user_id").cast("bigint").alias("user_id"),
        F.posexplode(entries).alias("position", "r"),
    ).select("*", "r.*").drop("r")


def timestamp_column_pick(
    df: DataFrame, preference: Sequence[str] = fixed.TIMESTAMP_PREFERENCE, output: str = "ts"
) -> DataFrame:
    """Add the first time column there is; numbers are milliseconds since 1970."""
    for name in preference:
        if name not in df.columns:
            continue
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        return df.withColumn(output, F.timestamp_millis(name) if numeric else F.col(name))
    raise ValueError(f"none of {list(preference)} is a column")


def champion_challenger(
    log: DataFrame, challenger_percent: int = 10, unit: str = "user_id"
) -> DataFrame:
    """Assign each user to one model version by a stable hash."""
    chosen = stable_bucket([unit], 100) < challenger_percent
    return log.withColumn("version", F.when(chosen, "challenger").otherwise("champion"))


def compare_versions(log: DataFrame, score: str = "score") -> DataFrame:
    return log.groupBy("version").agg(
        F.count("*").alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.round(F.avg(score), 6).alias("mean_score"),
    )
