"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from reelgrove.functions import fixed_values as fixed

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- viewing ----------------------------------------------------------------

def completed_flag(watch_seconds: ColumnLike, duration_min: ColumnLike) -> Column:
    """Watched at least 85% of the running time, in whole-number arithmetic."""
    return _col(watch_seconds) >= F.lit(51) * _col(duration_min)


def completed_flag_truncated(watch_seconds: ColumnLike, duration_min: ColumnLike) -> Column:
    """The same rule with the threshold computed in doubles and cut to whole seconds."""
    threshold = (F.lit(fixed.COMPLETED_SHARE) * _col(duration_min) * 60).cast("bigint")
    return _col(watch_seconds) >= threshold


def is_weekend(ts: ColumnLike) -> Column:
    return F.dayofweek(_col(ts)).isin(1, 7)


def age_band(age: ColumnLike) -> Column:
    a = _col(age)
    return (
        F.when(a.isNull(), "unknown")
        .when(a < 18, "under 18")
        .when(a < 25, "18-24")
        .when(a < 35, "25-34")
        .when(a < 50, "35-49")
        .otherwise("50 and over")
    )


# ---- text -------------------------------------------------------------------

def embedding_text(*columns: ColumnLike) -> Column:
    return F.concat_ws(fixed.EMBEDDING_TEXT_SEPARATOR, *[_col(c) for c in columns])


def joined_titles(titles: ColumnLike, n: int = fixed.PROMPT_TITLES) -> Column:
    head = F.concat_ws(", ", F.slice(_col(titles), 1, n))
    return F.when(head == "", fixed.UNKNOWN_TITLES).otherwise(head)


def json_field(column: ColumnLike, path: str, dtype: str = "string") -> Column:
    return F.get_json_object(_col(column), path).cast(dtype)


# ---- vectors ----------------------------------------------------------------

def dot(a: ColumnLike, b: ColumnLike) -> Column:
    """Inner product of two arrays, accumulated in doubles from left to right."""
    products = F.zip_with(
        _col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(a: ColumnLike) -> Column:
    return F.sqrt(dot(a, a))


# ---- stable hashing ---------------------------------------------------------

def digest(*columns: ColumnLike) -> Column:
    """A digest of the values that any engine with MD5 reproduces."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("~")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def stable_bucket(columns: Sequence[ColumnLike], buckets: int) -> Column:
    """A bucket in ``[0, buckets)`` that never depends on row order or partitioning."""
    head = F.conv(F.substring(digest(*columns), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


# ---- masking ----------------------------------------------------------------

def mask_email(email: ColumnLike) -> Column:
    """Keep the first letter and the domain."""
    return F.regexp_replace(_col(email), r"^(.)[^@]*(@.*)$", "$1***$2")


def mask_phone(phone: ColumnLike) -> Column:
    """Keep the last two digits."""
    return F.regexp_replace(_col(phone), r"[0-9](?=[0-9]{2})", "*")


def visible_to(column: ColumnLike, groups: ColumnLike, reader_group: str) -> Column:
    """The column as text for members of ``reader_group``, a fixed word for anyone else."""
    return F.when(F.array_contains(_col(groups), reader_group), _col(column).cast("string")).otherwise(
        F.lit(fixed.REDACTED)
    )


# ---- explanations -----------------------------------------------------------

def explanation_messages(
    titles: ColumnLike, fav_genre: ColumnLike, title: ColumnLike, genre: ColumnLike
) -> Column:
    """The system and user message of one recommendation."""
    user_text = F.format_string(
        fixed.USER_PROMPT_FORMAT, joined_titles(titles), _col(fav_genre), _col(title), _col(genre)
    )
    return F.array(
        F.struct(
            F.lit("system").alias("role"),
            F.lit(fixed.EXPLAIN_SYSTEM_PROMPT).alias("content"),
        ),
        F.struct(F.lit("user").alias("role"), user_text.alias("content")),
    )


def fallback_explanation(fav_genre: ColumnLike) -> Column:
    return F.format_string(fixed.FALLBACK_EXPLANATION_FORMAT, _col(fav_genre))
