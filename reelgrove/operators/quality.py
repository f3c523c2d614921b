"""Named data-quality rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F


@dataclass(frozen=True)
class Rule:
    """A SQL predicate with a name. A NULL result counts as a failure."""

    name: str
    predicate: str
    drop: bool = False

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))

    def failures(self) -> Column:
        return F.count(F.when(~self.passes(), F.lit(1)))


# ---- fixed values: the rules of the silver tables ----------------------------
USER_RULES = (
    Rule("user_id_not_null", "user_id IS NOT NULL", drop=True),
    Rule("valid_age", "age BETWEEN 5 AND 120"),
)
ITEM_RULES = (
    Rule("content_id_not_null", "content_id IS NOT NULL", drop=True),
    Rule("duration_positive", "duration_min > 0", drop=True),
)
INTERACTION_RULES = (
    Rule("ids_not_null", "user_id IS NOT NULL AND content_id IS NOT NULL", drop=True),
    Rule("watch_seconds_non_negative", "watch_seconds >= 0"),
)
# -------------------------------------------------------------------------------


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep the rows that pass every dropping rule."""
    for rule in rules:
        if rule.drop:
            df = df.where(rule.passes())
    return df


def expect_warn(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str
) -> DataFrame:
    """Keep every row and count the failures of each rule while the rows pass by."""
    return df.observe(
        observation, F.count("*").alias("rows"), *[r.failures().alias(r.name) for r in rules]
    )


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None
) -> DataFrame:
    """Count failures if asked to, then drop what the dropping rules reject."""
    if observation is not None:
        df = expect_warn(df, rules, observation)
    return expect_or_drop(df, rules)


def expectation_report(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows, failures and pass rate per rule, from one pass over the table."""
    counted = df.agg(
        F.count("*").alias("rows"), *[r.failures().alias(f"f{i}") for i, r in enumerate(rules)]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit("drop" if r.drop else "warn").alias("action"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counted.select("rows", F.inline(entries)).select(
        F.lit(table).alias("table_name"),
        "rule",
        "action",
        "rows",
        "failed",
        F.when(F.col("rows") > 0, (F.col("rows") - F.col("failed")) / F.col("rows")).alias(
            "pass_rate"
        ),
    )


def quarantine(df: DataFrame, rules: Sequence[Rule], output: str = "failed_rules") -> DataFrame:
    """The rows that fail a rule, with the names of those they fail, in the rules' order."""
    failed = F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]))
    return df.withColumn(output, failed).where(F.size(output) > 0)
