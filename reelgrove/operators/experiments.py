"""Comparing two model versions by what users watched, with an interval and a decision.

Users are drawn again many times with Poisson(1) weights: a user counts 0, 1, 2, ... times in
a replicate, independently of all others. So replicates need no passes of their own and their
sums merge across tasks. Weights follow from a digest of user and replicate, which
makes every run give the same interval.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from reelgrove.operators.questions import served_then_watched

REPLICATES = 200
LEVEL = 0.95
CHAMPION, CHALLENGER = "champion", "challenger"


def poisson_limits(digits: int = 8) -> list[int]:
    """Below which number of ``digits`` hexadecimal digits a uniform draw means 0, 1, 2, ..."""
    limits, total, p = [], 0.0, math.exp(-1.0)
    for n in range(12):
        total += p
        limits.append(math.floor(total * 16**digits))
        p /= n + 1
    return limits


def poisson_weight(unit: str, replicate: str) -> Column:
    """How often a unit counts in a replicate."""
    text = F.concat(F.col(unit).cast("string"), F.lit("|"), F.col(replicate).cast("string"))
    draw = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    limits = poisson_limits()
    weight = F.lit(len(limits))
    for n, limit in reversed(list(enumerate(limits))):
        weight = F.when(draw < limit, F.lit(n)).otherwise(weight)
    return weight.cast("bigint")


def outcomes(served: DataFrame, watched: DataFrame, hours: int = 168) -> DataFrame:
    """Served rows with ``hit``: the user watched the item within ``hours`` after it was served.

    The same search as for watches that a recommendation preceded, with time turned round.
    """
    def turned(column: str) -> Column:
        return F.timestamp_micros(-F.unix_micros(F.col(column).cast("timestamp")))

    rows = served.withColumn("event_ts", turned("served_at"))
    later = watched.select("user_id", "content_id", turned("event_ts").alias("served_at"))
    return served_then_watched(rows, later, hours, output="hit").drop("event_ts")


def per_unit(rows: DataFrame, version: str, hit: str, unit: str) -> DataFrame:
    """Served and hit counts of each unit and version."""
    return rows.groupBy(unit, version).agg(
        F.count("*").alias("served"), F.count_if(F.col(hit)).alias("hits")
    )


def compare_by_outcome(
    rows: DataFrame,
    version: str = "version",
    hit: str = "hit",
    unit: str = "user_id",
    replicates: int = REPLICATES,
    level: float = LEVEL,
) -> DataFrame:
    """One row: both hit rates, their difference with an interval, and a verdict.

    The interval holds the middle ``level`` of the replicates' differences. The challenger is
    ``better`` or ``worse`` if the interval lies on one side of 0, otherwise ``undecided``, as it
    is where a version was never served. Rows without a unit are left out.
    """
    units = per_unit(rows.where(F.col(unit).isNotNull()), version, hit, unit)
    drawn = units.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    # Replicate 0 is the data as they are.
    weight = F.when(F.col("replicate") == 0, F.lit(1)).otherwise(poisson_weight(unit, "replicate"))

    def of(name: str, column: str) -> Column:
        return F.sum(F.when(F.col(version) == name, weight * F.col(column)).otherwise(0))

    sums = drawn.groupBy("replicate").agg(
        *[of(v, c).alias(f"{v}_{c}") for v in (CHAMPION, CHALLENGER) for c in ("served", "hits")]
    )
    rates = sums.withColumns(
        {f"{v}_rate": F.try_divide(f"{v}_hits", f"{v}_served") for v in (CHAMPION, CHALLENGER)}
    ).withColumn("difference", F.round(F.col(f"{CHALLENGER}_rate") - F.col(f"{CHAMPION}_rate"), 9))
    # At most one number per replicate.
    drawn_again = F.array_sort(
        F.filter(F.collect_list(F.when(F.col("replicate") > 0, F.col("difference"))), lambda d: d.isNotNull())
    )

    def actual(column: str) -> Column:
        return F.max(F.when(F.col("replicate") == 0, F.col(column)))

    counts = [f"{v}_{c}" for v in (CHAMPION, CHALLENGER) for c in ("served", "hits")]
    one = rates.agg(
        *[actual(c).alias(c) for c in (*counts, f"{CHAMPION}_rate", f"{CHALLENGER}_rate", "difference")],
        drawn_again.alias("__drawn"),
    )

    def quantile(p: float) -> Column:
        n = F.size("__drawn")
        place = F.ceil(F.round(F.lit(p) * n, 6))
        return F.get("__drawn", F.greatest(F.lit(1), place).cast("int") - 1)

    tail = round((1 - level) / 2, 9)
    bounds = one.withColumns({"low": quantile(tail), "high": quantile(1 - tail)})
    verdict = (
        F.when(F.col("low") > 0, "better").when(F.col("high") < 0, "worse").otherwise("undecided")
    )
    return bounds.withColumn("verdict", verdict).withColumns(
        {c: F.round(c, 9) for c in (f"{CHAMPION}_rate", f"{CHALLENGER}_rate")}
    ).drop("__drawn")
