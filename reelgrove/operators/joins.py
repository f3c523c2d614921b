"""Joins of a large side to a side with one row per key.

Catalyst broadcasts a side it knows to be small. Past that limit the join is
shuffled, and a key holding a large share of the rows would land in one task.
``lookup_join`` finds such keys in one pass with Spark's frequent-item sketch, which
keeps a bounded number of counters, and spreads only those keys over several salts. A key counts as hot once it outweighs
a few average shuffle partitions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_SALT = "__salt"
_MIN_SUPPORT = 2e-4
_MAX_SUPPORT = 0.2
_TRACKED = 10_000


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def source_bytes(df: DataFrame) -> int:
    """Size of everything the plan reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def measured_bytes(df: DataFrame) -> int:
    """Exact size of the rows: fixed widths plus the bytes of every text."""
    fixed, texts = 8 * (len(df.columns) + 1), []
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            texts.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        elif not isinstance(field.dataType, T.AtomicType):
            texts.append(F.octet_length(F.to_json(F.struct(field.name))))
    total = reduce(lambda a, b: a + b, texts, F.lit(fixed))
    return int(df.agg(F.coalesce(F.sum(total.cast("bigint")), F.lit(0))).first()[0])


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the rows are known to fit the session's broadcast limit.

    Catalyst multiplies sizes at joins, so a small joined lookup can look large. One that
    reads little is therefore measured.
    """
    limit = broadcast_limit(df)
    if limit <= 0:
        return False
    if planned_bytes(df) <= limit:
        return True
    return source_bytes(df) <= 4 * limit and measured_bytes(df) <= limit


def joins_tables(df: DataFrame) -> bool:
    """Whether the optimised plan still has a join in it."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(line.lstrip(" :+-").startswith("Join ") for line in plan.splitlines())


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_code(keys: Sequence[str], types: Sequence) -> Column:
    """One number per key tuple; both join sides cast to the same types first."""
    return F.xxhash64(*[F.col(k).cast(t) for k, t in zip(keys, types)])


def frequent_codes(keys: DataFrame, types: Sequence, support: float) -> list[int]:
    """Codes of the rows with at least ``support`` of all rows; at most ``1 / support``.

    One pass with a sketch of bounded size, whose counts are off by less than the
    smallest support in use.
    """
    codes = keys.dropna().select(key_code(keys.columns, types).alias("code"))
    most = math.ceil(1 / support)
    top, total = codes.agg(
        F.expr(f"approx_top_k(code, {most}, {_TRACKED})"), F.count("*")
    ).first()
    return sorted(t["item"] for t in top if t["count"] >= support * total)


def row_salt(df: DataFrame, salts: int) -> Column:
    """A salt from the row's values and its task, stable when a task is run again.

    The task number keeps identical copies of one row from sharing a salt.
    """
    return F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(salts)).cast("int")


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: str | Sequence[str],
    how: str = "left",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Join ``fact`` to ``lookup``, which holds at most one row per key.

    ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. The result equals
    the plain join; only its distribution differs. Hot keys are searched in ``fact`` if it
    comes from one table. ``keys_from`` names a table with the same key frequencies for one
    that went through joins; without it, skew there is left to adaptive execution.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    limit = broadcast_limit(lookup)
    if 0 < planned_bytes(lookup) <= limit:  # Catalyst and its runtime statistics decide
        return fact.join(lookup, keys, how)
    if fits_broadcast(lookup):
        return fact.join(F.broadcast(lookup), keys, how)

    partitions = shuffle_partitions(fact)
    support = min(_MAX_SUPPORT, max(_MIN_SUPPORT, 4.0 / partitions))
    source = fact if keys_from is None else keys_from
    if joins_tables(source):  # a search would run those joins once more; AQE splits skew
        return fact.join(lookup, keys, how)
    types = [fact.schema[k].dataType for k in keys]
    hot = frequent_codes(source.select(*keys), types, support)
    if not hot:
        return fact.join(lookup, keys, how)
    return salted_join(fact, lookup, keys, how, hot, salts=max(2, min(256, partitions // 2)))


def salted_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: Sequence[int],
    salts: int,
) -> DataFrame:
    """The same join with the rows of the ``hot`` key codes spread over ``salts`` tasks.

    Rows without a key never match, so they are spread as well.
    """
    keys = list(keys)
    types = [fact.schema[k].dataType for k in keys]
    is_hot = key_code(keys, types).isin(list(hot))
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    left = fact.withColumn(
        _SALT, F.when(keyless | is_hot, row_salt(fact, salts)).otherwise(F.lit(0))
    )
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    right = lookup.withColumn(_SALT, F.explode(copies))
    return left.join(right, [*keys, _SALT], how).drop(_SALT)
