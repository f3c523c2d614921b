"""Layout along a curve through several keys, so that filters on any of them skip files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Ranges per key, 2^8: their bounds are all that the driver sees of a key.
BITS = 8
_ACCURACY = 10_000
_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _number(df: DataFrame, key: str) -> Column:
    """A number in the order of the key. Texts count by their first seven bytes."""
    kind, column = df.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if not isinstance(kind, _ORDERED):
        raise TypeError(f"no order of ranges for {key} of type {kind.simpleString()}")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        column = column.cast("timestamp")
    return column.cast("double")


def range_bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> list[list[float]]:
    """The values that cut each key into 2^bits ranges of about equal numbers of rows.

    One pass over the key columns, with mergeable quantile sketches of bounded size.
    """
    shares = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(
        *[F.percentile_approx(_number(df, k), shares, _ACCURACY).alias(f"b{i}") for i, k in enumerate(keys)]
    ).first()
    return [list(bounds or [float("inf")] * len(shares)) for bounds in row]


def _spread(at: Column, bits: int, step: int, first: int) -> Column:
    """The lowest bits of a number, ``step`` places apart."""
    out = F.lit(0).cast("bigint")
    for b in range(bits):
        bit = F.shiftright(at, b).bitwiseAND(F.lit(1)).cast("bigint")
        out = out.bitwiseOR(F.shiftleft(bit, b * step + first))
    return out


def _range_bits(value: Column, bounds: Sequence[float], bits: int, step: int, first: int) -> Column:
    """How many bounds are not above the value, found by halving, with its bits spread.

    NULL is in the first range.
    """
    known = F.array(*[F.lit(float(b)) for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(2**b) for b in reversed(range(bits))]),
        F.lit(0),
        lambda at, half: F.when(value >= F.element_at(known, at + half), at + half).otherwise(at),
        lambda at: _spread(at, bits, step, first),
    )


def curve_position(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """Place on the curve: the bits of the keys' ranges in turn, the highest ones first.

    Neighbours on it are near in every key, where a sort by the keys keeps only the first
    one together.
    """
    if not 0 < bits * len(keys) < 64:
        raise ValueError("keys times bits must fit a 64-bit place")
    place = F.lit(0).cast("bigint")
    for i, (key, bounds) in enumerate(zip(keys, range_bounds(df, keys, bits))):
        place = place.bitwiseOR(
            _range_bits(_number(df, key), bounds, bits, len(keys), len(keys) - 1 - i)
        )
    return place


def curve_layout(
    df: DataFrame, keys: Sequence[str], partitions: int | None = None, bits: int = BITS
) -> DataFrame:
    """Order rows along the curve across and inside partitions.

    With f files, an equality on one of k keys reads about f to the power (k - 1) / k of them, whichever key
    it is. Key ranges follow the data, so skewed values do not fill one file; a hash of the
    other columns cuts places with very many equal rows. NULL keys lie in the first range.
    An empty table stays empty. Two passes: the key columns for the bounds, then one exchange.
    """
    place = "__place"
    others = [F.col(f"`{c}`") for c in df.columns if c not in keys] or [F.col(f"`{k}`") for k in keys]
    placed = df.withColumn(place, curve_position(df, keys, bits))
    ranges = [F.col(place), F.xxhash64(*others)]
    laid = (
        placed.repartitionByRange(partitions, *ranges) if partitions else placed.repartitionByRange(*ranges)
    )
    return laid.sortWithinPartitions(place, *[F.col(f"`{k}`") for k in keys]).drop(place)
