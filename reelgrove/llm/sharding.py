"""Histogram sort: splitters of equal bytes from exact counts, then one exchange.

Rows are ordered by a key of 32 hexadecimal digits: the hash of the group columns, so that
copies lie together, then the hash of the tie columns and of the row. Each round counts the
exact bytes and rows in equal cells of key space, but only inside cells that still hold a
wanted splitter. A splitter is accepted at a cell boundary within its tolerance, else its
cell is cut again. Boundaries inside the group half come last, so a group of copies is
divided only where keeping it whole would miss the tolerance. The counts also give each
slice its first slot, so no task has to number a whole shard.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from reelgrove.llm.common import kept

DIGITS = 3  # of a probe round: 4,096 cells
KEY_DIGITS = 32


def counted(keys: DataFrame, cells: list[str], digits: int) -> dict[str, list]:
    """Bytes and rows of the sub-cells of the given cells, which have one depth."""
    depth = len(cells[0])
    rows = keys.withColumn("cell", F.substring("key", 1, depth))
    if depth:
        wanted = keys.sparkSession.createDataFrame([(c,) for c in cells], "cell string")
        rows = rows.join(F.broadcast(wanted), "cell")
    found = rows.groupBy("cell", F.substring("key", depth + 1, digits).alias("sub")).agg(
        F.sum("bytes").alias("b"), F.count("*").alias("n")
    )
    out: dict[str, list] = {}
    for r in found.collect():  # at most 4,096 rows for each wanted splitter
        out.setdefault(r["cell"], []).append((r["sub"], r["b"], r["n"]))
    return out


def splitters(keys: DataFrame, wanted: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """For each (bytes, tolerance) a key with about as many bytes below it.

    Returns ``(key, bytes below, rows below)`` of each, with exact counts. Where a cell of
    full depth misses the tolerance the nearest boundary is taken.
    """
    done: list = [None] * len(wanted)
    cells = {"": (0, 0, list(range(len(wanted))))}
    while cells:
        depth = len(next(iter(cells)))
        digits = min(DIGITS, KEY_DIGITS - depth)
        found = counted(keys, list(cells), digits)
        deeper: dict[str, tuple] = {}
        for cell, (bytes_below, rows_below, inside) in cells.items():
            subs = sorted(found[cell])
            edges = [(cell + s, 0, 0) for s, _, _ in subs]
            for i, (_, b, n) in enumerate(subs):
                edges[i] = (edges[i][0], bytes_below, rows_below)
                bytes_below, rows_below = bytes_below + b, rows_below + n
            last = cell + "g"  # behind every key of the cell
            edges.append((last, bytes_below, rows_below))
            sums = [e[1] for e in edges]
            for t in inside:
                target, tolerance = wanted[t]
                k = min(bisect.bisect_right(sums, target), len(edges) - 1)
                best = min(edges[max(0, k - 1) : k + 1], key=lambda e: abs(e[1] - target))
                if abs(best[1] - target) <= tolerance or depth + digits == KEY_DIGITS:
                    done[t] = best
                else:
                    at = edges[k - 1]
                    deeper.setdefault(at[0], (at[1], at[2], []))[2].append(t)
        cells = deeper
    return done


def shard(
    rows: DataFrame,
    size_col: str,
    group_cols: Sequence[str],
    tie_cols: Sequence[str],
    shards: int = 16,
    tolerance: float = 0.001,
) -> DataFrame:
    """Add ``shard`` and ``slot`` to every row, so that shards hold nearly equal bytes.

    ``size_col`` holds a row's bytes, ``group_cols`` what copies have in common, ``tie_cols``
    what orders them. Each of a shard's two ends is off by at most ``tolerance`` of an equal
    part, or by half a row where a row is larger. Slots number a shard's rows from 0 in key
    order. All columns are kept but ``shard`` and ``slot`` of the input, which are replaced.
    NULL sizes count as 0, NULL keys are a value like others, repeated rows are kept and may
    be divided; an empty table gives an empty result.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c not in ("shard", "slot")]
    quoted = {c: F.col(f"`{c}`") for c in columns}
    row_tie = F.xxhash64(F.monotonically_increasing_id())

    def digits(hashed):
        return F.lpad(F.lower(F.hex(hashed)), 16, "0")

    keyed = kept(
        rows.select(
            F.struct(*quoted.values()).alias("row"),
            F.coalesce(quoted[size_col].cast("bigint"), F.lit(0)).alias("bytes"),
            F.concat(
                digits(F.xxhash64(*[quoted[c] for c in group_cols])),
                F.substring(digits(F.xxhash64(*[quoted[c] for c in tie_cols])), 1, 10),
                F.substring(digits(row_tie), 1, 6),
            ).alias("key"),
        ),
        "keys",
    )
    keys = keyed.select("key", "bytes")
    total = keys.agg(F.sum("bytes")).first()[0]
    cuts: list[tuple[str, int, int]] = []
    shard_cuts: list[tuple[str, int, int]] = []
    if total is not None:
        inner = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
        slices = shards * inner
        wanted = [
            (total * j // slices, int(total * (tolerance / shards if j % inner == 0 else 0.2 / slices)))
            for j in range(1, slices)
        ]
        cuts = splitters(keys, wanted)
        shard_cuts = [c for j, c in enumerate(cuts, 1) if j % inner == 0]
        cuts = sorted(set(cuts))
    starts = [(0, 0)] + [(bisect.bisect_right(shard_cuts, c), c[2]) for c in cuts]
    shard_starts = [0] + [c[2] for c in shard_cuts]
    slices_of = spark.createDataFrame(
        [(i, s, n - shard_starts[s]) for i, (s, n) in enumerate(starts)],
        "slice int, shard int, first_slot bigint",
    )
    by_cell: dict[str, list[str]] = {}
    for c in cuts:
        by_cell.setdefault(c[0][:DIGITS], []).append(c[0])
    order = sorted(by_cell)
    lookup, below = [], 0
    for i in range(16**DIGITS):
        cell = f"{i:0{DIGITS}x}"
        while order and order[0] < cell:  # a cut behind the last key of a cell ends in "g"
            below += len(by_cell[order.pop(0)])
        lookup.append((cell, below, by_cell.get(cell, [])))
    cells = spark.createDataFrame(lookup, "cell string, below int, cuts array<string>")

    sliced = (
        keyed.withColumn("cell", F.substring("key", 1, DIGITS))
        .join(F.broadcast(cells), "cell")
        .withColumn("slice", F.col("below") + F.size(F.filter("cuts", lambda c: c <= F.col("key"))))
        .select("row", "key", "slice")
    )
    place = F.row_number().over(Window.partitionBy("slice").orderBy("key")) - 1
    return (
        sliced.withColumn("place", place)
        .join(F.broadcast(slices_of), "slice")
        .select(
            *[F.col("row").getField(c).alias(c) for c in columns],
            "shard",
            (F.col("first_slot") + F.col("place")).alias("slot"),
        )
    )
