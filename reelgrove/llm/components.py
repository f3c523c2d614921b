"""Connected components by alternating star operations on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reelgrove.llm.common import kept
from reelgrove.operators.joins import salted_join, shuffle_partitions

# A node is hot with this share of the edges, and at least so many; its edges are spread.
HOT_SHARE = 0.005
HOT_EDGES = 1_000
_TRACKED = 10_000


def _to_least(directed: DataFrame, hot: list[int]) -> DataFrame:
    """Every edge ``u, v`` with the least of ``u`` and all its neighbours as ``m``."""
    least = directed.groupBy("u").agg(F.min("v").alias("m"))
    if hot:
        salts = max(2, min(256, shuffle_partitions(directed) // 2))
        joined = salted_join(directed, least, ["u"], "inner", hot, salts)
    else:
        joined = directed.join(least, "u")
    return joined.withColumn("m", F.least("u", "m"))


def _state(edges: DataFrame) -> tuple[tuple, list[int]]:
    """What tells two edge tables apart, and the codes of hot nodes (at most 200 a column)."""
    most = int(1 / HOT_SHARE)
    count, code, *tops = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        *[F.expr(f"approx_top_k(xxhash64({c}), {most}, {_TRACKED})") for c in ("u", "v")],
    ).first()
    least = max(HOT_EDGES, HOT_SHARE * count)
    return (count, code), sorted({t["item"] for top in tops for t in top or [] if t["count"] >= least})


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its least node) for the nodes of an edge table ``u, v``.

    Each round hangs larger neighbours, then smaller ones, on the least node known nearby.
    Rounds are written, so that plans stay short and a lost executor costs a re-read; the
    number of rounds grows with the logarithm of the longest chain. Minima are combined
    before the shuffle, and the edges of hot nodes are spread over several tasks where they
    meet them. Loops and repeated edges are ignored.
    """
    edges = kept(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state, hot = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both, hot).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _to_least(large, hot)
        hung = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        following = kept(hung.where("u != v").distinct(), "edges")
        new_state, hot = _state(following)
        edges = following
        if new_state == state:
            break
        state = new_state
    own = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
