"""Lists that weigh score against likeness: maximal marginal relevance per user."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reelgrove.functions import fixed_values as fixed
from reelgrove.operators.joins import lookup_join
from reelgrove.operators.lists import top_k_per_user
from reelgrove.session import stored

# Likeness and values are rounded before they are compared, so that equal ones tie and ties go
# by id.
DIGITS = 9
VALUE_DIGITS = 12
# How much of a place's value is the score; the rest is the distance from the places before.
SCORE_SHARE = 0.7
GROUP_ROWS = 65_536


def _unit(lists: pa.ChunkedArray) -> np.ndarray:
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    m = flat.reshape(len(lists), -1) if len(flat) else np.zeros((len(lists), 0))
    norms = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(norms == 0.0, 1.0, norms)


def greedy_order(scores: np.ndarray, vectors: np.ndarray, k: int, share: float) -> list[tuple[int, float]]:
    """Rows of one list in the order they are picked, with their values; rows are in id order.

    The first pick has the best score. Each later one has the greatest
    ``share * score - (1 - share) * likeness`` to the most alike item picked before.
    """
    alike = np.zeros(len(scores))
    left = np.ones(len(scores), dtype=bool)
    picked: list[tuple[int, float]] = []
    while left.any() and len(picked) < k:
        value = np.round(share * scores - (1 - share) * alike, VALUE_DIGITS)
        best = int(np.where(left, value, -np.inf).argmax())
        picked.append((best, float(value[best])))
        left[best] = False
        likeness = np.round(vectors @ vectors[best], DIGITS)
        alike = likeness if len(picked) == 1 else np.maximum(alike, likeness)
    return picked


def mmr_rerank(
    scored: DataFrame,
    vectors: DataFrame,
    k: int = fixed.TOP_K,
    share: float = SCORE_SHARE,
    user: str = "user_id",
    item: str = "content_id",
    score: str = "score",
    vector: str = "embedding",
    candidates: int = fixed.NUM_CANDIDATES,
) -> DataFrame:
    """The ``k`` items of each user picked by maximal marginal relevance, with rank and value.

    ``vectors`` holds a row per item. Items without a vector are like no other; ties go to the
    lower item id. Of each user the ``candidates`` best by score are looked at, as many as
    retrieval returns, so no list is longer. Lists are put together by a hash of the user into
    Arrow tables of about ``GROUP_ROWS`` rows.
    """
    best = stored(
        top_k_per_user(scored.select(user, item, score), candidates, user, item, score).drop("rank"), "best_scored"
    )
    known = vectors.select(item, F.col(vector).alias("__vector"))
    rows = lookup_join(best, known, item)
    groups = max(1, math.ceil(best.count() / GROUP_ROWS))
    fields = [
        scored.schema[user],
        scored.schema[item],
        scored.schema[score],
        T.StructField("mmr", T.DoubleType()),
        T.StructField("rank", T.IntegerType()),
    ]

    def pick(table: pa.Table) -> pa.Table:
        table = table.sort_by([(user, "ascending"), (item, "ascending")])
        column = table["__vector"]
        width = max((len(v) for v in column.slice(0).drop_null()[:1].to_pylist()), default=0)
        has = column.is_valid().to_numpy()
        m = np.zeros((len(table), width))
        if has.any():
            m[has] = _unit(column.filter(pa.array(has)))
        scores = table[score].to_numpy().astype(np.float64)
        users = table[user].combine_chunks()
        starts = np.flatnonzero(np.r_[True, [a != b for a, b in zip(users[1:].to_pylist(), users[:-1].to_pylist())]])
        places, values, ranks = [], [], []
        for start, end in zip(starts, [*starts[1:], len(table)]):
            for rank, (row, value) in enumerate(greedy_order(scores[start:end], m[start:end], k, share), 1):
                places.append(start + row)
                values.append(value)
                ranks.append(rank)
        out = table.select([user, item, score]).take(pa.array(places, pa.int64()))
        return out.append_column("mmr", pa.array(values, pa.float64())).append_column("rank", pa.array(ranks, pa.int32()))

    return rows.groupBy(F.pmod(F.xxhash64(user), F.lit(groups)).alias("__group")).applyInArrow(
        pick, T.StructType(fields)
    )
