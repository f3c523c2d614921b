"""Maximal marginal relevance against a plain greedy loop."""

import random

import pytest
from pyspark.sql import functions as F

from reelgrove.operators import spread


def cosine(a, b):
    norm = lambda v: sum(x * x for x in v) ** 0.5 or 1.0
    return round(sum(x * y for x, y in zip(a, b)) / (norm(a) * norm(b)), 9)


def greedy(rows, vectors, k, share):
    """(item, rank) of one user's (item, score) rows, by the definition."""
    picked, left = [], dict(rows)
    while left and len(picked) < k:
        def value(i):
            alike = max((cosine(vectors.get(i) or [0.0], vectors.get(j) or [0.0]) if vectors.get(i) and vectors.get(j) else 0.0 for j in picked), default=0.0)
            return round(share * left[i] - (1 - share) * alike, 12)

        best = min(left, key=lambda i: (-value(i), i))
        picked.append(best)
        del left[best]
    return [(i, r) for r, i in enumerate(picked, 1)]


@pytest.mark.parametrize("share", [0.0, 0.5, 0.7, 1.0])
def test_same_as_a_plain_loop(spark, share):
    rng = random.Random(11)
    vectors = {i: [rng.choice([-1.0, 0.0, 1.0, 2.0]) for _ in range(6)] for i in range(40)}
    vectors[7] = None
    del vectors[8]
    rows = [(u, i, rng.choice([0.1, 0.5, 0.9, rng.random()])) for u in range(25) for i in rng.sample(range(40), rng.randint(1, 30))]
    scored = spark.createDataFrame(rows, "user_id bigint, content_id bigint, score double")
    table = spark.createDataFrame(list(vectors.items()), "content_id bigint, embedding array<double>")
    got = {}
    for r in spread.mmr_rerank(scored, table, k=5, share=share).collect():
        got.setdefault(r.user_id, []).append((r.content_id, r["rank"]))
    for u in range(25):
        wanted = greedy([(i, s) for v, i, s in rows if v == u], vectors, 5, share)
        assert sorted(got[u], key=lambda x: x[1]) == wanted


def test_alike_items_make_room(spark):
    scored = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 0.99), ("a", 3, 0.5), (None, 1, 1.0)], "user_id string, content_id int, score double"
    )
    table = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "content_id int, embedding array<float>")
    rows = spread.mmr_rerank(scored, table, k=2, share=0.5).where("user_id = 'a'").orderBy("rank").collect()
    assert [(r.content_id, r["rank"]) for r in rows] == [(1, 1), (3, 2)]
    assert spread.mmr_rerank(scored, table.limit(0), k=2).where("user_id = 'a'").orderBy("rank").first().content_id == 1
    assert spread.mmr_rerank(scored.limit(0), table).count() == 0
    assert spread.mmr_rerank(scored, table).where(F.col("user_id").isNull()).count() == 1
