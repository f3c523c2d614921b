"""Versions compared by outcome: hits, weights, interval, verdict."""

import hashlib
import math
import random
from datetime import datetime, timedelta

import pytest

from reelgrove.operators import experiments as e

T0 = datetime(2024, 1, 1)


def test_hits_are_watches_after_serving(spark):
    served = [(1, 7, T0, 0.5), (1, 7, T0 + timedelta(hours=30), 0.5), (1, 8, T0, 0.1), (2, 7, T0, 0.2), (None, 7, T0, 0.2)]
    watched = [(1, 7, T0 + timedelta(hours=24)), (1, 8, T0 - timedelta(hours=1)), (2, 7, T0 + timedelta(hours=25)), (None, 7, T0)]
    rows = e.outcomes(
        spark.createDataFrame(served, "user_id int, content_id int, served_at timestamp, score double"),
        spark.createDataFrame(watched, "user_id int, content_id int, event_ts timestamp"),
        hours=24,
    ).collect()
    assert sorted((r.user_id or 0, r.content_id, r.served_at.hour, r.hit) for r in rows) == [
        (0, 7, 0, False), (1, 7, 0, True), (1, 7, 6, False), (1, 8, 0, False), (2, 7, 0, False),
    ]


def weight(user, replicate):
    draw = int(hashlib.md5(f"{user}|{replicate}".encode()).hexdigest()[:8], 16) / 16**8
    n, total, p = 0, 0.0, math.exp(-1)
    while draw >= total + p:
        total += p
        n += 1
        p /= n
    return n


def brute(rows, replicates):
    """The difference and its interval, by drawing users one replicate after another."""
    def difference(draw):
        rates = {}
        for version in ("champion", "challenger"):
            own = [(draw(u), h) for u, v, h in rows if v == version]
            served = sum(w for w, _ in own)
            if not served:
                return None
            rates[version] = sum(w * h for w, h in own) / served
        return round(rates["challenger"] - rates["champion"], 9)

    drawn = sorted(d for b in range(1, replicates + 1) if (d := difference(lambda u: weight(u, b))) is not None)
    at = lambda p: drawn[max(1, math.ceil(p * len(drawn))) - 1]
    return difference(lambda u: 1), at(0.025), at(0.975)


@pytest.mark.parametrize("lift, verdict", [(0.0, "undecided"), (0.4, "better"), (-0.3, "worse")])
def test_interval_as_brute_force(spark, lift, verdict):
    rng = random.Random(3)
    rows = []
    for u in range(300):
        version = "challenger" if u % 3 == 0 else "champion"
        rate = 0.4 + (lift if version == "challenger" else 0.0)
        rows += [(u, version, rng.random() < rate) for _ in range(rng.randint(1, 5))]
    got = e.compare_by_outcome(spark.createDataFrame(rows, "user_id int, version string, hit boolean"), replicates=100).first()
    difference, low, high = brute(rows, 100)
    assert (got.difference, got.low, got.high) == pytest.approx((difference, low, high), abs=1e-8)
    assert got.verdict == verdict
    assert got.champion_served == sum(v == "champion" for _, v, _ in rows)


def test_one_version_alone_is_undecided(spark):
    rows = spark.createDataFrame([(1, "champion", True), (None, "challenger", True)], "user_id int, version string, hit boolean")
    got = e.compare_by_outcome(rows, replicates=20).first()
    assert (got.champion_rate, got.challenger_rate, got.low, got.verdict) == (1.0, None, None, "undecided")
    assert e.compare_by_outcome(rows.limit(0), replicates=5).first().verdict == "undecided"


def test_weights_have_mean_and_variance_one(spark):
    df = spark.range(4000).selectExpr("id AS user_id", "1 AS replicate").select(e.poisson_weight("user_id", "replicate").alias("w"))
    rows = [r.w for r in df.collect()]
    mean = sum(rows) / len(rows)
    assert abs(mean - 1) < 0.06 and abs(sum((w - mean) ** 2 for w in rows) / len(rows) - 1) < 0.1
    assert rows[:50] == [weight(u, 1) for u in range(50)]
