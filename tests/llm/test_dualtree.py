"""Vector codes: dual-tree rounds against plain loops over whole numbers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reelgrove.llm import dualtree
from reelgrove.llm.queries import QUERIES


def nearest(rows, book):
    """Index and distance of each row's nearest entry, by all distances in Python numbers."""
    out = []
    for r in rows:
        ranked = [(sum((int(a) - int(b)) ** 2 for a, b in zip(r, e)), i) for i, e in enumerate(book)]
        out.append(min(ranked))
    return out


def brute(vectors, parts=16, entries=64, rounds=2):
    """Codes, errors and codebooks of (id, vector) rows by the contract's words."""
    vectors = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    size = len(ints[0][1]) // parts
    codes, errors, books = [""] * len(ints), [0] * len(ints), []
    for p in range(parts):
        rows = [v[p * size : (p + 1) * size] for _, v in ints]
        book = [list(r) for r in rows[:entries]]
        for _ in range(rounds):
            found = nearest(rows, book)
            for e in range(len(book)):
                own = [r for r, (_, i) in zip(rows, found) if i == e]
                if own:
                    book[e] = [sum(c) // len(own) for c in zip(*own)]
        for k, (d, i) in enumerate(nearest(rows, book)):
            codes[k] += f"{i:02x}"
            errors[k] += d
        books.append(book)
    return [(i, c, e) for (i, _), c, e in zip(vectors, codes, errors)], books


def got(df):
    return sorted((r.vec_id is None, r.vec_id or 0, bytes(r.code).hex(), r.error) for r in df.collect())


def wanted(rows):
    return sorted((i is None, i or 0, c, e) for i, c, e in rows)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 90), st.integers(1, 30), st.integers(1, 4), st.integers(1, 6), st.randoms())
def test_assignment_with_ties(size, entries, width, spread, rng):
    """Small numbers, so that many distances are equal and boxes touch."""
    rows = np.array([[rng.randint(-spread, spread) for _ in range(width)] for _ in range(size)])
    book = np.array([[rng.randint(-spread, spread) for _ in range(width)] for _ in range(entries)])
    for kind in (np.int64, object):
        tree = dualtree.Tree(rows, 4)
        held = rows.astype(kind)
        wide = dualtree.Tree(held, 4, tree.order)
        found = dualtree.assign(wide, held[tree.order], dualtree.Entries(book.astype(kind)))
        assert found.codes.tolist() == [i for _, i in nearest(rows[tree.order], book)]
        sums, counts = dualtree._sums(found, held[tree.order], entries)
        for e in range(entries):
            own = rows[tree.order][found.codes == e]
            assert counts[e] == len(own) and sums[e].tolist() == own.sum(axis=0).tolist()


def test_trees_spare_most_distances():
    rng = np.random.default_rng(1)
    rows = rng.integers(-10, 10, (8192, 4)) + 100 * rng.integers(0, 8, (8192, 1))
    tree = dualtree.Tree(rows, dualtree.LEAF_ROWS)
    book = rows[:64].copy()
    found = dualtree.assign(tree, rows[tree.order], dualtree.Entries(book))
    assert found.rows_compared + found.pairs_compared < 0.3 * len(rows) * len(book)
    assert found.whole
    # Copies of one vector are given away whole, however many there are.
    same = np.tile(rows[:1], (8192, 1))
    found = dualtree.assign(dualtree.Tree(same, 8), same, dualtree.Entries(np.array([[0] * 4, [500] * 4, [0] * 4])))
    assert found.rows_compared == 0 and len(found.whole) == 1


@pytest.mark.parametrize("block_rows", [7, 64, 8192])
def test_as_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 32)]) for i in rng.permutation(300)]
    rows += rows[:20] + [(i + 1000, v) for i, v in rows[:40]]
    coded, books = dualtree.quantise(frame(spark, rows).repartition(3), block_rows=block_rows)
    expected, expected_books = brute(rows)
    assert got(coded) == wanted(expected)
    assert [b.tolist() for b in books] == expected_books


def test_few_rows_and_other_settings(spark):
    rows = [(3, [0.5] * 4), (1, [0.25, -0.001, 0.0, 1.0]), (None, [0.5] * 4)]
    coded, books = dualtree.quantise(frame(spark, rows), parts=2, entries=64, rounds=3)
    expected, expected_books = brute(rows, parts=2, rounds=3)
    assert got(coded) == wanted(expected) and [b.tolist() for b in books] == expected_books


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [i / 7.0, -i / 3.0] * 16) for i in range(70)]
    odd = [(70, None), (71, [nan] + [0.0] * 31), (72, [inf] * 32), (73, [None] * 32), (74, []), (75, [1.0])]
    schema = "vec_id bigint, embedding array<double>, code string, error int, row string, label string"
    rows = [(i, v, "x", 1, "r", None if (i or 0) % 3 else "a") for i, v in good + odd + [(None, good[0][1])]]
    coded, _ = dualtree.quantise(spark.createDataFrame(rows, schema))
    assert coded.columns == ["vec_id", "row", "label", "code", "error"]
    expected, _ = brute(good + [(None, good[0][1])])
    assert got(coded) == wanted(expected)
    summed = dualtree.with_group_error(coded, "label", "label_error").collect()
    assert len(summed) == 71
    for label in (None, "a"):
        assert {r.label_error for r in summed if r.label == label} == {sum(r.error for r in summed if r.label == label)}
    empty, books = dualtree.quantise(frame(spark, []))
    assert empty.count() == 0 and books == []
    only_odd, books = dualtree.quantise(frame(spark, [(70, None), (71, [nan])]))
    assert only_odd.count() == 0 and books == []
    blank, books = dualtree.quantise(frame(spark, [(1, []), (2, [])]))
    assert got(blank) == [(False, 1, "00" * 16, 0), (False, 2, "00" * 16, 0)]
    with pytest.raises(ValueError, match="divide"):
        dualtree.quantise(frame(spark, [(1, [1.0] * 17)]))


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-(2**30), 2**30, 32)]) for i in range(80)]
    coded, books = dualtree.quantise(frame(spark, rows))
    expected, expected_books = brute(rows)
    assert [b.tolist() for b in books] == expected_books
    assert got(coded) == wanted([(i, c, min(e, dualtree.LONG_MAX)) for i, c, e in expected])
    far = dualtree.quantise(frame(spark, [(1, [1e300] * 32), (2, [-1e300] * 32), (3, [3e38] * 32)]), rounds=2)[0]
    assert far.count() == 3
    assert dualtree.with_group_error(far.withColumn("g", F.lit(1)), "g", "t").first().t >= 0


def test_query_as_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    labels = {r.vec_id: r.label for r in rows}
    expected, books = brute([(r.vec_id, list(r.embedding)) for r in rows])
    out = QUERIES["op13_vector_codes"](spark, small).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in out) == sorted(expected)
    sums = {}
    for i, _, e in expected:
        sums[labels[i]] = sums.get(labels[i], 0) + e
    assert all(r.label_error == sums[labels[r.vec_id]] for r in out)
