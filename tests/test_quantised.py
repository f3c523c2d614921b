"""Short codes against the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgrove.operators import quantised, similarity


def table(spark, m, first=0):
    rows = [(first + i, [float(x) for x in v]) for i, v in enumerate(m)]
    return spark.createDataFrame(rows, "id bigint, embedding array<double>")


@pytest.fixture(scope="module")
def clustered(spark):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(20, 16))
    m = middles[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    return spark, similarity.stored(table(spark, m), "clustered")


NAMES = dict(query_id="id", item_id="id")


def test_codes_stand_for_their_vectors(clustered):
    spark, items = clustered
    index = quantised.build_index(items, "id", cells=12, parts=8, entries=32)
    rows = {r.id: r for r in index.codes.collect()}
    vectors = {r.id: np.array(r.embedding) for r in items.collect()}
    assert sorted(rows) == sorted(vectors) and {len(r.code) for r in rows.values()} == {8}
    m = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in sorted(vectors)])
    cell, codes = index.books.encode(m)
    assert [rows[i].cell for i in sorted(rows)] == cell.tolist()
    assert [bytes(rows[i].code) for i in sorted(rows)] == [c.tobytes() for c in codes]
    # Looked-up scores are the products with the rebuilt vectors.
    rebuilt = index.books.centres[cell] + np.concatenate(
        [index.books.entries[p][codes[:, p]] for p in range(8)], axis=1
    )
    one = int(cell[0])
    inside = cell == one
    guess = index.books.looked_up(index.books.tables(m[:5]), m[:5] @ index.books.centres[one], codes[inside])
    assert np.allclose(guess, m[:5] @ rebuilt[inside].T)
    assert ((m - rebuilt) ** 2).sum(axis=1).mean() < 0.35 * ((m - m.mean(axis=0)) ** 2).sum(axis=1).mean()


def test_recall_and_products(clustered):
    spark, items = clustered
    index = quantised.build_index(items, "id", cells=12, parts=8, entries=32)
    effort = quantised.effort_for_recall(items, items, index, 10, **NAMES)
    found = similarity.stored(quantised.knn_quantised(items, items, 10, index=index, effort=effort, **NAMES), "found")
    exact = similarity.stored(similarity.knn_exact(items, items, 10, **NAMES), "exact")
    assert similarity.recall(exact, found, "id", "neighbour_id").first()["recall"] >= 0.9
    n = items.count()
    assert effort.products(index.books, n) < n * n / 4
    assert effort.n_probe < 12
    assert found.groupBy("id").agg(F.count("*").alias("n"), F.max("rank").alias("r")).where("n <> 10 OR r <> 10").count() == 0
    both = found.join(exact.select("id", "neighbour_id", F.col("score").alias("right")), ["id", "neighbour_id"])
    assert both.where("score <> right").count() == 0


def test_whole_lists_give_the_exact_result(clustered):
    spark, items = clustered
    queries = items.where("id % 50 = 0")
    index = quantised.build_index(items, "id", cells=4, parts=4, entries=8)
    found = quantised.knn_quantised(queries, items, 7, index=index, effort=quantised.Effort(4, 1500), **NAMES)
    exact = similarity.knn_exact(queries, items, 7, **NAMES)
    as_rows = lambda df: sorted((r.id, r.rank, r.neighbour_id, r.score) for r in df.collect())
    assert as_rows(found) == as_rows(exact)


def test_saved_and_loaded(clustered, tmp_path):
    spark, items = clustered
    index = quantised.build_index(items, "id", cells=4, parts=4, entries=8)
    quantised.save_index(index, str(tmp_path))
    again = quantised.load_index(spark, str(tmp_path))
    effort = quantised.Effort(2, 60)
    as_rows = lambda i: sorted(map(tuple, quantised.knn_quantised(items.where("id < 40"), items, 5, index=i, effort=effort, **NAMES).collect()))
    assert as_rows(index) == as_rows(again)


def test_edges(spark):
    none = table(spark, np.empty((0, 4)))
    assert quantised.knn_quantised(none, none, 3, **NAMES).count() == 0
    few = spark.createDataFrame(
        [(1, [1.0, 0.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [0.0, 0.0, 0.0]), (4, None), (None, [1.0, 1.0, 1.0])],
        "id bigint, embedding array<double>",
    )
    rows = quantised.knn_quantised(few, few, 2, **NAMES).collect()
    assert sorted((r.id, r.rank, r.neighbour_id, r.score) for r in rows) == [
        (1, 1, 1, 1.0), (1, 2, 2, 1.0), (2, 1, 1, 1.0), (2, 2, 2, 1.0), (3, 1, 1, 0.0), (3, 2, 2, 0.0),
    ]
    # Copies of one vector in a single cell: blocks bound what meets in a task.
    same = table(spark, np.tile([[1.0, 2.0, 3.0, 4.0]], (300, 1)))
    index = quantised.build_index(same, "id", cells=4)
    lists = quantised.short_lists(same, index, 3, "id", block_rows=32, query_rows=16).collect()
    assert len(lists) == 900 and {r.item for r in lists} == {0, 1, 2}


def test_short_lists_are_scored_where_they_arise(spark, monkeypatch):
    """A search stores no lists, and its tables of pairs of parts give the looked-up scores."""
    rng = np.random.default_rng(4)
    rows = table(spark, rng.normal(size=(700, 10)))
    index = quantised.build_index(rows, "id", cells=5, parts=5, entries=16)
    names = []
    monkeypatch.setattr(quantised, "stored", lambda df, name: names.append(name) or similarity.stored(df, name))
    found = quantised.knn_quantised(rows, rows, 4, index=index, effort=quantised.Effort(3, 40), **NAMES)
    assert found.count() == 2800 and names == []
    books, m = index.books, rng.normal(size=(6, 10))
    codes = rng.integers(0, 16, (50, 5)).astype(np.uint8)
    cells = np.repeat(2, 50)
    probed = np.zeros((6, 5), dtype=bool)
    probed[:5, 2] = True
    guess = quantised._guesses(books, m, cells, probed, codes)
    assert np.allclose(guess[:5], books.looked_up(books.tables(m), m @ books.centres[2], codes)[:5], atol=1e-4)
    assert np.isneginf(guess[5]).all()
