"""An index that follows its items by what changed."""

from pyspark.sql import functions as F

from reelgrove.operators import plugins
from reelgrove.operators.index_sync import VectorIndex, changes_since, digest_of
from reelgrove.session import shared_dir

SCHEMA = "content_id bigint, title string, synopsis string, views int"


def items(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def embedder(seen):
    """Counts letters, and notes which items it was given."""

    def embed(rows):
        seen.append(sorted(r.content_id for r in rows.select("content_id").collect()))
        made = plugins.embed_with(rows, "title", lambda: lambda texts: [[len(t)] for t in texts])
        return made.select("content_id", "embedding")

    return embed


def held(index):
    return sorted((r.content_id, r.embedding and r.embedding[0]) for r in index.read().collect())


def test_only_changed_items_are_embedded_and_the_result_is_that_of_a_rebuild(spark):
    seen = []
    index = VectorIndex(spark, shared_dir(spark, "index"), "content_id", ["title", "synopsis"], buckets=4)
    first = items(spark, (1, "a", "s", 1), (2, "bb", None, 1), (3, "ccc", "", 1), (4, None, "s", 1), (None, "x", "x", 1))
    assert index.sync(first, embedder(seen)) == {"insert": 4}
    later = items(spark, (1, "a", "s", 99), (2, "bb", "", 1), (3, "changed", "", 1), (5, "new", None, 1), (None, "y", "y", 1))
    assert index.sync(later, embedder(seen)) == {"insert": 1, "update": 2, "delete": 1}
    assert seen == [[1, 2, 3, 4], [2, 3, 5]]
    fresh = VectorIndex(spark, shared_dir(spark, "index"), "content_id", ["title", "synopsis"])
    fresh.sync(later, embedder([]))
    assert held(index) == held(fresh) == [(1, 1.0), (2, 2.0), (3, 7.0), (5, 3.0)]
    assert index.sync(later, embedder(seen)) == {} and len(seen) == 2
    assert index.sync(items(spark), embedder(seen)) == {"delete": 4} and held(index) == []


def test_the_model_sees_changed_rows_alone_in_the_plan(spark):
    index = VectorIndex(spark, shared_dir(spark, "index"), "content_id", ["title"])
    first = spark.range(1000).selectExpr("id AS content_id", "string(id) AS title", "'' AS synopsis", "1 AS views")
    index.sync(first, embedder([]))
    plans, counts = [], []

    def embed(rows):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        counts.append(rows.count())
        return embedder([])(rows)

    index.sync(first.withColumn("title", F.when(F.col("content_id") == 7, "seven").otherwise(F.col("title"))), embed)
    assert counts == [1] and "LeftSemi" in plans[0]


def test_a_sync_cut_short_is_made_up_for(spark):
    index = VectorIndex(spark, shared_dir(spark, "index"), "content_id", ["title"])
    first = items(spark, (1, "a", "", 1), (2, "b", "", 1))
    index.sync(first, embedder([]))
    later = items(spark, (1, "aaaa", "", 1), (2, "b", "", 1))
    real, index.digests.rewrite = index.digests.rewrite, None
    try:
        index.sync(later, embedder([]))
    except TypeError:
        pass
    index.digests.rewrite = real
    assert index.sync(later, embedder([])) == {"update": 1}
    assert held(index) == [(1, 4.0), (2, 1.0)] and index.sync(later, embedder([])) == {}


def test_digests_tell_nulls_and_columns_apart(spark):
    rows = spark.createDataFrame([("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), ("a", "b")], "x string, y string")
    found = [r[0] for r in rows.select(digest_of(["x", "y"])).collect()]
    assert len(set(found)) == 5 and found[0] == found[-1]


def test_changes(spark):
    state = spark.createDataFrame([(1, "old"), (2, "gone")], "content_id bigint, digest string")
    got = changes_since(state, items(spark, (1, "t", "", 1), (3, "n", "", 1)), "content_id", ["title"])
    assert sorted((r.content_id, r.change_type, r.digest is None) for r in got.collect()) == [
        (1, "update", False), (2, "delete", True), (3, "insert", False),
    ]
