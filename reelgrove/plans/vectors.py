"""Vectors: nearest neighbours, text vectors and factors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from reelgrove.functions import fixed_values as fixed
from reelgrove.functions.expressions import dot, l2_norm
from reelgrove.operators import models, quantised, similarity
from reelgrove.plans.registry import query
from reelgrove.session import stored
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import read_table


def _ranked(df):
    return df.withColumn("rank", F.col("rank").cast("bigint"))


@query("knn_exact", """
    WITH unit AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (
        SELECT q.vec_id, v.vec_id AS neighbour_id,
               round(list_dot_product(q.e, v.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(v.e, v.e))), 9) AS score
        FROM unit q, unit v)
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour_id) AS rank FROM pairs)
    WHERE rank <= 10""")
def knn_exact(spark, folder):
    rows = read_table(spark, folder, "embeddings")
    return _ranked(
        similarity.knn_exact(rows, rows, 10, query_id="vec_id", item_id="vec_id", cells=8)
    )


# Of the given vectors, which have no clusters, 32 entries for every 4 components.
_QUANTISED = dict(cells=8, entries=32)


def _quantised(spark, folder):
    """All vectors, their index, what it takes for a recall of 0.9, and the neighbours found."""
    rows = read_table(spark, folder, "embeddings")
    names = dict(query_id="vec_id", item_id="vec_id")
    index = quantised.build_index(rows, "vec_id", **_QUANTISED)
    effort = quantised.effort_for_recall(rows, rows, index, 10, **names)
    found = quantised.knn_quantised(rows, rows, 10, index=index, effort=effort, **names)
    return rows, index, effort, stored(found, "approximate")


def _recall(rows, found):
    exact = similarity.knn_exact(rows, rows, 10, query_id="vec_id", item_id="vec_id", cells=8)
    return similarity.recall(exact, found, "vec_id", "neighbour_id").first()["recall"]


@query("knn_quantised")
def knn_quantised(spark, folder):
    """The neighbours found by short codes, with their recall and share of the products.

    Rows of an approximate search are no rows of a SQL text: they are held against the exact
    search in the tests, and ``knn_approx`` states what SQL can of them.
    """
    rows, index, effort, found = _quantised(spark, folder)
    n = rows.count()
    return _ranked(found).withColumns(
        {
            "recall": F.lit(_recall(rows, found)),
            "products_share": F.lit(effort.products(index.books, n, index.blocks()) / (n * n)),
        }
    )


@query("knn_approx", """
    SELECT vec_id, CAST(10 AS BIGINT) AS neighbours, TRUE AS ranks_run, TRUE AS scores_are_cosines,
           TRUE AS recall_above_half
    FROM embeddings""")
def knn_approx(spark, folder):
    """The neighbours of ``knn_quantised``, checked against the true cosine and the exact search.

    The bar of ``recall_above_half`` is 0.9, with under a quarter of the exact search's products.
    """
    rows, index, effort, found = _quantised(spark, folder)
    n = rows.count()
    cheap = 4 * effort.products(index.books, n, index.blocks()) < n * n
    others = rows.select(F.col("vec_id").alias("neighbour_id"), F.col("embedding").alias("other"))
    cosine = dot("embedding", "other") / (l2_norm("embedding") * l2_norm("other"))
    checked = found.join(rows, "vec_id").join(others, "neighbour_id")
    return checked.groupBy("vec_id").agg(
        F.count("*").alias("neighbours"),
        ((F.min("rank") == 1) & (F.max("rank") == F.count("*"))).alias("ranks_run"),
        (F.max(F.abs(F.col("score") - cosine)) < 1e-6).alias("scores_are_cosines"),
        F.lit(cheap and _recall(rows, found) >= similarity.MIN_RECALL).alias("recall_above_half"),
    )


@query("item_similarity_pairs", """
    WITH wide AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    pairs AS (
        SELECT q.vec_id, v.vec_id AS neighbour_id, round(list_dot_product(q.e, v.e), 9) AS score
        FROM wide q, wide v)
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbour_id) AS rank FROM pairs)
    WHERE rank <= 100""")
def item_similarity_pairs(spark, folder):
    rows = read_table(spark, folder, "embeddings")
    return _ranked(
        similarity.top_k_by_product(rows, rows, 100, query_id="vec_id", item_id="vec_id")
    )


@query("text_embedding", r"""
    SELECT doc_id, CAST(256 AS INTEGER) AS dimensions,
           CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm
    FROM documents""")
def text_embedding(spark, folder):
    """Length of every text's vector: one, or zero without a term."""
    found = models.text_embedding(read_table(spark, folder, "documents"), "doc_id", "text")
    return found.select(
        "doc_id", F.size("embedding").alias("dimensions"), F.round(l2_norm("embedding"), 4).alias("norm")
    )


@query("normalised_ratings", """
    SELECT user_id, content_id,
           watch_seconds / greatest((SELECT max(watch_seconds) FROM silver_interactions), 1) AS rating
    FROM silver_interactions""")
def normalised_ratings(spark, folder):
    return models.normalised_ratings(v.silver_interactions(spark, folder))


def _factors(spark, folder):
    return models.factor_embeddings(models.normalised_ratings(v.silver_interactions(spark, folder)))


@query("factor_embeddings", f"""
    SELECT DISTINCT 'user' AS side, user_id AS id, {fixed.FACTOR_RANK} AS dimensions, TRUE AS beats_constant
    FROM silver_interactions
    UNION ALL
    SELECT DISTINCT 'item', content_id, {fixed.FACTOR_RANK}, TRUE FROM silver_interactions""")
def factor_embeddings(spark, folder):
    """A vector for every user and item, and whether they predict better than the mean."""
    views = v.silver_interactions(spark, folder).select("user_id", "content_id", "watch_seconds")
    ratings = models.normalised_ratings(stored(views, "views"))  # the views' join runs once
    model = models.factor_embeddings(ratings)
    mean = ratings.agg(F.avg("rating")).first()[0]
    pairs = ratings.join(model.users.withColumnRenamed("embedding", "u"), "user_id").join(
        model.items.withColumnRenamed("embedding", "i"), "content_id"
    )
    ours, constant = pairs.agg(
        F.avg((F.col("rating") - dot("u", "i")) ** 2), F.avg((F.col("rating") - mean) ** 2)
    ).first()
    sides = [("user", model.users, "user_id"), ("item", model.items, "content_id")]
    return reduce(
        lambda a, b: a.unionByName(b),
        [
            rows.select(
                F.lit(side).alias("side"), F.col(key).cast("bigint").alias("id"),
                F.size("embedding").alias("dimensions"), F.lit(ours < constant).alias("beats_constant"),
            )
            for side, rows, key in sides
        ],
    )


@query("retrieve_factors", """
    SELECT user_id, (SELECT least(100, count(DISTINCT content_id)) FROM silver_interactions) AS items,
           TRUE AS ranks_run, TRUE AS scores_fall, TRUE AS scores_are_products
    FROM silver_interactions GROUP BY user_id""")
def retrieve_factors(spark, folder):
    """The best items of every user, their order and scores checked against the vectors."""
    model = _factors(spark, folder)
    found = models.retrieve_factors(model)
    # A user's rows leave the search in one task: what needs their order is found there.
    before = F.lag("score").over(Window.partitionBy("user_id").orderBy("rank"))
    found = stored(found.withColumn("falls", F.coalesce(before >= F.col("score"), F.lit(True))), "retrieved")
    products = similarity.pair_products(found, model.users, model.items, "user_id", "content_id", "score")
    error = F.coalesce(F.abs(F.col("score") - F.col("product")), F.lit(float("inf")))
    checked = products.groupBy("user_id").agg((F.max(error) < 1e-5).alias("scores_are_products"))
    return found.groupBy("user_id").agg(
        F.count("*").alias("items"),
        ((F.min("rank") == 1) & (F.max("rank") == F.count("*"))).alias("ranks_run"),
        F.bool_and("falls").alias("scores_fall"),
    ).join(checked, "user_id")
