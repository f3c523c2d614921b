"""Training, scoring and the recommendation chain."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from reelgrove.functions import fixed_values as fixed
from reelgrove.operators import features, governance, lists, models, monitoring, plugins, recommend
from reelgrove.operators.joins import lookup_join
from reelgrove.plans.aggregates import _watch_lists
from reelgrove.plans.registry import query
from reelgrove.session import lasting_dir, shared_dir, stored
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import state_of
from reelgrove.streaming.schemas import load_text, save_text

# What the ranker is trained on.
_RANKER_TABLES = ("customer", "lineitem", "nation", "orders", "part")


def _split(spark, folder, cap=None):
    """All rows to learn from and all test rows; their facts come from all training rows alone.

    A ``cap`` is for trials: so many rows are chosen before the facts are joined, so the joins
    see them and the test rows, not every view.
    """
    views = v.viewed_items(spark, folder).select(
        "interaction_id", "user_id", "content_id", "watch_seconds", "event_ts", "completed"
    )
    marked = stored(models.rank_training_split(views), "marked_views")
    train = marked.where("split = 'train'")
    users = features.with_age(features.user_totals(train), v.silver_users(spark, folder))
    users = stored(features.side_facts(users, "user_id", ""), "train_users")
    items = features.item_features(v.silver_items(spark, folder), train)
    items = stored(features.side_facts(items, "content_id", ""), "train_items")
    pairs = ["interaction_id", "user_id", "content_id", "completed", "split"]
    learnt = models.training_sample(train.select(*pairs), cap)
    if cap is not None:
        learnt = stored(learnt, "training_sample")
    test = marked.where("split = 'test'").select(*pairs)
    return features.ranker_inputs(learnt, users, items), features.ranker_inputs(test, users, items)


def _place(spark, folder):
    """The folder of the rankers that learnt from all rows of these tables as they are now."""
    return lasting_dir(spark, f"ranker-all-rows-{state_of(spark, folder, _RANKER_TABLES)}")


def _search(spark, folder):
    """Search, and put the best model where all jobs on these tables find it."""
    train, test = _split(spark, folder)
    best, trials = models.ranker_search(train, test)
    place = _place(spark, folder)
    name = uuid.uuid4().hex[:12]
    best.save(spark, f"{place}/{name}")
    save_text(spark, f"{place}/current", name)
    return best, trials


def _trained(spark, folder):
    """The stored ranker of these tables as they are now; trained by whoever needs it first."""
    place = _place(spark, folder)
    name = load_text(spark, f"{place}/current")
    if name is None:
        return _search(spark, folder)[0]
    return models.Ranker.load(spark, f"{place}/{name}")


@query("rank_training_split", """
    SELECT interaction_id, user_id, content_id, event_ts, watch_seconds,
           CASE WHEN CAST(concat('0x', substr(md5(concat('42|', interaction_id)), 1, 8)) AS BIGINT) % 100 < 20
                THEN 'test' ELSE 'train' END AS split
    FROM silver_interactions""")
def rank_training_split(spark, folder):
    return models.rank_training_split(v.silver_interactions(spark, folder)).drop("device")


IN_RANGE = "score BETWEEN 0 AND 1 AS score_in_range"


@query("ranker_fit", """
    SELECT interaction_id, user_id, content_id, completed, TRUE AS score_in_range, TRUE AS beats_chance
    FROM gold_interactions
    WHERE CAST(concat('0x', substr(md5(concat('42|', interaction_id)), 1, 8)) AS BIGINT) % 100 < 20""")
def ranker_fit(spark, folder):
    """Scores of the held-out rows by a ranker with the default settings, fitted here."""
    train, test = _split(spark, folder)
    ranker = models.ranker_fit(train)
    scored = stored(ranker.score(test), "scored")
    return scored.select(
        "interaction_id", "user_id", "content_id", "completed", F.expr(IN_RANGE),
        F.lit(models.auc(scored).first()["auc"] > 0.5).alias("beats_chance"),
    )


_TRIALS = ", ".join(
    f"({i}, {p['maxDepth']}, {p['stepSize']!r}::DOUBLE, {p['maxIter']}, {p['minInstancesPerNode']})"
    for i, p in enumerate(models.search_space())
)


@query("ranker_search", f"""
    SELECT trial, depth, rate, trees, min_child, TRUE AS beats_chance, TRUE AS chosen_is_best
    FROM (VALUES {_TRIALS}) AS t(trial, depth, rate, trees, min_child)""")
def ranker_search(spark, folder):
    """The whole search space, each trial's AUC checked against chance and the chosen one's.

    No trial may beat the chosen one in the last round it took part in.
    """
    best, trials = _search(spark, folder)
    chosen = next(t for t in trials if t.params == best.params)
    rows = [
        (i, t.params["maxDepth"], t.params["stepSize"], t.params["maxIter"], t.params["minInstancesPerNode"],
         t.auc > 0.5 and best.auc > 0.5, t.auc <= chosen.rounds[len(t.rounds) - 1] and len(t.rounds) <= len(chosen.rounds))
        for i, t in enumerate(trials)
    ]
    return spark.createDataFrame(
        rows,
        "trial int, depth int, rate double, trees int, min_child int, beats_chance boolean, chosen_is_best boolean",
    )


@query("auc", """
    WITH scored AS (
        SELECT CAST(g.completed AS INTEGER) AS y, t.completion_rate AS s
        FROM gold_interactions g JOIN item_features t ON g.content_id = t.content_id
        WHERE g.completed IS NOT NULL),
    ranked AS (
        SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM scored)
    SELECT CAST(sum(y) AS BIGINT) AS positives, CAST(sum(1 - y) AS BIGINT) AS negatives,
           round((CAST(sum(r) FILTER (WHERE y = 1) AS DOUBLE) - CAST(sum(y) AS DOUBLE) * (sum(y) + 1) / 2)
                 / (CAST(sum(y) AS DOUBLE) * sum(1 - y)), 9) AS auc
    FROM ranked""")
def auc(spark, folder):
    rates = v.all_item_features(spark, folder).select(
        "content_id", F.col("completion_rate").alias("score")
    )
    scored = lookup_join(v.viewed_items(spark, folder), rates, "content_id", "inner")
    return models.auc(scored).withColumn("auc", F.round("auc", 9))


# ---- retrieval --------------------------------------------------------------------

def _with_candidates(spark, folder, tables=None):
    users, items = tables or v.list_tables(spark, folder)
    known = items.select("content_id")
    vectors = lookup_join(v.vectors(spark, folder), known, "content_id", "left_semi")
    found = recommend.retrieve_by_seed(users, vectors, popular=recommend.popular_items(items))
    return stored(found, "candidates"), items


_CANDIDATES = """
    WITH vectors AS (
        SELECT vec_id AS content_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IN (SELECT content_id FROM silver_items)),
    near AS (
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY seed ORDER BY similarity DESC, content_id) AS place FROM (
                SELECT q.content_id AS seed, i.content_id,
                       round(list_dot_product(q.e, i.e) / (sqrt(list_dot_product(q.e, q.e)) * sqrt(list_dot_product(i.e, i.e))), 9) AS similarity
                FROM vectors q, vectors i WHERE q.content_id IN (SELECT seed_content_id FROM seeds)))
        WHERE place <= 100),
    popular AS (
        SELECT content_id, row_number() OVER (ORDER BY popularity_7d DESC, content_id) AS place
        FROM item_features ORDER BY place LIMIT 100),
    candidates AS (
        SELECT u.user_id, n.content_id, n.place, 'vector_search' AS retrieved_by
        FROM user_features u JOIN near n ON u.seed_content_id = n.seed
        UNION ALL
        SELECT u.user_id, p.content_id, p.place, 'popular' FROM user_features u, popular p
        WHERE u.seed_content_id NOT IN (SELECT content_id FROM vectors))
"""

_LISTS = _CANDIDATES + """,
    scored AS (
        SELECT c.user_id, c.content_id, t.title, t.genre, c.retrieved_by, u.fav_genre,
               (7 * t.popularity_7d + (31 * c.user_id + 17 * c.content_id) % 101) / 1000 AS score
        FROM candidates c JOIN item_features t ON c.content_id = t.content_id
        JOIN user_features u ON c.user_id = u.user_id),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY user_id, genre ORDER BY score DESC, content_id) AS g FROM scored),
    places AS (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank
        FROM best WHERE g = 1),
    listed AS (
        SELECT user_id, rank, content_id, title, genre, score, retrieved_by,
               coalesce(fav_genre, 'drama') AS fav_genre FROM places WHERE rank <= 5)
"""


def _sample_score(pairs):
    """A fixed score of a pair, in place of a trained model, so that SQL can repeat it."""
    score = (
        7 * F.col("i_popularity_7d")
        + F.pmod(31 * F.col("user_id") + 17 * F.col("content_id"), F.lit(101))
    ) / 1000
    return pairs.withColumn("score", score)


def _lists(spark, folder):
    users, items = _with_candidates(spark, folder)
    ranked = recommend.ranked_lists(
        _sample_score(recommend.user_candidate_pairs(users, items)), items
    )
    return users, ranked


@query("retrieve_by_seed", _CANDIDATES + """
    SELECT user_id, retrieved_by, string_agg(CAST(content_id AS VARCHAR), ',' ORDER BY place) AS candidates
    FROM candidates GROUP BY user_id, retrieved_by""")
def retrieve_by_seed(spark, folder):
    users, _ = _with_candidates(spark, folder)
    ids = F.transform("candidates", lambda x: x.cast("string"))
    return users.select("user_id", "retrieved_by", F.array_join(ids, ",").alias("candidates"))


@query("user_candidate_pairs", _CANDIDATES + """
    SELECT c.user_id, c.content_id, c.retrieved_by, u.watch_count_7d AS u_watch_count_7d,
           u.p50_session_seconds AS u_p50_session_seconds, t.popularity_7d AS i_popularity_7d,
           t.genre AS i_genre
    FROM candidates c JOIN item_features t ON c.content_id = t.content_id
    JOIN user_features u ON c.user_id = u.user_id""")
def user_candidate_pairs(spark, folder):
    users, items = _with_candidates(spark, folder)
    return recommend.user_candidate_pairs(users, items).select(
        "user_id", "content_id", "retrieved_by", "u_watch_count_7d",
        "u_p50_session_seconds", "i_popularity_7d", "i_genre",
    )


@query("score_candidates", _CANDIDATES + """
    SELECT c.user_id, c.content_id, c.retrieved_by, TRUE AS score_in_range, TRUE AS beats_chance,
           count(*) OVER (PARTITION BY c.user_id) > 1 AS scores_differ
    FROM candidates c JOIN item_features t ON c.content_id = t.content_id""")
def score_candidates(spark, folder):
    """The stored ranker scores every user's candidates.

    Its AUC on held-out rows has to beat chance, and a user's candidates must not all get one
    score.
    """
    ranker = _trained(spark, folder)
    users, items = v.list_tables(spark, folder)
    users = stored(features.with_age(users, v.silver_users(spark, folder)), "users_with_age")
    users, items = _with_candidates(spark, folder, (users, items))
    scored = recommend.score_candidates(recommend.user_candidate_pairs(users, items), ranker)
    own = Window.partitionBy("user_id")  # a user's pairs leave one task, so nothing is shuffled
    return scored.select("user_id", "content_id", "retrieved_by", "score").select(
        "user_id", "content_id", "retrieved_by", F.expr(IN_RANGE), F.lit(ranker.auc > 0.5).alias("beats_chance"),
        (F.min("score").over(own) < F.max("score").over(own)).alias("scores_differ"),
    )


# ---- lists and explanations ---------------------------------------------------------

@query("explain_prompts", _LISTS + f"""
    SELECT user_id, rank, '{fixed.EXPLAIN_SYSTEM_PROMPT.replace("'", "''")}' AS system_text,
           concat('Recently watched: ',
                  coalesce((SELECT string_agg(o.title, ', ' ORDER BY o.rank) FROM listed o
                            WHERE o.user_id = l.user_id AND o.rank < l.rank AND o.rank <= 3), 'unknown'),
                  chr(10), 'Favorite genre: ', fav_genre, chr(10),
                  'Candidate: ''', title, ''' (genre: ', genre, ')', chr(10),
                  'Why might they like this candidate?') AS user_text
    FROM listed l""")
def explain_prompts(spark, folder):
    _, ranked = _lists(spark, folder)
    return recommend.explain_prompts(ranked).select(
        "user_id",
        F.col("rank").cast("bigint").alias("rank"),
        F.col("messages")[0]["content"].alias("system_text"),
        F.col("messages")[1]["content"].alias("user_text"),
    )


@query("explain_text", _LISTS + """
    SELECT *, concat('Recommended based on your taste in ', fav_genre, '.') AS why FROM listed""")
def explain_text(spark, folder):
    _, ranked = _lists(spark, folder)
    return recommend.explain_text(ranked).withColumn("rank", F.col("rank").cast("bigint"))


@query("recommend_batch", _LISTS + """
    SELECT u.user_id, count(l.rank) AS items,
           coalesce(string_agg(CAST(l.content_id AS VARCHAR), ',' ORDER BY l.rank), '') AS content_ids,
           coalesce(string_agg(l.genre, ',' ORDER BY l.rank), '') AS genres,
           max(l.score) AS best_score, min(l.retrieved_by) AS retrieved_by
    FROM user_features u LEFT JOIN listed l ON u.user_id = l.user_id GROUP BY u.user_id""")
def recommend_batch(spark, folder):
    users, items = _with_candidates(spark, folder)
    explained = recommend.recommend_batch(users, items, _sample_score)
    whole = recommend.as_user_lists(users, explained)
    entry = F.col("recommendations")
    return whole.select(
        "user_id",
        F.size(entry).cast("bigint").alias("items"),
        F.array_join(F.transform(entry, lambda r: r["content_id"].cast("string")), ",").alias("content_ids"),
        F.array_join(entry["genre"], ",").alias("genres"),
        F.array_max(entry["score"]).alias("best_score"),
        F.array_min(entry["retrieved_by"]).alias("retrieved_by"),
    )


@query("publish_recommendations", """
    WITH totals AS (
        SELECT user_id, content_id, genre, CAST(sum(watch_seconds) AS BIGINT) AS score
        FROM gold_interactions WHERE genre IS NOT NULL GROUP BY user_id, content_id, genre),
    published AS (
        SELECT * FROM (
            SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank,
                   content_id, score FROM totals) WHERE rank <= 10),
    fresh AS (
        SELECT * FROM (
            SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank,
                   content_id, score FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id, genre ORDER BY score DESC, content_id) AS g
                FROM totals) WHERE g = 1) WHERE rank <= 5)
    SELECT * FROM published WHERE (user_id, rank) NOT IN (SELECT user_id, rank FROM fresh)
    UNION ALL SELECT * FROM fresh""")
def publish_recommendations(spark, folder):
    scored = _watch_lists(spark, folder)
    columns = ["user_id", F.col("rank").cast("bigint").alias("rank"), "content_id", "score"]
    published = lists.top_k_per_user(scored, 10).select(*columns)
    fresh = stored(lists.diversity_rerank(scored).select(*columns), "fresh_lists")  # read three times
    return recommend.publish_recommendations(published, fresh)


# ---- plug-in points, with models that SQL can repeat ------------------------------------

@query("embed_with", """
    SELECT content_id, CAST(length(title) AS FLOAT) AS letters,
           CAST(length(title) - length(replace(title, ' ', '')) AS FLOAT) AS spaces
    FROM silver_items""")
def embed_with(spark, folder):
    def counting():
        return lambda texts: [[len(t), t.count(" ")] for t in texts]

    found = plugins.embed_with(v.silver_items(spark, folder), "title", counting)
    return found.select(
        "content_id", F.col("embedding")[0].alias("letters"), F.col("embedding")[1].alias("spaces")
    )


@query("explain_with", _LISTS + """
    SELECT user_id, rank,
           CASE WHEN contains(title, 'e') THEN concat('Recommended based on your taste in ', fav_genre, '.')
                ELSE concat('Try ', title, '.') END AS why
    FROM listed""")
def explain_with(spark, folder):
    """A model that fails on some prompts; only those fall back to the template."""

    def picky():
        def answer(batch):
            titles = [m.split("Candidate: '")[1].split("' (genre")[0] for m in batch]
            if any("e" in t for t in titles):
                raise ValueError("a title this model cannot spell")
            return [f" Try {t}. " for t in titles]

        return answer

    _, ranked = _lists(spark, folder)
    explained = plugins.explain_with(recommend.explain_prompts(ranked), picky)
    return explained.select("user_id", F.col("rank").cast("bigint").alias("rank"), "why")


# ---- the whole chain ------------------------------------------------------------------

@query("recommend_chain", """
    SELECT u.user_id,
           CASE WHEN u.seed_content_id IN (SELECT content_id FROM silver_items) THEN 'vector_search'
                ELSE 'two_tower' END AS retrieved_by,
           TRUE AS list_fits, TRUE AS one_per_genre, TRUE AS all_explained, TRUE AS log_is_complete
    FROM user_features u""")
def recommend_chain(spark, folder):
    """Item text to vectors, neighbours of the seed, factor fallback, trained ranker, lists.

    The lists are explained, logged as requests and read back from the log; the daily
    profile of the logged scores has to count every entry.
    """
    gold, users, items = v.feature_tables(spark, folder)
    texts = items.select("content_id", F.coalesce("synopsis", "title").alias("synopsis"))
    vectors = stored(models.text_embedding(texts, "content_id", "synopsis"), "item_vectors")
    factors = models.factor_embeddings(models.normalised_ratings(gold))
    # Only users whose seed has no vector take their candidates from factors.
    without = users.withColumnRenamed("seed_content_id", "content_id").join(
        vectors.select("content_id"), "content_id", "left_anti"
    )
    by_factors = recommend.candidate_lists(models.retrieve_factors(factors, without), "user_id")
    found = stored(
        recommend.retrieve_by_seed(
            users, vectors, fallback=by_factors, popular=recommend.popular_items(items)
        ),
        "candidates",
    )
    ranker = _trained(spark, folder)
    known = features.with_age(found, v.silver_users(spark, folder))
    explained = recommend.recommend_batch(known, items, ranker.score)
    lists_of = stored(recommend.as_user_lists(found, explained), "recommendations")

    # Every list is one request of a fixed time, so that the log's profile has one day.
    requests = lists_of.withColumn("request_time", F.to_timestamp(F.lit("2024-01-01 12:00:00")))
    log = shared_dir(spark, "request_log")
    governance.append_request_log(requests, log, key="user_id")
    read_back = stored(
        governance.parse_request_log(spark.read.parquet(log).drop("user_id")), "parsed_log"
    )
    profile = monitoring.profile_daily(read_back, "request_time", ["score"]).agg(F.sum("rows")).first()[0]
    entries = lists_of.agg(F.sum(F.size("recommendations"))).first()[0]
    logged = read_back.groupBy("user_id").agg(F.count("*").alias("logged"))

    entry = F.col("recommendations")
    size = F.size(entry)
    return lookup_join(lists_of, logged, "user_id").join(
        found.select("user_id", "retrieved_by"), "user_id"
    ).select(
        "user_id",
        "retrieved_by",
        size.between(1, fixed.TOP_K).alias("list_fits"),
        (F.size(F.array_distinct(entry["genre"])) == size).alias("one_per_genre"),
        F.forall(entry, lambda r: F.length(r["why"]) > 0).alias("all_explained"),
        ((F.coalesce("logged", F.lit(0)) == size) & F.lit(profile == entries)).alias("log_is_complete"),
    )
