"""Physical plans: pruned scans, early limits."""

import re

import pytest
from oracle import plan_of
from pyspark.sql import functions as F

from reelgrove.operators import filters, lists, models
from reelgrove.plans import QUERIES
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import read_table


def test_lookup_filter_reaches_the_scan(spark, small):
    text = plan_of(filters.point_lookup(v.items(spark, small), "content_id", 7, ["title"]))
    assert "EqualTo(p_partkey,7)" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_time_filter_with_a_given_end_reaches_the_scan(spark, small):
    end = F.expr("TIMESTAMP_NTZ '2001-12-01 00:00:00'")
    text = plan_of(filters.last_n_days(v.interactions(spark, small), 7, as_of=end))
    assert "GreaterThan(l_shipdate,2001-11-24" in text


def test_completion_by_genre_reads_few_columns(spark, small):
    text = plan_of(QUERIES["q_completion_by_genre"](spark, small))
    lineitem = next(s for s in re.findall(r"ReadSchema: (\S+)", text) if "l_partkey" in s)
    assert set(re.findall(r"(\w+):", lineitem)) == {"l_orderkey", "l_partkey", "l_quantity"}


def test_ranks_are_cut_before_the_shuffle(spark, small):
    scored = read_table(spark, small, "events").select(
        "user_id", F.col("event_id").alias("content_id"), F.col("value").alias("score")
    )
    assert "WindowGroupLimit" in plan_of(lists.top_k_per_user(scored, 5))


def test_default_time_bound_is_found_once_and_reaches_the_scan(spark, small):
    text = plan_of(filters.last_n_days(v.interactions(spark, small), 7))
    assert "Subquery" not in text and "GreaterThan(l_shipdate," in text
    text = plan_of(QUERIES["q_week_over_week"](spark, small))
    assert "Subquery" not in text and "GreaterThan(l_shipdate," in text


def test_user_features_read_the_facts_once(spark, small):
    assert "lineitem" not in plan_of(QUERIES["user_features"](spark, small))  # a stored table


def test_no_join_runs_inside_a_search_for_hot_keys(spark, small, no_broadcast, monkeypatch):
    from reelgrove.operators import joins

    searched = []
    real = joins.frequent_codes
    monkeypatch.setattr(joins, "frequent_codes", lambda keys, *a: searched.append(keys) or real(keys, *a))
    v.gold_interactions(spark, small)
    assert all(not joins.joins_tables(keys) for keys in searched)


@pytest.mark.parametrize("name", ["first_genre", "diversity_rerank"])
def test_tasks_of_views_grow_in_number_with_the_views(spark, small, monkeypatch, name):
    views = read_table(spark, small, "lineitem").count()
    monkeypatch.setattr(v, "TASK_VIEWS", views // 9)
    assert v.view_tasks(spark, small) in (9, 10)
    text = plan_of(QUERIES[name](spark, small))
    dealt = re.findall(r"hashpartitioning\(\w+#\d+L?, (\d+)\), REPARTITION_BY_NUM", text)
    assert dealt and {int(n) for n in dealt} == {v.view_tasks(spark, small)}


def test_publishing_scores_the_views_once_for_each_list(spark, small):
    text = plan_of(QUERIES["publish_recommendations"](spark, small))
    assert len(re.findall(r"Location: .*lineitem", text)) == 1  # the fresh lists are read from a table


def test_factors_are_checked_on_views_joined_once(spark, small, monkeypatch):
    read, whole = [], models.normalised_ratings
    monkeypatch.setattr(models, "normalised_ratings", lambda rows: read.append(plan_of(rows)) or whole(rows))
    QUERIES["factor_embeddings"](spark, small)
    assert read and not any("lineitem" in text for text in read)


def test_no_vector_is_shuffled_with_each_retrieved_pair(spark, small, no_broadcast):
    text = plan_of(QUERIES["retrieve_factors"](spark, small))
    joined = [line for line in text.splitlines() if "SortMergeJoin" in line]
    assert "FlatMapCoGroupsInArrow" in text and all("content_id" not in line for line in joined)
