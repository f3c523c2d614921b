from pyspark.sql import Observation, functions as F

from reelgrove.operators import filters, medallion, quality
from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.functions.expressions import completed_flag, completed_flag_truncated, stable_bucket


def users(spark, *rows):
    return spark.createDataFrame(list(rows), "user_id bigint, age int")


def test_null_predicate_is_a_failure(spark):
    df = users(spark, (1, None), (2, 50))
    rule = quality.Rule("valid_age", "age BETWEEN 5 AND 120", drop=True)
    assert [r.user_id for r in quality.expect_or_drop(df, [rule]).collect()] == [2]


def test_report_counts_each_rule(spark):
    df = users(spark, (1, 200), (2, 50), (None, 7), (None, None))
    report = {
        r.rule: (r.action, r.rows, r.failed, r.pass_rate)
        for r in quality.expectation_report(df, "users", quality.USER_RULES).collect()
    }
    assert report == {
        "user_id_not_null": ("drop", 4, 2, 0.5),
        "valid_age": ("warn", 4, 2, 0.5),
    }


def test_warnings_keep_rows_and_are_observed(spark):
    seen = Observation("q")
    kept = quality.expect_warn(users(spark, (1, 200), (2, 50)), quality.USER_RULES, seen)
    assert kept.count() == 2
    assert seen.get == {"rows": 2, "user_id_not_null": 0, "valid_age": 1}


def test_rules_run_after_dedupe_unless_asked(spark):
    items = spark.createDataFrame(
        [(1, 0), (1, 30), (None, 5), (None, 6)], "content_id bigint, duration_min int"
    )
    assert medallion.silver_items(items).count() == 0
    rescued = medallion.silver_items(items, rules_first=True).collect()
    assert [tuple(r) for r in rescued] == [(1, 30)]


def test_null_keys_are_one_group(spark):
    df = users(spark, (None, 3), (None, 1), (5, 2))
    assert sorted(map(tuple, dedupe_by_key(df, "user_id").collect()), key=str) == [
        (5, 2),
        (None, 1),
    ]


def test_interactions_are_not_deduplicated(spark):
    rows = [("i1", 1, 2, 30), ("i1", 1, 2, 30), ("i2", None, 2, 30), ("i3", 1, 2, -1)]
    df = spark.createDataFrame(
        rows, "interaction_id string, user_id bigint, content_id bigint, watch_seconds bigint"
    )
    assert medallion.silver_interactions(df).count() == 3


def test_completed_threshold(spark):
    df = spark.createDataFrame([(458, 9), (459, 9), (50, 1), (51, 1)], "w bigint, d int")
    flags = df.select(completed_flag("w", "d"), completed_flag_truncated("w", "d")).collect()
    assert [tuple(r) for r in flags] == [
        (False, 458 >= int(0.85 * 9 * 60)), (True, True), (False, False), (True, True),
    ]


def test_capped_sample_is_the_same_every_time(spark):
    df = spark.range(5000).select("id", F.lit("x").alias("t"))
    first = {r.id for r in filters.capped_sample(df, ["id"], 300).collect()}
    again = {r.id for r in filters.capped_sample(df.repartition(9), ["id"], 300).collect()}
    assert first == again and len(first) == 300
    assert filters.capped_sample(df, ["id"], 5000).count() == 5000


def test_capped_sample_with_many_copies(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, -1).otherwise(F.col("id")).alias("id"))
    assert filters.capped_sample(df, ["id"], 1500).count() == 1500


def test_buckets_are_even_enough(spark):
    counts = spark.range(4000).groupBy(stable_bucket(["id"], 4)).count().collect()
    assert len(counts) == 4 and min(r["count"] for r in counts) > 850


def test_numeric_only_takes_booleans_on_request(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "a int, b string, c boolean, d double")
    assert filters.numeric_only(df, drop=["a"]).columns == ["d"]
    assert filters.numeric_only(df, booleans=True).first().c == 1


def test_cold_start(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 4, "user_id bigint")
    assert [tuple(r) for r in filters.cold_start_users(df).collect()] == [(2, 4)]
