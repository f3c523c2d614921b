from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelgrove.functions import fixed_values as fixed
from reelgrove.functions.expressions import age_band, is_weekend, joined_titles, mask_email, mask_phone
from reelgrove.operators import governance as g, monitoring as m


def test_a_masked_view_follows_the_session_variable(spark):
    spark.createDataFrame([(1, "drama")], "user_id int, fav_genre string").createOrReplaceTempView("f")
    view = g.masked_view(spark, "f_masked", "f", ["fav_genre"])
    assert view.columns == ["user_id", "fav_genre"]
    assert spark.table("f_masked").first().fav_genre == fixed.REDACTED
    spark.sql(f"SET VAR reader_groups = array('{fixed.PII_READERS_GROUP}')")
    assert spark.table("f_masked").first().fav_genre == "drama"
    spark.sql("SET VAR reader_groups = array('others')")
    assert spark.table("f_masked").first().fav_genre == fixed.REDACTED


def test_contact_masks(spark):
    df = spark.createDataFrame([("user_1@x.org", "+66123456789"), (None, "12")], "e string, p string")
    got = df.select(mask_email("e"), mask_phone("p")).collect()
    assert [tuple(r) for r in got] == [("u***@x.org", "+*********89"), (None, "12")]


def test_tags_are_replaced_and_found(spark):
    objects = spark.createDataFrame([("t1", "email"), ("t2", "phone")], "object_name string, column_name string")
    tags = g.column_tags(objects).unionByName(g.table_tags(objects, {fixed.OWNER_TAG: "a"}))
    moved = g.table_tags(objects.where("object_name = 't2'"), {fixed.OWNER_TAG: "b"})
    tags = g.tag_table(tags, moved)
    assert [r.object_name for r in g.tagged_with(tags, fixed.OWNER_TAG, "b").collect()] == ["t2"]
    assert g.tagged_with(tags, fixed.PII_TAG).count() == 2


def test_assets_are_listed_in_order_and_replaced(spark):
    t = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [(2, "model", "m", "1", "u", "", t), (1, "table", "b", "2", "u", "", t), (1, "table", "a", "3", "u", "", t)],
        g.ASSET_SCHEMA,
    )
    again = spark.createDataFrame([(1, "table", "a", "9", "u", "new", t + timedelta(1))], g.ASSET_SCHEMA)
    listed = g.sorted_listing(g.asset_log(log, again)).collect()
    assert [(r.chapter, r.name, r.id) for r in listed] == [(1, "a", "9"), (1, "b", "2"), (2, "m", "1")]
    assert listed[0].created_at == t + timedelta(1)


def test_time_column_preference(spark):
    t = datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([(t, 1_704_103_200_123)], "__db_request_time timestamp, timestamp_ms bigint")
    assert g.timestamp_column_pick(df).first().ts == datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert g.timestamp_column_pick(df.drop("timestamp_ms")).first().ts == t
    with pytest.raises(ValueError):
        g.timestamp_column_pick(df.select(F.lit(1).alias("x")))


def test_rate_limit(spark):
    t = datetime(2024, 1, 1)
    calls = [(t + timedelta(seconds=i % 60),) for i in range(101)]
    calls += [(t + timedelta(minutes=1),)] * 100
    got = g.rate_limit_audit(spark.createDataFrame(calls, "ts timestamp"), "ts").collect()
    assert [(r.minute, r.calls) for r in got] == [(t, 101)]


def test_personal_data_in_text(spark):
    df = spark.createDataFrame([("a b@c.de x@y.org",), ("call +66 123 456 789",), ("nothing 12",), (None,)], "t string")
    got = [(r.emails, r.phones, r.blocked) for r in g.pii_scan(df, "t").collect()]
    assert got == [(2, 0, True), (0, 1, True), (0, 0, False), (None, None, None)]


def test_versions_are_stable_per_user(spark):
    log = spark.range(4000).select((F.col("id") % 400).alias("user_id"), F.lit(1.0).alias("score"))
    arms = g.champion_challenger(log, 25).groupBy("user_id").agg(F.count_distinct("version").alias("n"))
    assert arms.where("n > 1").count() == 0
    share = g.champion_challenger(log, 25).where("version = 'challenger'").count() / 4000
    assert 0.15 < share < 0.35
    assert g.champion_challenger(log, 0).where("version = 'challenger'").count() == 0


def test_small_expressions(spark):
    df = spark.createDataFrame([(17, date(2024, 1, 6)), (50, date(2024, 1, 8)), (None, None)], "a int, d date")
    got = df.select(age_band("a"), is_weekend("d")).collect()
    assert [tuple(r) for r in got] == [("under 18", True), ("50 and over", False), ("unknown", None)]
    lists = spark.createDataFrame([([],), (["a", "b", "c", "d"],)], "t array<string>")
    assert [r[0] for r in lists.select(joined_titles("t")).collect()] == ["unknown", "a, b, c"]


def numbers(spark, days):
    rows = [(datetime(2024, 1, 1 + d), float(x), c) for d, pairs in enumerate(days) for x, c in pairs]
    return spark.createDataFrame(rows, "ts timestamp, x double, c string")


def test_no_drift_against_itself(spark):
    day = [(i, "ab"[i % 2]) for i in range(40)]
    df = numbers(spark, [day, day])
    first = m.baseline_days(df, "ts", 1)
    for r in m.drift_numeric(df, "ts", "x", first).collect():
        assert (r.psi, r.ks) == (0.0, 0.0)
    for r in m.drift_categorical(df, "ts", "c", first).collect():
        assert (r.psi, r.js, r.chi_square) == (0.0, 0.0, 0.0)


def test_complete_shift(spark):
    df = numbers(spark, [[(i, "a") for i in range(20)], [(i + 100, "b") for i in range(20)]])
    first = m.baseline_days(df, "ts", 1)
    shifted = m.drift_numeric(df, "ts", "x", first, slices=3).where("day = '2024-01-02'").first()
    assert shifted.ks == 1.0 and shifted.psi > 1
    other = m.drift_categorical(df, "ts", "c", first).where("day = '2024-01-02'").first()
    assert abs(other.js - 0.693147) < 1e-6
    assert m.drift_categorical(df, "ts", "c").count() == 1


def test_profile_of_an_unknown_column(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), None, "z")], "ts timestamp, x double, c string")
    got = {r.column_name: r for r in m.profile_daily(df, "ts", ["x"], ["c"]).collect()}
    assert (got["x"].rows, got["x"].nulls, got["x"].distinct_values, got["x"].min_value) == (1, 1, 0, None)
    assert (got["c"].nulls, got["c"].distinct_values) == (0, 1)
