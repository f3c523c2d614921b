from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from reelgrove.operators.upsert import (
    DuplicateKeyError,
    change_feed,
    scd2_apply,
    scd2_from_cdc,
    upsert_by_key,
)
from reelgrove.session import shared_dir
from reelgrove.sources import tables

SCHEMA = "k bigint, a string, b string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_updated_new_and_untouched(spark):
    target = spark.createDataFrame([(1, "x", "y"), (2, "p", None)], SCHEMA)
    source = spark.createDataFrame([(2, None, "q"), (3, "n", "n")], SCHEMA)
    assert rows(upsert_by_key(target, source, "k")) == [(1, "x", "y"), (2, None, "q"), (3, "n", "n")]


def test_null_keys_match_nothing(spark):
    target = spark.createDataFrame([(None, "x", "y")], SCHEMA)
    source = spark.createDataFrame([(None, "z", "z"), (None, "w", "w")], SCHEMA)
    assert upsert_by_key(target, source, "k").count() == 3


def test_repeated_source_keys_are_refused(spark):
    target = spark.createDataFrame([(1, "x", "y")], SCHEMA)
    source = spark.createDataFrame([(2, "a", "a"), (2, "b", "b")], SCHEMA)
    with pytest.raises(DuplicateKeyError, match="'k': 2"):
        upsert_by_key(target, source, "k")


def test_changes(spark):
    old = spark.createDataFrame(
        [(1, "x", None), (2, "same", None), (3, "gone", "g"), (4, None, "v")], SCHEMA
    )
    new = spark.createDataFrame(
        [(1, "x2", None), (2, "same", None), (4, "v", None), (5, "in", "i")], SCHEMA
    )
    assert rows(change_feed(old, new, "k")) == [
        ("delete", 3, "gone", "g"),
        ("insert", 5, "in", "i"),
        ("update", 1, "x2", None),
        ("update", 4, "v", None),
    ]


def test_a_keyed_table_replaces_rows(spark):
    table = tables.KeyedTable(spark, shared_dir(spark, "keyed"), "k")
    assert not table.exists()
    table.upsert(spark.createDataFrame([(1, "x", "y")], SCHEMA))
    table.upsert(spark.createDataFrame([(1, "z", "y"), (2, "n", "n")], SCHEMA))
    assert rows(table.read()) == [(1, "z", "y"), (2, "n", "n")]


def files_of(spark, table):
    found = spark.read.parquet(table.path).select("__bucket", F.input_file_name().alias("f")).distinct().collect()
    return {(r["__bucket"], r.f) for r in found}


def test_an_upsert_leaves_other_buckets_as_they_were(spark):
    table = tables.KeyedTable(spark, shared_dir(spark, "keyed"), "k", buckets=8)
    table.upsert(spark.range(200).selectExpr("int(id) AS k", "'x' AS a", "'y' AS b"))
    before = files_of(spark, table)
    table.upsert(spark.createDataFrame([(7, "z", "y"), (None, "n", "n")], SCHEMA))
    after = files_of(spark, table)
    assert len({b for b, _ in before}) == 8 and 1 <= len({b for b, _ in before - after}) <= 2
    assert table.read().count() == 201 and rows(table.read().where("k = 7")) == [(7, "z", "y")]


def test_a_merge_may_empty_a_bucket(spark):
    table = tables.KeyedTable(spark, shared_dir(spark, "keyed"), "k", buckets=4)
    table.upsert(spark.createDataFrame([(k, "x", "y") for k in range(20)], SCHEMA))
    gone = spark.createDataFrame([(k, "", "") for k in range(19)], SCHEMA)
    left = table.rewrite(gone, lambda held: held.join(gone, "k", "left_anti"))
    assert rows(left) == [(19, "x", "y")]
    assert rows(table.rewrite(table.read(), lambda held: held.limit(0))) == []
    table.upsert(spark.createDataFrame([(1, "a", "b")], SCHEMA))
    assert rows(table.read()) == [(1, "a", "b")]


def test_a_merge_that_fails_changes_nothing(spark):
    table = tables.KeyedTable(spark, shared_dir(spark, "keyed"), "k")
    table.upsert(spark.createDataFrame([(1, "x", "y")], SCHEMA))
    change = spark.createDataFrame([(1, "z", "y")], SCHEMA)
    with pytest.raises(Exception, match="half-way"):
        table.rewrite(change, lambda held: change.withColumn("a", F.raise_error(F.lit("half-way")).cast("string"))).count()
    assert rows(table.read()) == [(1, "x", "y")]


def test_a_later_column_is_null_in_other_buckets(spark):
    table = tables.KeyedTable(spark, shared_dir(spark, "keyed"), "k", buckets=8)
    table.upsert(spark.createDataFrame([(k, "x", "y") for k in range(30)], SCHEMA))
    table.upsert(spark.createDataFrame([(3, "x", "y", 5)], SCHEMA + ", more int"))
    assert [r.k for r in table.read().where("more IS NOT NULL").collect()] == [3]
    assert table.read().count() == 30


DAY = datetime(2024, 3, 1)


def change(k, hours, value, event):
    return (k, DAY + timedelta(hours=hours), value, event)


CDC = "k bigint, ts timestamp, value string, event bigint"


def test_history_with_ties(spark):
    changes = spark.createDataFrame(
        [change(1, 0, "a", 1), change(1, 50, "b", 2), change(1, 50, "c", 3), change(2, 5, "z", 4)],
        CDC,
    )
    got = scd2_from_cdc(changes, "k", "ts", "event").orderBy("k", "valid_from").collect()
    assert [(r.k, r.value, r.valid_to, r.is_current) for r in got] == [
        (1, "a", DAY + timedelta(hours=50), False),
        (1, "c", None, True),
        (2, "z", None, True),
    ]


def test_late_changes_fall_into_place(spark):
    early = [change(1, 0, "a", 1), change(1, 60, "c", 3)]
    late = [change(1, 30, "b", 2), change(2, 1, "x", 4)]
    whole = scd2_from_cdc(spark.createDataFrame(early + late, CDC), "k", "ts", "event")
    first = scd2_from_cdc(spark.createDataFrame(early, CDC), "k", "ts", "event")
    batch = spark.createDataFrame(late, CDC)
    assert rows(scd2_apply(first, batch, ["k"], "ts", "event")) == rows(whole)
    twice = scd2_apply(scd2_apply(first, batch, ["k"], "ts", "event"), batch, ["k"], "ts", "event")
    assert rows(twice) == rows(whole)


def test_clustered_files_do_not_overlap(spark):
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") % 200).alias("user_id"),
        (F.col("id") % 17).alias("content_id"),
        "id",
    )
    path = shared_dir(spark, "laid")
    tables.write_parquet(tables.clustered_layout(df, ["user_id", "content_id"], 8), path)
    files = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("f"))
        .agg(
            F.min(F.struct("user_id", "content_id")).alias("low"),
            F.max(F.struct("user_id", "content_id")).alias("high"),
            F.count("*").alias("n"),
        )
        .orderBy("low", "high")
        .collect()
    )
    assert all(tuple(a.high) <= tuple(b.low) for a, b in zip(files, files[1:]))
    # The user with a third of the rows is cut up rather than kept in one file.
    assert max(r.n for r in files) < 5_000


def test_listing_by_prefix(spark):
    for name in ("listed_b", "listed_a", "other_c"):
        spark.range(1).createOrReplaceTempView(name)
    try:
        listed = [r.table_name for r in tables.table_listing(spark, ["listed_"]).collect()]
        assert listed == ["listed_a", "listed_b"]
    finally:
        for name in ("listed_b", "listed_a", "other_c"):
            spark.catalog.dropTempView(name)


def test_create_table_as(spark):
    df = spark.range(3).selectExpr("id", "id * 2 AS twice")
    first = tables.create_table_as(df, "projected", ["twice"])
    assert first.columns == ["twice"] and first.count() == 3
    assert tables.create_table_as(df, "projected", ["id"]).columns == ["id"]
    spark.sql("DROP TABLE projected")
