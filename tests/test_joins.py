import pytest
from pyspark.sql import functions as F

from reelgrove.operators import joins
from reelgrove.operators.joins import fits_broadcast, frequent_codes, key_code, lookup_join


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def fact(spark):
    """3,000 rows; key 7 holds half, a tenth have no key."""
    key = (
        F.when(F.col("id") % 2 == 0, F.lit(7))
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.col("id") % 50)
    )
    return spark.range(3000).select(key.cast("bigint").alias("k"), (F.col("id") % 11).alias("x"))


@pytest.fixture
def lookup(spark):
    return spark.range(5, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(fact, lookup, no_broadcast, how):
    salted = lookup_join(fact, lookup, "k", how)
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted) == rows(fact.join(lookup, ["k"], how))


def test_hot_key_is_spread(fact, lookup, no_broadcast, spark):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        salted = fact.withColumn("s", joins.row_salt(fact, 8)).where("k = 7")
        assert salted.select("s").distinct().count() == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_identical_copies_get_different_salts(spark):
    copies = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("t"))
    assert copies.withColumn("s", joins.row_salt(copies, 4)).select("s").distinct().count() == 4


def test_no_salt_without_hot_keys(spark, lookup, no_broadcast):
    even = spark.range(4000).select((F.col("id") % 1000).alias("k"), "id")
    joined = lookup_join(even, lookup, "k")
    assert "__salt" not in joined._jdf.queryExecution().optimizedPlan().toString()


def test_keys_of_two_columns_and_different_widths(spark, no_broadcast):
    fact = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).cast("int").alias("a"),
        F.when(F.col("id") % 3 == 0, "h").otherwise("n").alias("b"),
        "id",
    )
    lookup = spark.range(60).select("id", (F.col("id") % 2).alias("p")).select(
        (F.col("id") % 30).alias("a"),
        F.when(F.col("p") == 0, "h").otherwise("n").alias("b"),
        F.col("id").alias("v"),
    ).dropDuplicates(["a", "b"])
    salted = lookup_join(fact, lookup, ["a", "b"])
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    assert rows(salted) == rows(fact.join(lookup, ["a", "b"], "left"))


def test_only_confirmed_keys_are_hot(fact):
    types = [fact.schema["k"].dataType]
    found = frequent_codes(fact.select("k"), types, 0.25)
    expected = fact.sparkSession.range(1).select(F.lit(7).cast("bigint").alias("k"))
    assert found == [expected.select(key_code(["k"], types)).first()[0]]


def test_a_small_joined_lookup_is_measured_not_guessed(spark, small):
    customer = spark.read.parquet(f"{small}/customer.parquet")
    nation = spark.read.parquet(f"{small}/nation.parquet")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "200000")
    try:
        assert joins.planned_bytes(joined) > 200_000
        assert fits_broadcast(joined)
        assert not fits_broadcast(joined.withColumn("pad", F.repeat(F.lit("x"), 5000)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
