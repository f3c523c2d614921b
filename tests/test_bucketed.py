import pytest
from pyspark.sql import functions as F

from reelgrove.sources import bucketed


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def facts(spark):
    """A third of the rows have one key, some have none, one row is repeated."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400)
    rows = spark.range(3000).select(key.cast("bigint").alias("k"), (F.col("id") % 10).alias("v"))
    return rows.unionByName(rows.limit(1))


def sums(df):
    return df.groupBy("k", "name").agg(F.sum("v").alias("v"), F.count("*").alias("n"))


def test_join_and_sums_by_key_need_no_exchange(spark, no_broadcast):
    names = spark.range(0, 300).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    left, right = bucketed.store(facts(spark), "k", 16), bucketed.store(names, "k", 16)
    assert len(left.hot_codes) == 1 and not right.hot_codes
    joined = bucketed.lookup(left, right)
    assert "Exchange" not in plan_text(sums(joined.ordinary))
    got = bucketed.per_key(joined, sums)
    want = sums(facts(spark).join(names, "k", "left"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    inner = bucketed.lookup(left, right, "inner").rows()
    assert inner.count() == facts(spark).join(names, "k").count()


def test_hot_key_is_stored_apart_with_rows_without_key(spark):
    left = bucketed.store(facts(spark), "k", 16)
    assert {r.k for r in left.hot.select("k").distinct().collect()} == {7, None}
    assert left.ordinary.where("k = 7 OR k IS NULL").count() == 0
    assert left.rows().exceptAll(facts(spark)).count() == 0 and left.rows().count() == 3001


def test_empty_tables_and_mismatches(spark):
    none = bucketed.store(facts(spark).where("false"), "k", 4)
    names = bucketed.store(spark.createDataFrame([(1, "a")], "k bigint, name string"), "k", 4)
    assert bucketed.lookup(none, names).rows().count() == 0
    assert bucketed.lookup(names, bucketed.store(facts(spark).where("false").withColumnRenamed("v", "w"), "k", 4)).rows().count() == 1
    with pytest.raises(ValueError):
        bucketed.lookup(none, bucketed.store(facts(spark), "k", 8))
    other = bucketed.store(spark.createDataFrame([(1, "a")], "k int, name string"), "k", 4)
    with pytest.raises(ValueError):
        bucketed.lookup(none, other)
