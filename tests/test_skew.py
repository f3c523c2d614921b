"""A key, a day or a set of copies with a third of the rows must not end up in one task."""

from oracle import plan_of
from pyspark.sql import functions as F

from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.ordered import next_in_group
from reelgrove.operators.quality import USER_RULES
from reelgrove.session import shared_dir
from reelgrove.streaming import ingest


def most_rows_per_task(df) -> float:
    """Share of the rows in the fullest partition of a DataFrame."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_copies_of_one_key_are_cut_before_the_shuffle(spark):
    df = spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x")
    )
    deduped = dedupe_by_key(df, "k", ["x"])
    assert deduped.where("k = -1").first().x == 0
    before, after = plan_of(deduped).split("Exchange", 1)[0], plan_of(deduped)
    assert "WindowGroupLimit" in before and "row_number(), 1, Partial" in after


def test_a_long_history_is_cut_into_time_slices(spark):
    df = spark.range(50_000).select(
        F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 600).alias("ts")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert most_rows_per_task(next_in_group(df, ["k"], "ts", "nxt")) < 0.5
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_streamed_copies_are_dropped_per_salt_first(spark):
    base = shared_dir(spark, "copies")
    rows = spark.range(0, 6_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("user_id"),
        F.lit(30).alias("age"),
    )
    rows.write.parquet(f"{base}/bronze")
    counts = {}
    for salts in (1, 8):
        counts[salts] = ingest.stream_silver(
            spark, f"{base}/bronze", f"{base}/silver{salts}", f"{base}/cp{salts}",
            USER_RULES, "user_id", salts=salts,
        )
        assert spark.read.parquet(f"{base}/silver{salts}").count() == 4_001
    assert counts[1] == counts[8]
