import datetime

import pytest
from pyspark.sql import functions as F

from reelgrove.session import shared_dir
from reelgrove.sources import curve, tables


def skewed(spark):
    """A third of the rows belongs to one user; items spread evenly and apart from users."""
    return spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, 77).otherwise(F.pmod(F.xxhash64("id"), F.lit(500))).alias("user_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)).alias("content_id"),
        "id",
    )


def files_with(spark, path, key, values):
    """Files whose range of ``key`` holds a value, summed over the values."""
    facts = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name())
        .agg(F.min(key).alias("low"), F.max(key).alias("high"))
        .collect()
    )
    return sum(r.low <= x <= r.high for r in facts for x in values)


def test_both_keys_skip_files(spark):
    df, keys = skewed(spark), ["user_id", "content_id"]
    paths = {}
    for name, layout in (("sorted", tables.clustered_layout), ("curve", curve.curve_layout)):
        paths[name] = shared_dir(spark, name)
        tables.write_parquet(layout(df, keys, 64), paths[name])
    values = range(0, 300, 10)
    second = {n: files_with(spark, p, "content_id", values) for n, p in paths.items()}
    first = files_with(spark, paths["curve"], "user_id", values)
    assert second["curve"] < second["sorted"] / 3
    assert first < 64 * len(values) / 3
    sizes = spark.read.parquet(paths["curve"]).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes < 4 * 40_000 / 64  # the frequent user is cut up


def test_same_rows_and_columns(spark):
    df = skewed(spark)
    laid = curve.curve_layout(df, ["content_id", "user_id"], 8)
    assert laid.columns == df.columns
    assert laid.exceptAll(df).count() == 0 and df.exceptAll(laid).count() == 0


def test_places_follow_interleaved_ranges(spark):
    df = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    found = df.select("a", "b", curve.curve_position(df, ["a", "b"], 3).alias("at")).collect()
    bounds = curve.range_bounds(df, ["a", "b"], 3)

    def place(r):
        ranks = [sum(x <= value for x in bounds[i]) for i, value in enumerate((r.a, r.b))]
        return sum((ranks[i] >> b & 1) << (2 * b + 1 - i) for i in (0, 1) for b in range(3))

    assert all(r["at"] == place(r) for r in found) and len({r["at"] for r in found}) > 32


def test_kinds_of_keys_nulls_and_empty_tables(spark):
    day = datetime.date(2024, 1, 1)
    rows = [
        (i if i % 5 else None, f"t{i % 7}" if i % 4 else None, day + datetime.timedelta(i), i / 3, i % 2 == 0)
        for i in range(50)
    ]
    df = spark.createDataFrame(rows, "`a.b` int, s string, d date, x double, flag boolean")
    keys = ["a.b", "s", "d", "x", "flag"]
    laid = curve.curve_layout(df, keys, 4)
    assert laid.exceptAll(df).count() == 0 and laid.count() == 50
    assert curve.curve_layout(df.limit(0), keys, 4).count() == 0
    nothing = df.select(F.lit(None).cast("int").alias("k"), "s")
    assert curve.curve_layout(nothing, ["k", "s"], 2).count() == 50
    with pytest.raises(TypeError):
        curve.curve_layout(df.select(F.array("x").alias("xs")), ["xs"])
    with pytest.raises(ValueError):
        curve.curve_layout(df, keys, 2, bits=16)
