"""Incremental pickup of files, and silver tables from bronze ones."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from reelgrove.operators.joins import row_salt
from reelgrove.operators.quality import (
    INTERACTION_RULES,
    ITEM_RULES,
    USER_RULES,
    Rule,
    expect_or_drop,
    expect_warn,
)
from reelgrove.session import RUNTIME_SETTINGS, stored
from reelgrove.streaming.quality_log import QualityLog
from reelgrove.streaming.schemas import grown, load_schema, path_exists, save_schema


def drain(
    df: DataFrame, target: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append everything there is to read to a parquet folder, then stop."""
    query = (
        df.writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(target)
    )
    query.awaitTermination()
    return query


def landed_schema(spark: SparkSession, *paths: str) -> T.StructType:
    """All columns of the files in a folder, or of some files."""
    return spark.read.option("mergeSchema", True).parquet(*paths).schema


def new_files(spark: SparkSession, landing: str, known: str, pattern: str | None = None) -> DataFrame:
    """Names of landed files that the table at ``known`` does not list, whatever their time."""
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    listed = reader.load(landing).select("path")
    if path_exists(spark, known):
        listed = listed.join(spark.read.schema("path string").parquet(known), "path", "left_anti")
    return listed


# Files opened at once for their columns.
FILES_AT_ONCE = 10_000


def _grown_schema(spark: SparkSession, landing: str, checkpoint: str, pattern: str | None) -> T.StructType:
    """The stream's columns, with those of files that were never opened for them."""
    registry, known = f"{checkpoint}.schema.json", f"{checkpoint}.files"
    schema = load_schema(spark, registry)
    fresh = stored(new_files(spark, landing, known, pattern), "new_files")
    names = [r.path for r in fresh.collect()]
    for start in range(0, len(names), FILES_AT_ONCE):
        schema = grown(schema, landed_schema(spark, *names[start : start + FILES_AT_ONCE]))
    if schema is None:
        schema = grown(None, landed_schema(spark, landing))
    save_schema(spark, registry, schema)
    fresh.coalesce(1).write.mode("append").parquet(known)  # after the columns are safe
    return schema


def ingest_files(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    evolve: bool = True,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Add each new landed file to the bronze table exactly once.

    The column list is kept in a schema file beside the checkpoint, with the names of the
    files whose columns it has: only others are opened, also one that arrives with an older time
    (up to Spark's ``maxFileAge`` of seven days; the stream itself passes over older ones).
    With ``evolve`` a column that appears in later files is added; earlier rows hold NULL there.
    """
    schema = load_schema(spark, f"{checkpoint}.schema.json")
    if schema is None or evolve:
        schema = _grown_schema(spark, landing, checkpoint, pattern)
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return drain(reader.parquet(landing), target, checkpoint)


def read_evolved(spark: SparkSession, target: str) -> DataFrame:
    """A bronze table with every column any of its files has."""
    return spark.read.option("mergeSchema", True).parquet(target)


# Session settings for streams that remember very many keys.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

SILVER = {
    "users": ("user_id", USER_RULES),
    "items": ("content_id", ITEM_RULES),
    "interactions": (None, INTERACTION_RULES),
}


def own_settings(spark: SparkSession) -> dict[str, str]:
    """The settings a new session of the same application takes over."""
    names = [*RUNTIME_SETTINGS, "spark.sql.shuffle.partitions", *ROCKSDB_STATE]
    return {n: v for n in names if (v := spark.conf.get(n, None)) is not None}


def _first_per_key(
    rows: DataFrame, key: str, watermark: tuple[str, str] | None, salts: int
) -> DataFrame:
    if watermark:
        rows = rows.withWatermark(*watermark)

    def first(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.dropDuplicatesWithinWatermark(keys) if watermark else df.dropDuplicates(keys)

    if salts > 1:
        salted = rows.withColumn("__salt", row_salt(rows, salts))
        rows = first(salted, [key, "__salt"]).drop("__salt")
    return first(rows, [key])


def stream_silver(
    spark: SparkSession,
    bronze: str,
    target: str,
    checkpoint: str,
    rules: Sequence[Rule],
    key: str | None = None,
    watermark: tuple[str, str] | None = None,
    name: str = "quality",
    salts: int = 1,
    state_partitions: int | None = None,
    files_per_batch: int | None = None,
    schema: T.StructType | None = None,
    log: str | None = None,
) -> dict[str, int]:
    """Bronze to silver: first row per key, failure counts, dropping rules.

    Without a watermark every key ever seen is remembered, which suits dimension
    tables; ``ROCKSDB_STATE`` keeps many keys off the heap. With a watermark
    (column, delay) only keys inside the delay are. With ``salts`` copies are first dropped
    per key and salt, so that one key with very many copies is not read by a single task;
    that keeps more state. The first run fixes the number of state partitions:
    ``state_partitions``, or the session's shuffle partitions. ``files_per_batch`` bounds a
    micro-batch. ``schema`` spares a look at all bronze files for their columns. ``log`` is
    the folder for the failures of each micro-batch (``QualityLog``), under the table's
    ``name``. Returns the failures per rule over all micro-batches of the run.
    """
    # A session of its own: other streams keep their settings, and a listener hears of this one.
    own = spark.newSession()
    for setting, value in own_settings(spark).items():
        own.conf.set(setting, value)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    reader = own.readStream.schema(schema or landed_schema(spark, bronze))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(bronze)
    if key:
        rows = _first_per_key(rows, key, watermark, salts)
    checked = expect_or_drop(expect_warn(rows, rules, name), rules)
    metrics = QualityLog(own, log, name, name, rules)
    own.streams.addListener(metrics)
    try:
        drain(checked, target, checkpoint)
        return metrics.finished()
    finally:
        own.streams.removeListener(metrics)


def run_medallion(
    spark: SparkSession,
    landing: str,
    lake: str,
    checkpoints: str,
    state_partitions: int | None = None,
) -> dict:
    """Landed users, items and interactions to silver; one triggered run of all six streams.

    The three tables run side by side, each bronze stream before its silver one. Their
    quality metrics are in ``quality_log`` of the lake.
    """
    def run(table: str) -> dict[str, int]:
        key, rules = SILVER[table]
        bronze, checkpoint = f"{lake}/bronze_{table}", f"{checkpoints}/bronze_{table}"
        ingest_files(spark, f"{landing}/{table}", bronze, checkpoint)
        return stream_silver(
            spark,
            bronze,
            f"{lake}/silver_{table}",
            f"{checkpoints}/silver_{table}",
            rules,
            key,
            state_partitions=state_partitions,
            schema=load_schema(spark, f"{checkpoint}.schema.json"),
            name=table,
            log=f"{lake}/quality_log",
        )

    with ThreadPoolExecutor(len(SILVER)) as pool:
        return dict(zip(SILVER, pool.map(inheritable_thread_target(spark)(run), SILVER)))


# Sketch sizes: 2^12 registers and rows of 400 keep distinct counts within about 5 % and ranks
# within about 1 % of the rows, with high probability.
HLL_LOG_SIZE, DISTINCT_ERROR = 12, 0.05
KLL_SIZE, RANK_ERROR = 400, 0.01


def daily_sketch_stream(rows: DataFrame, ts: str, value: str, delay: str = "1 hour") -> DataFrame:
    """Distinct values and quartiles of a column per day, from mergeable sketches as state.

    A day's state has a fixed size, however many rows it has; late rows are dropped. Errors are
    ``DISTINCT_ERROR`` of the count and ``RANK_ERROR`` of the ranks.
    """
    x = F.col(value).cast("double")
    sketched = (
        rows.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"))
        .agg(
            F.count("*").alias("rows"),
            F.hll_sketch_agg(F.hash(x), F.lit(HLL_LOG_SIZE)).alias("distinct"),
            F.kll_sketch_agg_double(x, F.lit(KLL_SIZE)).alias("ranks"),
        )
    )
    quartiles = [
        F.kll_sketch_get_quantile_double("ranks", F.lit(p)).alias(f"p{round(100 * p)}") for p in (0.25, 0.5, 0.75)
    ]
    return sketched.select(
        F.to_date("w.start").alias("day"), "rows", F.hll_sketch_estimate("distinct").alias("distinct_values"), *quartiles
    )


def daily_profile_stream(
    rows: DataFrame, ts: str, value: str, delay: str = "1 hour"
) -> DataFrame:
    """Daily counts, range and moments of a column as a tumbling window; late rows are dropped."""
    x = F.col(value).cast("double")
    return (
        rows.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("w"))
        .agg(
            F.count("*").alias("rows"),
            F.count(F.when(x.isNull(), 1)).alias("nulls"),
            F.min(x).alias("min_value"),
            F.max(x).alias("max_value"),
            F.sum(x).alias("sum_value"),
            F.avg(x).alias("mean_value"),
            F.stddev_samp(x).alias("stddev_value"),
        )
        .select(
            F.to_date("w.start").alias("day"), "rows", "nulls", "min_value", "max_value",
            "sum_value", "mean_value", "stddev_value",
        )
    )
