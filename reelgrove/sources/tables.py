"""Parquet tables: reading, writing, layout, listing and whole-table replacement."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reelgrove.operators.upsert import upsert_by_key
from reelgrove.session import shared_dir
from reelgrove.streaming.schemas import grown, load_schema, save_schema


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def state_of(spark: SparkSession, folder: str, names: Sequence[str]) -> str:
    """A digest of the tables' files, their sizes and times: another one after any change."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    facts = []
    for name in sorted(names):
        path = hadoop.Path(f"{folder}/{name}.parquet")
        fs = path.getFileSystem(conf)
        status = fs.getFileStatus(path)
        for f in [status] if status.isFile() else fs.listStatus(path):
            facts.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(facts)).encode()).hexdigest()[:16]


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write a folder and return it as a table."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def create_table_as(
    df: DataFrame, table: str, columns: Sequence[str], path: str | None = None
) -> DataFrame:
    """Create or replace a catalog table from some columns of a table."""
    writer = df.select(*columns).write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def clustered_layout(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Order rows by key across and inside partitions, so file statistics prune well.

    A hash of the other columns ends the range key: the copies of one very frequent
    key can be cut into several ranges instead of filling a single one.
    """
    others = [c for c in df.columns if c not in keys] or list(keys)
    ranges = [*[F.col(k) for k in keys], F.xxhash64(*others)]
    laid = (
        df.repartitionByRange(partitions, *ranges) if partitions else df.repartitionByRange(*ranges)
    )
    return laid.sortWithinPartitions(*keys)


def table_listing(spark: SparkSession, prefixes: Sequence[str]) -> DataFrame:
    """Names of the catalog's tables and views that start with a prefix, in order."""
    names = [(t.name,) for t in spark.catalog.listTables()]
    listed = spark.createDataFrame(names, "table_name string")
    wanted = F.lit(False)
    for prefix in prefixes:
        wanted = wanted | F.col("table_name").startswith(prefix)
    return listed.where(wanted).orderBy("table_name")


_BUCKET = "__bucket"


class KeyedTable:
    """A parquet table partitioned by a hash of its keys; a write replaces what it touches.

    The merged rows are written to the shared folder first and from there over the partitions
    that the changes fall into, so a job that fails while it merges changes nothing, and one
    that fails while it overwrites is made good by running it again. One writer at a time, and
    no readers during a write, as with any overwritten folder.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: str | Sequence[str],
        buckets: int = 16,
        bucket_by: Sequence[str] | None = None,
    ):
        self.spark = spark
        self.path = path
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.buckets = buckets
        self.bucket_by = list(bucket_by or self.keys)
        self._schema_file = f"{path}.schema.json"
        self._staging = shared_dir(spark, "staged")  # asked for here, as streams write in other threads

    def exists(self) -> bool:
        return load_schema(self.spark, self._schema_file) is not None

    def read(self, only: Sequence[int] | None = None) -> DataFrame:
        """All rows; with ``only`` those of some partitions."""
        schema = load_schema(self.spark, self._schema_file)
        rows = self.spark.read.schema(
            T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
        ).parquet(self.path)
        if only is not None:
            rows = rows.where(F.col(_BUCKET).isin(list(only)))
        return rows.drop(_BUCKET)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        texts = [F.col(c).cast("string") for c in self.bucket_by]  # whatever width a number has
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*texts), F.lit(self.buckets)).cast("int"))

    def _overwrite(self, df: DataFrame, mode: str) -> DataFrame:
        """Write the rows over the partitions they are in, or over the whole folder."""
        place = f"{self._staging}/{uuid.uuid4().hex[:12]}"
        self._bucketed(df).write.parquet(place)
        staged = self.spark.read.parquet(place)
        # Merged rows have the old columns too, of the same or a wider type.
        save_schema(self.spark, self._schema_file, grown(None, df.schema))
        writer = staged.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET)
        writer.option("partitionOverwriteMode", mode).parquet(self.path)
        return staged

    def replace(self, df: DataFrame) -> DataFrame:
        self._overwrite(df, "static")
        return self.read()

    def rewrite(self, changes: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Put ``merge(rows)`` in place of the rows in the partitions that ``changes`` touch."""
        touched = {r[0] for r in self._bucketed(changes).select(_BUCKET).distinct().collect()}
        staged = self._overwrite(merge(self.read(only=sorted(touched))), "dynamic")
        # A partition that lost all of its rows is not in the write.
        left = {r[0] for r in staged.select(_BUCKET).distinct().collect()}
        for bucket in sorted(touched - left):
            empty = staged.drop(_BUCKET).limit(0)
            empty.write.mode("overwrite").parquet(f"{self.path}/{_BUCKET}={bucket}")
        return self.read()

    def upsert(self, source: DataFrame, check: bool = True) -> DataFrame:
        if not self.exists():
            return self.replace(upsert_by_key(source.limit(0), source, self.keys, check))
        return self.rewrite(source, lambda rows: upsert_by_key(rows, source, self.keys, check))
