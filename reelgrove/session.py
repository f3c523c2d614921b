"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. Cluster sizing (executors, memory,
# spark.sql.shuffle.partitions) stays with whoever submits the job.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_fallback: str | None = None
# The open job scopes of the running thread or task.
_scopes: ContextVar[tuple[str, ...]] = ContextVar("scopes", default=())
_shipped_to: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "reelgrove",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = tune(builder.getOrCreate())
    ship_package(spark)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for written tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which a cluster points at storage
    every executor can reach. A local folder is only used by a local master with
    that setting absent, as in tests.
    """
    scopes = _scopes.get()
    return os.path.join(scopes[-1] if scopes else _base(spark), f"{purpose}-{uuid.uuid4().hex[:12]}")


def lasting_dir(spark: SparkSession, name: str) -> str:
    """A folder of this name in the shared folder, which outlives the job and its scope."""
    return os.path.join(_base(spark), name)


def _base(spark: SparkSession) -> str:
    global _local_fallback
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="reelgrove-")
    return _local_fallback


@contextmanager
def job_scope(spark: SparkSession) -> Iterator[str]:
    """Delete at the end what is stored inside: intermediates, not the results.

    Everything ``shared_dir`` and ``stored`` hand out inside goes to one folder, so results
    have to be written elsewhere before the scope ends. A failed job is cleared as well.
    """
    folder = shared_dir(spark, "job")
    token = _scopes.set((*_scopes.get(), folder))
    try:
        yield folder
    finally:
        _scopes.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows from a table written to the shared folder.

    For results that several later steps read: they are computed once, a lost executor
    costs a re-read, and later plans know their real size.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, for functions that run in Python workers.

    Spark serves the archive to every executor, also to one that joins later. Done once
    per application; a job submitted with ``--py-files`` or an installed package gets the
    same code twice, which does no harm.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped_to:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "reelgrove.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped_to.add(app)
