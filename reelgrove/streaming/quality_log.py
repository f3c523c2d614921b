"""Quality metrics of streams, stored by micro-batch as the stream reports them."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from reelgrove.operators.quality import Rule

_METRICS = "table_name string, rule string, action string, rows bigint, failed bigint"
# Seconds to wait for the events of a stream that has ended.
LAST_EVENTS = 600


class QualityLog(StreamingQueryListener):
    """Writes what ``expect_warn`` observes in a stream, one folder per micro-batch.

    A folder is named by the stream's lasting id and the batch's number, so a batch that
    is run again after a failure replaces its own metrics. A driver that is lost after a batch
    is committed and before its event arrives leaves that batch without metrics. Without
    a ``path`` nothing is written and only the sums of the run are kept, which are as many
    as there are rules.
    """

    def __init__(
        self, spark: SparkSession, path: str | None, observation: str, table: str, rules: Sequence[Rule]
    ):
        self.spark = spark
        self.path = path
        self.observation = observation
        self.table = table
        self.rules = list(rules)
        self.sums: dict[str, int] = {}
        self._error: Exception | None = None
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.observation)
        if seen is None:
            return
        counts = seen.asDict()
        try:
            self._write(f"{self.path}/query_id={progress.id}/batch_id={progress.batchId}", counts)
        except Exception as error:  # raised again by the job that waits for the stream
            self._error = self._error or error
        for name, n in counts.items():
            self.sums[name] = self.sums.get(name, 0) + n

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def _write(self, folder: str, counts: dict[str, int]) -> None:
        if self.path is None or not self.rules:
            return
        rows = [
            (self.table, r.name, "drop" if r.drop else "warn", counts["rows"], counts[r.name]) for r in self.rules
        ]
        metrics = self.spark.createDataFrame(rows, _METRICS)
        stamped = metrics.withColumn("recorded", F.current_timestamp())
        stamped.coalesce(1).write.mode("overwrite").parquet(folder)

    def finished(self) -> dict[str, int]:
        """Rows and failures of the run, once all events have come and are stored."""
        if not self._ended.wait(LAST_EVENTS):
            raise TimeoutError(f"the last events of {self.table} did not arrive")
        if self._error is not None:
            raise self._error
        return dict(self.sums)


def read_quality_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream, micro-batch and rule."""
    return spark.read.schema(f"{_METRICS}, recorded timestamp, query_id string, batch_id bigint").parquet(path)


def logged_report(log: DataFrame) -> DataFrame:
    """``expectation_report`` of all rows that streams have checked, from their metrics alone."""
    summed = log.groupBy("table_name", "rule", "action").agg(
        F.sum("rows").alias("rows"), F.sum("failed").alias("failed")
    )
    rate = F.when(F.col("rows") > 0, (F.col("rows") - F.col("failed")) / F.col("rows"))
    return summed.withColumn("pass_rate", rate)
