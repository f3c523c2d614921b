"""Streams into keyed tables, histories and logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from reelgrove.operators.dedupe import dedupe_by_key
from reelgrove.operators.governance import request_log_rows
from reelgrove.operators.upsert import scd2_apply, scd2_from_cdc
from reelgrove.sources.tables import KeyedTable
from reelgrove.streaming.ingest import drain


def _drain_batches(df: DataFrame, apply, checkpoint: str) -> None:
    query = (
        df.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_upsert(df: DataFrame, table: KeyedTable, order: Sequence, checkpoint: str) -> None:
    """Upsert each micro-batch; of several rows for a key the first in ``order`` counts.

    A batch that is run again after a failure gives the same table.
    """

    def apply(batch: DataFrame, _: int) -> None:
        table.upsert(dedupe_by_key(batch, table.keys, order), check=False)

    _drain_batches(df, apply, checkpoint)


def stream_least(
    df: DataFrame, table: KeyedTable, checkpoint: str, order: Sequence | None = None
) -> None:
    """Keep the first row of each key in ``order`` over all micro-batches, as a batch job does.

    Without ``order`` the least by all other columns counts (``dedupe_by_key``). Each batch's
    least rows meet those held for its keys, so the table ends up the same however rows are
    dealt to files and batches, where copies differ as well.
    """

    def apply(batch: DataFrame, _: int) -> None:
        least = dedupe_by_key(batch, table.keys, order)
        if not table.exists():
            table.replace(least)
            return
        table.rewrite(least, lambda held: dedupe_by_key(held.unionByName(least), table.keys, order))

    _drain_batches(df, apply, checkpoint)


def stream_scd2(
    df: DataFrame,
    table: KeyedTable,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: str | None,
    checkpoint: str,
) -> None:
    """Add each micro-batch of changes to a history table, in the buckets of its keys only."""
    table = KeyedTable(table.spark, table.path, table.keys, table.buckets, bucket_by=keys)

    def apply(batch: DataFrame, _: int) -> None:
        if table.exists():
            table.rewrite(
                batch, lambda history: scd2_apply(history, batch, keys, sequence_by, tie_break)
            )
        else:
            table.replace(scd2_from_cdc(batch, keys, sequence_by, tie_break))

    _drain_batches(df, apply, checkpoint)


def stream_request_log(
    scored: DataFrame, path: str, checkpoint: str, **columns
) -> None:
    """Append scored requests to the log as JSON, laid out by day, exactly once."""
    drain(request_log_rows(scored, **columns), path, checkpoint, partition_by=["day"])


def latest_first(ts: str, tie_break: str):
    return [F.desc(ts), F.desc(tie_break)]
