"""Mixture-controlled packing of token streams into sequences of one length.

Every source is a queue of token ids. Queues are served in rounds, a window each: a queue's
credit grows by its share of the window, whole tokens are taken, and the fraction left (the
deficit, below one token) is carried to the next window. Because credits only depend on
totals, what queue ``q`` has given before window ``w`` of ``n`` has the closed form
``floor(tokens * w / n)``: every task finds the windows of its documents by itself and the
carried deficits are the same wherever the work is cut. Windows follow each other without
gaps and are cut into sequences, so only the last sequence can have padding.

Token ids are made once and written. The plan needs only their counts; ids meet their
pieces in one join.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from fractions import Fraction

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from reelgrove.llm.common import kept, slices, text_values

MAX_QUEUES = 1024
WINDOW_SEQUENCES = 64
# Fixed value: how the byte-level tokenizer's file splits a text before merging.
BYTE_LEVEL_SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_loaded: dict[str, tiktoken.Encoding] = {}


def byte_encoder(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer file for the ``tiktoken`` library: the same ids, sooner."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in visible]
        octet = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {
            bytes(octet[c] for c in token): number
            for token, number in data["model"]["vocab"].items()
            if token not in special
        }
        _loaded[path] = tiktoken.Encoding(
            path,
            pat_str=BYTE_LEVEL_SPLIT,
            mergeable_ranks=ranks,
            special_tokens=special,
        )
    return _loaded[path]


def token_table(
    docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str, source_col: str
) -> DataFrame:
    """Written ids of every text with ``end_id`` behind them: one row per document.

    ``part`` and ``row`` number the rows: the task that made a row and its place there. Ids
    are little-endian unsigned numbers of 16 bits where the vocabulary allows it, else 32.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        width = "<u2" if encoder.max_token_value < 1 << 16 > end_id else "<u4"
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for cut in slices(batch, "text"):
                arrays = [
                    np.append(encoder.encode_to_numpy(t, allowed_special="all"), end_id)
                    for t in text_values(cut.column("text"))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(cut), part, np.int32)),
                        pa.array(np.arange(row, row + len(cut))),
                        cut.column("id"),
                        cut.column("queue"),
                        pa.array([len(a) for a in arrays], pa.int64()),
                        pa.array([a.astype(width).tobytes() for a in arrays], pa.binary()),
                    ],
                    ["part", "row", "id", "queue", "n", "ids"],
                )
                row += len(cut)

    plain = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("queue"),
        F.col(text_col).alias("text"),
    )
    kind = plain.schema["id"].dataType.simpleString()
    schema = f"part int, row bigint, id {kind}, queue string, n bigint, ids binary"
    return kept(plain.mapInArrow(run, schema), "tokens")


def stretches(totals: dict[int, int], weights: Mapping[int, float] | None, window: int) -> list[dict]:
    """Per stretch in which the same queues are served: each queue's tokens, and the windows.

    Without weights every queue is served in proportion to its tokens and all end together:
    one stretch. With weights a stretch ends when a queue is empty; the others share its
    place from then on in proportion to their weights. Queues of weight zero come last.
    """
    left = {q: n for q, n in totals.items() if n}
    given = dict.fromkeys(left, 0)
    out, first, start = [], 0, 0
    while left:
        share = {q: Fraction(weights[q]) if weights else Fraction(n) for q, n in left.items()}
        if any(share.values()):
            turns = min(n / share[q] for q, n in left.items() if share[q])
            take = {q: int(share[q] * turns) for q in left}
        else:
            take = left
        take = {q: n for q, n in take.items() if n}
        tokens = sum(take.values())
        count = -(-tokens // window)
        out.append({"first": first, "windows": count, "start": start, "take": take, "base": dict(given)})
        first, start = first + count, start + tokens
        given |= {q: given[q] + n for q, n in take.items()}
        left = {q: totals[q] - given[q] for q in left if totals[q] > given[q]}
    return out


def taken(tokens, windows, before):
    """Tokens a queue gave before a window: floor(tokens * before / windows), within 64 bits."""
    return tokens // windows * before + tokens % windows * before // windows


def window_starts(spark, plan: list[dict]) -> DataFrame:
    """Where in the packed stream each queue's part of each window begins."""
    total = sum(s["windows"] for s in plan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                ids = batch.column(0).to_numpy()[at : at + 1000]
                for s in plan:
                    own = ids[(ids >= s["first"]) & (ids < s["first"] + s["windows"])]
                    if not len(own):
                        continue
                    queues, tokens = (np.array(list(x), np.int64) for x in (s["take"], s["take"].values()))
                    place = (own - s["first"])[:, None]
                    before = taken(tokens, s["windows"], place)
                    size = taken(tokens, s["windows"], place + 1) - before
                    begin = s["start"] + before.sum(axis=1, keepdims=True) + size.cumsum(axis=1) - size
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.repeat(own, len(queues))),
                            pa.array(np.tile(queues, len(own)).astype(np.int32)),
                            pa.array(begin.ravel()),
                        ],
                        ["window", "queue_no", "begin"],
                    )

    return spark.range(total).mapInArrow(run, "window bigint, queue_no int, begin bigint")


def widened(pieces: DataFrame, width: int) -> DataFrame:
    """Ids of ``width`` bytes as numbers of 32 bits."""
    if width == 4:
        return pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, "ids"):
                ids = cut.column("ids")
                ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
                octets = np.frombuffer(ids.buffers()[2], np.uint8)[ends[0] : ends[-1]]
                wide = octets.view("<u2").astype("<u4")
                column = pa.Array.from_buffers(
                    pa.binary(),
                    len(ids),
                    [None, pa.py_buffer((ends - ends[0]) * np.int32(2)), pa.py_buffer(wide)],
                )
                yield cut.set_column(cut.schema.get_field_index("ids"), "ids", column)

    return pieces.mapInArrow(run, pieces.schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    sequence_length: int = 1024,
    end_id: int = 0,
    targets: Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pieces of all documents, laid out in sequences of ``sequence_length`` tokens.

    ``targets`` gives token shares of sources; sources it does not name are one queue that
    has the rest of the shares (or comes last). Without it each window has the shares of
    the whole table. The 1,023 largest sources have queues of their own, smaller ones share
    one, which has the shares of those among them that are named as well.

    One row per piece: the id column, ``start`` (the document's ids before it), ``length``,
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` (in the sequence),
    ``window`` and ``ids`` (little-endian 32-bit numbers). Every id of every document lies in
    one piece. NULL texts are empty and give the end id only; a NULL source is a queue of
    its own; NULL and repeated document ids are kept, each row is packed; other columns are
    dropped; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, tokenizer_path, end_id, id_col, text_col, source_col)
    counts = tokens.select("part", "row", "queue", "n")

    largest = counts.groupBy("queue").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "queue")
    if targets:  # at most as many as are named
        present = [r["queue"] for r in largest.where(F.col("queue").isin(list(targets))).collect()]
    else:
        present = [r["queue"] for r in largest.limit(MAX_QUEUES - 1).collect()]
    named = [(queue, i) for i, queue in enumerate(present[: MAX_QUEUES - 1])]
    rest = len(named)
    names = spark.createDataFrame(named, "queue_name string, queue_no int")
    counts = counts.join(
        F.broadcast(names), F.col("queue").eqNullSafe(F.col("queue_name")), "left"
    ).select("part", "row", "n", F.coalesce("queue_no", F.lit(rest)).alias("queue_no"))

    per_part = kept(counts.groupBy("queue_no", "part").agg(F.sum("n").alias("t")), "queue-parts")
    totals = {r["queue_no"]: r["t"] for r in per_part.groupBy("queue_no").agg(F.sum("t").alias("t")).collect()}
    weights = None
    if targets:
        weights = {i: targets[name] for name, i in named}
        weights[rest] = max(0.0, 1.0 - sum(targets.values())) + sum(targets[q] for q in present[rest:])
    plan = stretches(totals, weights, sequence_length * WINDOW_SEQUENCES)

    # Place of each document in its queue: parts follow each other, rows inside a part too.
    by_part = Window.partitionBy("queue_no").orderBy("part")
    in_part = Window.partitionBy("queue_no", "part").orderBy("row")
    before = per_part.select("queue_no", "part", (F.sum("t").over(by_part) - F.col("t")).alias("before"))
    placed = (
        counts.withColumn("to_row", F.sum("n").over(in_part.rowsBetween(Window.unboundedPreceding, 0)))
        .join(before, ["queue_no", "part"])
        .withColumn("b", F.col("before") + F.col("to_row"))
        .withColumn("a", F.col("b") - F.col("n"))
    )

    served = spark.createDataFrame(
        [(q, s["base"][q], n, s["windows"], s["first"]) for s in plan for q, n in s["take"].items()],
        "queue_no int, base bigint, tokens bigint, windows bigint, first bigint",
    )
    window_of = (
        "int((cast({x} + 1 as decimal(19, 0)) * cast(windows as decimal(12, 0)) + tokens - 1) div tokens) - 1"
    )
    taken_sql = "(tokens div windows) * ({w}) + (tokens % windows * ({w})) div windows"
    parts = (
        placed.join(F.broadcast(served), "queue_no")
        .where("a < base + tokens and b > base")
        .selectExpr("*", "greatest(a, base) - base as x0", "least(b, base + tokens) - base as x1")
        .selectExpr("*", f"explode(sequence({window_of.format(x='x0')}, {window_of.format(x='(x1 - 1)')})) as w")
        .selectExpr("*", f"{taken_sql.format(w='w')} as c0", f"{taken_sql.format(w='w + 1')} as c1")
        .selectExpr("*", "greatest(x0, c0) as p0", "least(x1, c1) as p1", "first + w as window")
        .where("p1 > p0")
        # Windows grow with the tokens, which the planner cannot see from their generator.
        .join(window_starts(spark, plan).hint("merge"), ["window", "queue_no"])
        .selectExpr("part", "row", "window", "p0 + base - a as start", "begin + p0 - c0 as g0", "p1 - p0 as size")
    )
    n = sequence_length
    pieces = (
        parts.selectExpr("*", f"explode(sequence(g0 div {n}, (g0 + size - 1) div {n})) as sequence_id")
        .selectExpr("*", f"greatest(g0, sequence_id * {n}) as q0", f"least(g0 + size, (sequence_id + 1) * {n}) as q1")
        .selectExpr(
            "part", "row",
            f"struct(start + q0 - g0 as start, q1 - q0 as length, sequence_id, q0 - sequence_id * {n} as offset, window) as piece",
        )
        .groupBy("part", "row")
        .agg(F.collect_list("piece").alias("pieces"))
    )
    width = 2 if byte_encoder(tokenizer_path).max_token_value < 1 << 16 > end_id else 4
    cut = (
        tokens.join(pieces.hint("merge"), ["part", "row"])
        .select("id", F.col("n").alias("doc_tokens"), "ids", F.explode("pieces").alias("piece"))
        .select("id", "piece.*", "doc_tokens", "ids")
        .withColumn("ids", F.expr(f"substring(ids, int(start * {width} + 1), int(length * {width}))"))
    )
    return widened(cut, width).withColumnRenamed("id", id_col)
