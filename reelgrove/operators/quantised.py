"""Approximate nearest neighbours from short codes, exact scores for a short list.

Items are assigned to cells around coarse centres. What is left of each vector (its residual)
is cut into parts, and every part is stored as the number of its nearest codebook entry: a
few bytes in place of the vector. A search looks scores up in a small table per query, keeps
the most promising items as a short list and computes true scores for those alone.

Centres and codebooks are learnt on a bounded sample; every item is indexed. How many
cells and how long a list a query needs is measured against the exact search, so the recall
asked for is a result and not a hope.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from reelgrove.operators.similarity import (
    MIN_RECALL,
    RECALL_SAMPLE,
    SCORE_DIGITS,
    _exact_best,
    _first_copies,
    _kind,
    _matrix,
    _raw,
    _rows,
    _unit,
    cell_blocks,
    knn_exact,
)
from reelgrove.session import stored
from reelgrove.streaming.schemas import load_text, save_text

SAMPLE_ROWS = 16_384
LEARNING_ROUNDS = 12
# Items, or queries, that meet in a task, and pairs whose guesses it holds at once.
_BLOCK_ROWS = 1 << 17
_GUESSED_PAIRS = 1 << 22


@dataclass
class Codebooks:
    """Coarse centres, and for each part of the residual its entries."""

    centres: np.ndarray  # cells x components
    entries: np.ndarray  # parts x entries x components of a part

    @property
    def parts(self) -> int:
        return len(self.entries)

    def pieces(self, m: np.ndarray) -> np.ndarray:
        """Vectors as rows x parts x components of a part; the last part is filled with 0."""
        width = self.entries.shape[2]
        padded = np.zeros((len(m), self.parts * width))
        padded[:, : m.shape[1]] = m
        return padded.reshape(len(m), self.parts, width)

    def encode(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and code of each vector."""
        cell = _nearest(m, self.centres)
        pieces = self.pieces(m - self.centres[cell])
        codes = np.empty((len(m), self.parts), dtype=np.uint8)
        for p in range(self.parts):
            codes[:, p] = _nearest(pieces[:, p], self.entries[p])
        return cell, codes

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Inner products of each query's parts with all entries: queries x parts x entries."""
        return np.einsum("qpw,pew->qpe", self.pieces(queries), self.entries)

    def looked_up(self, tables: np.ndarray, coarse: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Approximate scores of queries and items: the cell's score and a number per part."""
        scores = np.repeat(coarse[:, None], len(codes), axis=1)
        for p in range(self.parts):
            scores += tables[:, p][:, codes[:, p]]
        return scores

    def to_json(self) -> str:
        return json.dumps({"centres": self.centres.tolist(), "entries": self.entries.tolist()})

    @classmethod
    def from_json(cls, text: str) -> Codebooks:
        held = json.loads(text)
        return cls(np.array(held["centres"]), np.array(held["entries"]))


def _nearest(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2.0 * (m @ centres.T)).argmin(axis=1)


def _centres(m: np.ndarray, count: int, rounds: int = LEARNING_ROUNDS) -> np.ndarray:
    """Lloyd's rounds from evenly spread rows of the sample; an unused centre stays."""
    count = min(count, len(m))
    centres = m[np.linspace(0, len(m) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(m, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, m)
        used = np.bincount(own, minlength=count)
        centres[used > 0] = sums[used > 0] / used[used > 0, None]
    return centres


def learn(
    items: DataFrame,
    item_id: str,
    item_vector: str = "embedding",
    cells: int = 16,
    parts: int | None = None,
    entries: int = 32,
    sample_rows: int = SAMPLE_ROWS,
) -> Codebooks | None:
    """Codebooks for unit vectors, from the ``sample_rows`` items with the least hashes.

    ``parts`` defaults to a quarter of the components. None for a table without vectors.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code byte tells at most 256 entries apart")
    picked = (
        _rows(items, item_id, item_vector)
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_rows)
        .select("vector")
        .collect()
    )
    if not picked:
        return None
    m = _unit(np.array([r["vector"] for r in picked], dtype=np.float64))
    parts = min(m.shape[1], parts or max(1, m.shape[1] // 4))
    centres = _centres(m, cells)
    books = Codebooks(centres, np.zeros((parts, 1, math.ceil(m.shape[1] / parts))))
    pieces = books.pieces(m - centres[_nearest(m, centres)])
    books.entries = np.stack([_centres(pieces[:, p], entries) for p in range(parts)])
    return books


@dataclass
class QuantisedIndex:
    """A table of (id, cell, code) for every item, and its codebooks."""

    codes: DataFrame
    books: Codebooks

    def counts(self) -> np.ndarray:
        held = np.zeros(len(self.books.centres), dtype=np.int64)
        for row in self.codes.groupBy("cell").count().collect():  # a number per cell
            held[row["cell"]] = row["count"]
        return held

    def blocks(self) -> int:
        """How many blocks a search cuts the items into; each gives a query a short list."""
        return max(1, math.ceil(self.codes.count() / _BLOCK_ROWS))


def encode(items: DataFrame, item_id: str, books: Codebooks, item_vector: str = "embedding") -> DataFrame:
    """``id``, ``cell`` and ``code`` of every item that has an id and a vector."""
    rows = _rows(items, item_id, item_vector)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                cell, codes = books.encode(_unit(_matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array(cell.astype(np.int32)),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                    ],
                    ["id", "cell", "code"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, cell int, code binary")


def build_index(items: DataFrame, item_id: str, item_vector: str = "embedding", **options) -> QuantisedIndex | None:
    """Learn codebooks and index every item; the codes are a written table."""
    books = learn(items, item_id, item_vector, **options)
    if books is None:
        return None
    return QuantisedIndex(stored(encode(items, item_id, books, item_vector), "vector_codes"), books)


def save_index(index: QuantisedIndex, path: str) -> None:
    index.codes.write.mode("overwrite").parquet(f"{path}/codes")
    save_text(index.codes.sparkSession, f"{path}/codebooks.json", index.books.to_json())


def load_index(spark: SparkSession, path: str) -> QuantisedIndex:
    books = Codebooks.from_json(load_text(spark, f"{path}/codebooks.json"))
    return QuantisedIndex(spark.read.parquet(f"{path}/codes"), books)


# ---- search -----------------------------------------------------------------------------

def _routed(books: Codebooks, counts: np.ndarray, n_probe: int):
    """Each query with the ``n_probe`` cells whose centres score best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            m = _unit(_matrix(batch.column("vector")))
            coarse = m @ books.centres.T
            order = np.argsort(-np.where(counts > 0, coarse, -np.inf), axis=1, kind="stable")[:, :n_probe]
            rows = np.repeat(np.arange(len(m)), order.shape[1])
            cells = order.reshape(-1)
            hold = counts[cells] > 0
            rows, cells = rows[hold], cells[hold]
            vectors = pa.ListArray.from_arrays(
                pa.array(np.arange(len(rows) + 1, dtype=np.int32) * m.shape[1]), pa.array(m[rows].reshape(-1))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(rows)), vectors, pa.array(cells.astype(np.int32))],
                ["id", "vector", "cell"],
            )

    return run


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, id and score of the ``k`` best of each row, ties by id."""
    by_id = np.argsort(ids, kind="stable")
    scores, ids = np.round(scores[:, by_id], SCORE_DIGITS), ids[by_id]
    k = min(k, scores.shape[1])
    bar = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
    rows, columns = np.nonzero(scores >= bar)
    values = scores[rows, columns]
    order = np.lexsort((columns, -values, rows))
    rows, columns, values = rows[order], columns[order], values[order]
    first = np.searchsorted(rows, np.arange(len(scores)))
    keep = np.arange(len(rows)) - first[rows] < k
    return rows[keep], ids[columns[keep]], values[keep]


def short_lists(
    queries: DataFrame,
    index: QuantisedIndex,
    length: int,
    query_id: str,
    query_vector: str = "embedding",
    n_probe: int | None = None,
    block_rows: int = 8192,
    query_rows: int = 512,
) -> DataFrame:
    """(query, item, approximate score, place) of the ``length`` best items by their codes.

    Codes and queries meet in cogroups of bounded blocks of a cell. A group returns at most
    ``length`` rows per query.
    """
    books, counts = index.books, index.counts()
    side = _rows(queries, query_id, query_vector)
    qtype, itype = side.schema["id"].dataType.simpleString(), index.codes.schema["id"].dataType.simpleString()
    routed = stored(
        side.mapInArrow(
            _routed(books, counts, n_probe or len(books.centres)), f"id {qtype}, vector array<double>, cell int"
        ),
        "routed_queries",
    )
    searched = np.zeros(len(counts), dtype=np.int64)
    for row in routed.groupBy("cell").count().collect():  # a number per cell
        searched[row["cell"]] = row["count"]
    coded, asked = cell_blocks(
        index.codes.withColumnRenamed("code", "vector"), routed, counts, searched, block_rows, query_rows
    )
    keys = ["cell", "block", "part"]

    def search(query_table: pa.Table, code_table: pa.Table) -> pa.Table:
        if query_table.num_rows and code_table.num_rows:
            m = _matrix(query_table["vector"])
            codes = np.frombuffer(b"".join(code_table["vector"].to_pylist()), np.uint8)
            codes = codes.reshape(code_table.num_rows, books.parts)
            coarse = m @ books.centres[query_table["cell"][0].as_py()]
            scores = books.looked_up(books.tables(m), coarse, codes)
            rows, ids, values = _best(scores, code_table["id"].to_numpy(), length)
        else:
            rows, ids, values = np.empty(0, int), code_table["id"].to_numpy()[:0], np.empty(0)
        return pa.table(
            {
                "query": query_table["id"].take(pa.array(rows)),
                "item": pa.array(ids, type=code_table.schema.field("id").type),
                "guess": pa.array(values, type=pa.float64()),
            }
        )

    found = asked.groupBy(*keys).cogroup(coded.groupBy(*keys)).applyInArrow(
        search, f"query {qtype}, item {itype}, guess double"
    )
    order = Window.partitionBy("query").orderBy(F.desc("guess"), "item")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= length)


def _guesses(books: Codebooks, queries: np.ndarray, cells: np.ndarray, probed: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Looked-up scores of queries x items in single width; -inf where no cell is searched.

    Two parts are looked up at once in a table of their entries' sums.
    """
    tables = books.tables(queries).astype(np.float32)
    coarse = (queries @ books.centres.T).astype(np.float32)
    parts, entries = books.parts, books.entries.shape[1]
    step = 2 if entries <= 64 else 1
    total = np.where(probed[:, cells], coarse[:, cells], np.float32(-np.inf)).T.copy()
    looked = np.empty_like(total)
    for p in range(0, parts, step):
        if step == 2 and p + 1 < parts:
            table = (tables[:, p][:, :, None] + tables[:, p + 1][:, None, :]).reshape(len(queries), -1)
            place = codes[:, p].astype(np.intp) * entries + codes[:, p + 1]
        else:
            table, place = tables[:, p], codes[:, p].astype(np.intp)
        np.take(np.ascontiguousarray(table.T), place, axis=0, out=looked, mode="clip")
        total += looked
    return np.ascontiguousarray(total.T)


def best_by_codes(
    books: Codebooks,
    queries: np.ndarray,
    probed: list,
    ids: np.ndarray,
    cells: np.ndarray,
    codes: np.ndarray,
    vectors: np.ndarray,
    length: int,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item id and true score of the ``k`` best of the ``length`` best guesses per query.

    Equal guesses at the end of a list are all scored.
    """
    by_id = np.argsort(ids, kind="stable")
    by_id = by_id[_first_copies(vectors, by_id, k)]
    ids, cells, codes, vectors = ids[by_id], cells[by_id], codes[by_id], vectors[by_id]
    chunk = max(1, _GUESSED_PAIRS // max(1, len(ids)))
    found = []
    for start in range(0, len(queries), chunk):
        m = _unit(queries[start : start + chunk].astype(np.float64))
        searched = np.zeros((len(m), len(books.centres)), dtype=bool)
        for row, own in enumerate(probed[start : start + chunk]):
            searched[row, own] = True
        rows, columns = [], []
        for row, guess in enumerate(_guesses(books, m, cells, searched, codes)):
            kept = np.flatnonzero(guess > -np.inf)
            if len(kept) > length:
                values = guess[kept]
                kept = kept[values >= np.partition(values, len(values) - length)[len(values) - length]]
            rows.append(np.full(len(kept), row))
            columns.append(kept)
        found.extend(_exact_best(m, vectors, np.arange(len(vectors)), rows, columns, start, k, True))
    rows, columns, values = (np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, int),) * 3
    return rows.astype(int), ids[columns.astype(int)], values


def _searched(
    queries: DataFrame,
    items: DataFrame,
    index: QuantisedIndex,
    effort: Effort,
    k: int,
    query_id: str,
    item_id: str,
    query_vector: str,
    item_vector: str,
) -> DataFrame:
    """(query, item, score) of the ``k`` best of every block of items that a query is held against.

    A block's codes and vectors meet a part of the queries once: lists are cut and scored
    where they arise, and ``k`` rows a query and block leave the task.
    """
    books, counts = index.books, index.counts()
    side, known = _rows(queries, query_id, query_vector), _rows(items, item_id, item_vector)
    qtype, itype = _kind(side, "id"), _kind(index.codes, "id")
    n_queries = side.count()
    tasks = 3 * side.sparkSession.sparkContext.defaultParallelism
    blocks = index.blocks()
    part_rows = min(_BLOCK_ROWS, max(1024, math.ceil(n_queries * blocks / tasks)))
    parts = max(1, math.ceil(n_queries / part_rows))

    def numbers(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def place(count: int):
        return F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")

    coded = index.codes.join(known, "id").select(
        "id", "cell", "code", "vector", place(blocks).alias("block"), numbers(parts).alias("part")
    )
    asked = side.select("id", "vector", place(parts).alias("part"), numbers(blocks).alias("block"))

    def search(query_table: pa.Table, item_table: pa.Table) -> pa.Table:
        ids = item_table["id"].to_numpy()
        if query_table.num_rows and item_table.num_rows:
            m = _raw(query_table["vector"])
            coarse = np.where(counts > 0, _unit(m.astype(np.float64)) @ books.centres.T, -np.inf)
            order = np.argsort(-coarse, axis=1, kind="stable")[:, : effort.n_probe]
            codes = np.frombuffer(b"".join(item_table["code"].to_pylist()), np.uint8)
            rows, ids, values = best_by_codes(
                books, m, list(order), ids, item_table["cell"].to_numpy(),
                codes.reshape(-1, books.parts), _raw(item_table["vector"]), effort.length, k,
            )
        else:
            rows, ids, values = np.empty(0, int), ids[:0], np.empty(0)
        return pa.table(
            {
                "query": query_table["id"].take(pa.array(rows)),
                "item": pa.array(ids, type=item_table.schema.field("id").type),
                "score": pa.array(values, type=pa.float64()),
            }
        )

    keys = ["block", "part"]
    return asked.groupBy(*keys).cogroup(coded.groupBy(*keys)).applyInArrow(
        search, f"query {qtype}, item {itype}, score double"
    )


@dataclass
class Effort:
    """What a search needs for its recall: cells per query and the short list's length."""

    n_probe: int
    length: int

    def products(self, books: Codebooks, n_queries: int, blocks: int = 1) -> int:
        """Whole-vector products of a search: centres and a table per query and block, its short list."""
        return n_queries * blocks * (len(books.centres) + books.entries.shape[1] + self.length)


def effort_for_recall(
    queries: DataFrame,
    items: DataFrame,
    index: QuantisedIndex,
    k: int,
    query_id: str,
    item_id: str,
    query_vector: str = "embedding",
    item_vector: str = "embedding",
    min_recall: float = MIN_RECALL,
) -> Effort:
    """The least cells, then the shortest list, with which ``min_recall`` is found.

    Measured on the ``RECALL_SAMPLE`` queries with the least hashes against the exact search
    over all items. The cells may miss half of what may be missed at all; the list is as long
    as the place of the last neighbour needed, which one pass over the codes counts. Three
    standard errors are added to the bar.
    """
    asked = stored(
        queries.where(F.col(query_id).isNotNull() & F.col(query_vector).isNotNull())
        .orderBy(F.xxhash64(query_id, F.lit(1)), query_id)
        .limit(RECALL_SAMPLE)
        .dropDuplicates([query_id]),
        "recall_sample",
    )
    item_out = item_id if item_id != query_id else "neighbour_id"
    exact = stored(
        knn_exact(
            asked, items, k, query_id=query_id, item_id=item_id, query_vector=query_vector, item_vector=item_vector
        ).select(F.col(query_id).alias("query"), F.col(item_out).alias("item")),
        "exact_neighbours",
    )
    books = index.books
    everything = len(books.centres)
    rows = asked.select(query_id, query_vector).collect()
    if not rows:
        return Effort(everything, k)
    vectors = _unit(np.array([r[1] for r in rows], dtype=np.float64))
    number = {r[0]: i for i, r in enumerate(rows)}
    held = np.where(index.counts() > 0, vectors @ books.centres.T, -np.inf)
    place = np.argsort(np.argsort(-held, axis=1, kind="stable"), axis=1)
    cells = exact.join(index.codes.select(F.col("id").alias("item"), "cell"), "item").select("query", "cell").collect()
    hits = np.zeros(place.shape)
    for query, cell in cells:
        hits[number[query], place[number[query], cell]] += 1
    n_probe = _enough(hits, (1 + min_recall) / 2) or everything

    # The guessed score of each true neighbour, and how many items are guessed no worse.
    coded = exact.join(index.codes.withColumnRenamed("id", "item"), "item").select("query", "cell", "code").collect()
    bars = np.full((len(rows), k), np.inf)
    filled = np.zeros(len(rows), dtype=int)
    probed = place < n_probe
    for query, cell, code in coded:
        i = number[query]
        if probed[i, cell]:
            one = np.frombuffer(code, np.uint8)[None, :]
            tables = books.tables(vectors[i : i + 1])
            bars[i, filled[i]] = books.looked_up(tables, vectors[i : i + 1] @ books.centres[cell], one)[0, 0]
        filled[i] += 1
    found = (
        index.codes.mapInArrow(_no_worse(books, vectors, probed, bars), "query int, bar int, n bigint")
        .groupBy("query", "bar")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    ahead = np.full((len(rows), k), np.inf)
    for r in found:
        if np.isfinite(bars[r["query"], r["bar"]]):
            ahead[r["query"], r["bar"]] = r["n"]
    return Effort(n_probe, max(k, _list_length(ahead, filled, min_recall) or int(index.counts().sum())))


def _no_worse(books: Codebooks, vectors: np.ndarray, probed: np.ndarray, bars: np.ndarray):
    """Items in each query's cells whose guessed score reaches each of its bars, per task."""
    tables, coarse = books.tables(vectors), vectors @ books.centres.T
    chunk = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(bars.shape, dtype=np.int64)
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(batch), books.parts)
            for cell in np.unique(cells):
                own, asked = codes[cells == cell], probed[:, cell]
                for start in range(0, len(own), chunk):
                    part = own[start : start + chunk]
                    scores = books.looked_up(tables[asked], coarse[asked, cell], part)
                    for j in range(bars.shape[1]):
                        counts[asked, j] += (scores >= bars[asked, j : j + 1]).sum(axis=1)
        query, bar = np.indices(bars.shape, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(query.ravel()), pa.array(bar.ravel()), pa.array(counts.ravel())], ["query", "bar", "n"]
        )

    return run


def _list_length(ahead: np.ndarray, own: np.ndarray, bar: float) -> int | None:
    """The shortest list that holds the share ``bar`` of the neighbours, over all queries."""
    lengths = np.unique(ahead[np.isfinite(ahead)])
    known = own > 0
    low, high = 0, len(lengths)
    while low < high:
        middle = (low + high) // 2
        share = (ahead[known] <= lengths[middle]).sum(axis=1) / own[known]
        if share.mean() - 3 * share.std() / math.sqrt(len(share)) >= bar:
            high = middle
        else:
            low = middle + 1
    return int(lengths[low]) if low < len(lengths) else None


def _enough(hits: np.ndarray, bar: float) -> int | None:
    """The least number of columns that hold the share ``bar`` of each row's hits."""
    own = hits.sum(axis=1, keepdims=True)
    known = own[:, 0] > 0
    if not known.any():
        return 1
    share = np.cumsum(hits, axis=1)[known] / own[known]
    lower = share.mean(axis=0) - 3 * share.std(axis=0) / math.sqrt(len(share))
    enough = np.flatnonzero(lower >= bar)
    return int(enough[0]) + 1 if len(enough) else None


def knn_quantised(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    *,
    query_id: str,
    item_id: str,
    query_vector: str = "embedding",
    item_vector: str = "embedding",
    index: QuantisedIndex | None = None,
    effort: Effort | None = None,
    min_recall: float = MIN_RECALL,
    **options,
) -> DataFrame:
    """The ``k`` items of about the highest cosine similarity, with true scores and ranks.

    Returns (query id, item id, score, rank) as ``knn_exact`` does; ``item_id`` is named
    ``neighbour_id`` where both sides use one name. ``index`` is built from ``options`` and
    ``effort`` measured if they are not given. Ids of queries and items must not repeat.
    """
    item_out = item_id if item_id != query_id else "neighbour_id"
    index = index or build_index(items, item_id, item_vector, **options)
    if index is None:
        return knn_exact(
            queries, items, k, query_id=query_id, item_id=item_id, query_vector=query_vector, item_vector=item_vector
        )
    columns = dict(query_id=query_id, query_vector=query_vector)
    effort = effort or effort_for_recall(
        queries, items, index, k, item_id=item_id, item_vector=item_vector, min_recall=min_recall, **columns
    )
    scored = _searched(queries, items, index, effort, k, item_id=item_id, item_vector=item_vector, **columns)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(F.col("query").alias(query_id), F.col("item").alias(item_out), "score", "rank")
    )
