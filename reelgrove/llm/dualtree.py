"""Vector codes by product quantisation, with Lloyd's rounds on two trees.

Vectors are cut into equal parts. Every part position has its own codebook. A block of
vectors has, for each position, a tree over its parts whose nodes hold their box and the
sum of their parts; the codebook has a tree of boxes over its entries. A round descends both
together. The bounds of a pair of boxes rule out entries for all parts of a node at once; a
node left with a single entry is given to it whole, by its stored sum; in leaves where
several entries are left the exact integer distances decide. Blocks and their trees are
written once and read by every round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from reelgrove.llm.common import kept
from reelgrove.operators.joins import lookup_join

BLOCK_ROWS = 8192
LEAF_ROWS = 8
# Parts within this bound are counted in 64 bits; larger ones in unbounded integers.
NARROW = 1 << 25
NARROW_LENGTH = 256
LARGEST = 1 << 48
LONG_MAX = (1 << 63) - 1


class Tree:
    """Equal halves by the widest dimension, down to ``leaf`` rows; boxes and sums per node.

    ``order`` puts the rows in tree order; ``edges[level]`` cuts them into that level's
    nodes. The children of node ``i`` are ``2 * i`` and ``2 * i + 1`` one level below.
    """

    def __init__(self, rows: np.ndarray, leaf: int, order: np.ndarray | None = None):
        size = len(rows)
        depth = max(0, int(np.ceil(np.log2(max(1, size) / leaf))))
        known = order is not None
        self.order = order if known else np.arange(size)
        self.edges: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.sums: list[np.ndarray] = []
        edges = np.array([0, size])
        for level in range(depth + 1):
            held = rows[self.order]
            starts = edges[:-1]
            low = np.minimum.reduceat(held, starts, axis=0)
            high = np.maximum.reduceat(held, starts, axis=0)
            self.edges.append(edges)
            self.low.append(low)
            self.high.append(high)
            self.sums.append(np.add.reduceat(held, starts, axis=0))
            if level == depth:
                break
            if not known and rows.shape[1]:
                node = np.repeat(np.arange(len(starts)), np.diff(edges))
                widest = (high - low).argmax(axis=1)
                value = held[np.arange(size), widest[node]]
                self.order = self.order[np.lexsort((value, node))]
            edges = np.sort(np.r_[edges, (edges[:-1] + edges[1:]) // 2])


class Entries:
    """A codebook's entries and the tree over them, its nodes numbered through all levels."""

    def __init__(self, entries: np.ndarray):
        self.rows = entries
        tree = Tree(entries, 1)
        starts, low, high, child, single = [], [], [], [], []
        base = 0
        for level, edges in enumerate(tree.edges):
            count = len(edges) - 1
            last = level == len(tree.edges) - 1
            for i in range(count):
                starts.append(edges[i])
                # A node of one entry is final; another one has its halves a level below.
                one = edges[i + 1] - edges[i] == 1
                single.append(tree.order[edges[i]] if one else -1)
                child.append(-1 if one or last else base + count + 2 * i)
            low.append(tree.low[level])
            high.append(tree.high[level])
            base += count
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.child, self.single = np.array(child), np.array(single)


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)


def _per_node(node: np.ndarray) -> np.ndarray:
    """Where each node's run of pairs begins; pairs are in the order of nodes."""
    return np.flatnonzero(np.r_[True, node[1:] != node[:-1]])


class Assigned:
    """What a descent found: whole nodes and single rows, each with its entry."""

    def __init__(self, size: int):
        self.codes = np.full(size, -1, dtype=np.int64)  # by place in tree order
        # Stored sums, sizes, entries and places of the nodes given away whole.
        self.whole: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.pairs_compared = 0
        self.rows_compared = 0


def assign(tree: Tree, rows: np.ndarray, book: Entries) -> Assigned:
    """The nearest entry of every row of ``rows`` (in tree order), ties to the lower index."""
    found = Assigned(len(rows))
    node = np.zeros(1, dtype=np.int64)
    entry = np.zeros(1, dtype=np.int64)
    for level in range(len(tree.edges)):
        edges = tree.edges[level]
        low, high = tree.low[level], tree.high[level]
        while True:
            found.pairs_compared += len(node)
            # The least and the greatest distance between the boxes of each pair.
            e_low, e_high, n_low, n_high = book.low[entry], book.high[entry], low[node], high[node]
            gap = np.maximum(np.maximum(e_low - n_high, n_low - e_high), 0)
            far = np.maximum(e_high - n_low, n_high - e_low)
            nearest, farthest = _squares(gap), _squares(far)
            starts = _per_node(node)
            run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(node)]))
            stay = nearest <= np.minimum.reduceat(farthest, starts)[run]
            node, entry, run = node[stay], entry[stay], run[stay]
            node, entry = _undominated(node, entry, low, high, book)
            open_pair = book.child[entry] >= 0
            if not open_pair.any():
                break
            # Halve the entry nodes that hold several entries, and look again.
            node = np.repeat(node, 1 + open_pair)
            first = np.where(open_pair, book.child[entry], entry)
            entry = np.repeat(first, 1 + open_pair)
            second = np.r_[False, (node[1:] == node[:-1]) & (entry[1:] == entry[:-1])]
            entry = entry + second
        starts = _per_node(node)
        counts = np.diff(np.r_[starts, len(node)])
        alone = counts == 1
        if alone.any():
            nodes, entries = node[starts[alone]], book.single[entry[starts[alone]]]
            sizes = edges[nodes + 1] - edges[nodes]
            places, owner = _places(edges, nodes, sizes)
            found.codes[places] = entries[owner]
            found.whole.append((tree.sums[level][nodes], sizes, entries, places))
        rest = np.repeat(~alone, counts)
        node, entry = node[rest], entry[rest]
        if not len(node):
            break
        if level + 1 < len(tree.edges):
            starts = _per_node(node)
            counts = np.diff(np.r_[starts, len(node)])
            node, entry = _to_children(node, entry, starts, counts)
        else:
            _compare_leaves(found, rows, edges, node, book.single[entry], book.rows)
    return found


def _undominated(node, entry, low, high, book):
    """Drop an entry that another one beats at every point of the node's box.

    The rival is the single entry nearest to the box's middle. The difference of the two
    distances is linear, so its greatest value lies in a corner of the box.
    """
    one = book.single[entry]
    if not (one >= 0).any():
        return node, entry
    starts = _per_node(node)
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(node)]))
    point = book.low[entry]
    away = _squares(2 * point - low[node] - high[node])
    away = np.where(one >= 0, away, np.iinfo(np.int64).max if away.dtype != object else LARGEST**3)
    least = np.minimum.reduceat(away, starts)
    nearest = np.flatnonzero(away == least[run])
    first = nearest[np.unique(run[nearest], return_index=True)[1]]  # one rival of each node
    rival, rival_one = point[first][run], one[first][run]
    step = point - rival
    corner = np.where(step > 0, high[node], low[node])
    # |x - rival|^2 - |x - point|^2 at its greatest.
    lead = (2 * corner * step).sum(axis=1) + _squares(rival) - _squares(point)
    beaten = (lead < 0) | ((lead == 0) & (rival_one < one))
    stay = ~((one >= 0) & (rival_one >= 0) & (one != rival_one) & beaten)
    return node[stay], entry[stay]


def _places(edges, nodes, sizes):
    """The places of all rows of the nodes, and the number of each one's node among them."""
    owner = np.repeat(np.arange(len(nodes)), sizes)
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(before, sizes) + np.repeat(edges[nodes], sizes), owner


def _to_children(node, entry, starts, counts):
    """Both halves of every node take over its entries."""
    pick = np.concatenate([np.r_[a : a + c, a : a + c] for a, c in zip(starts, counts)])
    half = np.concatenate([np.repeat([0, 1], c) for c in counts])
    return 2 * node[pick] + half, entry[pick]


def _compare_leaves(found, rows, edges, node, entry, entries):
    """Exact distances of the rows of uncertain leaves to the entries left for them."""
    sizes = edges[node + 1] - edges[node]
    places, pair = _places(edges, node, sizes)
    found.rows_compared += len(places)
    distance = _squares(rows[places] - entries[entry[pair]])
    order = np.lexsort((entry[pair], places))
    places, distance, chosen = places[order], distance[order], entry[pair][order]
    starts = _per_node(places)
    best = np.minimum.reduceat(distance, starts)
    run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(places)]))
    hits = np.flatnonzero(distance == best[run])
    first = hits[np.unique(run[hits], return_index=True)[1]]
    found.codes[places[first]] = chosen[first]


# ---- blocks ---------------------------------------------------------------------------

def _wide_enough(rows: np.ndarray) -> np.ndarray:
    largest = max(abs(int(rows.min())), abs(int(rows.max()))) if rows.size else 0
    return rows if largest < NARROW and rows.shape[1] <= NARROW_LENGTH else rows.astype(object)


def _vectors(lists: pa.Array) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(lists), len(flat) // len(lists))


def _blocks(parts: int, block_rows: int):
    """Blocks of rows, each with its vectors and the tree order of every part position."""

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        held = pa.Table.from_batches(batches).combine_chunks()
        vectors = _vectors(held["vector"].combine_chunks())
        cut = np.split(vectors, parts, axis=1)
        orders = [Tree(p, LEAF_ROWS).order.astype("<i4").tobytes() for p in cut]
        rows = held["row"].combine_chunks()
        whole = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
        return pa.RecordBatch.from_arrays(
            [
                whole,
                pa.array([vectors.astype("<i8").tobytes()], pa.binary()),
                pa.array([orders], pa.list_(pa.binary())),
            ],
            ["rows", "vectors", "orders"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while len(batch):
                part = batch.slice(0, block_rows - size)
                batch = batch.slice(len(part))
                held.append(part)
                size += len(part)
                if size == block_rows:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    return run


def _opened(batch: pa.RecordBatch, parts: int):
    """The rows of each block and, by position, its tree and its parts in tree order."""
    for i in range(len(batch)):
        rows = batch.column("rows")[i].values
        flat = np.frombuffer(batch.column("vectors")[i].as_py(), "<i8")
        vectors = flat.reshape(len(rows), len(flat) // len(rows))
        orders = batch.column("orders")[i].as_py()

        def positions():
            for part, order in zip(np.split(vectors, parts, axis=1), orders):
                part = _wide_enough(part)
                tree = Tree(part, LEAF_ROWS, np.frombuffer(order, "<i4"))
                yield tree, part[tree.order]

        yield rows, positions


def _round(books: list[np.ndarray], parts: int):
    """Count and sum of the parts of every entry, block by block."""
    trees = [Entries(_wide_enough(b)) for b in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, positions in _opened(batch, parts):
                out = []
                for place, (tree, rows) in enumerate(positions()):
                    sums, counts = _sums(assign(tree, rows, _same_kind(trees[place], rows)), rows, len(books[place]))
                    for e in np.flatnonzero(counts):
                        out.append((place, int(e), int(counts[e]), [int(x) for x in sums[e]]))
                place, entry, count, total = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place, pa.int32()),
                        pa.array(entry, pa.int32()),
                        pa.array(count, pa.int64()),
                        pa.array(total, pa.list_(pa.int64())),
                    ],
                    ["place", "entry", "n", "total"],
                )

    return run


def _same_kind(book: Entries, rows: np.ndarray) -> Entries:
    """Unbounded integers on both sides if either side needs them."""
    if rows.dtype == object and book.rows.dtype != object:
        return Entries(book.rows.astype(object))
    return book


def _sums(found: Assigned, rows: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of the entries: stored ones of whole nodes, and those of single rows."""
    sums = np.zeros((entries, rows.shape[1]), dtype=rows.dtype)
    counts = np.zeros(entries, dtype=np.int64)
    loose = np.ones(len(rows), dtype=bool)
    for node_sums, sizes, chosen, places in found.whole:
        np.add.at(sums, chosen, node_sums)
        np.add.at(counts, chosen, sizes)
        loose[places] = False
    np.add.at(sums, found.codes[loose], rows[loose])
    np.add.at(counts, found.codes[loose], 1)
    return sums, counts


def _encode(books: list[np.ndarray], parts: int, fields: list[str]):
    trees = [Entries(_wide_enough(b)) for b in books]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, positions in _opened(batch, parts):
                codes = np.zeros((len(held), parts), dtype=np.uint8)
                error = np.zeros(len(held), dtype=object)
                for place, (tree, rows) in enumerate(positions()):
                    book = _same_kind(trees[place], rows)
                    chosen = assign(tree, rows, book).codes
                    codes[tree.order, place] = chosen
                    error[tree.order] += _squares(rows - book.rows[chosen]).astype(object)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(held.field(f) for f in fields),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array([min(int(e), LONG_MAX) for e in error], pa.int64()),
                    ],
                    [*fields, "code", "error"],
                )

    return run


# ---- the operator ---------------------------------------------------------------------

def whole_numbers(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """``vector`` of ``floor(scale * x)`` and ``row`` with the other columns.

    Vectors that are NULL or hold a NULL or non-finite component take no part. Results
    beyond 2^48 count as that.
    """
    others = [F.col(f"`{c}`") for c in vectors.columns if c != vector_col]
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def number(x):
        return F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(x.cast("double") * scale)))

    return vectors.where(finite).select(
        F.struct(*others).alias("row"), F.transform(vector, number).alias("vector")
    )


def quantise(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``code`` (one byte per part) and ``error`` of every vector, and the codebooks.

    A codebook starts as its part of the ``entries`` vectors with the smallest ids (NULL
    last, then by vector). Each round gives every part to its nearest entry (squared distance,
    ties to the lower index) and moves the entry to its parts' floored mean; entries without
    parts stay. Then parts are assigned once more. The codebooks hold at most ``entries`` whole
    numbers per component and are all that the driver sees; each round sends it their sums.

    The other columns stay, ``code`` and ``error`` replace columns of these names. Repeated
    rows count each. Vectors must divide into ``parts``; those of another length than the one
    with the smallest id take no part, and an empty vector has empty parts and error 0. An
    error beyond 64 bits is the largest such number. An empty table gives an empty result and
    no codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code byte tells at most 256 entries apart")
    own = [c for c in vectors.columns if c not in ("code", "error") or c in (id_col, vector_col)]
    rows = whole_numbers(vectors.select([F.col(f"`{c}`") for c in own]), vector_col, scale)
    in_order = [F.col("row").getField(id_col).asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*in_order).select("vector").limit(1).collect()
    names = [f.name for f in rows.schema["row"].dataType.fields]
    result = T.StructType(
        [
            *rows.schema["row"].dataType.fields,
            T.StructField("code", T.BinaryType()),
            T.StructField("error", T.LongType()),
        ]
    )
    if not first:
        return rows.sparkSession.createDataFrame([], result), []
    length = len(first[0]["vector"])
    if length % parts:
        raise ValueError(f"vectors of {length} components do not divide into {parts} parts")
    rows = rows.where(F.size("vector") == length)
    seeds = rows.orderBy(*in_order).select("vector").limit(entries).collect()
    books = np.array([r["vector"] for r in seeds], dtype=np.int64).reshape(len(seeds), length)
    books = np.split(books, parts, axis=1)

    blocks = kept(
        rows.mapInArrow(
            _blocks(parts, block_rows),
            T.StructType(
                [
                    T.StructField("rows", T.ArrayType(rows.schema["row"].dataType)),
                    T.StructField("vectors", T.BinaryType()),
                    T.StructField("orders", T.ArrayType(T.BinaryType())),
                ]
            ),
        ),
        "vector_blocks",
    )
    for _ in range(rounds):
        books = _moved(blocks, books, parts)
    coded = blocks.mapInArrow(_encode(books, parts, names), result)
    return coded, books


def _moved(blocks: DataFrame, books: list[np.ndarray], parts: int) -> list[np.ndarray]:
    """The codebooks after a round: a floored mean of each entry's parts."""
    length = books[0].shape[1]
    sums = blocks.mapInArrow(_round(books, parts), "place int, entry int, n bigint, total array<bigint>")
    totals = (
        sums.groupBy("place", "entry")
        .agg(
            F.sum("n").alias("n"),
            *[F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(length)],
        )
        .collect()
    )
    moved = [b.copy() for b in books]
    for r in totals:
        for i in range(length):
            moved[r["place"]][r["entry"], i] = int(r[f"t{i}"]) // r["n"]
    return moved


def with_group_error(coded: DataFrame, group_col: str, output: str) -> DataFrame:
    """Add the sum of ``error`` over the rows of the same group, NULL being one group."""
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("null"))
    rows = coded.withColumn("__group", key)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX)).cast("bigint")
    return lookup_join(rows, rows.groupBy("__group").agg(total.alias(output)), "__group").drop("__group")


def codebook_text(books: list[np.ndarray]) -> str:
    """All components by part, entry and place, as decimal numbers with commas between."""
    return ",".join(str(int(x)) for book in books for entry in book for x in entry)
