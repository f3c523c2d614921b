"""Exact top-k inner products by best-first search of paged M-trees.

Vectors get one more component so that all have one length; then the greatest inner
product with a query is the least Euclidean distance to it. Vectors are dealt to cells
around a bounded number of sampled pivots and large cells are split; every part becomes an
M-tree whose nodes are rows of a written table: a page of entries with the entry's own
object, covering radius, distance to the parent's object and child page.

A search keeps pages in a queue by their least possible distance. The distance to the
parent's object, known from the page above, and the stored parent distance bound an entry's
distance by the triangle inequality; only entries this bound leaves are computed. Every
query is searched first in the part nearest to it; the k-th score found there bounds the
parts that it visits in the second round.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from reelgrove.llm.common import kept

PAGE = 256
PART_ROWS = 8192
MAX_CELLS = 1024
QUERY_BLOCK = 2048
SLACK = 1e-6
UNNAMED = (1 << 63) - 1  # stands for a NULL id, so that it comes last

PAGES = (
    "cell int, sub int, page int, is_leaf boolean, rows array<bigint>, ids array<bigint>, "
    "vectors binary, radii array<double>, to_parent array<double>, children array<int>"
)


def _matrix(column, dimensions: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, dimensions))
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dimensions)


def lifted(vectors: np.ndarray, reach: float) -> np.ndarray:
    """The vectors with a last component that makes every squared length ``reach``."""
    rest = np.maximum(reach - (vectors * vectors).sum(axis=1), 0)
    return np.c_[vectors, np.sqrt(rest)]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def build(points: np.ndarray, page_size: int = PAGE) -> list[dict]:
    """Pages of an M-tree over the rows of ``points``; page 0 is the root.

    A node's points are dealt to objects picked among them; each group becomes a child. A
    group that does not get smaller (equal points) is cut into equal parts.
    """
    pages: list[dict] = []

    def node(members: np.ndarray, center: int | None) -> tuple[int, float]:
        own = len(pages)
        pages.append({})
        to_center = (
            distances(points[members], points[[center]])[:, 0] if center is not None else np.zeros(len(members))
        )
        radius = float(to_center.max(initial=0.0))
        if len(members) <= page_size:
            pages[own] = {"leaf": True, "objects": members, "radii": np.zeros(len(members)),
                          "to_parent": to_center, "children": np.zeros(0, int)}
            return own, radius
        fanout = min(page_size, -(-len(members) // (page_size * 2 // 3)))
        pivots = members[np.linspace(0, len(members) - 1, fanout).astype(int)]
        nearest = distances(points[members], points[pivots]).argmin(axis=1)
        groups = [members[nearest == g] for g in range(fanout)]
        if max(map(len, groups)) > 0.9 * len(members):
            groups = np.array_split(members, fanout)
            pivots = np.array([g[0] for g in groups])
        objects, radii, children = [], [], []
        for pivot, group in zip(pivots, groups):
            if len(group):
                child, r = node(group, int(pivot))
                objects.append(int(pivot))
                radii.append(r)
                children.append(child)
        objects = np.array(objects)
        to_parent = (
            distances(points[objects], points[[center]])[:, 0] if center is not None else np.zeros(len(objects))
        )
        pages[own] = {"leaf": False, "objects": objects, "radii": np.array(radii),
                      "to_parent": to_parent, "children": np.array(children)}
        return own, radius

    if len(points):
        node(np.arange(len(points)), None)
    return pages


def _build_group(dimensions: int, reach: float):
    def run(key, table):
        vectors = _matrix(table.column("vector"), dimensions)
        rows = table.column("row").to_numpy()
        ids = table.column("vec_id").combine_chunks().fill_null(UNNAMED).to_numpy()
        pages = build(lifted(vectors, reach))
        return pa.table(
            {
                "cell": pa.array([key[0].as_py()] * len(pages), pa.int32()),
                "sub": pa.array([key[1].as_py()] * len(pages), pa.int32()),
                "page": pa.array(range(len(pages)), pa.int32()),
                "is_leaf": [p["leaf"] for p in pages],
                "rows": pa.array([rows[p["objects"]] for p in pages], pa.list_(pa.int64())),
                "ids": pa.array([ids[p["objects"]] for p in pages], pa.list_(pa.int64())),
                "vectors": pa.array([vectors[p["objects"]].tobytes() for p in pages], pa.binary()),
                "radii": pa.array([p["radii"] for p in pages], pa.list_(pa.float64())),
                "to_parent": pa.array([p["to_parent"] for p in pages], pa.list_(pa.float64())),
                "children": pa.array([p["children"].astype(np.int32) for p in pages], pa.list_(pa.int32())),
            }
        )

    return run


def search(pages: list[dict], query: np.ndarray, own_row: int, k: int, least: float, reach: float):
    """The best ``k`` of (score, id, row), scores at least ``least``; ties to smaller ids."""
    length = float(query @ query)

    def reach_of(score: float) -> float:
        return np.sqrt(max(length + reach - 2 * score, 0.0)) + SLACK * (1 + np.sqrt(length + reach))

    limit = reach_of(least) if np.isfinite(least) else np.inf
    scores, ids, rows = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
    queue = [(0.0, 0, None)] if pages else []
    while queue:
        nearest, number, to_object = heapq.heappop(queue)
        if nearest > limit:
            break
        page = pages[number]
        at = slice(None)
        if to_object is not None:  # bounds from stored distances, before any is computed
            open_entries = np.abs(to_object - page["to_parent"]) - page["radii"] <= limit
            left = np.count_nonzero(open_entries)
            if not left:
                continue
            if left < len(open_entries) // 2:  # picking more costs what it saves
                at = np.flatnonzero(open_entries)
        found = page["vectors"][at] @ query
        if page["is_leaf"]:
            keep = found >= least
            if not keep.any():
                continue
            keep &= page["rows"][at] != own_row
            scores = np.r_[scores, found[keep]]
            ids = np.r_[ids, page["ids"][at][keep]]
            rows = np.r_[rows, page["rows"][at][keep]]
            if len(scores) > k:
                best = np.lexsort((rows, ids, -scores))[:k]
                scores, ids, rows = scores[best], ids[best], rows[best]
            if len(scores) == k:
                least = max(least, float(scores.min()))
                limit = reach_of(least)
        else:
            far = np.sqrt(np.maximum(length + reach - 2 * found, 0))
            low = np.maximum(far - page["radii"][at], nearest)
            for i in np.flatnonzero(low <= limit):
                heapq.heappush(queue, (float(low[i]), int(page["children"][at][i]), float(far[i])))
    return scores, ids, rows


def _search_group(dimensions: int, reach: float, k: int):
    def run(tree, queries):
        tree = tree.sort_by("page")
        pages = [
            {
                "is_leaf": r["is_leaf"],
                "rows": np.array(r["rows"], np.int64),
                "ids": np.array(r["ids"], np.int64),
                "vectors": np.frombuffer(r["vectors"], np.float64).reshape(-1, dimensions),
                "radii": np.array(r["radii"]),
                "to_parent": np.array(r["to_parent"]),
                "children": np.array(r["children"], np.int64),
            }
            for r in tree.to_pylist()
        ]
        out: list[tuple] = []
        vectors = _matrix(queries.column("vector"), dimensions)
        own, ids, least = (queries.column(c).to_pylist() for c in ("row", "vec_id", "least"))
        for i in range(len(own)):
            bound = -np.inf if least[i] is None else least[i]
            for s, v, r in zip(*search(pages, vectors[i], own[i], k, bound, reach)):
                out.append((own[i], ids[i], int(v), int(r), int(s)))
        columns = list(zip(*out)) or [[]] * 5
        names = ["query_row", "query_id", "vec_id", "row", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return run


def top_k(
    items: DataFrame,
    is_query: Callable | str,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "vector",
) -> DataFrame:
    """The ``k`` rows with the greatest inner product for every query row of ``items``.

    ``vector_col`` is an array of whole numbers, ``is_query`` SQL over the id and other
    columns. A query's own row is no candidate. Ties go to the smaller id; a NULL id comes
    last. Vectors that are NULL or hold a NULL take no part; shorter ones are padded with
    zeros, an empty one scores 0. Repeated rows are rows like others. Returns ``query_id``,
    ``rank`` from 1, ``vec_id``, ``score``; an empty table gives an empty result. Scores are
    exact below 2^53; components beyond 2^31 over the root of their number count as that, so
    that no score leaves 64 bits.
    """
    spark = items.sparkSession
    vector = F.col(f"`{vector_col}`")
    bound = F.floor(F.lit(2.0**31) / F.sqrt(F.greatest(F.size(vector), F.lit(1))))

    def bounded(x):
        return F.greatest(-bound, F.least(bound, x.cast("double"))).cast("double")

    valid = items.where(vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull())).select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.coalesce(F.expr(is_query), F.lit(False)).alias("is_query"),
        F.transform(vector, bounded).alias("v"),
    )
    stored = kept(valid.withColumn("row", F.monotonically_increasing_id()), "vectors")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    facts = stored.agg(F.max(F.size("v")), F.max(length), F.count("*")).first()
    dimensions, reach, count = max(1, facts[0] or 0), float(facts[1] or 0), facts[2]

    # Pivots: a bounded sample in hash order, spread over the whole table.
    cells = max(1, min(MAX_CELLS, -(-count // PART_ROWS)))
    sample = (
        stored.where(F.pmod(F.xxhash64("row"), F.lit(max(1, count // (8 * cells)))) == 0)
        .select("v", "row").orderBy(F.xxhash64("row")).limit(cells).collect()
    )
    pivots = np.zeros((max(1, len(sample)), dimensions))
    for i, r in enumerate(sample):
        pivots[i, : len(r["v"])] = r["v"]
    lifted_pivots = lifted(pivots, reach)

    def place(batches):
        for batch in batches:
            rows = batch.column("v").to_pylist()
            for at in range(0, max(len(rows), 1), 4096):
                cut = batch.slice(at, 4096)
                own = np.zeros((len(cut), dimensions))
                for i, v in enumerate(rows[at : at + 4096]):
                    own[i, : len(v)] = v
                far = distances(lifted(own, reach), lifted_pivots)
                near = far.argmin(axis=1) if len(far) else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("vec_id"),
                        cut.column("row"),
                        cut.column("is_query"),
                        pa.array([v.tobytes() for v in own], pa.binary()),
                        pa.array(near.astype(np.int32)),
                        pa.array(far[np.arange(len(cut)), near]),
                    ],
                    ["vec_id", "row", "is_query", "vector", "cell", "far"],
                )

    placed = kept(
        stored.mapInArrow(
            place, "vec_id bigint, row bigint, is_query boolean, vector binary, cell int, far double"
        ),
        "placed",
    )
    shape = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
    subs = {r["cell"]: -(-r["n"] // (2 * PART_ROWS)) for r in shape}  # at most MAX_CELLS numbers
    radii = np.array([dict((r["cell"], r["radius"]) for r in shape).get(c, -1.0) for c in range(len(pivots))])
    sub_table = spark.createDataFrame(list(subs.items()), "cell int, subs int")
    parts = placed.join(F.broadcast(sub_table), "cell").withColumn(
        "sub", F.pmod(F.xxhash64("row"), F.col("subs")).cast("int")
    )
    tree = kept(
        parts.select("cell", "sub", "row", "vec_id", "vector")
        .groupBy("cell", "sub")
        .applyInArrow(_build_group(dimensions, reach), PAGES),
        "pages",
    )

    queries = placed.where("is_query").select("vec_id", "row", "vector")

    def route(home: bool):
        """Cells a query has to visit: the nearest pivot's, or all that its bound leaves."""

        def run(batches):
            for batch in batches:
                for at in range(0, len(batch), 2048):
                    cut = batch.slice(at, 2048)
                    own = _matrix(cut.column("vector"), dimensions)
                    square = (own * own).sum(axis=1)[:, None] + reach - 2 * (own @ pivots.T)
                    far = np.where(radii < 0, np.inf, np.sqrt(np.maximum(square, 0)))
                    if home:
                        q, c = np.arange(len(cut)), far.argmin(axis=1)
                        least = pa.nulls(len(cut), pa.float64())
                    else:
                        bound = cut.column("least").to_numpy(zero_copy_only=False).astype(float)
                        length = (own * own).sum(axis=1)
                        limit = np.sqrt(np.maximum(length + reach - 2 * np.where(np.isnan(bound), 0, bound), 0))
                        limit = np.where(np.isnan(bound), np.inf, limit + SLACK * (1 + np.sqrt(length + reach)))
                        q, c = np.nonzero((far - radii <= limit[:, None]) & (radii >= 0))
                        least = cut.column("least").take(pa.array(q))
                    picks = pa.array(q)
                    yield pa.RecordBatch.from_arrays(
                        [cut.column(n).take(picks) for n in ("vec_id", "row", "vector")]
                        + [least, pa.array(c.astype(np.int32))],
                        ["vec_id", "row", "vector", "least", "cell"],
                    )

        return run

    def searched(routed: DataFrame, all_subs: bool, purpose: str) -> DataFrame:
        routed = kept(routed, purpose)
        blocks = routed.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
        block = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
        asked = routed.join(blocks, "cell").withColumn("block", block)
        pages = tree.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        if all_subs:
            asked = asked.join(F.broadcast(sub_table), "cell").withColumn(
                "sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1))
            )
        else:
            asked, pages = asked.withColumn("sub", F.lit(0)), pages.where("sub = 0")
        keys = ["cell", "sub", "block"]
        pages = pages.select(*[F.col(c).alias(f"p_{c}") for c in keys], *[c for c in tree.columns if c not in keys])
        asked = asked.select(*keys, "row", "vec_id", "vector", "least")
        return (
            pages.groupBy(*[f"p_{c}" for c in keys])
            .cogroup(asked.groupBy(*keys))
            .applyInArrow(
                _search_group(dimensions, reach, k),
                "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint",
            )
        )

    fields = "vec_id bigint, row bigint, vector binary, least double, cell int"
    first = searched(queries.mapInArrow(route(True), fields), False, "homes")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    bounds = (
        first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k)
        .select(F.col("query_row").alias("row"), F.col("score").cast("double").alias("least"))
    )
    second = searched(
        queries.join(bounds, "row", "left").select("vec_id", "row", "vector", "least").mapInArrow(route(False), fields),
        True,
        "routes",
    )
    best = second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    unnamed = F.col("vec_id") == F.lit(UNNAMED)
    return best.select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.when(~unnamed, F.col("vec_id")).alias("vec_id"), "score"
    )
