"""Jaccard join on word n-grams: MinHash bands find candidates, full sets decide.

The rows of a band and the number of bands follow from the wanted recall. Texts that agree
in a whole band meet in its bucket; a bucket is a star around its least member, so its
links are as many as its members. The stars' components are the places where texts are
compared: each text's full n-gram set moves there once.

A component above ``BLOCK`` texts gets a centre, the n-grams that most of a few of its texts
have. Jaccard distance is a metric, so the full sets' distances to the centre decide most
pairs of a large group exactly: two texts within half the allowed distance are linked and
are counted, not compared; one within that half and one beyond three halves are not linked.
What stays open is cut into blocks and each open pair of blocks is a group of its own, so no
task holds more than two blocks. A group counts common n-grams of all its pairs by matrix
products over the n-grams that at least two of its texts share, and returns one row per text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reelgrove.llm.common import kept, mixed, shingles, slices
from reelgrove.llm.components import components
from reelgrove.operators.joins import lookup_join

BLOCK = 512
# Texts whose n-grams make a component's centre; any centre gives the same links.
CENTRE_TEXTS = 64
CORE, RING, FAR = range(3)
MAX_HASHES = 128
_COLUMNS = 4096


def bands_and_rows(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """The most rows per band (fewest false candidates) with the bands that reach the recall.

    A pair at the threshold agrees in one band with probability ``threshold ** rows``.
    """
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold**rows
        if p >= 1:
            return 1, max_hashes
        bands = math.ceil(math.log(1 - recall) / math.log1p(-p))
        if bands * rows > max_hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError("the recall needs more hashes than allowed")
    return best


def band_hashes(hashes: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per text and band from the least values of its n-grams; texts have n-grams."""
    out = np.zeros((len(starts) - 1, bands), np.uint64)
    seeds = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for b in range(bands):
        code = np.full(len(out), np.uint64(b + 1), np.uint64)
        for r in range(rows):
            k = 2 * (b * rows + r)
            least = np.minimum.reduceat((hashes ^ seeds[k]) * (seeds[k + 1] | np.uint64(1)), starts[:-1])
            code = mixed(code ^ least) + np.uint64(r)
        out[:, b] = mixed(code)
    return out


def _signatures(bands: int, rows: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, "text"):
                hashes, starts = shingles(cut.column("text"), n)
                sizes = np.diff(starts)
                some = np.flatnonzero(sizes)
                found = np.zeros((0, bands), np.uint64)
                if len(some):
                    found = band_hashes(hashes, np.r_[starts[some], starts[-1]], bands, rows)
                ends = np.r_[0, np.cumsum((sizes > 0) * bands)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        cut.column("id"),
                        cut.column("key"),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel().view(np.int64))),
                    ],
                    ["id", "key", "bands"],
                )

    return run


def _sets(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, "text"):
                hashes, starts = shingles(cut.column("text"), n)
                sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(starts, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [cut.column("node"), pa.array(sets, pa.binary())], ["node", "grams"]
                )

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(shared.sum()), _COLUMNS):
        a, b = np.searchsorted(column, [first, first + _COLUMNS])
        hit = np.zeros((len(sets), _COLUMNS), np.float32)
        hit[owner[a:b], column[a:b] - first] = 1
        counts += hit @ hit.T
    return counts


def _compare(threshold: float):
    def run(table):
        node = table.column("node").to_numpy()
        copies = table.column("copies").to_numpy()
        block = table.column("block").to_numpy()
        across = table.column("low")[0].as_py() != table.column("high")[0].as_py()
        sets = [np.frombuffer(g.as_py(), np.uint64) for g in table.column("grams")]
        size = np.array([len(s) for s in sets], np.float64)
        common = common_counts(sets).astype(np.float64)
        near = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-9
        np.fill_diagonal(near, False)
        if across:  # two blocks: pairs inside one belong to its own group
            near &= block[:, None] != block[None, :]
        root = np.arange(len(node))
        for i, j in zip(*np.nonzero(np.triu(near))):
            while root[i] != i:
                root[i] = i = root[root[i]]
            while root[j] != j:
                root[j] = j = root[root[j]]
            root[max(i, j)] = min(i, j)
        for i in range(len(root)):
            root[i] = root[root[i]]
        return pa.table({"node": node, "hub": node[root], "links": (near * copies[None, :]).sum(axis=1)})

    return run


def _centre(table):
    grams = [np.frombuffer(g.as_py(), np.uint64) for g in table.column("grams")]
    values, seen = np.unique(np.concatenate(grams), return_counts=True)
    return pa.table({
        "component": table.column("component")[:1],
        "centre": pa.array([values[2 * seen > len(grams)].tobytes()], pa.binary()),
    })


def _zoned(threshold: float):
    half = (1 - threshold) / 2

    def zone(grams: bytes, centre: bytes) -> int:
        a, b = np.frombuffer(grams, np.uint64), np.frombuffer(centre, np.uint64)
        common = len(np.intersect1d(a, b, assume_unique=True))
        away = 1 - common / (len(a) + len(b) - common)
        if away <= half - 1e-9:
            return CORE
        return RING if away <= 3 * half + 1e-9 else FAR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [zone(g.as_py(), c.as_py()) for g, c in zip(batch.column("grams"), batch.column("centre"))]
            columns = [batch.column(c) for c in ("node", "component", "copies", "grams")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(found, pa.int32())], ["node", "component", "copies", "grams", "zone"]
            )

    return run


def zones(sets: DataFrame, threshold: float) -> DataFrame:
    """The texts of components above ``BLOCK`` with their zone around the component's centre.

    ``sets`` holds ``node``, ``component``, ``copies``, ``large`` and ``grams`` (sorted n-gram
    hashes); the result the same without ``large`` and with ``zone``: ``CORE`` within half the
    allowed distance, ``RING`` within three halves, else ``FAR``.
    """
    large = sets.where("large")
    order = Window.partitionBy("component").orderBy(F.xxhash64("node"), "node")
    picked = (
        large.select("node", "component").withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= CENTRE_TEXTS).select("node")
    )
    centres = kept(
        large.select("node", "component", "grams").join(picked, "node").groupBy("component").applyInArrow(
            _centre, "component bigint, centre binary"
        ),
        "centres",
    )
    return lookup_join(large.drop("large"), centres, "component", "inner").select(
        "node", "component", "copies", "grams", "centre"
    ).mapInArrow(_zoned(threshold), "node bigint, component bigint, copies bigint, grams binary, zone int")


def open_groups(zoned: DataFrame) -> DataFrame:
    """Every text once for each pair of blocks (``low``, ``high``) that has open pairs with it.

    Texts of the core meet those of the ring alone; ring and far texts meet both kinds.
    """
    counts = zoned.groupBy("component").agg(
        *[F.ceil(F.count_if(F.col("zone") == z) / BLOCK).cast("bigint").alias(f"blocks{z}") for z in (CORE, RING, FAR)]
    )
    stride = 1 << 40

    def blocks(zone: int) -> Column:
        n = F.col(f"blocks{zone}")
        names = F.sequence(F.lit(zone * stride), F.lit(zone * stride) + n - 1)
        return F.when(n > 0, names).otherwise(F.array().cast("array<bigint>"))

    zone = F.col("zone")
    own = F.when(zone == CORE, F.col("blocks0")).when(zone == RING, F.col("blocks1")).otherwise(F.col("blocks2"))
    others = (
        F.when(zone == CORE, blocks(RING))
        .when(zone == RING, F.concat(blocks(CORE), blocks(RING), blocks(FAR)))
        .otherwise(F.concat(blocks(RING), blocks(FAR)))
    )
    return (
        lookup_join(zoned, counts, "component", "inner")
        .withColumn("block", zone * F.lit(stride) + F.pmod(F.xxhash64("node"), own))
        .withColumn("other", F.explode(others))
        .select(
            "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "copies", "grams",
        )
    )


def core_links(zoned: DataFrame) -> DataFrame:
    """Links among the core texts of each component, all of which are linked."""
    core = zoned.where(F.col("zone") == CORE).select("component", "node", "copies")
    whole = core.groupBy("component").agg(F.min("node").alias("hub"), F.sum("copies").alias("all"))
    return lookup_join(core, whole, "component", "inner").select(
        "node", "hub", (F.col("all") - F.col("copies")).alias("links")
    )


def near_classes(
    docs: DataFrame,
    threshold: float = 0.8,
    recall: float = 0.9999,
    n: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Class and number of links of every document.

    Documents are linked where the Jaccard likeness of their sets of ``n`` lower-cased words
    is at least ``threshold``; classes are the connected groups of links. A text of fewer
    words has one n-gram of all of them. A text without words (NULL, empty) has no links.

    One row per row of ``docs``: the id column, ``class_id`` (least id of the class, NULL if
    it has none), ``n_links`` (other documents linked, copies included), ``copy_of`` (least id
    with the same text), ``text_md5`` and ``first_of_class`` (true for the rows that have
    the id and text which stand for the class; rows that repeat both are all marked, texts
    without words always). Other columns are dropped; an empty table gives an empty result.
    N-grams are compared by 64-bit hashes. A linked pair is found with probability
    ``recall`` or more.
    """
    bands, rows = bands_and_rows(threshold, recall)
    text = F.col(f"`{text_col}`")
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.md5(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    signed = kept(
        plain.mapInArrow(_signatures(bands, rows, n), f"id {kind}, key string, bands array<bigint>"), "signatures"
    )

    # Equal texts are one node with a number of copies.
    nodes = kept(
        signed.groupBy("key")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("copies"), F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    in_buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    hubs = in_buckets.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    stars = in_buckets.join(hubs, "bucket").select(F.col("node").alias("u"), F.col("hub").alias("v"))
    places = kept(components(stars), "places")

    sizes = places.groupBy("component").agg((F.count("*") > BLOCK).alias("large"))
    members = lookup_join(places, sizes, "component", "inner").join(nodes.select("node", "key", "copies"), "node")
    grams = (
        plain.select("key", "text")
        .join(members.select("key", "node"), "key")
        .select("node", "text")
        .mapInArrow(_sets(n), "node bigint, grams binary")
        .dropDuplicates(["node"])
    )
    sets = kept(members.join(grams, "node").select("node", "component", "copies", "large", "grams"), "sets")
    zoned = kept(zones(sets, threshold), "zones")
    small = sets.where("NOT large").select(
        "component", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("high"),
        F.lit(0).cast("bigint").alias("block"), "node", "copies", "grams",
    )
    compared = kept(
        small.unionByName(open_groups(zoned))
        .groupBy("component", "low", "high")
        .applyInArrow(_compare(threshold), "node bigint, hub bigint, links bigint")
        .unionByName(core_links(zoned)),
        "links",
    )
    classes = components(compared.select(F.col("node").alias("u"), F.col("hub").alias("v")))
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))

    # The class is named by the least id among its nodes.
    labelled = kept(
        nodes.select("node", "key", "first_id", "copies", (F.size("bands") > 0).alias("has_words"))
        .join(classes, "node", "left")
        .join(links, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "labelled",
    )
    chosen = labelled.groupBy("component").agg(
        F.min("first_id").alias("class_id"),
        F.min(F.struct(F.col("first_id").isNull(), "first_id", "key")).alias("first"),
    )
    per_text = labelled.join(chosen, "component").select(
        "key", "has_words", "first_id", "class_id", (F.col("first.key") == F.col("key")).alias("is_first"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
    )
    has_words = F.col("has_words")
    return signed.select("id", "key").join(per_text, "key").select(
        F.col("id").alias(id_col),
        F.when(has_words, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.when(has_words, F.col("links")).otherwise(0).cast("bigint").alias("n_links"),
        F.when(has_words, F.col("first_id")).otherwise(F.col("id")).alias("copy_of"),
        F.col("key").alias("text_md5"),
        (~has_words | (F.col("is_first") & F.col("id").eqNullSafe(F.col("first_id")))).alias("first_of_class"),
    )


def one_per_class(
    docs: DataFrame, threshold: float = 0.8, n: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near copies: of every class the row with the least id.

    Rows that repeat id and text of a kept row go as well. Texts without words are all
    kept. All columns are kept.
    """
    near = near_classes(docs, threshold, n=n, id_col=id_col, text_col=text_col)
    chosen = near.where("first_of_class").select(
        F.col("text_md5").alias("__key"), F.col(id_col).alias("__id")
    )
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.withColumns({
        "__text_key": F.md5(text),
        # Copies of one row are told apart only where all of them are kept.
        "__spare": F.when(text.rlike(r"\S"), F.lit(-1).cast("bigint")).otherwise(F.monotonically_increasing_id()),
    })
    return (
        keyed.join(
            chosen,
            (F.col("__text_key") == F.col("__key")) & F.col(f"`{id_col}`").eqNullSafe(F.col("__id")),
            "left_semi",
        )
        .dropDuplicates(["__text_key", id_col, "__spare"])
        .select([F.col(f"`{c}`") for c in docs.columns])
    )
