"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reelgrove.session import shared_dir

SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """The rows from a compressed table written to the shared folder.

    Computed once; a lost executor costs a re-read and not the work again.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each cut holds about ``size`` bytes of ``column``.

    A single value is never cut, so a text larger than that comes alone.
    """
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths, dtype=np.int64) // size
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else []
    for start, end in zip(starts, [*starts[1:], len(group)]):
        yield batch.slice(int(start), int(end - start))


def appended(df: DataFrame, run: Callable, fields: Sequence[T.StructField]) -> DataFrame:
    """All columns of ``df`` and the new ones that ``run`` puts behind them, batch by batch."""
    names = {f.name for f in fields}
    rest = df.select([F.col(f"`{c}`") for c in df.columns if c not in names])
    return rest.mapInArrow(run, T.StructType([*rest.schema.fields, *fields]))


def text_values(array: pa.Array) -> list[str]:
    """The texts, NULL as empty."""
    return [t or "" for t in array.to_pylist()]


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """White-space words of all texts, dictionary coded, and where each text's words begin.

    The second result has one entry more than there are texts. NULL is empty.
    """
    trimmed = pc.utf8_trim_whitespace(pc.fill_null(texts, ""))
    lists = pc.utf8_split_whitespace(trimmed)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets -= offsets[0]
    empty = pc.equal(words, "")
    if pc.any(empty).as_py():  # an empty text splits into one empty word
        keep = pc.invert(empty)
        before = np.r_[0, np.cumsum(keep.to_numpy(zero_copy_only=False), dtype=np.int64)]
        words, offsets = words.filter(keep), before[offsets]
    coded = words.dictionary_encode()
    return coded, offsets


def code64(values: list[str], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each string."""
    code = xxhash.xxh64_intdigest
    return np.array([code(v, seed) for v in values], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, text after text, and where each text's begin.

    Words are split at white space and lower-cased. A text of fewer words than ``n`` has
    one shingle of all its words; one without words has none.
    """
    coded, offsets = words_of(pc.utf8_lower(texts))
    word = code64(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    total = len(word)
    counts = np.diff(offsets)
    factors = mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    sums = word * factors[0]
    for k in range(1, n):
        sums[: total - k] += word[k:] * factors[k]
    keep = np.zeros(total, dtype=bool)
    per_text = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.repeat(offsets[:-1], per_text)
    starts = np.r_[0, np.cumsum(per_text)]
    rank = np.arange(starts[-1]) - np.repeat(starts[:-1], per_text)
    keep[first + rank] = True
    for text in np.flatnonzero((counts > 0) & (counts < n)):
        own = word[offsets[text] : offsets[text + 1]]
        sums[offsets[text]] = (own * factors[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mixed(sums[keep]), starts


def gathered(values: np.ndarray, ends: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[ends[p]:ends[p + 1]]`` of all picks one after another, and their ends."""
    sizes = (ends[1:] - ends[:-1])[picks]
    run_ends = np.cumsum(sizes)
    total = int(run_ends[-1]) if len(run_ends) else 0
    where = np.arange(total) + np.repeat(ends[:-1][picks] - (run_ends - sizes), sizes)
    return values[where], run_ends
