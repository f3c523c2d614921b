"""BPE encoding and decoding with merge ranks in a priority queue.

A word's symbols form a doubly linked list. A heap holds the merge rank and place of each
adjacent pair that has a merge; the lowest rank is applied first, the leftmost of equals
first. A merge changes the neighbouring pairs, so an entry popped later is skipped unless
the pair at its place still has that rank. Decoding concatenates vocabulary strings.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from reelgrove.llm.common import gathered, slices

CACHED_WORDS = 600_000

_loaded: dict[str, Vocabulary] = {}


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where it is visible."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class Vocabulary:
    """A tokenizer file with byte-level words, word ends and lower-casing."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.strings = [strings.get(i, "") for i in range(max(strings) + 1)]
        suffix = model["end_of_word_suffix"] or ""
        self.inner = [vocab.get(c) for c in byte_alphabet()]
        self.last = [vocab.get(c + suffix) for c in byte_alphabet()]
        # Both sides' ids as one number lead to the rank and the merged symbol's id.
        self.width = len(strings).bit_length()
        self.merges = {
            vocab[a] << self.width | vocab[b]: rank << self.width | vocab[a + b]
            for rank, (a, b) in enumerate(model["merges"])
        }
        split = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find_words = regex.compile(split).findall
        names = sorted(self.special, key=len, reverse=True)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split
        self.cached: dict[str, bytes] = {}
        self.bound = cached_words

    def merge(self, word: str) -> list[int]:
        """Token ids of one word."""
        octets = word.encode()
        inner = self.inner
        symbols = [inner[b] for b in octets[:-1]]
        symbols.append(self.last[octets[-1]])
        symbols = [s for s in symbols if s is not None]
        size = len(symbols)
        if size < 2:
            return symbols
        known, width = self.merges.get, self.width
        mask = (1 << width) - 1
        bits = max(16, size.bit_length())
        places = (1 << bits) - 1
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        queue = []
        left = symbols[0]
        for i in range(1, size):
            right = symbols[i]
            m = known(left << width | right)
            if m is not None:
                queue.append(m << bits | i - 1)
            left = right
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            entry = pop(queue)
            place, found = entry & places, entry >> bits
            second = after[place]
            if second >= size or symbols[place] < 0:
                continue
            if known(symbols[place] << width | symbols[second]) != found:
                continue  # stale: a neighbour was merged since
            symbols[place] = merged = found & mask
            symbols[second] = -1
            beyond = after[place] = after[second]
            if beyond < size:
                before[beyond] = place
                m = known(merged << width | symbols[beyond])
                if m is not None:
                    push(queue, m << bits | place)
            previous = before[place]
            if previous >= 0:
                m = known(symbols[previous] << width | merged)
                if m is not None:
                    push(queue, m << bits | previous)
        return [s for s in symbols if s >= 0]

    def ids_of(self, word: str) -> bytes:
        """Little-endian 32-bit ids of a word; the cache is emptied when it reaches its bound."""
        ids = self.cached.get(word)
        if ids is None:
            if len(self.cached) >= self.bound:
                self.cached.clear()
            ids = np.array(self.merge(word), "<u4").tobytes()
            self.cached[word] = ids
        return ids

    def normal(self, text: str) -> str:
        """Composed and lower-cased character by character."""
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:  # lower-casing a whole text would use the word-final form
            text = text.replace("Σ", "σ")
        return text.lower()

    def encode(self, text: str) -> bytes:
        """Little-endian 32-bit ids of any text."""
        found = []
        for part in self.split_special(text) if "<|" in text else [text]:
            if part in self.special:
                found.append(np.uint32(self.special[part]).tobytes())
            else:
                found += map(self.ids_of, self.find_words(self.normal(part)))
        return b"".join(found)

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """``encode`` of each of many strings without line ends."""
        together = "\n".join(chunks)
        if "<|" in together:
            return [self.encode(c) for c in chunks]
        ids_of, found = self.ids_of, []
        for c in self.normal(together).split("\n"):
            words = (c,) if c.isascii() and c.isalpha() else self.find_words(c)
            found.append(ids_of(words[0]) if len(words) == 1 else b"".join(map(ids_of, words)))
        return found

    def decode(self, ids: np.ndarray) -> str:
        """Vocabulary strings, set apart by spaces, as the file names no decoder."""
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


def vocabulary(path: str) -> Vocabulary:
    """The file's vocabulary, read once per worker process."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``ids`` (binary, little-endian 32-bit numbers) and ``decoded`` of every text.

    One row per row of ``docs``: the id column, ``ids``, ``decoded``. A NULL or empty text
    has no ids and an empty decoded text; NULL or repeated ids are kept as they are; other
    columns are dropped; an empty table gives an empty result. Nothing is shuffled. Memory
    holds one slice of a batch (a longer text comes alone) and a bounded number of words.

    Texts are cut at ASCII white space, where no token or character composition crosses;
    each distinct cut of a slice is encoded once. Characters newer than Unicode 15 may be
    split or lower-cased by another table than the tokenizer's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            for part in slices(batch, "text"):
                lists = pc.ascii_split_whitespace(pc.fill_null(part.column("text"), ""))
                coded = lists.flatten().dictionary_encode()
                starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                encoded = known.encode_chunks(coded.dictionary.to_pylist())
                chunk_ends = np.cumsum([0, *map(len, encoded)]) // 4
                ids, ends = gathered(
                    np.frombuffer(b"".join(encoded), "<u4"), chunk_ends, coded.indices.to_numpy()
                )
                ends = np.r_[0, ends][starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.Array.from_buffers(
                            pa.binary(),
                            len(part),
                            [None, pa.py_buffer((ends * 4).astype("<i4")), pa.py_buffer(ids)],
                        ),
                        pa.array([known.decode(ids[a:b]) for a, b in zip(ends, ends[1:])], pa.string()),
                    ],
                    ["id", "ids", "decoded"],
                )

    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", id_col)
