"""Fill-in-middle examples, cut with indexable skip lists.

Every text is a skip list of its tokens. A link of any lane carries how many units it skips
and how many code points they have. A cut rank is reached from the top lane downwards: a
link is followed while its units still fit, so the accumulated widths end at exactly that
rank and give the code point to cut at. The lists of a batch lie one after another in the
same arrays, each behind a head that is in all lanes.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from reelgrove.llm.common import mixed, slices, text_values

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
PROMOTION = 4

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class SkipLists:
    """The token lists of several texts, with units and code points on every lane."""

    def __init__(self, texts: pa.Array):
        plain = pc.fill_null(texts, "").cast(pa.large_binary())
        ends = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
        octets = np.frombuffer(plain.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]

        # A token ends with a run of other characters, or with the text.
        space = _SPACE[octets]
        last = np.zeros(len(octets), dtype=bool)
        last[ends[1:][ends[1:] > ends[:-1]] - 1] = True
        closes = np.flatnonzero(last | (~space & np.r_[space[1:], True]))
        points = (octets & 0xC0) != 0x80
        token_points = np.add.reduceat(points, np.r_[0, closes[:-1] + 1], dtype=np.int64) if len(closes) else closes
        self.counts = np.searchsorted(closes, ends[1:]) - np.searchsorted(closes, ends[:-1])

        # The link of the head or of a token leads to the next token. The last one's leads
        # beyond the text, to the next head: no rank is that large.
        heads = np.r_[0, np.cumsum(self.counts + 1)[:-1]]
        size = int(self.counts.sum()) + len(self.counts)
        widths = np.zeros(size, dtype=np.int64)
        into = np.ones(size, dtype=bool)
        into[heads] = False
        widths[np.flatnonzero(into) - 1] = token_points
        self.lanes = [(np.ones(size, dtype=np.int64), widths)]
        self.down: list[np.ndarray] = []
        self.heads = heads

        # Heights follow from a hash of a token's place in its text.
        place = np.arange(size, dtype=np.uint64) - np.repeat(heads, self.counts + 1).astype(np.uint64)
        with np.errstate(over="ignore"):
            coin = mixed(place + np.uint64(1))
        tall = ~into
        level = np.arange(size)
        while len(level) > len(heads):
            coin, chosen = coin // np.uint64(PROMOTION), coin % np.uint64(PROMOTION) == 0
            picked = np.flatnonzero(chosen[: len(level)] | tall)
            units, widths = self.lanes[-1]
            self.lanes.append((np.add.reduceat(units, picked), np.add.reduceat(widths, picked)))
            self.down.append(picked)
            level, coin, tall = level[picked], coin[picked], tall[picked]

    def cut(self, ranks: np.ndarray) -> np.ndarray:
        """Code points before the given number of units of each text, all texts at once."""
        place = np.arange(len(self.heads))  # on the top lane there are heads only
        if len(self.lanes) == 1:
            place = self.heads.copy()
        left = ranks.astype(np.int64)
        found = np.zeros(len(ranks), dtype=np.int64)
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, widths = self.lanes[lane]
            moving = np.flatnonzero(_fits(units, place, left))
            while len(moving):
                at = place[moving]
                left[moving] -= units[at]
                found[moving] += widths[at]
                place[moving] = at + 1
                moving = moving[_fits(units, at + 1, left[moving])]
            if lane:
                place = self.down[lane - 1][place]
        return found


def _fits(units: np.ndarray, place: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whether the link at each place skips no more units than are left."""
    inside = place < len(units)
    return inside & (units[np.where(inside, place, 0)] <= left)


def draws(key: str, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that follow from the seed and a row's id."""
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{key}".encode()).digest()[:16])


def arranged(text: str, form: str, first: int, second: int) -> str:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "spm":
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transform(
    docs: DataFrame,
    rate: int = 50,
    spm: int = 80,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every row of ``docs`` with its text arranged for filling in the middle.

    Added: ``fim_units`` (tokens), ``fim_form`` (``plain``, ``psm``, ``spm``),
    ``fim_prefix_chars`` and ``fim_middle_chars`` (code points, NULL if plain) and
    ``fim_text``. Columns of these names are replaced. ``rate`` and ``spm`` are percentages:
    of rows that are cut, and of those with the suffix first.

    A text stays plain if it is empty or NULL (then ``fim_text`` is empty) or holds a mark.
    Draws depend on the id alone, so equal texts of different ids are cut differently and
    repeated rows alike; a NULL id counts as the empty string. Whole texts are cut, nothing is
    shuffled; memory holds one slice of a batch (a longer text comes alone). An empty table
    gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__text"):
                lists = SkipLists(part.column("__text"))
                texts = text_values(part.column("__text"))
                drawn = np.array([draws(k or "", seed) for k in part.column("__key").to_pylist()], dtype=np.int64)
                ranks = np.sort(drawn[:, :2] % (lists.counts + 1)[:, None], axis=1)
                first, second = lists.cut(ranks[:, 0]), lists.cut(ranks[:, 1])
                cut = (drawn[:, 2] % 100 < rate) & (lists.counts > 0)
                forms, out = [], []
                for text, wanted, order, a, b in zip(
                    texts, cut.tolist(), (drawn[:, 3] % 100).tolist(), first.tolist(), second.tolist()
                ):
                    form = "plain"
                    if wanted and not any(m in text for m in MARKS):
                        form = "spm" if order < spm else "psm"
                    forms.append(form)
                    out.append(text if form == "plain" else arranged(text, form, a, b))
                plain = np.array([f == "plain" for f in forms], dtype=bool)
                kept = [c for i, c in enumerate(part.columns) if part.schema.names[i] not in ("__key", "__text")]
                names = [n for n in part.schema.names if n not in ("__key", "__text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *kept,
                        pa.array(lists.counts, pa.int64()),
                        pa.array(forms, pa.string()),
                        pa.array(first, pa.int64(), mask=plain),
                        pa.array(second - first, pa.int64(), mask=plain),
                        pa.array(out, pa.string()),
                    ],
                    [*names, *(f.name for f in FIELDS)],
                )

    own = {f.name for f in FIELDS}
    rest = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in own])
    keyed = rest.select(
        "*", F.col(f"`{id_col}`").cast("string").alias("__key"), F.col(f"`{text_col}`").alias("__text")
    )
    return keyed.mapInArrow(run, T.StructType([*rest.schema.fields, *FIELDS]))


FIELDS = [
    T.StructField("fim_units", T.LongType()),
    T.StructField("fim_form", T.StringType()),
    T.StructField("fim_prefix_chars", T.LongType()),
    T.StructField("fim_middle_chars", T.LongType()),
    T.StructField("fim_text", T.StringType()),
]


def restored(output: Column, form: Column) -> Column:
    """The exact text again. No text that was cut holds a mark, so each mark is there once."""

    def between(start: str, end: str | None) -> Column:
        tail = F.substring_index(output, start, -1)
        return F.substring_index(tail, end, 1) if end else tail

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
