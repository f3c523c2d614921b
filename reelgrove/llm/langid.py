"""Language of texts and of the spans inside them.

Character trigrams of every learned language are counted over all labelled documents. A
word scores in each language by the mean-free log probabilities of its trigrams; the
script of its letters first narrows the languages to those that use it. A text's words are
then labelled together by the Viterbi path with the highest sum of scores, where each change
of language costs a penalty, so a stray word does not break a span.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from reelgrove.llm.common import appended, mixed, slices, words_of

BUCKETS = 1 << 15
SWITCH_PENALTY = 8.0
WORD_BOUND = 6.0
SMOOTHING = 0.5
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

# Where the blocks of Unicode's scripts begin. Letters between two starts
# belong to the script at the left.
SCRIPT_STARTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Syriac"), (0x0750, "Arabic"), (0x0780, "Thaana"), (0x07C0, "Nko"),
    (0x0800, "Hebrew"), (0x08A0, "Arabic"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Cherokee"),
    (0x1400, "Canadian"), (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x1900, "Other"), (0x1C80, "Cyrillic"),
    (0x1C90, "Georgian"), (0x1CD0, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Latin"),
    (0x2C00, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x2DE0, "Cyrillic"), (0x2E00, "Han"),
    (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Han"),
    (0xA000, "Other"), (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"),
    (0xAC00, "Hangul"), (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB13, "Armenian"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"),
    (0x10000, "Other"), (0x1B000, "Kana"), (0x1B300, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
SCRIPTS = sorted({name for _, name in SCRIPT_STARTS})
_STARTS = np.array([s for s, _ in SCRIPT_STARTS])
_SCRIPT_OF = np.array([SCRIPTS.index(name) for _, name in SCRIPT_STARTS])
_FACTORS = mixed(np.arange(1, 4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # of a trigram bucket in each language
    allowed: np.ndarray  # script by language: whether the language is written in it


@dataclass
class WordFeatures:
    """Trigram buckets of distinct words, word after word, and each word's letters."""

    buckets: np.ndarray
    starts: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    script_of_letter: np.ndarray


def features(words: list[str]) -> WordFeatures:
    """Trigrams around every letter; anything else counts as a break."""
    text = " " + " ".join(words) + " "
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, place = np.unique(points, return_inverse=True)
    is_letter = np.array([chr(c).isalpha() for c in kinds.tolist()], bool)[place]
    plain = np.where(is_letter, points, np.uint32(32)).astype(np.uint64)
    ends = np.flatnonzero(points == 32)  # one before each word and one behind the last
    at = np.flatnonzero(is_letter)
    code = mixed(plain[at - 1] * _FACTORS[0] + plain[at] * _FACTORS[1] + plain[at + 1] * _FACTORS[2])
    starts = np.searchsorted(at, ends)
    script = _SCRIPT_OF[np.searchsorted(_STARTS, points[at], "right") - 1]
    letters = np.diff(starts)
    first = np.zeros(len(words), np.int64)
    first[letters > 0] = script[starts[:-1][letters > 0]]
    return WordFeatures((code % np.uint64(BUCKETS)).astype(np.int64), starts, letters, first, script)


def _texts(array: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(array, ""))


def learn(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model | None:
    """Count trigrams and letters by script of every language over all labelled texts.

    What reaches the driver is one number per language and trigram bucket or script. None
    where there is no labelled text with a letter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for cut in slices(batch, "text"):
                coded, offsets = words_of(_texts(cut.column("text")))
                if not len(coded):
                    continue
                f = features(coded.dictionary.to_pylist())
                owner = np.repeat(np.arange(len(cut)), np.diff(offsets))
                langs = cut.column("lang").dictionary_encode()
                lang_of = langs.indices.to_numpy()[owner]
                words = coded.indices.to_numpy()
                of_trigram = np.repeat(np.arange(len(f.letters)), f.letters)
                for i, lang in enumerate(langs.dictionary.to_pylist()):
                    times = np.bincount(words[lang_of == i], minlength=len(f.letters)).astype(float)
                    out = counts.setdefault(lang, np.zeros(BUCKETS + len(SCRIPTS)))
                    out[:BUCKETS] += np.bincount(f.buckets, times[of_trigram], BUCKETS)
                    out[BUCKETS:] += np.bincount(f.script, times * f.letters, len(SCRIPTS))
        for lang, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some.astype(np.int32)), pa.array(n[some].astype(np.int64))],
                ["lang", "bucket", "n"],
            )

    rows = (
        labelled.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
        .where("lang is not null and text is not null")
        .mapInArrow(run, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    if not len(rows):
        return None
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS + len(SCRIPTS)))
    counts[rows["lang"].map(languages.index), rows["bucket"]] = rows["n"]
    trigrams, scripts = counts[:, :BUCKETS] + SMOOTHING, counts[:, BUCKETS:]
    logs = np.log(trigrams / trigrams.sum(axis=1, keepdims=True))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))
    return Model(languages, (logs - logs.mean(axis=0)).T.astype(np.float32).copy(), allowed.T.copy())


def word_scores(model: Model, f: WordFeatures) -> np.ndarray:
    """Scores of words in each language: zero for words without letters."""
    out = np.zeros((len(f.letters), len(model.languages)), np.float32)
    some = np.flatnonzero(f.letters)
    if len(some):
        out[some] = np.add.reduceat(model.scores[f.buckets], f.starts[:-1][some], axis=0)
        out[some] -= out[some].max(axis=1, keepdims=True)
        np.maximum(out, -WORD_BOUND, out=out)
        allowed = model.allowed[f.script[some]]
        narrowed = allowed.any(axis=1, keepdims=True) & ~allowed
        out[some] = np.where(narrowed, -2 * WORD_BOUND, out[some])
    return out


def viterbi(scores: np.ndarray, words: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The label of every word of every text on its text's best path, ties to the first label.

    All texts take a step together, longest first, so those that have ended drop out.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    begin = offsets[:-1][order]
    labels = np.zeros(len(words), np.int32)
    if not len(order):
        return labels
    steps = int(lengths[order[0]])
    active = np.searchsorted(-lengths[order], -np.arange(steps), "left")  # texts longer than t
    stays, sources, finals = [], [], np.zeros(len(order), np.int64)
    value = scores[words[begin]].astype(np.float64)
    for t in range(1, steps):
        ended = active[t]
        if ended < len(value):
            finals[ended : len(value)] = value[ended:].argmax(axis=1)
            value = value[:ended]
        source = value.argmax(axis=1)
        switched = value[np.arange(ended), source][:, None] - penalty
        stay = value >= switched
        stays.append(stay)
        sources.append(source.astype(np.int16))
        value = np.where(stay, value, switched) + scores[words[begin[:ended] + t]]
    finals[: len(value)] = value.argmax(axis=1)
    current = finals
    for t in range(steps - 1, -1, -1):
        n = active[t]
        labels[begin[:n] + t] = current[:n]
        if t:
            stay = stays[t - 1][np.arange(n), current[:n]]
            current[:n] = np.where(stay, current[:n], sources[t - 1])
    return labels


SPANS = T.ArrayType(
    T.StructType([
        T.StructField("first_word", T.IntegerType()),
        T.StructField("words", T.IntegerType()),
        T.StructField("lang", T.StringType()),
    ])
)
_SPAN = pa.list_(pa.struct([("first_word", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))


def labelled_batch(
    model: Model, texts: pa.Array, penalty: float
) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Language, its share of the letters, the spans, and the share of foreign letters of each text."""
    coded, offsets = words_of(_texts(texts))
    count, languages = len(texts), model.languages
    owner = np.repeat(np.arange(count), np.diff(offsets))
    share = np.zeros((count, len(languages)))
    foreign = np.zeros(count)
    if len(coded):
        f = features(coded.dictionary.to_pylist())
        words = coded.indices.to_numpy()
        labels = viterbi(word_scores(model, f), words, offsets, penalty)
        share = np.bincount(
            owner * len(languages) + labels, f.letters[words], count * len(languages)
        ).reshape(share.shape)
        # Letters of scripts that no language is written in.
        strange = ~model.allowed.any(axis=1)[f.script_of_letter]
        per_word = np.bincount(np.repeat(np.arange(len(f.letters)), f.letters), strange, len(f.letters))
        foreign = np.bincount(owner, per_word[words], count)
    total = share.sum(axis=1)
    best = share.argmax(axis=1)
    known = total > 0
    names = np.array([*languages, UNKNOWN], object)
    predicted = names[np.where(known, best, len(languages))]
    score = np.where(known, share[np.arange(count), best] / np.maximum(total, 1), 0.0)
    if len(coded):
        new = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (labels[1:] != labels[:-1])])
        keep = known[owner[new]]
        sizes = np.diff(np.r_[new, len(words)])[keep]
        new = new[keep]
        ends = np.r_[0, np.cumsum(np.bincount(owner[new], minlength=count))]
        spans = pa.StructArray.from_arrays(
            [
                pa.array((new - offsets[owner[new]]).astype(np.int32)),
                pa.array(sizes.astype(np.int32)),
                pa.array(names[labels[new]], pa.string()),
            ],
            fields=list(_SPAN.value_type),
        )
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), spans).cast(_SPAN)
    else:
        lists = pa.array([[]] * count, _SPAN)
    return pa.array(predicted, pa.string()), pa.array(score), lists, pa.array(foreign / np.maximum(total, 1))


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Add ``lang_pred``, ``lang_score``, ``lang_spans`` and ``lang_foreign`` to every row.

    ``lang_score`` is the share of the text's letters in spans of ``lang_pred``; a tie goes
    to the first language by name. Spans give the first word, the number of words and the
    language. A text that is NULL, has no letter, or meets an empty model is ``und`` with
    score 0 and no spans. A script that no language uses does not narrow them;
    ``lang_foreign`` is the share of the text's letters in such scripts, 0 without letters or
    with an empty model. All other columns and rows are kept; columns of these four names are
    replaced. Row by row, nothing is shuffled.
    """
    if model is None:
        model = Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPTS), 0), bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, text_col):
                if model.languages:
                    found = labelled_batch(model, cut.column(text_col), penalty)
                else:
                    found = (
                        pa.array([UNKNOWN] * len(cut)),
                        pa.array(np.zeros(len(cut))),
                        pa.array([[]] * len(cut), _SPAN),
                        pa.array(np.zeros(len(cut))),
                    )
                for name, column in zip(("lang_pred", "lang_score", "lang_spans", "lang_foreign"), found):
                    cut = cut.append_column(name, column)
                yield cut

    return appended(
        docs,
        run,
        [
            T.StructField("lang_pred", T.StringType()),
            T.StructField("lang_score", T.DoubleType()),
            T.StructField("lang_spans", SPANS),
            T.StructField("lang_foreign", T.DoubleType()),
        ],
    )
