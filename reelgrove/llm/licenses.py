"""Licence notices found by a trained paragraph classifier and confirmed by templates.

A paragraph's words give hashed features of one to three words. A multinomial logistic
regression, trained here, tells licence families from ordinary text. Its probabilities are
calibrated with a temperature on held-out examples, which also set the probability below
which a likely notice is ``unknown``; held-out prose sets the one that makes a notice. A
predicted family holds only if the paragraph also contains enough of the word pairs of one
of its notice templates.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from reelgrove.llm.common import appended, code64, mixed, slices, words_of

BUCKETS = 1 << 17
WINDOW, STRIDE = 32, 16
SAMPLE_DOCS = 2000
VARIANTS = 80
MIN_SIMILARITY = 0.6
COMMON = 0.005  # share of ordinary windows above which a feature tells nothing
NONE, UNKNOWN = "none", "unknown"
CUES = r"(?i)licen[sc]|copyright|warrant|redistribut|permission|spdx|creative commons|public domain|gnu "

# Wording of well-known public licence notices, by family and identifier.
TEMPLATES: list[tuple[str, str, str]] = [
    ("MIT", "MIT", "Released under the MIT License."),
    ("MIT", "MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache", "Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL", "GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL", "LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL", "LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("AGPL", "AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "AGPL-3.0", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("BSD", "BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD", "BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD", "BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("MPL", "MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY-NC", "CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA", "CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY", "CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY", "CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0", "CC0-1.0", "Released under CC0 1.0 Universal. To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("ISC", "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "Unlicense", "This is free and unencumbered software released into the public domain."),
    ("EPL", "EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
]
# Ordinary sentences with the same words, which are no notices.
LOOKALIKES = [
    "The driver lost the license after the third offence and had to walk.",
    "The council granted a licence to the new restaurant on the square.",
    "All permission slips must be returned before the class trip.",
    "The general public was not allowed to see the work of the artist.",
    "A version of the story was released last year and sold in all shops.",
    "The warranty of the machine covers two years and all spare parts.",
    "Free software was the subject of the talk about distribution of rights.",
    "The public library is open to any person under the terms of the city.",
]


@dataclass
class Model:
    classes: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float  # of the family's probability, below it the licence is unknown
    notice: float  # of all families' probability, below it a window is ordinary text


@dataclass
class Units:
    """Windows over the paragraphs of some texts: where their words lie, and whose they are."""

    words: np.ndarray  # a code of every word
    coded: pa.DictionaryArray
    first: np.ndarray
    last: np.ndarray  # behind the last word
    paragraph: np.ndarray
    text: np.ndarray


def units(texts: pa.Array) -> Units:
    """Lower-cased words of letters and digits, in windows over paragraphs.

    Lines without a blank one between are one paragraph, as notices are wrapped; a line of
    comment leaders alone is blank. Its number is that of its first line. A paragraph above
    ``WINDOW`` words has windows every ``STRIDE`` words up to its end.
    """
    whole = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"\r\n?", "\n")
    # A comment leader that is a word, as in batch files and typesetting macros.
    bare = pc.replace_substring_regex(whole, r"(?m)^[ \t]*(?:rem|dnl)\b", "")
    plain = pc.replace_substring_regex(bare, r"[^\p{L}\p{N}\n]+", " ")
    lines = pc.split_pattern(plain, "\n")
    line_ends = lines.offsets.to_numpy().astype(np.int64)
    line_ends -= line_ends[0]
    coded, offsets = words_of(lines.flatten())
    # A paragraph begins at a line with words behind one without, and in every text anew.
    filled = np.diff(offsets) > 0
    begins = filled.copy()
    begins[1:] &= ~filled[:-1]
    opening = line_ends[:-1][np.diff(line_ends) > 0]
    begins[opening] = filled[opening]
    heads = np.flatnonzero(begins)
    offsets = np.r_[offsets[heads], offsets[-1]].astype(np.int64)
    sizes = np.diff(offsets)
    count = np.where(sizes > WINDOW, -(-(sizes - WINDOW) // STRIDE) + 1, (sizes > 0).astype(np.int64))
    line = np.repeat(np.arange(len(sizes)), count)
    rank = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
    inside = np.minimum(rank * STRIDE, np.maximum(sizes[line] - WINDOW, 0))
    first = offsets[:-1][line] + inside
    text = np.searchsorted(line_ends, heads[line], "right") - 1
    return Units(
        code64(coded.dictionary.to_pylist())[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.uint64),
        coded,
        first,
        np.minimum(first + WINDOW, offsets[1:][line]),
        heads[line] - line_ends[text],
        text,
    )


def gram_buckets(words: np.ndarray, n: int) -> np.ndarray:
    """Feature of the ``n`` words from every place; the last ``n - 1`` places have none."""
    code = np.full(max(0, len(words) - n + 1), np.uint64(n), np.uint64)
    for k in range(n):
        code = mixed(code + words[k : len(words) - n + 1 + k])
    return (code % np.uint64(BUCKETS)).astype(np.int64)


def window_sums(u: Units, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of all features of every window."""
    size = u.last - u.first
    out = np.zeros((len(u.first), weights.shape[1]))
    for n in (1, 2, 3):
        sums = np.zeros((len(u.words) + 1, weights.shape[1]))
        values = weights[gram_buckets(u.words, n)]
        np.cumsum(values, axis=0, out=sums[1 : len(values) + 1])
        grams = np.maximum(size - n + 1, 0)
        out += np.where(grams[:, None] > 0, sums[np.minimum(u.first + grams, len(values))] - sums[np.minimum(u.first, len(values))], 0)
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def notice_examples(prose: list[str], seed: int = 5) -> list[tuple[str, str]]:
    """Variants of every family's notices: cropped, with words lost, inside ordinary prose."""
    rng = random.Random(seed)
    filler = " ".join(prose).split() or ["text"]
    out = []
    for family in sorted({t[0] for t in TEMPLATES}):
        texts = [t[2] for t in TEMPLATES if t[0] == family]
        for i in range(VARIANTS):
            words = texts[i % len(texts)].split()
            if len(words) > 12 and rng.random() < 0.6:
                size = rng.randint(max(10, len(words) * 6 // 10), len(words))
                at = rng.randint(0, len(words) - size)
                words = words[at : at + size]
            if len(words) > 8:
                words = [w for w in words if rng.random() > 0.05]
            if rng.random() < 0.5:
                at = rng.randrange(len(filler))
                words = filler[at : at + rng.randint(1, 24)] + words
            if rng.random() < 0.5:
                at = rng.randrange(len(filler))
                words = words + filler[at : at + rng.randint(1, 24)]
            out.append((" ".join(words), family))
    return out


def train(prose: list[str], rounds: int = 100) -> Model:
    """Fit and calibrate on notice variants and a bounded sample of ordinary paragraphs."""
    examples = notice_examples(prose) + [(t, NONE) for t in prose] + [(t, NONE) for t in LOOKALIKES * 10]
    classes = [NONE, *sorted({t[0] for t in TEMPLATES})]
    u = units(pa.array([t.replace("\n", " ") for t, _ in examples]))
    truth = np.array([classes.index(c) for _, c in examples])[u.text]
    held = u.text % 5 == 4
    rows, columns = [], []
    for n in (1, 2, 3):
        buckets = gram_buckets(u.words, n)
        grams = np.maximum(u.last - u.first - n + 1, 0)
        row = np.repeat(np.arange(len(u.first)), grams)
        place = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams) + u.first[row]
        rows.append(row)
        columns.append(buckets[place])
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    # Only words of the templates tell anything, and of those not the ones common in prose.
    notice_words = units(pa.array([t[2] for t in TEMPLATES])).words
    telling = np.unique(np.concatenate([gram_buckets(notice_words, n) for n in (1, 2, 3)]))
    in_prose = (truth[rows] == 0) & ~held[rows]
    pairs = np.unique(rows[in_prose] * np.int64(BUCKETS) + columns[in_prose])
    common = np.bincount(pairs % BUCKETS, minlength=BUCKETS) > COMMON * max(1, (truth == 0).sum())
    used = ~held[rows] & np.isin(columns, telling) & ~common[columns]
    order = np.argsort(columns[used], kind="stable")
    row, column = rows[used][order], columns[used][order]
    starts = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    known = column[starts]
    local = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(column)]))
    by_row = np.argsort(row, kind="stable")
    row_starts = np.flatnonzero(np.r_[True, row[by_row][1:] != row[by_row][:-1]])
    own = row[by_row][row_starts]

    target = np.eye(len(classes))[truth] * ~held[:, None]
    balance = 1 / np.maximum(target.sum(axis=0), 1)
    balance[1:] /= max(1, (target.sum(axis=0)[1:] > 0).sum())  # notices weigh as much as prose
    importance = (target * balance).sum(axis=1, keepdims=True) / 2
    w = np.zeros((len(known), len(classes)))
    bias = np.zeros(len(classes))
    size_w, size_b = np.full_like(w, 1e-8), np.full_like(bias, 1e-8)
    for _ in range(rounds):  # full-batch AdaGrad
        logits = bias + np.zeros((len(u.first), 1))
        logits[own] += np.add.reduceat(w[local[by_row]], row_starts, axis=0)
        error = (softmax(logits) - target) * importance
        grad = np.add.reduceat(error[row], starts, axis=0) + 1e-6 * w
        size_w += grad * grad
        w -= 0.5 * grad / np.sqrt(size_w)
        grad = error.sum(axis=0)
        size_b += grad * grad
        bias -= 0.1 * grad / np.sqrt(size_b)
    weights = np.zeros((BUCKETS, len(classes)), np.float32)
    weights[known] = w

    logits = window_sums(u, weights)[held] + bias
    truth = truth[held]
    pick = np.arange(len(truth))
    temperature = min(
        (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0),
        key=lambda t: -np.log(softmax(logits / t)[pick, truth] + 1e-12).mean(),
    )
    chance = softmax(logits / temperature)
    sure = chance[pick, truth][truth > 0]
    threshold = float(np.clip(np.quantile(sure, 0.02), 0.3, 0.9)) if len(sure) else 0.5
    doubt = 1 - chance[truth == 0, 0]
    notice = float(np.clip(np.quantile(doubt, 0.999), 0.5, 0.95)) if len(doubt) else 0.5
    return Model(classes, weights, bias, temperature, threshold, notice)


def similarity(words: list[str], family: str) -> tuple[float, str | None, int]:
    """The best share of word pairs in common with the family's templates, and which one.

    Which one is None where templates of different versions tie. The third is the most pairs
    in common with any template.
    """
    own = set(zip(words, words[1:]))
    best: tuple[float, str | None] = (0.0, None)
    most = 0
    for name, identifier, pairs in _template_pairs():
        both = len(own & pairs)
        most = max(most, both)
        if name == family and both >= 3:
            share = both / min(len(own), len(pairs))
            if share > best[0]:
                best = (share, identifier)
            elif share == best[0] and identifier != best[1]:
                best = (share, None)
    return *best, most


_pairs: list[tuple[str, str, set]] = []


def _template_pairs() -> list[tuple[str, str, set]]:
    if not _pairs:
        u = units(pa.array([t[2] for t in TEMPLATES]))
        words = np.array(u.coded.to_pylist(), object)
        owner = {}
        for i, text in enumerate(u.text):
            owner.setdefault(text, set()).update(range(u.first[i], u.last[i]))
        for i, (family, identifier, _) in enumerate(TEMPLATES):
            own = [words[j] for j in sorted(owner[i])]
            _pairs.append((family, identifier, set(zip(own, own[1:]))))
    return _pairs


FIELDS = [
    ("paragraph", T.IntegerType(), pa.int32()),
    ("family", T.StringType(), pa.string()),
    ("license", T.StringType(), pa.string()),
    ("probability", T.DoubleType(), pa.float64()),
    ("similarity", T.DoubleType(), pa.float64()),
]
NOTICES = T.ArrayType(T.StructType([T.StructField(n, t) for n, t, _ in FIELDS]))
_NOTICES = pa.list_(pa.struct([(n, a) for n, _, a in FIELDS]))


def notices(model: Model, texts: pa.Array) -> list[list[dict]]:
    """Per text its notices in order: for a paragraph the surest of every family and all whole
    templates, or the surest unknown one."""
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    u = units(texts)
    if not len(u.first):
        return out
    chance = softmax((window_sums(u, model.weights) + model.bias) / model.temperature)
    best: dict[tuple[int, int], dict[tuple, tuple]] = {}
    for i in np.flatnonzero(1 - chance[:, 0] >= model.notice):
        c = int(chance[i, 1:].argmax()) + 1
        words = u.coded[u.first[i] : u.last[i]].to_pylist()
        share, identifier, common = similarity(words, model.classes[c])
        if common < 2:  # words of notices, but not put together as in one
            continue
        firm = identifier and chance[i, c] >= model.threshold and share >= MIN_SIMILARITY
        family = model.classes[c]
        seen = [((family, None if firm else UNKNOWN), (float(chance[i, c]), identifier if firm else UNKNOWN, float(share)))]
        own = set(zip(words, words[1:]))
        for other, name, pairs in _template_pairs():
            if pairs <= own:  # a whole notice beside others
                seen.append(((other, name), (float(chance[i, model.classes.index(other)]), name, 1.0)))
        kept = best.setdefault((int(u.text[i]), int(u.paragraph[i])), {})
        for key, found in seen:
            kept[key] = max(kept.get(key, found), found, key=lambda x: x[0])
    for (text, paragraph), kept in sorted(best.items()):
        whole = {family for family, name in kept if name not in (None, UNKNOWN)}
        sure = {k: v for k, v in kept.items() if k[1] != UNKNOWN and (k[1] or k[0] not in whole)}
        if not sure:
            sure = dict([max(kept.items(), key=lambda x: x[1][0])])
        for (family, _), (p, identifier, share) in sorted(sure.items(), key=lambda x: (x[0][0], x[1][1])):
            out[text].append({"paragraph": paragraph, "family": family, "license": identifier, "probability": p, "similarity": share})
    return out


def prose_sample(docs: DataFrame, bound: int = SAMPLE_DOCS, text_col: str = "text") -> list[str]:
    """Whole lines of ordinary text, at most two from each of about ``bound`` documents.

    Documents and lines are chosen, and the lines ordered, by hashes; lines with licence-like
    words are left out, which is the only label that ordinary text has.
    """
    texts = docs.where(F.col(f"`{text_col}`").isNotNull()).select(F.col(f"`{text_col}`").alias("text"))
    every = max(1, texts.count() // bound)
    lines = F.filter(F.split("text", "\n"), lambda x: ~x.rlike(CUES) & (F.length(x) > 0))
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("hash"), x.alias("line")))
    rows = (
        texts.where(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(every)) == 0)
        .select(F.explode(F.slice(F.array_sort(hashed), 1, 2)).alias("chosen"))
        .select("chosen.line")
        .orderBy(F.xxhash64("line", F.lit(2)), "line")
        .limit(2 * bound)
    )
    return [r["line"] for r in rows.collect()]


def scan(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Add ``license_notices`` to every row: paragraph (its first line, from 0), family, licence, scores.

    ``license`` is the identifier of the template that confirms the predicted family, or
    ``unknown`` where the calibrated probability or the likeness to a template is too low or
    two versions tie.
    The list is empty without a notice, also for NULL and empty texts. Whole texts are
    read, long paragraphs in overlapping windows. All other columns and rows are kept; a
    column of that name is replaced. Row by row, nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in slices(batch, text_col, 2 << 20):
                yield cut.append_column("license_notices", pa.array(notices(model, cut.column(text_col)), _NOTICES))

    return appended(docs, run, [T.StructField("license_notices", NOTICES)])
