import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelgrove.llm import fingerprints, ngram_join
from reelgrove.llm.common import shingles
from reelgrove.llm.components import components


def grams(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def by_force(docs, threshold=0.8):
    """Classes and links of (id, text) rows from an index of all n-grams."""
    sets = [grams(t) for _, t in docs]
    index = defaultdict(list)
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(docs)
    for i, s in enumerate(sets):
        for j, common in Counter(j for g in s for j in index[g]).items():
            if common / (len(s) + len(sets[j]) - common) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            index[g].append(i)
    least = defaultdict(list)
    for i in range(len(docs)):
        least[root(i)].append(docs[i][0])
    return {(d[0], d[1]): (min((x for x in least[root(i)] if x is not None), default=None), links[i]) for i, d in enumerate(docs)}


def test_shingle_hashes_follow_the_sets():
    import pyarrow as pa

    texts = [None, "", "a", "a b c", "a b c d e f", "A  b\nc d e f", "x a b c d e f"]
    hashes, starts = shingles(pa.array(texts))
    sets = [set(hashes[a:b].tolist()) for a, b in zip(starts, starts[1:])]
    assert [len(s) for s in sets] == [0, 0, 1, 1, 2, 2, 3]
    assert sets[4] == sets[5] and sets[4] < sets[6] and not sets[2] & sets[3]


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 180)} == {100}
    assert {found[i] for i in (200, 201, 202)} == {200} and 300 not in found
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_and_rows(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= ngram_join.MAX_HASHES
    with pytest.raises(ValueError):
        ngram_join.bands_and_rows(0.1, 0.999999, 8)


def test_documents_as_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = by_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in ngram_join.near_classes(docs).collect():
        assert (r.class_id, r.n_links) == want[r.doc_id, texts[r.doc_id]]


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(150)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"u{i}_{j}" for j in range(40))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = by_force(rows)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_classes(docs).collect()}
    assert got == {i: v for (i, _), v in want.items()}


def test_odd_rows_in_the_join(odd_docs, no_docs):
    rows = ngram_join.near_classes(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r.doc_id].append((r.class_id, r.n_links))
    assert by_id[0] == [(0, 0)] and by_id[1] == [(1, 0)] and by_id[2] == [(2, 0)]
    assert by_id[5] == [(5, 2)] * 3 and by_id[8] == [(7, 1)]
    assert sorted(by_id[None], key=str) == [(4, 1), (None, 0)]
    kept = ngram_join.one_per_class(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [0, 1, 2, 3, 4, 5, 6, 7, 9, None]
    assert ngram_join.near_classes(no_docs).count() == 0 and ngram_join.one_per_class(no_docs).count() == 0


def test_likeness_is_near_the_truth(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    ordered = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    rows = {r.doc_id: r for r in fingerprints.compare_with_edit(docs).collect()}
    errors = []
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        r = rows[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors.append(r.near_edited - jaccard(grams(text), grams(edited)))
        errors.append(r.near_next - jaccard(grams(text), grams(following)))
    assert np.sqrt(np.mean(np.square(errors))) < 0.04 and abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.2


def test_estimate_has_no_bias_and_short_texts_work(spark):
    """Sets of known likeness, dense and sparse: the mean estimate is the likeness."""
    rng = random.Random(5)
    rows = []
    for size in (12, 40, 1500):
        for i in range(40):
            words = [f"{size}_{i}_{j}" for j in range(size)]
            other = words[: size * 3 // 4] + [f"o{rng.random()}" for _ in range(size // 4)]
            a, b = " ".join(words), " ".join(other)
            rows.append((size, jaccard(grams(a), grams(b)), a, b))
    pairs = spark.createDataFrame(rows, "size int, truth double, a string, b string").select(
        "size", "truth", fingerprints.fingerprint(F.col("a")).alias("fa"), fingerprints.fingerprint(F.col("b")).alias("fb")
    )
    found = pairs.select("size", "truth", fingerprints.likeness(F.col("fa"), F.col("fb")).alias("near")).collect()
    for size in (12, 40, 1500):
        own = [r for r in found if r["size"] == size]
        assert abs(np.mean([r.near - r.truth for r in own])) < 0.05


def test_no_python_in_the_fingerprint_plan(spark, small):
    from oracle import plan_of

    text = plan_of(fingerprints.compare_with_edit(spark.read.parquet(f"{small}/documents.parquet")))
    assert not any(w in text for w in ("Python", "Arrow", "Pandas"))


def test_odd_rows_fingerprints(odd_docs, no_docs):
    rows = fingerprints.compare_with_edit(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_text = defaultdict(set)
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id is not None}
    for r in rows:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            by_text[texts[r.doc_id]].add(tuple(r.fingerprint))
    assert all(len(f) == 1 for f in by_text.values()) and by_text[""] == {()}
    assert fingerprints.compare_with_edit(no_docs).count() == 0


def edited(rng, words, edits, spare="x"):
    out = list(words)
    for place in rng.sample(range(len(words)), edits):
        out[place] = f"{spare}{rng.randrange(10**9)}"
    return " ".join(out)


def test_zones_of_a_large_group_lose_no_link(spark, monkeypatch):
    """Texts near, beside and far from the centre, in one component chained by steps."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, edited(rng, base, rng.choice([0, 1, 2, 3, 4, 5, 6]))) for i in range(240)]
    chain = list(base)
    for step in range(40):
        chain[(step * 5) % 200] = f"c{step}"
        rows += [(1000 + 3 * step + k, edited(rng, chain, k)) for k in range(3)]
    rows += [(2000, rows[0][1]), (2001, rows[0][1]), (2002, rows[-1][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = by_force(rows)
    seen = []
    zones = ngram_join.zones
    monkeypatch.setattr(ngram_join, "zones", lambda *a: seen.append(zones(*a)) or seen[-1])
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.near_classes(docs).collect()}
    assert got == {i: v for (i, _), v in want.items()}
    assert {r.zone for r in seen[0].select("zone").distinct().collect()} == {0, 1, 2}


def test_rows_of_one_large_group_grow_with_its_texts(spark, monkeypatch):
    """Near copies around one text are counted: none of them moves to a pair of blocks."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(i, edited(rng, base, 3)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    moved = []
    groups = ngram_join.open_groups
    monkeypatch.setattr(ngram_join, "open_groups", lambda z: moved.append(groups(z)) or moved[-1])
    got = ngram_join.near_classes(docs).collect()
    assert len(got) == 3000 and {(r.class_id, r.n_links) for r in got} == {(0, 2999)}
    assert moved[0].count() == 0


def test_components_of_a_hot_hub(spark, monkeypatch):
    from reelgrove.llm import components as module

    monkeypatch.setattr(module, "HOT_EDGES", 10)
    edges = [(i, 0) for i in range(1, 400)] + [(i, i + 1) for i in range(500, 530)] + [(399, 500)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert set(found.values()) == {0} and len(found) == 431
