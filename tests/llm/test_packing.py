from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from reelgrove.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def check_pieces(pieces, length):
    """Documents whole and in order, sequences gapless, all but the last full."""
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for number, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == length if number < len(by_sequence) - 1 else at <= length


def test_same_ids_as_the_library_for_any_text():
    encoder = packing.byte_encoder(PATH)

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=40))
    def check(text):
        assert encoder.encode_to_numpy(text, allowed_special="all").tolist() == ids_of(text)[:-1]

    check()
    for text in ("<|endoftext|> a", "  \n\n  x", "it's 123"):
        assert encoder.encode_to_numpy(text, allowed_special="all").tolist() == ids_of(text)[:-1]


def test_every_id_in_one_piece(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    pieces = packing.pack(docs, PATH).collect()
    check_pieces(pieces, 1024)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for r in docs.collect():
        own = sorted(by_doc.pop(r.doc_id), key=lambda p: p.start)
        got = [i for p in own for i in np.frombuffer(p.ids, "<u4").tolist()]
        assert got == ids_of(r.text) and all(p.doc_tokens == len(got) for p in own)
        assert [p.start for p in own] == [sum(q.length for q in own[:i]) for i in range(len(own))]
    assert not by_doc


def test_windows_have_the_shares_of_the_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    source = {r.doc_id: r.source for r in docs.collect()}
    pieces = packing.pack(docs, PATH).collect()
    windows = max(p.window for p in pieces) + 1
    taken, total = defaultdict(int), defaultdict(int)
    for p in pieces:
        taken[p.window, source[p.doc_id]] += p.length
        total[source[p.doc_id]] += p.length
    for s, n in total.items():
        given_so_far = 0
        for w in range(windows):
            given_so_far += taken[w, s]
            assert 0 <= n * (w + 1) / windows - given_so_far < 1  # the carried deficit


def test_targets(spark):
    rows = [(i, "a few words of text " * 20, "big" if i % 4 else "small") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    pieces = packing.pack(docs, PATH, sequence_length=32, targets={"small": 0.5, "big": 0.5}).collect()
    check_pieces(pieces, 32)
    names = dict((r[0], r[2]) for r in rows)
    first = [p for p in pieces if p.window == 0]
    share = sum(p.length for p in first if names[p.doc_id] == "small") / sum(p.length for p in first)
    assert abs(share - 0.5) < 0.01
    assert {p.doc_id for p in pieces} == set(names)


def test_named_sources_without_a_queue_keep_their_shares(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 4)
    rows = [(i, "some words of text here " * 8, f"s{i % 6}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    targets = {"s0": 0.3, **{f"s{i}": 0.1 for i in range(1, 6)}, "absent": 0.2}
    pieces = packing.pack(docs, PATH, sequence_length=16, targets=targets).collect()
    check_pieces(pieces, 16)
    source = {r[0]: r[2] for r in rows}
    first = [p for p in pieces if p.window == 0]
    total = sum(p.length for p in first)
    share = {s: sum(p.length for p in first if source[p.doc_id] == s) / total for s in targets}
    # Three sources have queues; the other three meet in one, with their 0.3 of 0.8.
    assert abs(share["s0"] - 0.3 / 0.8) < 0.02
    own = sorted(share[f"s{i}"] for i in range(1, 6))
    assert abs(sum(own) - 0.5 / 0.8) < 0.02
    assert sum(p.length for p in pieces) == sum(len(ids_of(r[1])) for r in rows)


def test_more_queues_than_sequences_in_a_window(spark):
    rows = [(i, "text of a source " * 20, f"s{i % 90}") for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    pieces = packing.pack(docs, PATH, sequence_length=16).collect()
    check_pieces(pieces, 16)
    tokens = sum(len(ids_of(r[1])) for r in rows)
    assert max(p.window for p in pieces) + 1 == -(-tokens // (16 * packing.WINDOW_SEQUENCES))


def test_stretches_use_all_tokens():
    plan = packing.stretches({0: 1000, 1: 10, 2: 300}, {0: 0.2, 1: 0.8, 2: 0.0}, 64)
    for q, n in {0: 1000, 1: 10, 2: 300}.items():
        assert sum(s["take"].get(q, 0) for s in plan) == n
    assert 2 not in plan[0]["take"] and packing.stretches({}, None, 64) == []


def test_odd_rows(odd_docs, no_docs):
    pieces = packing.pack(odd_docs, PATH).collect()
    check_pieces(pieces, 1024)
    assert sum(p.length for p in pieces) == sum(len(ids_of(r.text)) for r in odd_docs.collect())
    assert packing.pack(no_docs, PATH).count() == 0
