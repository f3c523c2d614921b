import random

import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from reelgrove.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def by_library(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return b"".join(i.to_bytes(4, "little") for i in ids), LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.vocabulary(PATH)


# Characters up to Unicode 15, which the tokenizer's tables know.
OLD = st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"])


@settings(max_examples=300, deadline=None)
@given(st.text(OLD, max_size=40))
def test_any_text_as_the_library(text):
    assert bpe.vocabulary(PATH).encode(text) == by_library(text)[0]


def test_special_tokens_and_final_sigma(vocabulary):
    for text in ("a<|endoftext|>B <|startoftext|>", "ΟΔΟΣ Σ", "İ", "don't WE'LL", "a\u0085b"):
        assert vocabulary.encode(text) == by_library(text)[0]


def test_merge_takes_lowest_rank_first_and_skips_stale_entries(vocabulary):
    """A slow reference: scan for the lowest rank again after every merge."""
    rng = random.Random(3)
    for _ in range(200):
        word = "".join(rng.choice("abcdehinorstü") for _ in range(rng.randint(1, 25)))
        octets = word.encode()
        symbols = [vocabulary.inner[b] for b in octets[:-1]] + [vocabulary.last[octets[-1]]]
        while len(symbols) > 1:
            ranked = [
                (m, i)
                for i in range(len(symbols) - 1)
                if (m := vocabulary.merges.get(symbols[i] << vocabulary.width | symbols[i + 1])) is not None
            ]
            if not ranked:
                break
            m, i = min(ranked)
            symbols[i : i + 2] = [m & (1 << vocabulary.width) - 1]
        assert vocabulary.merge(word) == symbols


def test_cache_is_bounded():
    small = bpe.Vocabulary(PATH, cached_words=10)
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100))
    assert small.encode(text) == by_library(text)[0]
    assert len(small.cached) <= 10


def test_odd_rows(odd_docs, no_docs):
    rows = bpe.encode_decode(odd_docs, PATH).collect()
    given_rows = odd_docs.select("doc_id", "text").collect()
    assert [(r.doc_id, bytes(r.ids), r.decoded) for r in rows] == [
        (g.doc_id, *by_library(g.text)) for g in given_rows
    ]
    assert bpe.encode_decode(no_docs, PATH).count() == 0


def test_documents_as_the_library(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in bpe.encode_decode(docs, PATH).collect():
        assert (bytes(r.ids), r.decoded) == by_library(texts[r.doc_id])
