"""Fill-in-middle: skip lists against the plain pattern, forms, exact restoring."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from reelgrove.llm import infill
from reelgrove.llm.queries import QUERIES

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    """The contract, step by step."""
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ALPHABET = st.text(alphabet=" \t\n\x0b\x0c\r\x1c\x85\xa0ab<PSM>é中😀", max_size=60)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), ALPHABET), min_size=1, max_size=8), st.randoms())
def test_every_rank_is_reached_exactly(texts, rng):
    lists = infill.SkipLists(pa.array(texts, pa.string()))
    tokens = [TOKEN.findall(t or "") for t in texts]
    assert lists.counts.tolist() == [len(t) for t in tokens]
    ranks = [rng.randint(0, len(t)) for t in tokens]
    cuts = lists.cut(np.array(ranks))
    assert cuts.tolist() == [len("".join(t[:r])) for t, r in zip(tokens, ranks)]


def test_lanes_carry_the_sums_of_the_lane_below_and_few_links_are_followed():
    text = " ".join("w" * random.Random(i).randint(1, 9) for i in range(50_000))
    lists = infill.SkipLists(pa.array([text, "a b"]))
    assert 6 <= len(lists.lanes) <= 14
    for (units, widths), (below, chars), picked in zip(lists.lanes[1:], lists.lanes, lists.down):
        ends = [*picked[1:].tolist(), len(below)]
        assert units.tolist() == [below[a:b].sum() for a, b in zip(picked, ends)]
        assert widths.tolist() == [chars[a:b].sum() for a, b in zip(picked, ends)]
    tokens = TOKEN.findall(text)
    for rank in (0, 1, 24_999, 49_999, 50_000):
        assert lists.cut(np.array([rank, 2])).tolist() == [len("".join(tokens[:rank])), 3]


def test_a_slice_of_a_larger_array():
    texts = pa.array(["é é", None, " x", "", "a b c "]).slice(2)
    assert infill.SkipLists(texts).counts.tolist() == [1, 0, 4]


def test_odd_rows(odd_docs, no_docs):
    clash = odd_docs.withColumn("fim_text", F.lit("x")).withColumn("prefix", F.lit("y"))
    out = infill.transform(clash)
    assert set(out.columns) == {*clash.columns, *(f.name for f in infill.FIELDS)}
    again = out.withColumn("back", infill.restored(F.col("fim_text"), F.col("fim_form"))).collect()
    assert len(again) == odd_docs.count()
    for r in again:
        assert (r.fim_units, r.fim_form, r.fim_prefix_chars, r.fim_middle_chars, r.fim_text) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "") and r.prefix == "y"
    assert infill.transform(no_docs).count() == 0


def test_texts_with_marks_stay_plain_and_halves_of_marks_do_no_harm(spark):
    texts = ["a <P> b", "<S>", "x <M", "< P> <<S", "<P", "S>", "<P <S <M > P> S> M>"] * 30
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = infill.transform(docs).withColumn("back", infill.restored(F.col("fim_text"), F.col("fim_form"))).collect()
    assert all(r.back == r.text for r in rows)
    assert {r.fim_form for r in rows} == {"plain", "psm", "spm"}
    assert all(r.fim_form == "plain" for r in rows if any(m in r.text for m in infill.MARKS))


@pytest.mark.parametrize("rate, spm, forms", [(0, 0, {"plain"}), (100, 0, {"psm"}), (100, 100, {"spm"})])
def test_rates(spark, small, rate, spm, forms):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("length(text) > 0")
    assert {r.fim_form for r in infill.transform(docs, rate, spm).select("fim_form").distinct().collect()} == forms


def test_query_as_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op11_infill"](spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n, form, prefix, middle, out = brute(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
