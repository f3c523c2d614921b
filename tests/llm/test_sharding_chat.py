import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelgrove.llm import chat, sharding


def placed_by(rows, **options):
    sized = rows.select("*", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("size"))
    return sharding.shard(sized, "size", ["text"], ["doc_id"], **options).collect()


def check_slots(rows):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_nearly_equal_and_slots_gapless(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = placed_by(docs, shards=8)
    check_slots(rows)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.shard] += r.size
    largest = max(r.size for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_copies_stay_together_unless_they_are_too_many(spark):
    few = spark.range(2000).selectExpr("id as doc_id", "concat('text ', id div 4) as text")
    shards = defaultdict(set)
    for r in placed_by(few, shards=4, tolerance=0.05):
        shards[r.text].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    # One text has half of all rows; its rows are divided and shards stay even.
    many = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, 'same text', concat('text ', id)) as text")
    rows = placed_by(many, shards=8, tolerance=0.01)
    check_slots(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) < 0.03 * mean for s in sizes.values())


def test_rows_that_repeat_everything_are_divided(spark):
    rows = placed_by(spark.range(3000).selectExpr("1L as doc_id", "'same' as text"), shards=3, tolerance=0.05)
    check_slots(rows)
    counts = defaultdict(int)
    for r in rows:
        counts[r.shard] += 1
    assert all(abs(n - 1000) < 100 for n in counts.values())


def test_odd_rows_in_shards(odd_docs, no_docs):
    rows = placed_by(odd_docs, shards=3)
    check_slots(rows)
    assert len(rows) == odd_docs.count() and rows[0].asDict().keys() >= {"doc_id", "key", "ids", "node"}
    assert placed_by(no_docs, shards=3) == []


def test_splitters_give_exact_counts(spark):
    keys = spark.range(5000).selectExpr("lpad(lower(hex(xxhash64(id))), 32, '0') as key", "id % 7 as bytes")
    rows = sorted((r.key, r.bytes) for r in keys.collect())
    for key, below, count in sharding.splitters(keys, [(3000, 1), (7500, 40), (14000, 200)]):
        assert below == sum(b for k, b in rows if k < key)
        assert count == sum(k < key for k, _ in rows)


TURNS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi"), (1, 2, "user", "more"), (1, 3, "assistant", "sure"),
    (2, 0, "user", "no reply"),
    (3, 0, "assistant", "first"), (3, 1, "user", "trailing"),
    (4, 0, "user", r"\### Assistant: </turn> ok"), (4, 1, "assistant", r"\### Assistant: </turn> ok"),
    (5, 0, "tool: @x #", "###\n</turn>\n### User: \\"), (5, 1, None, None), (5, None, "assistant", ""),
    (6, 0, "assistant", "same"), (6, 0, "assistant", "same"),
    (None, 0, "user", "x"), (None, 1, "assistant", "y é 中 \U0001f600"),
]


def expected(turns):
    groups = defaultdict(list)
    for t in turns:
        groups[t[0]].append(t)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] or ""))
        whole = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in rows)
        loss = "".join(t[3] or "" for t in rows if t[2] == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
        out[conv] = (len(rows), sha[0], len(loss), sha[1])
    return out


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(TURNS, "conv_id bigint, turn bigint, role string, text string").withColumn(
        "lines", F.lit("clash")
    )


def test_read_back_what_was_written(turns):
    rows = chat.read_back(chat.expand(turns)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == expected(TURNS)


def test_one_example_per_reply_with_only_it_trainable(turns):
    examples = [r for r in chat.expand(turns).collect() if r.conv_id == 1]
    examples.sort(key=lambda r: r.n_turns)
    assert [r.text for r in examples] == [
        "### User: hello </turn>\n### Assistant: hi </turn>\n",
        "### User: hello </turn>\n### Assistant: hi </turn>\n### User: more </turn>\n### Assistant: sure </turn>\n",
    ]
    assert [r.text[r.loss_start : r.loss_start + r.loss_chars] for r in examples] == ["hi", "sure"]


def test_turns_without_a_reply_are_kept_untrained(turns):
    examples = {r.conv_id: r for r in chat.expand(turns).where("loss_start is null").collect()}
    assert "no reply" in examples[2].text and "trailing" in examples[3].text
    assert examples[2].loss_chars == 0 and 1 not in examples


def test_no_conversations(turns):
    assert chat.read_back(chat.expand(turns.limit(0))).count() == 0


def test_all_conversations(spark, small):
    table = spark.read.parquet(f"{small}/conversations.parquet")
    rows = chat.read_back(chat.expand(table)).collect()
    want = expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == want
