"""The registered queries and the pipeline over whole tables."""

import json

import pytest
from oracle import differences

import corpus_pipeline
from reelgrove.llm.queries import ORACLE, QUERIES


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, small, name):
    assert differences(QUERIES[name](spark, small), ORACLE[name], small) == []


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in ("op1", "op3", "op6", "op7", "op8", "op9", "op10", "op11")))
def test_one_row_per_document(spark, small, name):
    ids = sorted(r.doc_id for r in QUERIES[name](spark, small).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id").collect())


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == columns, name
        counts.append(docs.count())
    assert counts[1] == counts[0] > counts[2] == counts[3]
    # Near copies go: no two of the kept texts have the same words.
    assert docs.select("text").distinct().count() == counts[3]
    pieces = corpus_pipeline.run(spark, small)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert json.loads(pieces.schema.json())["fields"]


def test_documents_without_language_go(spark, small, odd_docs):
    rows = corpus_pipeline.language(spark, odd_docs, small)
    assert rows.columns == odd_docs.columns
    assert not {0, 1, 2} & {r.doc_id for r in rows.collect()}


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_on_nothing(spark, small, no_docs, stage):
    assert stage(spark, no_docs, small).count() == 0


def test_documents_in_other_scripts_go_and_mixed_ones_stay(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    texts = ["the cat and the dog " * 5, "le chat et le chien " * 5, "这是一个完全不同的文字系统里的文本", "the cat 这是 and the dog", "это другой текст"]
    docs = spark.createDataFrame([(i, t, ["en", "fr"][i] if i < 2 else None, None, None) for i, t in enumerate(texts)], schema)
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, docs, small).collect()}
    assert set(kept) == {0, 1, 3} and kept[3] == "en"


def test_without_labels_documents_with_letters_stay(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    docs = spark.createDataFrame([(1, "some text", None, None, None), (2, "123 ...", None, None, None), (3, None, None, None, None), (4, "текст", None, None, None)], schema)
    out = corpus_pipeline.language(spark, docs, small)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 4]


def test_private_data_is_masked_in_the_stage(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    docs = spark.createDataFrame([(1, "write to jane.doe@mail.com on 19/01/2000", "en", "s", 3), (2, "nothing here", "en", "s", 12), (3, None, None, None, None)], schema)
    rows = {r.doc_id: r for r in corpus_pipeline.private_data(spark, docs, small).collect()}
    assert "jane" not in rows[1].text and "19/01/2000" not in rows[1].text and rows[1].n_chars == len(rows[1].text)
    assert rows[2].text == "nothing here" and rows[3].text is None
