"""Named queries that apply each operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reelgrove.llm import bpe, chat, dualtree, fingerprints, infill, langid, licenses, mtree, ngram_join, packing, pii, sharding, wrappers
from reelgrove.llm.common import kept, table
from reelgrove.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(run: Query) -> Query:
    """Register a query under its function's name; workers get the package first."""

    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = shipped
    return run


@query
def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, licenses.train(licenses.prose_sample(docs)))
    known = F.filter("license_notices", lambda n: n["license"] != licenses.UNKNOWN)
    surest = F.array_max(
        F.transform(
            F.when(F.size(known) > 0, known).otherwise(F.col("license_notices")),
            lambda n: F.struct(n["probability"], (-n["paragraph"]).alias("place"), n["license"], n["family"], n["similarity"]),
        )
    )
    return found.select("doc_id", F.size("license_notices").alias("n_notices"), surest.alias("n")).select(
        "doc_id",
        F.coalesce("n.license", F.lit(licenses.NONE)).alias("license"),
        F.col("n.family").alias("family"),
        "n_notices",
        F.round("n.probability", 4).alias("probability"),
        F.round("n.similarity", 4).alias("similarity"),
        (-F.col("n.place")).alias("paragraph"),
    )


@query
def op2_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = table(spark, sf_dir, "embeddings").where(finite).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 64)).alias("vector")
    )
    return mtree.top_k(vectors, "vec_id % 20 = 0", k=20)


ORACLE["op2_mtree"] = """
WITH v AS (
    SELECT row_number() OVER () AS rn, vec_id,
           [CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, q.rn, c.vec_id, c.rn AS crn, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.rn <> c.rn
    WHERE q.vec_id % 20 = 0
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id, crn) AS INTEGER) AS rank,
           vec_id, score
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query
def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = fingerprints.compare_with_edit(table(spark, sf_dir, "documents"))
    return marked.withColumns(
        {c: fingerprints.as_text(F.col(c)) for c in ("fingerprint", "edited_fingerprint")}
    )


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window"
    )


def conversations_and_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table and one conversation whose texts look like the template."""
    told = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", told), (-7, 1, "assistant", told)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    return table(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe)


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.expand(conversations_and_probe(spark, sf_dir)))


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("copies"),
    )
    placed = sharding.shard(rows, "size", ["copies"], ["doc_id"], shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


HELD_OUT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0"


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(f"not ({HELD_OUT})"))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.size("lang_spans").alias("n_spans"),
    )


@query
def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = ngram_join.near_classes(table(spark, sf_dir, "documents"), threshold=0.8, n=5)
    return near.select("doc_id", "class_id", "n_links", "copy_of")


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, pii.key_of(spark)).select(
        "doc_id",
        "text",
        F.size("pii_spans").alias("n_pii"),
        F.array_sort(F.array_distinct("pii_spans.kind")).alias("kinds"),
    )


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text"), rate=50, spm=80, seed=42)
    back = infill.restored(F.col("fim_text"), F.col("fim_form"))
    return cut.select(
        "doc_id",
        F.col("fim_units").alias("n"),
        F.col("fim_form").alias("form"),
        F.col("fim_prefix_chars").alias("prefix_chars"),
        F.col("fim_middle_chars").alias("middle_chars"),
        F.sha2(F.col("fim_text").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


@query
def op12_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = wrappers.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), output="text")
    return read.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    coded, books = dualtree.quantise(vectors, parts=16, entries=64, rounds=2, scale=256)
    digest = hashlib.sha256(dualtree.codebook_text(books).encode()).hexdigest()
    summed = dualtree.with_group_error(kept(coded, "vector_codes"), "label", "label_error")
    return summed.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def _nearest(book: str) -> str:
    """Each part's nearest entry and its distance; products of whole numbers are exact."""
    return f"""
    SELECT rn, p, c, best % 64 AS e, best // 64 AS d FROM (
        SELECT x.rn, x.p, any_value(x.c) AS c,
               min(CAST(list_dot_product(x.c, x.c) - 2 * list_dot_product(x.c, b.c) + list_dot_product(b.c, b.c) AS BIGINT) * 64 + b.e) AS best
        FROM parts x JOIN {book} b ON x.p = b.p GROUP BY x.rn, x.p)"""


def _moved(near: str, book: str) -> str:
    """Entries after a round: floored means, unused entries as they were."""
    return f"""
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
        SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS DOUBLE) ORDER BY i) AS c FROM (
            SELECT p, e, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
            FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM {near}) GROUP BY p, e, i)
        GROUP BY p, e) m ON b.p = m.p AND b.e = m.e"""


ORACLE["op13_vector_codes"] = f"""
WITH kept AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS rn, vec_id, label,
           [CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
    SELECT rn, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS c FROM kept, range(16) AS t(p)
), book0 AS (SELECT p, rn - 1 AS e, c FROM parts WHERE rn <= 64),
near1 AS ({_nearest("book0")}), book1 AS ({_moved("near1", "book0")}),
near2 AS ({_nearest("book1")}), book2 AS ({_moved("near2", "book1")}),
near3 AS ({_nearest("book2")}),
codes AS (
    SELECT rn, string_agg(lower(format('{{:02x}}', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near3 GROUP BY rn
), digest AS (
    SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
    FROM (SELECT p, e, CAST(unnest(c) AS BIGINT) AS x, generate_subscripts(c, 1) AS i FROM book2)
)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
       (SELECT codebooks_sha256 FROM digest) AS codebooks_sha256
FROM kept k JOIN codes c ON k.rn = c.rn
"""
