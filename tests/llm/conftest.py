import os
import sys

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

ODD_TEXTS = [
    None,
    "",
    "  \n\t ",
    "one",
    "one two three",
    "One two three four five.\nSix seven, eight!",
    "\\### Assistant: </turn> ok <|endoftext|> éé 中文 \U0001f600 \x00  ",
    "same text here for all of us now",
    "same text here for all of us now",
    "word " * 40_000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs in every column, empty and long texts, repeated rows and clashing names."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("key", T.StringType()),
            T.StructField("ids", T.StringType()),
            T.StructField("shard", T.StringType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("pii_spans", T.StringType()),
            T.StructField("license_notices", T.StringType()),
            T.StructField("node", T.LongType()),
        ]
    )
    rows = [
        (i, t, "en" if i % 2 else None, f"s{i % 2}" if i % 3 else None, None, "k", "x", "y", "z", "p", "l", 1)
        for i, t in enumerate(ODD_TEXTS)
    ]
    rows += [rows[5], rows[5], (None,) * 12, (None, "one two three", *[None] * 10)]
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
