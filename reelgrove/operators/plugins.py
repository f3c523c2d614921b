"""Plug-in points for embedding and explanation models, called on Arrow batches."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from reelgrove.functions.expressions import fallback_explanation


def embed_with(df: DataFrame, text: str, model_factory, output: str = "embedding") -> DataFrame:
    """Add vectors from a plugged-in model, loaded once per task.

    ``model_factory()`` returns a function from a list of texts to a list of vectors. A NULL
    text has a NULL vector and is not shown to the model.
    """

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for batch in batches:
            known = batch.notna()
            out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if known.any():
                vectors = model(batch[known].tolist())
                out[known] = pd.Series([[float(x) for x in v] for v in vectors], index=batch.index[known], dtype=object)
            yield out

    return df.withColumn(output, embed(F.col(text)))


def _answers(model, prompts: list) -> list:
    """The model's answers; NULL for what it fails on, which spoils no other prompt."""
    if model is None:
        return [None] * len(prompts)
    try:
        texts = list(model(prompts))
        if len(texts) == len(prompts):
            return texts
    except Exception:
        pass
    if len(prompts) == 1:
        return [None]
    return [text for p in prompts for text in _answers(model, [p])]


def explain_with(
    df: DataFrame, model_factory, messages: str = "messages", fav_genre: str = "fav_genre",
    output: str = "why",
) -> DataFrame:
    """Add a trimmed answer per prompt; the template where the model fails or is not there.

    ``model_factory()`` returns a function from a list of message lists, each message
    with ``role`` and ``content``, to a list of texts.
    """

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            model = model_factory()
        except Exception:
            model = None
        for batch in batches:
            yield pd.Series(_answers(model, list(batch)), dtype=object)

    # Arrow hands structs over as dictionaries; JSON text keeps that independent of
    # session settings.
    answered = df.withColumn(output, F.trim(answer(F.to_json(F.col(messages)))))
    return answered.withColumn(output, F.coalesce(output, fallback_explanation(fav_genre)))
