"""Prefix-target expansion of conversations into training examples.

Every assistant turn becomes an example of its own: all turns before it are context, only
its text is trainable. A turn is written as ``### Assistant: ``, the text, `` </turn>`` and a
line end. In texts and role names a backslash goes before every backslash, ``#`` and ``<``
(in role names also ``:``, ``@`` and spaces), so no control string can occur inside one and the writing is
undone by dropping those backslashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPENING, AFTER_ROLE, CLOSING = "### ", ": ", " </turn>\n"
NAMES = {"user": "User", "assistant": "Assistant", "system": "System"}
TARGET = "assistant"


def escaped(text: Column, also: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{also}])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def written_role(role: Column) -> Column:
    """Known roles by their names; any other as ``@`` and its text, a NULL role as ``@@``."""
    out = F.when(role.isNull(), "@@")
    for known, name in NAMES.items():
        out = out.when(role == known, name)
    return out.otherwise(F.concat(F.lit("@"), escaped(role, ":@ ")))


def read_role(written: Column) -> Column:
    out = F.when(written == "@@", F.lit(None).cast("string"))
    for known, name in NAMES.items():
        out = out.when(written == name, known)
    return out.otherwise(unescaped(F.substring(written, 2, 1 << 30)))


def expand(turns: DataFrame) -> DataFrame:
    """One row per example: ``conv_id``, ``example``, ``n_turns``, ``text``, ``loss_start``, ``loss_chars``.

    ``example`` counts a conversation's examples from 0, ``n_turns`` the turns in its text.
    The trainable part is ``loss_chars`` characters of ``text`` from ``loss_start`` (from 0).
    Turns after the last reply, and conversations without one, give one more example with
    no trainable part, so that no turn is lost; ``loss_start`` is NULL there.

    Turns are ordered by ``turn`` (NULL first), equal numbers by role and text; repeated
    rows are kept. A NULL text is empty, a NULL ``conv_id`` is one conversation. Other
    columns are dropped; an empty table gives an empty result. One shuffle brings a
    conversation's turns together, as its last example holds them all in one text.
    """
    role = F.col("role")
    lines = turns.select(
        "conv_id",
        F.struct(
            F.col("turn").cast("bigint").alias("turn"),
            role,
            F.concat(F.lit(OPENING), written_role(role), F.lit(AFTER_ROLE)).alias("head"),
            escaped(F.coalesce("text", F.lit(""))).alias("body"),
        ).alias("line"),
    )
    gathered = lines.groupBy("conv_id").agg(F.sort_array(F.collect_list("line")).alias("lines"))
    whole = gathered.select(
        "conv_id",
        F.transform("lines", lambda x: x["role"].eqNullSafe(TARGET)).alias("is_target"),
        F.transform("lines", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSING))).alias("written"),
        F.transform("lines", lambda x: F.char_length(x["body"])).alias("body_chars"),
    )
    last = F.size("written") - 1
    return (
        whole.select("*", F.posexplode("is_target").alias("at", "target"))
        .where(F.col("target") | (F.col("at") == last))
        .select(
            "conv_id",
            (F.col("at") + 1).cast("bigint").alias("n_turns"),
            F.array_join(F.slice("written", 1, F.col("at") + 1), "").alias("text"),
            F.when(F.col("target"), F.get("body_chars", F.col("at"))).cast("bigint").alias("loss_chars"),
        )
        .withColumn(
            "loss_start",
            F.when(
                F.col("loss_chars").isNotNull(),
                F.char_length("text") - F.col("loss_chars") - len(CLOSING),
            ).cast("bigint"),
        )
        .withColumn("loss_chars", F.coalesce("loss_chars", F.lit(0).cast("bigint")))
    )


def read_back(examples: DataFrame) -> DataFrame:
    """One row per conversation, all of it read from the formatted texts and their masks.

    ``turns_sha256`` and ``n_turns`` come from the longest example, ``loss_chars`` and
    ``loss_sha256`` from the trainable parts of all examples in order.
    """
    reply = unescaped(F.expr("substring(text, int(loss_start + 1), int(loss_chars))"))
    per_example = examples.select(
        "conv_id",
        "n_turns",
        F.char_length("text").cast("bigint").alias("chars"),
        "text",
        F.when(F.col("loss_start").isNotNull(), reply).alias("reply"),
    )
    per_conv = per_example.groupBy("conv_id").agg(
        F.max_by("text", "n_turns").alias("text"),
        F.sort_array(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("n_turns", "reply")))).alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    written = F.filter(F.split("text", CLOSING), lambda x: x != "")

    def one_turn(x: Column) -> Column:
        head = F.substring_index(x, AFTER_ROLE, 1)
        role = read_role(F.substring(head, len(OPENING) + 1, 1 << 30))
        body = F.substring(x, F.char_length(head) + len(AFTER_ROLE) + 1, F.char_length(x))
        return F.concat(F.coalesce(role, F.lit("")), F.lit("\n"), unescaped(body), F.lit("\n"))

    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    return per_conv.select(
        "conv_id",
        F.size(written).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform(written, one_turn), "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
