"""One-permutation MinHash fingerprints from built-in functions only.

Each word shingle is hashed once. The hash's high bits choose one of ``BINS`` bins and each
bin keeps its least hash. An empty bin takes over another's: a fixed sequence of bins is
probed for it, first four by hash of (bin, attempt), then all others in hash order, and the
first that is filled is taken, so that every filled bin is as likely. What is taken is hashed
with the bin's number, so that the copies of one value do not agree by chance all together.
The low ``BITS`` bits of all bins are stored, sixteen bins to a 64-bit number. Unequal hashes agree in those bits by
chance, so likeness is ``(p - c) / (1 - c)`` of the share ``p`` of equal bins, with
``c = 2 ** -BITS``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from reelgrove.llm.common import kept

BINS, BITS, SHINGLE = 256, 4, 5
LANES = 64 // BITS
_BIN_SHIFT = 64 - (BINS - 1).bit_length()
_PROBES = 4
_LANE_LOW = 0x1111111111111111


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, which a plain column is not in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of all runs of ``n`` words; of all words where there are fewer; none without."""
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")

    def runs(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))
        hashed = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]))
        return F.when(F.size(w) > 0, hashed).otherwise(F.array().cast("array<bigint>"))

    return let(words, runs)


def bin_of(x: Column) -> Column:
    return F.shiftrightunsigned(x, _BIN_SHIFT).cast("int")


def filled_bins(hashes: Column) -> Column:
    """The least hash of each bin, NULL for an empty one."""

    def firsts(h: Column) -> Column:
        # In sorted order a bin's hashes are together, its least first.
        least = F.filter(h, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(h, i - 1))))
        return let(least, lambda m: let(F.transform(m, bin_of), lambda b: F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda j: F.get(m, (F.array_position(b, j) - 1).cast("int")),
        )))

    return let(F.sort_array(hashes), firsts)


def densified(bins: Column) -> Column:
    """Every empty bin takes the hash of the first filled one in its probe sequence."""

    def fill(full: Column) -> Column:
        filled = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(full, j).isNotNull())

        def donors(there: Column) -> Column:
            def one(j: Column) -> Column:
                probes = [F.get(full, F.pmod(F.xxhash64(j, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(_PROBES)]
                ranked = F.array_min(F.transform(there, lambda c: F.struct(F.xxhash64(j, c, F.lit(-1)).alias("rank"), c.alias("donor"))))
                taken = F.coalesce(*probes, F.get(full, ranked["donor"]))
                return F.coalesce(F.get(full, j), F.xxhash64(taken, j))

            return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), one)

        return let(filled, donors)

    return let(bins, fill)


def packed(bins: Column) -> Column:
    """Low bits of the bins, ``LANES`` of them in each 64-bit number."""
    low = (1 << BITS) - 1

    def pack(full: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(BINS // LANES - 1)),
            lambda w: F.aggregate(
                F.slice(full, w * LANES + 1, F.lit(LANES)),
                F.lit(0).cast("bigint"),
                lambda a, x: F.shiftleft(a, BITS).bitwiseOR(x.bitwiseAND(F.lit(low))),
            ),
        )

    return let(bins, pack)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint as an array of 64-bit numbers; an empty array without words."""
    return let(
        shingle_hashes(F.coalesce(text, F.lit(""))),
        lambda h: F.when(F.size(h) > 0, packed(densified(filled_bins(h)))).otherwise(
            F.array().cast("array<bigint>")
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two fingerprints, from 0 to 1.

    Two texts without words are alike, one without words is unlike any other.
    """
    equal = F.lit(BINS)
    for w in range(BINS // LANES):
        x = F.get(a, F.lit(w)).bitwiseXOR(F.get(b, F.lit(w)))
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        equal = equal - F.bit_count(folded.bitwiseAND(F.lit(_LANE_LOW)))
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1 - chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0)
        .when((F.size(a) == 0) | (F.size(b) == 0), 0.0)
        .otherwise(corrected)
    )


def as_text(fingerprint_col: Column) -> Column:
    """Hexadecimal digits, sixteen for each number."""
    return F.array_join(F.transform(fingerprint_col, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def next_rows(rows: DataFrame, order: list[Column], key: list[str]) -> DataFrame:
    """Add ``next_<key>`` of the row that follows in the order; the first follows the last.

    Rows are dealt into ranges, numbered in each range, and ranges are linked by their
    first rows, of which there are as many as partitions.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = kept(
        rows.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    inside = Window.partitionBy("range").orderBy(*order)
    numbered = ranged.withColumns(
        {f"next_{k}": F.lead(k).over(inside) for k in key} | {"place": F.row_number().over(inside)}
    )
    heads = numbered.where("place = 1").select("range", F.struct(*key).alias("head"))
    all_heads = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = heads.select(
        "range",
        F.coalesce(
            F.lead("head").over(Window.orderBy("range")), F.first("head").over(all_heads)
        ).alias("head"),
    )
    return numbered.join(following, "range").select(
        *rows.columns,
        *[F.coalesce(f"next_{k}", F.col("head")[k]).alias(f"next_{k}") for k in key],
    )


def compare_with_edit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form, and their likeness.

    In the edited form the last third of the characters is replaced by as many first
    characters (or all) of the next document in descending order of ids; the first follows
    the last. NULL ids come last. Rows with one id and different texts are ordered by a hash
    of the text; rows equal in id and text are one document in this order, and each of them
    gets its result. NULL texts are empty. Other columns are dropped; an empty table gives
    an empty result.

    Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``
    (arrays of 64-bit numbers), ``near_edited``, ``near_next``.
    """
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    ).select("id", F.xxhash64("id").alias("k1"), F.xxhash64("text", F.lit(7)).alias("k2"), "text")
    ids = texts.select("id", "k1", "k2", F.char_length("text").cast("bigint").alias("n_chars"))
    ids = ids.groupBy("id", "k1", "k2", "n_chars").agg(F.count("*").alias("copies"))
    links = kept(next_rows(ids, [F.desc_nulls_last("id"), F.asc("k2")], ["k1", "k2"]), "next")

    # What a document lends to the one before it is all of it that has to move.
    borrowed = (
        texts.select(F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), "text")
        .join(
            links.select("k1", "k2", "next_k1", "next_k2", "n_chars").hint("shuffle_hash"),
            ["next_k1", "next_k2"],
        )
        .select("k1", "k2", "n_chars", F.expr("left(text, int(n_chars div 3))").alias("loan"))
        .dropDuplicates(["k1", "k2"])
    )
    edited = texts.join(borrowed.hint("shuffle_hash"), ["k1", "k2"]).withColumn(
        "edited", F.concat(F.expr("left(text, int(n_chars - n_chars div 3))"), "loan")
    )
    marks = kept(
        edited.select(
            "k1",
            "k2",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("fingerprint"),
            fingerprint(F.col("edited")).alias("edited_fingerprint"),
        ).dropDuplicates(["k1", "k2"]),
        "fingerprints",
    )
    following = marks.select(
        F.col("k1").alias("next_k1"), F.col("k2").alias("next_k2"), F.col("fingerprint").alias("next_fingerprint")
    )
    return (
        links.join(marks, ["k1", "k2"])
        .join(following, ["next_k1", "next_k2"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
        .select(
            F.col("id").alias(id_col),
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        )
    )
