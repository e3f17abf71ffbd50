"""Document fingerprints by winnowing, in Spark's own column functions only.

A text's words (ASCII letters, digits and everything beyond ASCII, in lower case) are hashed; the
hash of ``GRAM`` words in a row is rolled from the words' hashes by rotation and exclusive or. Of
every ``WINDOW`` grams in a row the one with the smallest hash is kept, the rightmost of equal
ones, together with its position (the number of its first word). So two texts that share
``GRAM + WINDOW - 1`` words in a row share a kept gram, and its positions tell where.

Fewer words than a gram make one gram, fewer grams than a window one window; a text without words
has an empty fingerprint. The likeness of two fingerprints is the share of common hashes among all
their hashes, 1 for two empty ones. Null texts count as empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.native import SEPARATORS, let

GRAM = 5
WINDOW = 8
BUCKETS_PER_PARTITION = 4
_LOW = (1 << 31) - 1  # of a kept value: 32 bits of hash above 31 bits of position, counted down


def _rotated(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _shifted(values: Column, by: int) -> Column:
    """The values from number ``by`` on; combining with them pads with nulls at the end."""
    return F.slice(values, by + 1, F.greatest(F.size(values) - by, F.lit(0)))


def _rolled(hashes: Column, gram: int) -> Column:
    """For every word the rolled hash of the gram that begins with it (shorter at the end)."""

    def combined(left: Column, right: Column, by: int, bits: int) -> Column:
        return F.zip_with(
            left, _shifted(right, by), lambda a, b: F.when(b.isNull(), a).otherwise(_rotated(a, bits).bitwiseXOR(b))
        )

    def build(single: Column, done: Column, have: int) -> Column:
        if have == gram:
            return done
        if 2 * have <= gram:
            return let(combined(done, done, have, have), lambda twice: build(single, twice, 2 * have))
        return let(combined(done, single, have, 1), lambda more: build(single, more, have + 1))

    return let(hashes, lambda single: build(single, single, 1))


def _minima(values: Column, window: int) -> Column:
    """The smallest of every ``window`` values in a row (of fewer at the end)."""

    def build(done: Column, have: int) -> Column:
        if have == window:
            return done
        by = min(have, window - have)
        return let(
            F.zip_with(done, _shifted(done, by), lambda a, b: F.least(a, b)), lambda more: build(more, have + by)
        )

    return let(values, lambda single: build(single, 1))


def kept_grams(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """array<bigint>: hash and position of the kept grams of the whole text, from left to right."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")
    hashes = F.transform(words, lambda word: F.xxhash64(word))

    def from_hashes(single: Column) -> Column:
        grams = F.slice(_rolled(single, gram), 1, F.greatest(F.size(single) - (gram - 1), F.lit(1)))
        placed = F.transform(
            grams,
            lambda h, i: F.shiftleft(h.bitwiseAND(F.lit((1 << 32) - 1)), 31).bitwiseOR(F.lit(_LOW) - i.cast("bigint")),
        )
        return let(
            placed,
            lambda v: F.array_distinct(
                F.slice(_minima(v, window), 1, F.greatest(F.size(v) - (window - 1), F.lit(1)))
            ),
        )

    return let(hashes, from_hashes)


def hash_of(kept: Column) -> Column:
    return F.shiftrightunsigned(kept, 31)


def position_of(kept: Column) -> Column:
    return F.lit(_LOW) - kept.bitwiseAND(F.lit(_LOW))


def printed(kept: Column) -> Column:
    """hash:position of the kept grams, comma-joined."""
    return F.array_join(
        F.transform(kept, lambda k: F.concat(F.lower(F.hex(hash_of(k))), F.lit(":"), position_of(k).cast("string"))), ","
    )


def likeness(left: Column, right: Column) -> Column:
    """The share of common hashes of two fingerprints' kept grams, 0 to 1."""

    def hashes(kept: Column) -> Column:
        return F.array_distinct(F.transform(kept, hash_of))

    def share(a: Column, b: Column) -> Column:
        both = F.size(F.array_intersect(a, b))
        total = F.size(a) + F.size(b) - both
        return F.when(total == 0, F.lit(1.0)).otherwise(both / total)

    return let(hashes(left), lambda a: let(hashes(right), lambda b: share(a, b)))


def with_next(docs: DataFrame, carried: dict[str, Column]) -> DataFrame:
    """key, text and ``carried`` of every row, and those of the next row by key as ``next_*``.

    Rows are ordered by (doc_id, text), null ids as the smallest; after the last comes the first.
    Ranges of ids, a few for each shuffle partition, are cut at approximate quantiles; each range
    goes to one task together with the first row of the following range. So the texts are
    shuffled once, whatever the number of rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    many = BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / many for i in range(1, many)]
    bounds = rows.agg(F.percentile_approx("key", shares, 20 * many).alias("b")).first()["b"]
    bounds = F.array([F.lit(b).cast("bigint") for b in sorted(set(bounds or []))] or [F.lit(2**63 - 1)])
    # One row more than its range has: the extra one stands behind the others.
    ranged = rows.withColumn("range", F.size(F.filter(bounds, lambda b: b <= F.col("key"))))
    first = ranged.groupBy("range").agg(F.min("key").alias("key"))  # no more rows than ranges
    around = Window.orderBy("range")
    first = first.select(
        "key", F.coalesce(F.lag("range").over(around), F.max("range").over(Window.partitionBy())).alias("before")
    )
    heads = (
        rows.join(F.broadcast(first), "key").groupBy("key", "before").agg(F.min(F.struct("text", "doc_id")).alias("h"))
        .select("h.doc_id", "key", "h.text", F.col("before").alias("range"), F.lit(True).alias("extra"))
    )
    dealt = ranged.withColumn("extra", F.lit(False)).unionByName(heads).repartition("range")
    dealt = dealt.withColumns(carried)
    order = Window.partitionBy("range").orderBy("extra", "key", "text")
    found = dealt.withColumns({f"next_{name}": F.lead(name).over(order) for name in ("text", *carried)})
    return found.where(~F.col("extra")).drop("range", "extra", "key")


def edited(text: Column, following: Column) -> Column:
    """The last half (rounded down) of the code points replaced by the first as many of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: its fingerprint and that of its edited text.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hash:position, comma-joined),
    near_edited, near_next (likeness to the edited text and to the next document).
    """
    pairs = with_next(docs, {"kept": kept_grams(F.col("text"))})
    pairs = pairs.withColumn("edited", edited(F.col("text"), F.col("next_text"))).withColumn(
        "edited_kept", kept_grams(F.col("edited"))
    )
    return pairs.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("kept")).alias("fingerprint"),
        printed(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("edited_kept")).alias("near_edited"),
        likeness(F.col("kept"), F.col("next_kept")).alias("near_next"),
    )
