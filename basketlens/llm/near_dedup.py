"""Near-duplicates by Order MinHash, verified by banded alignment.

A document's shingles are its runs of five words, labelled with how often each has come up before
in the text. Each of ``ROWS`` rows of the sketch takes the ``PICKS`` labelled shingles with the smallest hashes of
that row and keeps them in the order of the text, so a row agrees only where texts have the same
shingles in the same order. Two documents that agree in a row are candidates. They are linked if
the longest common subsequence of their shingles, found by an alignment within the band that the threshold
allows, is at least ``SIMILARITY`` of all their shingles (those of both counted once). Linked documents are one class, as
are documents linked through others.

At a similarity of 0.8 a row of long texts agrees with probability 0.33, at least one of 32 rows with 0.999997;
at 0.3, as where a third of two texts is a common passage, a row agrees with 0.002. The fewer shingles, the less
often a row agrees, and where one text has fewer than ``PICKS`` it never does. So texts of up to ``SHORT`` shingles
do not depend on the sketch: whatever can be near them shares one of their rarest shingles with them
(:func:`_rarest`, :func:`_through_rarest`), and none of their pairs is lost.

Documents with equal words are one text; only one of them is compared. To join groups of many
near-copies without comparing all their pairs, every text is first compared with one text, the hub: of all
texts in its buckets that in the largest buckets altogether, and then, where the hub is itself linked to
others, with the best connected one of that class. What this leaves apart is settled exactly, without
loss among the candidates:

* Two texts close to one hub (``CLOSE``) have their shingles in common either through the hub's or
  through some that both have added. A bound from the counts alone (no more can be in common through the
  hub than either has of it) tells which pairs can reach the threshold without added ones
  (:func:`_through_the_hub`); all others must share one of the rarest of their added shingles, by
  prefix filtering (:func:`_through_added`).
* Pairs of one bucket without a common hub are compared directly (:func:`_without_common_hub`).

The classes are found by hooking to smaller neighbours and pointer jumping over tables in the
shared folder. Nothing but counts reaches the driver.

A text's words are those of its lower case (ASCII letters, digits and everything beyond ASCII). Fewer words than a
shingle make one shingle. Texts without words are compared as they are; a null text
counts as an empty one. What is compared and joined are texts, not ids: rows that share a doc_id, or have none, fall
together only if their texts are near. A class is named by its smallest doc_id, a null one counting as the smallest,
so classes that share an id or hold a null one may have the same name.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from basketlens.llm.common import free_name
from basketlens.operators.staging import staged

SHINGLE = 5
SIMILARITY = 0.8
ROWS = 32
PICKS = 5
SHORT = 40  # shingles up to which a text's pairs are found without the sketch
CLOSE = 0.4  # share of common shingles from which a text counts as close to its hub

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_WORD = np.zeros(256, dtype=bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True
_ROW_STEP = np.random.default_rng(11).integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ORDER_STEP = np.random.default_rng(12).integers(1, 1 << 63, PICKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * _MIX
    return value ^ (value >> np.uint64(29))


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word of the whole text, in order."""
    raw = np.frombuffer((text or "").lower().encode(), dtype=np.uint8)
    inside = _WORD[raw]
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    # Bytes weighted by their place in the word: the sum of a word comes from cumulated sums.
    at = np.arange(len(raw))
    begin = np.zeros(len(raw), dtype=np.int64)
    begin[start] = start
    place = at - np.maximum.accumulate(begin)
    weight = _mixed((place.astype(np.uint64) + np.uint64(1)) * _STEP) | np.uint64(1)
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * weight * inside)))
    return _mixed(total[stop] - total[start] + (stop - start).astype(np.uint64) * _STEP)


def shingles(words: np.ndarray) -> np.ndarray:
    """A hash of every five words in a row; one of all words if there are fewer."""
    size = min(SHINGLE, len(words))
    if not size:
        return words
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = out * _STEP + words[i : i + len(out)]
    return _mixed(out + np.uint64(size))


def labelled(grams: np.ndarray) -> np.ndarray:
    """The shingles mixed with how often each has come up before."""
    order = np.argsort(grams, kind="stable")
    sorted_ = grams[order]
    new = np.concatenate(([True], sorted_[1:] != sorted_[:-1]))
    begin = np.flatnonzero(new)
    count = np.empty(len(grams), dtype=np.uint64)
    count[order] = np.arange(len(grams)) - begin[np.cumsum(new) - 1]
    return _mixed(grams + count * _STEP)


def sketch(words: np.ndarray) -> np.ndarray:
    """``ROWS`` numbers, each from the picked shingles of a row in the order of the text."""
    if not len(words):
        return np.zeros(ROWS, dtype=np.int64)
    grams = labelled(shingles(words))
    picks = min(PICKS, len(grams))
    out = np.empty(ROWS, dtype=np.uint64)
    together = max(1, (1 << 18) // len(grams))  # rows at a time, for bounded memory
    for begin in range(0, ROWS, together):
        step = _ROW_STEP[begin : begin + together, None]
        at = np.argpartition(_mixed(grams[None, :] * step), picks - 1, axis=1)[:, :picks]
        at.sort(axis=1)
        out[begin : begin + together] = _mixed((grams[at] * _ORDER_STEP[:picks]).sum(axis=1) + step[:, 0])
    return out.view(np.int64)


def banded_lcs(left: list, right: list, band: int) -> int:
    """The longest common subsequence that leaves the diagonal by at most ``band``.

    The cells of a row of the alignment are the bits of a number (a zero bit: one more in common
    than in the cell before); the number holds the band only.
    """
    if len(left) > len(right):
        left, right = right, left
    begin = 0
    while begin < len(left) and left[begin] == right[begin]:
        begin += 1
    end = 0
    while end < len(left) - begin and left[-1 - end] == right[-1 - end]:
        end += 1
    left, right = left[begin : len(left) - end], right[begin : len(right) - end]
    if not left:
        return begin + end
    places: dict = {}
    for i, value in enumerate(left):
        places.setdefault(value, []).append(i)
    many = len(left)
    low, high, row, done = 0, 0, 0, 0
    for j, value in enumerate(right):
        reach = min(many, j + band + 1)
        if reach > high:
            row |= ((1 << (reach - high)) - 1) << (high - low)
            high = reach
        while low < min(many, j - band):
            done += not row & 1
            row >>= 1
            low += 1
        hit = 0
        for i in places.get(value, ()):
            if low <= i < high:
                hit |= 1 << (i - low)
        if hit:
            both = row & hit
            row = ((row + both) | (row - both)) & ((1 << (high - low)) - 1)
    return begin + end + done + (high - low) - row.bit_count()


def _needed(total: int, least: float) -> float:
    """How many of all the shingles of two texts must be in common; rounding must not raise it above a whole number."""
    return least / (1 + least) * total - 1e-9


def similar(left: np.ndarray, right: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the shingles of two texts' words have ``least`` of all in common, in order."""
    a, b = shingles(left).tolist(), shingles(right).tolist()
    total = len(a) + len(b)
    if not a or not b:
        return False
    need = _needed(total, least)
    if min(len(a), len(b)) < need or (Counter(a) & Counter(b)).total() < need:
        return False
    return banded_lcs(a, b, int(total - 2 * need) + 1) >= need


# ---- Spark ----------------------------------------------------------------------------------


def _identity() -> tuple[Column, Column]:
    """doc (doc_id, null as the smallest) and text_key: rows that have both in common hold the same text."""
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    return doc.alias("doc"), F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("text_key")


def sketches(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, doc, text_key, words_key, sketch, grams of every row.

    grams: the labelled shingles of a text short enough to be near one of ``SHORT`` shingles, else null.
    """
    most = int(SHORT / least + 1e-6)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, grams = [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words = word_hashes(text)
                raw = b"w" + words.tobytes() if len(words) else b"t" + text.encode()
                keys.append(hashlib.blake2b(raw, digest_size=16).digest())
                rows.append(sketch(words) if len(words) else [])
                short = 0 < len(words) < most + SHINGLE
                grams.append(labelled(shingles(words)).view(np.int64) if short else None)
            made = [pa.array(keys, pa.binary()), *(pa.array(x, pa.list_(pa.int64())) for x in (rows, grams))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "doc", "text_key")), *made],
                ["doc_id", "doc", "text_key", "words_key", "sketch", "grams"],
            )

    kept = docs.select("doc_id", *_identity(), "text")
    kind = StructType(kept.schema.fields[:3]).add("words_key", "binary")
    return kept.mapInArrow(work, kind.add("sketch", ArrayType(LongType())).add("grams", ArrayType(LongType())))


def _texts(rows: DataFrame) -> DataFrame:
    """words_key, node (its number), first (smallest doc and text_key of its rows), sketch, grams of every different text."""
    texts = rows.groupBy("words_key").agg(
        F.min(F.struct("doc", "text_key")).alias("first"),
        F.any_value("sketch").alias("sketch"),
        F.any_value("grams").alias("grams"),
    )
    # 56 bits of the key, then a place among the texts that share them (nearly always one text).
    head = F.conv(F.hex(F.substring("words_key", 1, 7)), 16, 10).cast("bigint")
    place = F.row_number().over(Window.partitionBy("head").orderBy("words_key")) - 1
    return texts.withColumn("head", head).withColumn("node", F.shiftleft("head", 7) + place).drop("head")


def _word_lists(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, words (hashes as bytes) of the wanted texts (node, doc, text_key)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [word_hashes(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(rows, pa.binary())], ["node", "words"])

    on = ["doc", "text_key"]
    texts = docs.select(*_identity(), "text").join(wanted, on).dropDuplicates(on).select("node", "text")
    return texts.mapInArrow(work, "node bigint, words binary")


def compared(pairs: DataFrame, lists: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Of each pair (a, b): linked; n, common (labelled shingles of a, and those b has too); close
    (whether ``CLOSE`` of all are common), and if so, added: those of a that b lacks."""
    kind = "a bigint, b bigint, linked boolean, n int, common int, close boolean, added array<bigint>"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                left = np.frombuffer(x.as_py(), dtype=np.uint64)
                right = np.frombuffer(y.as_py(), dtype=np.uint64)
                one, two = labelled(shingles(left)), labelled(shingles(right))
                both = len(np.intersect1d(one, two, assume_unique=True))
                total = len(one) + len(two)
                close = both >= CLOSE * (total - both)
                added = np.setdiff1d(one, two, assume_unique=True).view(np.int64).tolist() if close else []
                linked = both >= _needed(total, least) and similar(left, right, least)
                out.append((linked, len(one), both, close, added))
            kinds = (pa.bool_(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64()))
            made = [pa.array([row[i] for row in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *made], ["a", "b", "linked", "n", "common", "close", "added"]
            )

    one = lists.select(F.col("node").alias("a"), F.col("words").alias("left"))
    two = lists.select(F.col("node").alias("b"), F.col("words").alias("right"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right").mapInArrow(work, kind)


def components(links: DataFrame) -> DataFrame:
    """node, root (its smallest connected node) of all nodes in ``links`` (a, b)."""
    edges = staged(links.select("a", "b").where("a <> b").distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    found = staged(nodes.select("node", F.col("node").alias("root")))
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("root"), F.col("b").alias("to")).union(edges.select("b", "a"))
        parent = both.groupBy("root").agg(F.min("to").alias("to"))
        parent = staged(parent.select("root", F.least("root", "to").alias("to")))
        while True:  # jump until every pointer ends at a root
            up = parent.select(F.col("root").alias("to"), F.col("to").alias("further"))
            jumped = staged(parent.join(up, "to", "left").select("root", F.coalesce("further", "to").alias("to"), (F.col("further") < F.col("to")).alias("moved")))
            parent = jumped.select("root", "to")
            if jumped.where("moved").isEmpty():
                break
        found = staged(found.join(parent, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        a = parent.select(F.col("root").alias("a"), F.col("to").alias("a2"))
        b = parent.select(F.col("root").alias("b"), F.col("to").alias("b2"))
        edges = staged(edges.join(a, "a").join(b, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b").distinct())
    # A root need not be the smallest node of what was hooked to it in several turns.
    smallest = found.groupBy("root").agg(F.min("node").alias("least"))
    return staged(found.join(smallest, "root").select("node", F.col("least").alias("root")))


def _rooted(df: DataFrame, roots: DataFrame) -> DataFrame:
    """``df`` with the root of each node, the node itself where nothing is linked to it."""
    return df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _apart(one: DataFrame, two: DataFrame, on: list[str], also: Column) -> DataFrame:
    """The pairs (a, b) of nodes in different classes with equal ``on``, once each."""
    left = one.select(*on, *[F.col(c).alias(f"{c}_a") for c in one.columns if c not in on])
    right = two.select(*on, *[F.col(c).alias(f"{c}_b") for c in two.columns if c not in on])
    met = left.join(right, on).where((F.col("root_a") != F.col("root_b")) & also)
    return met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _minority(rows: DataFrame, on: list[str], label: str) -> DataFrame:
    """The rows whose label is not the most frequent one among those with equal ``on``.

    A pair with different labels has at least one such row.
    """
    counts = rows.groupBy(*on, label).agg(F.count("*").alias("many"))
    most = counts.groupBy(*on).agg(F.max(F.struct("many", label)).alias("most"), F.count("*").alias("labels"))
    most = most.where("labels > 1").select(*on, F.col(f"most.{label}").alias("most"))
    return rows.join(most, on).where(F.col(label) != F.col("most")).drop("most")


def _without_common_hub(entries: DataFrame, near: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of a bucket that are not both close to one hub."""
    label = near.where("close").select("node", F.col("top").alias("label"))
    rows = entries.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = staged(_rooted(rows.select("bucket", "node", "label"), roots))
    return _apart(_minority(rows, ["bucket"], "label"), rows, ["bucket"], F.col("label_a") != F.col("label_b"))


def _through_the_hub(entries: DataFrame, near: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Pairs of a bucket close to one hub that may have enough in common through it alone."""
    rich = near.where(F.col("close") & (F.col("common") >= least * F.col("n") - 1e-6))
    rows = entries.select("bucket", "node").join(rich.select("node", "top", "n", "common"), "node")
    rows = staged(_rooted(rows, roots))
    need = least / (1 + least) * (F.col("n_a") + F.col("n_b")) - 1e-6
    on = ["bucket", "top"]
    return _apart(_minority(rows, on, "root"), rows, on, F.least("common_a", "common_b") >= need)


def _through_added(near: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Pairs close to one hub that share one of their rarest added shingles.

    A text of n shingles needs at least ``least`` * n in common with any other; what it has not in
    common with the hub must come from the shared added ones, so all but that many less one, rarest
    first, are enough to meet in.
    """
    each = _rooted(near.where("close").select("node", "top", "n", "common", F.explode("added").alias("gram")), roots)
    counts = each.groupBy("top", "gram").agg(F.count("*").alias("many")).where("many > 1")
    each = staged(each.join(staged(counts), ["top", "gram"]))
    order = Window.partitionBy("node").orderBy(F.desc("many"), F.desc("gram"))
    spare = F.greatest(F.ceil(least * F.col("n") - 1e-6) - F.col("common"), F.lit(1))
    # Numbered from the most frequent one, so the last ``spare`` - 1 to be left out come first.
    prefix = each.withColumn("place", F.row_number().over(order)).where(F.col("place") >= spare)
    prefix = prefix.select("top", "gram", "node", "root", "n", "common", "place")
    # Where this is the rarest added shingle that two texts share, they share no more than the smaller place of them.
    need = least / (1 + least) * (F.col("n_a") + F.col("n_b")) - 1e-6
    enough = F.least("common_a", "common_b") + F.least("place_a", "place_b") >= need
    prefix, on = staged(prefix), ["top", "gram"]
    return _apart(_minority(prefix, on, "root"), prefix, on, enough)


def _rarest(texts: DataFrame, least: float) -> DataFrame:
    """node, n, gram, place, m, long: where short texts meet by one of their rarest shingles.

    Shingles are numbered from the most frequent one, ``place`` of them are no rarer than this one. Where it is the rarest
    that two texts have in common, no more than the smaller place can be. So the longer text has it only
    for lengths ``m`` of the shorter one at which that is enough, and the shorter one for its own.
    """
    each = texts.where("grams is not null").select("node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    counts = each.groupBy("gram").agg(F.count("*").alias("many")).where("many > 1")
    each = each.join(staged(counts), "gram")
    order = Window.partitionBy("node").orderBy(F.desc("many"), F.desc("gram"))
    fewest = F.ceil(least * F.col("n") - 1e-6).cast("int")
    each = staged(each.withColumn("place", F.row_number().over(order)).where(F.col("place") >= fewest).drop("many"))
    most = F.least(F.col("n"), F.floor((1 + least) / least * F.col("place") + 1e-6).cast("int") - F.col("n"))
    long = each.where(most >= fewest).select("*", F.explode(F.sequence(fewest, most)).alias("m"), F.lit(True).alias("long"))
    rows = staged(long.union(each.select("*", F.col("n").alias("m"), F.lit(False).alias("long"))))
    both = rows.groupBy("gram", "m").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.max("long").alias("any"))
    both = both.where("any and low < high").select("gram", "m")
    return rows.join(staged(both), ["gram", "m"])


def _through_rarest(meets: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """Pairs of short texts that share one of their rarest shingles and may have enough in common."""
    rows = staged(_rooted(meets, roots))
    need = least / (1 + least) * (F.col("n_a") + F.col("n_b")) - 1e-6
    others = rows.withColumn("long", ~F.col("long"))
    few = _minority(rows, ["gram", "m"], "root")
    return _apart(few, others, ["gram", "m", "long"], F.least("place_a", "place_b") >= need)


def _classes(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """The rows with their words_key, and words_key, first, head (smallest first of its class) of every text."""
    # The sketch of equal texts is the same, whichever row it comes from.
    rows = staged(sketches(docs, least))
    texts = staged(_texts(rows))
    entries = texts.select("node", F.explode("sketch").alias("bucket")).distinct()
    shared = entries.groupBy("bucket").agg(F.count("*").alias("many")).where("many > 1")
    entries = staged(entries.join(shared, "bucket"))
    degree = staged(entries.groupBy("node").agg(F.sum("many").alias("degree")))
    meets = staged(_rarest(texts, least))
    wanted = degree.select("node").union(meets.select("node")).distinct()
    wanted = texts.select("node", "first.doc", "first.text_key").join(wanted, "node", "left_semi")
    lists = staged(_word_lists(docs, wanted))

    # Every text against the best connected text of its buckets.
    rank = F.struct("degree", (-F.col("node")).alias("back"))
    ranked = entries.join(degree, "node")
    hubs = ranked.groupBy("bucket").agg(F.max(rank).alias("hub"))
    stars = entries.join(hubs, "bucket").groupBy("node").agg(F.max("hub").alias("hub"))
    stars = stars.select(F.col("node").alias("a"), (-F.col("hub.back")).alias("b")).where("a <> b")
    first = staged(compared(stars, lists, least))
    links = first.where("linked").select("a", "b")
    roots = components(links)

    # And against the best connected text of that one's class.
    tops = _rooted(degree, roots).groupBy("root").agg(F.max(rank).alias("top")).select("root", (-F.col("top.back")).alias("top"))
    of_hub = _rooted(first.select("a", F.col("b").alias("node")), roots).join(staged(tops), "root").select("a", "top")
    first = first.join(of_hub, "a")
    again = compared(first.where("b <> top and a <> top").select("a", F.col("top").alias("b")), lists, least)
    near = first.where("b = top").drop("top").unionByName(again)
    near = staged(near.withColumnRenamed("a", "node").withColumnRenamed("b", "top"))
    links = links.union(near.where("linked").select("node", "top"))
    roots = components(links)

    # What is still apart.
    rest = (
        _without_common_hub(entries, near, roots)
        .union(_through_the_hub(entries, near, roots, least))
        .union(_through_added(near, roots, least))
        .union(_through_rarest(meets, roots, least))
        .distinct()
    )
    links = links.union(staged(compared(rest, lists, least).where("linked").select("a", "b")))

    placed = staged(_rooted(texts.select("words_key", "node", "first"), components(links)))
    heads = staged(placed.groupBy("root").agg(F.min("first").alias("head")))
    return rows, staged(placed.join(heads, "root").select("words_key", "first", "head"))


def near_duplicate_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), kept (its one document that stays).

    One row for each row of ``docs``; ``kept`` is true for the rows of that smallest doc_id with one and
    the same text.
    """
    rows, placed = _classes(docs, least)
    return rows.join(placed, "words_key").select(
        "doc_id",
        F.nullif(F.col("head.doc"), F.lit(-(2**63))).alias("class_id"),
        ((F.col("doc") == F.col("head.doc")) & (F.col("text_key") == F.col("head.text_key"))).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class of near-duplicates: that with the smallest doc_id, one of those equal in id and text."""
    _, placed = _classes(docs, least)
    on = [free_name(docs, "__doc"), free_name(docs, "__text_key")]
    kept = placed.where("first = head").select(F.col("first.doc").alias(on[0]), F.col("first.text_key").alias(on[1]))
    keyed = docs.select("*", *(c.alias(name) for c, name in zip(_identity(), on, strict=True)))
    return keyed.join(kept, on, "left_semi").dropDuplicates(on).select(*docs.columns)
