"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a document with a
smaller id, or earlier in the same document) is removed; strings never cross documents, may overlap,
and are judged on the input.

A string of that length always holds one of the anchors of its text: the leftmost smallest hash of
``SEED`` bytes among all those inside the string. Equal strings have the same anchor, so

1. tasks cut each text's anchors, and the seeds that occur twice anywhere are found from short
   keys (:func:`repeated_seeds`);
2. texts and the repeated seeds of their group of documents meet in one task. It settles
   what repeats inside a document or a group, and sends on the bytes around each other repeated
   anchor (a context), dealt by the seed (:func:`_contexts`);
3. contexts of one seed hold all strings with that anchor. Equal contexts are settled at once; of
   the others the suffixes are sorted (:func:`repeated_starts`), one block at a time;
4. removed ranges and texts meet again and the rest of each text is cut together.

Suffix sorting (:class:`SuffixBlock`) is blockwise: a block's suffixes are dealt into buckets by their
first bytes and one bucket is sorted at a time, by its first ``PERIOD`` bytes. What ties
there is resolved by the ranks of a difference-cover sample: any two positions have a common
distance below ``PERIOD`` after which both are sample positions, whose ranks over ``LENGTH`` bytes
and more are computed once for the block. So memory is bounded by the block, not by the length of ties.

Seeds with more than ``HOT`` contexts would be too large for one task: for these every string is
sent by itself, dealt by its own hash, which has the same result.

Rows that share a doc_id but not the text are documents of their own, in the order of a hash of the
text. Repeated rows get equal results. A null doc_id counts as the smallest, a null text as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH = 100
SEED = 32
HOT = 40_000  # contexts of one seed that a task takes
GROUP_DOCS = 1_000  # documents of a group, about
BLOCK_BYTES = 2 << 20  # contexts sorted together, about
PERIOD = 31
#: A difference cover of the period; every distance is the difference of two of them.
COVER = (0, 1, 3, 8, 12, 18)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_KEY = np.dtype([("key", "<u8"), ("group", "<i4"), ("many", "<u4")])
_ROW = "route bigint, kind int, doc bigint, text_id bigint, start int, anchor int, payload binary"
_ROW_ARROW = pa.schema([
    ("route", pa.int64()), ("kind", pa.int32()), ("doc", pa.int64()), ("text_id", pa.int64()),
    ("start", pa.int32()), ("anchor", pa.int32()), ("payload", pa.binary()),
])
CONTEXT, STRING, RANGE = 0, 1, 2


# ---- hashes and anchors of one text ---------------------------------------------------------


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(int(_STEP), exponent, 1 << 64))


def _mixed(value: np.ndarray) -> np.ndarray:
    return (value ^ (value >> np.uint64(31))) * _MIX


def window_hashes(raw: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` bytes in a row, joined from those of powers of two."""
    if len(raw) < size:
        return np.zeros(0, dtype=np.uint64)
    now, have = raw.astype(np.uint64) + np.uint64(1), 1
    done, length = None, 0
    left = size
    while True:
        if left & 1:
            if done is None:
                done, length = now, have
            else:
                many = len(raw) - length - have + 1
                done = done[:many] * _power(have) + now[length : length + many]
                length += have
        left >>= 1
        if not left:
            return _mixed(done)
        now = now[: len(now) - have] * _power(have) + now[have:]
        have *= 2


def window_minima(values: np.ndarray, size: int) -> np.ndarray:
    """The smallest of every ``size`` values in a row."""
    have = 1
    while have < size:
        by = min(have, size - have)
        values = np.minimum(values[: len(values) - by], values[by:])
        have += by
    return values


def _anchors(seeds: np.ndarray) -> np.ndarray:
    """For every start the position of its anchor, the leftmost smallest hash of its window."""
    # Half of the hash above the position, so that one minimum finds both.
    placed = (seeds >> np.uint64(32) << np.uint64(32)) | np.arange(len(seeds), dtype=np.uint64)
    return (window_minima(placed, LENGTH - SEED + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchor_seeds(raw: np.ndarray) -> np.ndarray:
    """The seeds of a text's anchors, in order."""
    if len(raw) < LENGTH:
        return np.zeros(0, dtype=np.uint64)
    seeds = window_hashes(raw, SEED)
    anchor = _anchors(seeds)
    return seeds[anchor[np.concatenate(([True], anchor[1:] != anchor[:-1]))]]


def anchored_starts(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text: the starts that repeat none before them, their anchors, seeds; and the repeated starts.

    A start is where ``LENGTH`` bytes begin.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(raw) < LENGTH:
        return none, none, none.astype(np.uint64), none
    seeds = window_hashes(raw, SEED)
    anchor = _anchors(seeds)
    starts = np.arange(len(anchor))
    whole = window_hashes(raw, LENGTH)
    values = np.sort(whole)
    if not (values[1:] == values[:-1]).any():
        return starts, anchor, seeds[anchor], none
    by_hash = np.argsort(whole, kind="stable")
    same = np.concatenate(([False], whole[by_hash][1:] == whole[by_hash][:-1]))
    repeated = np.zeros(len(starts), dtype=bool)
    repeated[by_hash[same]] = True
    first = starts[~repeated]
    return first, anchor[first], seeds[anchor[first]], starts[repeated]


def runs(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges covered by ``LENGTH`` bytes from each of the ascending starts."""
    if len(starts):
        cut = np.flatnonzero(np.diff(starts) > LENGTH) + 1
        for part in np.split(starts, cut):
            yield int(part[0]), int(part[-1]) + LENGTH


# ---- suffix sorting -------------------------------------------------------------------------


class SuffixBlock:
    """Order of some suffixes of a block of bytes by ``LENGTH`` bytes at least."""

    def __init__(self, raw: np.ndarray):
        self.size = len(raw)
        padded = np.zeros(len(raw) + 2 * LENGTH + 64, dtype=np.uint8)
        padded[: len(raw)] = raw
        self.raw = padded
        #: words[i]: the bytes i .. i+7 as one number of the same order.
        self.words = np.zeros(len(padded) - 8, dtype=np.uint64)
        for i in range(8):
            self.words = (self.words << np.uint64(8)) | padded[i : len(padded) - 8 + i]
        self.distance = np.zeros((PERIOD, PERIOD), dtype=np.int64)
        for i in range(PERIOD):
            for j in range(PERIOD):
                self.distance[i, j] = next(
                    d for d in range(PERIOD) if (i + d) % PERIOD in COVER and (j + d) % PERIOD in COVER
                )
        self._rank_sample()

    def _word(self, at: np.ndarray) -> np.ndarray:
        return self.words[at]

    def _prefix(self, at: np.ndarray) -> list[np.ndarray]:
        """The first ``PERIOD`` bytes as numbers, the most significant last (as lexsort wants)."""
        return [self._word(at + 24) >> np.uint64(8), self._word(at + 16), self._word(at + 8), self._word(at)]

    @staticmethod
    def _dense(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Order by the keys (most significant last) and dense ranks from 0 on."""
        order = np.lexsort(keys)
        new = np.zeros(len(order), dtype=bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.cumsum(new)
        return order, rank

    def _rank_sample(self) -> None:
        in_cover = np.zeros(PERIOD, dtype=bool)
        in_cover[list(COVER)] = True
        at = np.arange(self.size + PERIOD)
        at = at[in_cover[at % PERIOD]]
        self.rank = np.full(len(self.raw) + 8 * PERIOD, -1, dtype=np.int64)
        _, names = self._dense(self._prefix(at))
        self.rank[at] = names
        reach = PERIOD
        while reach < LENGTH:  # ranks over twice as many bytes from the ranks at both halves
            _, names = self._dense([self.rank[at + reach], self.rank[at]])
            self.rank[at] = names
            reach *= 2

    def order(self, starts: np.ndarray) -> np.ndarray:
        """The starts sorted, one bucket of equal first bytes after the other."""
        head = self._word(starts) >> np.uint64(48)
        by_head = np.argsort(head, kind="stable")
        cut = np.flatnonzero(np.diff(head[by_head])) + 1
        return np.concatenate([self._bucket(starts[part]) for part in np.split(by_head, cut)]) if len(starts) else starts

    def _bucket(self, starts: np.ndarray) -> np.ndarray:
        order, rank = self._dense(self._prefix(starts))
        starts, group = starts[order], rank[order]
        # Ties: compare all of a group with its first member by the sample ranks, at the distance
        # that suits the two; equal ones are done, lower and higher ones go on as groups.
        open_ = np.arange(len(starts))
        while len(open_):
            g = group[open_]
            first = np.concatenate(([True], g[1:] != g[:-1]))
            pivot = starts[open_[np.flatnonzero(first)[np.cumsum(first) - 1]]]
            mine = starts[open_]
            d = self.distance[mine % PERIOD, pivot % PERIOD]
            side = np.sign(self.rank[mine + d] - self.rank[pivot + d])
            again = np.lexsort((side, g))
            starts[open_] = mine[again]
            g, side = g[again], side[again]
            new = np.concatenate(([True], (g[1:] != g[:-1]) | (side[1:] != side[:-1])))
            label = np.cumsum(new) - 1
            size = np.bincount(label)
            # Number the groups anew within what is still open; their order is that of the rows.
            group[open_] = label
            open_ = open_[(side != 0) & (size[label] > 1)]
        return starts

    def same_as_before(self, ordered: np.ndarray) -> np.ndarray:
        """Whether a suffix has its first ``LENGTH`` bytes in common with the one in front of it."""
        same = np.ones(len(ordered), dtype=bool)
        if len(ordered):
            same[0] = False
        for at in range(0, LENGTH - 7, 8):
            word = self._word(ordered + at)
            same[1:] &= word[1:] == word[:-1]
        word = self._word(ordered + LENGTH - 8)
        same[1:] &= word[1:] == word[:-1]
        return same


def repeated_starts(raw: np.ndarray, starts: np.ndarray, doc: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Which starts in a block have an equal string at a smaller (doc, position)."""
    block = SuffixBlock(raw)
    by_start = np.argsort(starts, kind="stable")
    ordered = block.order(starts)
    index = by_start[np.searchsorted(starts[by_start], ordered)]
    label = np.cumsum(~block.same_as_before(ordered)) - 1
    by_time = np.lexsort((position[index], doc[index], label))
    label, index = label[by_time], index[by_time]
    out = np.zeros(len(starts), dtype=bool)
    out[index[1:]] = label[1:] == label[:-1]
    return out


# ---- Spark ----------------------------------------------------------------------------------


def _groups(docs: DataFrame) -> int:
    return max(1, -(-docs.count() // GROUP_DOCS))


def prepared(docs: DataFrame, groups: int) -> DataFrame:
    """group, doc, text_id, text of every row; text_id tells texts of one doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63)))
    return docs.select(
        F.pmod(F.xxhash64(doc), F.lit(groups)).cast("int").alias("group"),
        doc.alias("doc"),
        F.xxhash64(text, F.lit(1)).alias("text_id"),
        text.alias("text"),
    )


def repeated_seeds(texts: DataFrame, hot: int = HOT) -> DataFrame:
    """group, keys: of each group the seeds that occur more than once in all texts.

    A key is a seed's hash without its lowest 16 bits, the lowest of which says whether the seed
    is hot. Tasks send each key once for a group and batch, in blobs dealt by the key.
    """
    spark = texts.sparkSession
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for group, text in zip(batch.column("group"), batch.column("text"), strict=True):
                raw = np.frombuffer(text.as_py().encode(), dtype=np.uint8)
                seed = anchor_seeds(raw)
                rows = np.zeros(len(seed), dtype=_KEY)
                rows["key"], rows["group"], rows["many"] = seed >> np.uint64(16), group.as_py(), 1
                found.append(rows)
            rows = _summed(np.concatenate(found)) if found else np.zeros(0, dtype=_KEY)
            shard = (rows["key"] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.flatnonzero(np.diff(shard[order])) + 1
            parts = [p for p in np.split(order, cut) if len(p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[p[0]]) for p in parts], pa.int32()), pa.array([rows[p].tobytes() for p in parts], pa.binary())],
                ["shard", "blob"],
            )

    def replies(shard_rows: np.ndarray) -> tuple[list[int], list[bytes]]:
        rows = _summed(shard_rows)
        if not len(rows):
            return [], []
        new = np.concatenate(([True], rows["key"][1:] != rows["key"][:-1]))
        label = np.cumsum(new) - 1
        total = np.bincount(label, rows["many"])[label]
        rows, total = rows[total > 1], total[total > 1]
        flagged = (rows["key"] << np.uint64(1)) | (total > hot).astype(np.uint64)
        order = np.argsort(rows["group"], kind="stable")
        cut = np.flatnonzero(np.diff(rows["group"][order])) + 1
        parts = [p for p in np.split(order, cut) if len(p)]
        return [int(rows["group"][p[0]]) for p in parts], [flagged[p].tobytes() for p in parts]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []

        def done():
            group, keys = replies(np.frombuffer(b"".join(blobs), dtype=_KEY))
            return pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(keys, pa.binary())], ["group", "keys"])

        for batch in batches:
            for shard, blob in zip(batch.column("shard"), batch.column("blob"), strict=True):
                if shard.as_py() != now:
                    if blobs:
                        yield done()
                    now, blobs = shard.as_py(), []
                blobs.append(blob.as_py())
        if blobs:
            yield done()

    sent = texts.select("group", "text").mapInArrow(keys_of, "shard int, blob binary")
    return sent.repartition("shard").sortWithinPartitions("shard").mapInArrow(merge, "group int, keys binary")


def _summed(rows: np.ndarray) -> np.ndarray:
    """One row for each (key, group), sorted by them, with the sum of ``many``."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["group"], rows["key"]))]
    new = np.concatenate(
        ([True], (rows["key"][1:] != rows["key"][:-1]) | (rows["group"][1:] != rows["group"][:-1]))
    )
    many = np.bincount(np.cumsum(new) - 1, rows["many"])
    rows = rows[new]
    rows["many"] = many
    return rows


def _packed(text: str) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(text.encode())


def _unpacked(payload: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), dtype=np.uint8)


def packed_texts(texts: DataFrame) -> DataFrame:
    """group, doc, text_id, payload (the text's bytes, compressed)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = pa.array([_packed(t.as_py()) for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("doc"), batch.column("text_id"), payload],
                ["group", "doc", "text_id", "payload"],
            )

    return texts.mapInArrow(pack, "group int, doc bigint, text_id bigint, payload binary")


class _Rows:
    """Collects output rows and hands them on in batches of about a few MB."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in _ROW_ARROW]
        self.bytes = 0

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.bytes += 64 + len(values[-1])

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(self.columns, _ROW_ARROW, strict=True)], schema=_ROW_ARROW
        )
        self.__init__()
        return out


def _tuples(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*[batch.column(name).to_pylist() for name in names], strict=True)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _add_ranges(rows: _Rows, doc: int, text_id: int, starts: np.ndarray) -> None:
    for begin, end in runs(starts):
        rows.add(doc, RANGE, doc, text_id, begin, end, b"")


def _contexts(seeds: DataFrame, packed: DataFrame) -> DataFrame:
    """Rows by kind: CONTEXT (route: seed), STRING (route: its hash), RANGE (already removed)."""
    both = seeds.select(
        "group", F.lit(0).alias("order"), F.lit(0).cast("bigint").alias("doc"), F.lit(0).cast("bigint").alias("text_id"),
        F.col("keys").alias("payload"),
    ).unionByName(packed.withColumn("order", F.lit(1)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, group, blobs, keys = _Rows(), None, [], None
        seen: dict[tuple[int, int, bytes], tuple[int, int, int]] = {}
        done: set[tuple[int, int]] = set()
        for batch in batches:
            for now, order, doc, text_id, payload in _tuples(batch, "group", "order", "doc", "text_id", "payload"):
                if now != group:
                    group, blobs, keys, seen, done = now, [], None, {}, set()
                if not order:
                    blobs.append(payload)
                    continue
                if keys is None:
                    keys = np.unique(np.frombuffer(b"".join(blobs), dtype=np.uint64))
                if (doc, text_id) in done:
                    continue  # a repeated row
                done.add((doc, text_id))
                raw = _unpacked(payload)
                starts, anchor, seed, repeated = anchored_starts(raw)
                local = [repeated]
                if len(keys) and len(starts):
                    new = np.concatenate(([True], anchor[1:] != anchor[:-1]))
                    begin = np.flatnonzero(new)
                    end = np.append(begin[1:], len(starts))
                    key = seed[begin] >> np.uint64(16)
                    at = np.minimum(np.searchsorted(keys >> np.uint64(1), key), len(keys) - 1)
                    for i in np.flatnonzero(keys[at] >> np.uint64(1) == key):
                        own = starts[begin[i] : end[i]]
                        low, high, x = int(own[0]), int(own[-1]), int(anchor[begin[i]])
                        context = raw[low : high + LENGTH].tobytes()
                        earlier = seen.setdefault((x - low, int(seed[begin[i]]), context), (doc, text_id, low))
                        if earlier != (doc, text_id, low):
                            local.append(own)
                        elif keys[at[i]] & np.uint64(1):
                            grams = window_hashes(raw[low : high + LENGTH], LENGTH)
                            for p in own.tolist():
                                rows.add(_signed(int(grams[p - low])), STRING, doc, text_id, p, 0, raw[p : p + LENGTH].tobytes())
                        else:
                            rows.add(_signed(int(seed[begin[i]])), CONTEXT, doc, text_id, low, x - low, context)
                _add_ranges(rows, doc, text_id, np.unique(np.concatenate(local)))
                if rows.bytes > 4 << 20:
                    yield rows.batch()
        yield rows.batch()

    dealt = both.repartition("group").sortWithinPartitions("group", "order", "doc", "text_id")
    return dealt.mapInArrow(work, _ROW)


def _settled(contexts: DataFrame) -> DataFrame:
    """doc, text_id, begin, end: all removed ranges."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows()
        seen: dict[tuple[int, bytes], tuple[int, int, int]] = {}  # where a context comes first
        first: dict[bytes, tuple[int, int, int]] = {}
        own: list[tuple] = []  # the different contexts of one route
        waiting: list[tuple] = []  # those of routes that have more than one
        size, now = 0, None

        def sort_waiting() -> None:
            if not waiting:
                return
            raw = np.frombuffer(b"".join(context for _, _, _, context in waiting), dtype=np.uint8)
            length = np.array([len(context) for _, _, _, context in waiting])
            base = np.concatenate(([0], np.cumsum(length)[:-1]))
            many = length - LENGTH + 1
            which = np.repeat(np.arange(len(waiting)), many)
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            # Documents by their order among those that wait.
            place = {d: i for i, d in enumerate(sorted({w[:2] for w in waiting}))}
            doc = np.array([place[w[:2]] for w in waiting])
            position = np.array([start for _, _, start, _ in waiting])[which] + offset
            removed = repeated_starts(raw, base[which] + offset, doc[which], position)
            for (doc_, text_id, start, _), part in zip(waiting, np.split(removed, np.cumsum(many)[:-1]), strict=True):
                _add_ranges(rows, doc_, text_id, start + np.flatnonzero(part))
            waiting.clear()

        for batch in batches:
            for route, kind, doc, text_id, start, anchor, payload in _tuples(batch, *_ROW_ARROW.names):
                if route != now:
                    if len(own) > 1:  # a single context has nothing to repeat
                        waiting += own
                        size += sum(len(context) for _, _, _, context in own)
                    if size > BLOCK_BYTES:
                        sort_waiting()
                        size = 0
                    now, seen, first, own = route, {}, {}, []
                place = (doc, text_id, start)
                if kind == RANGE:
                    rows.add(route, RANGE, doc, text_id, start, anchor, b"")
                elif kind == STRING:
                    # Sorted by document and start within a route: the first one stays.
                    if first.setdefault(payload, place) != place:
                        _add_ranges(rows, doc, text_id, np.array([start]))
                elif seen.setdefault((anchor, payload), place) != place:
                    _add_ranges(rows, doc, text_id, start + np.arange(len(payload) - LENGTH + 1))
                else:
                    own.append((doc, text_id, start, payload))
                if rows.bytes > 4 << 20:
                    yield rows.batch()
        if len(own) > 1:
            waiting += own
        sort_waiting()
        yield rows.batch()

    dealt = contexts.repartition("route").sortWithinPartitions("route", "kind", "doc", "text_id", "start")
    return dealt.mapInArrow(work, _ROW).select("doc", "text_id", F.col("start").alias("begin"), F.col("anchor").alias("end"))


def removed_ranges(docs: DataFrame, groups: int | None = None, hot: int = HOT) -> DataFrame:
    """doc, text_id, begin, end: ranges of removed bytes; they may overlap."""
    texts = prepared(docs, groups or _groups(docs))
    return _settled(_contexts(repeated_seeds(texts, hot), packed_texts(texts)))


def deduplicated(docs: DataFrame, groups: int | None = None, hot: int = HOT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (bytes)."""
    groups = groups or _groups(docs)
    texts = prepared(docs, groups)
    ranges = removed_ranges(docs, groups, hot).select(
        F.pmod(F.xxhash64("doc"), F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("order"), "*",
        F.lit(b"").cast("binary").alias("payload"),
    )
    whole = packed_texts(texts).select(
        "group", F.lit(1).alias("order"), "doc", "text_id", F.lit(0).alias("begin"), F.lit(0).alias("end"), "payload"
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, spans = None, []
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        out: list[tuple] = []
        size = 0

        def batch_of() -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            for order, doc, text_id, begin, end, payload in _tuples(
                batch, "order", "doc", "text_id", "begin", "end", "payload"
            ):
                if (doc, text_id) != now:
                    now, spans = (doc, text_id), []
                if not order:
                    # Sorted by begin: join what overlaps or touches.
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([begin, end])
                    continue
                raw = _unpacked(payload)
                kept, at = [], 0
                for span in spans:
                    kept.append(raw[at : span[0]].tobytes())
                    at = span[1]
                kept.append(raw[at:].tobytes())
                rest = b"".join(kept)
                out.append((None if doc == -(2**63) else doc, len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), rest))
                size += len(rest)
                if size > 4 << 20:
                    yield batch_of()
                    out, size = [], 0
        yield batch_of()

    dealt = ranges.unionByName(whole).repartition("group")
    dealt = dealt.sortWithinPartitions("group", "doc", "text_id", "order", "begin")
    return dealt.mapInArrow(
        work, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )


def suffix_dedup_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``."""
    return deduplicated(docs).drop("kept")
