"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is cut into the pieces of a given vocabulary so that the sum of the pieces' scores is
highest; of equal sums the one whose last piece is longest wins. Spaces are part of the pieces,
one space is put in front, and a character without a piece becomes its UTF-8 bytes at a score
below that of any piece. Decoding gives back every text exactly, whatever its characters.

:class:`StreamingViterbi` reads a text in parts. It keeps the search's window only: whenever all
backpointer paths that can still be continued (they end within the longest piece's length) run
through one boundary, the ids before it are committed and forgotten. No piece of the vocabulary
continues past a space that follows something else, so all paths meet in front of such a space;
what lies between two of these boundaries (a unit) is searched alone. Units seen before are
remembered up to ``REMEMBERED``; new ones of a batch are searched together, all units one
character further at a time.

Null texts have no ids and decode to the empty text, like empty ones. Repeated rows give repeated results, an empty
table none; other columns may have any name. Time is linear in a text, memory follows its longest stretch without a
boundary that all paths share, such as a ruler of hyphens.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StructType

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 100_000  # units a worker remembers before it starts anew
PORTION = 1 << 18  # characters of texts that are encoded, and leave a worker, at once
TOGETHER = 40  # units of up to so many characters are searched together
AT_ONCE = 1024  # as many
_UNIT = re.compile(r" *[^ ]+| +")
_SLOTS = 18  # bits of the lookup table
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Vocabulary:
    """Pieces with a space for U+2581, their ids and scores, and the ids of the 256 bytes."""

    def __init__(self, model_file: str):
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.piece: dict[str, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [-1] * 256
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                plain = name.replace("▁", " ")
                self.piece[plain] = (i, model.get_score(i))
                self.bytes_of.append(plain.encode())
        if min(self.byte_id) < 0:
            raise ValueError("the vocabulary has no byte pieces")
        if any(" " in plain.lstrip(" ") for plain in self.piece):
            raise ValueError("a piece continues past a space")
        self.longest = max(map(len, self.piece))
        self.fallback = min(score for _, score in self.piece.values() if score > -1e8) - 10.0
        self._build_table()

    def _build_table(self) -> None:
        names = sorted(self.piece)
        ids = np.array([self.piece[name][0] for name in names])
        key = np.array([self._hash_one(name) for name in names], dtype=np.uint64)
        self.score = np.full(len(self.bytes_of) + 1, -np.inf)
        self.score[ids] = [self.piece[name][1] for name in names]
        self.score[self.byte_id] = self.fallback
        self.hash_of = np.zeros(len(self.bytes_of) + 1, dtype=np.uint64)
        self.hash_of[ids] = key
        self.tables = []  # what doesn't find a free slot in one table goes to the next
        while len(ids):
            slot = (key >> np.uint64(64 - _SLOTS)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << _SLOTS, -1, dtype=np.int32)
            table[slot[first]] = ids[first]
            self.tables.append(table)
            rest = np.ones(len(ids), dtype=bool)
            rest[first] = False
            key, ids = key[rest], ids[rest]

    @staticmethod
    def _hash_one(name: str) -> int:
        value = 0
        for c in name:
            value = ((value * int(_STEP)) + ord(c) + 1) & (2**64 - 1)
        return ((value ^ (value >> 31)) * int(_MIX)) & (2**64 - 1)

    def find(self, value: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these polynomial hashes, -1 where there is none."""
        key = (value ^ (value >> np.uint64(31))) * _MIX
        slot = (key >> np.uint64(64 - _SLOTS)).astype(np.int64)
        found = self.tables[0][slot]
        found[self.hash_of[found] != key] = -1
        for table in self.tables[1:]:
            other = table[slot]
            hit = (other >= 0) & (self.hash_of[other] == key)
            found[hit] = other[hit]
        return found


@lru_cache(maxsize=4)
def vocabulary(model_file: str) -> Vocabulary:
    return Vocabulary(model_file)


class StreamingViterbi:
    """Ids of a text that comes in parts; push() and finish() return the ids they commit.

    A meeting point is looked for when the window has doubled since the last one was looked for in vain, so the time is
    linear in the text. Where no paths meet, as in a long run of one character, the window is that stretch: 16 bytes a
    character.
    """

    def __init__(self, words: Vocabulary):
        self.words = words
        self.text = ""  # what is not committed yet
        self.best = array("d", [0.0])
        self.length = array("i", [0])  # of the best last piece
        self.which = array("i", [-1])  # its id
        self.look = 4 * words.longest

    def push(self, part: str) -> list[int]:
        out: list[int] = []
        for begin in range(0, len(part), 4096):
            self.text += part[begin : begin + 4096]
            while len(self.best) <= len(self.text):
                self._next(len(self.best))
                if len(self.best) > self.look:
                    out += self._commit(self._meeting())
                    self.look = max(4 * self.words.longest, 2 * (len(self.best) - 1))
        return out

    def _next(self, end: int) -> None:
        """The best path to the next boundary."""
        text, piece, best = self.text, self.words.piece, self.best
        top, start, which = -np.inf, end - 1, -1
        for begin in range(max(0, end - self.words.longest), end):
            found = piece.get(text[begin:end])
            if found is not None:
                total = best[begin] + found[1]
                if total > top:
                    top, start, which = total, begin, found[0]
        if text[end - 1] not in piece:
            total = best[end - 1] + self.words.fallback
            if total > top:
                top, start, which = total, end - 1, -1
        best.append(top)
        self.length.append(end - start)
        self.which.append(which)

    def finish(self) -> list[int]:
        return self._commit(len(self.text))

    def window(self) -> int:
        return len(self.text)

    def _meeting(self) -> int:
        """The last boundary on all paths that can still be continued."""
        end = len(self.best) - 1
        live = set(range(max(0, end - self.words.longest + 1), end + 1))
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(last - self.length[last])
        return live.pop()

    def _commit(self, boundary: int) -> list[int]:
        ids, at = [], boundary
        while at > 0:
            start, which = at - self.length[at], self.which[at]
            if which >= 0:
                ids.append(which)
            else:
                raw = self.text[start:at].encode("utf-8", "surrogatepass")
                ids += [self.words.byte_id[b] for b in reversed(raw)]
            at = start
        if boundary:
            self.text = self.text[boundary:]
            base = self.best[boundary]
            self.best = array("d", [score - base for score in self.best[boundary:]])
            self.length, self.which = self.length[boundary:], self.which[boundary:]
        return ids[::-1]


def encode_alone(words: Vocabulary, text: str) -> list[int]:
    stream = StreamingViterbi(words)
    return stream.push(text) + stream.finish()


def encode_together(words: Vocabulary, units: list[str]) -> list[bytes | None]:
    """Ids (as int32 bytes) of units of up to ``TOGETHER`` characters, searched in step.

    None for units with a character beyond ASCII that has no piece.
    """
    many, size = len(units), np.array([len(u) for u in units])
    width = int(size.max())
    code = np.zeros((many, width), dtype=np.uint64)
    inside = np.arange(width) < size[:, None]
    code[inside] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    byte_id = np.array(words.byte_id[:128], dtype=np.int32)
    value = np.zeros((many, width), dtype=np.uint64)
    found = []
    for length in range(1, min(words.longest, width) + 1):
        value = value[:, : width - length + 1] * _STEP + code[:, length - 1 :] + np.uint64(1)
        ids = words.find(value)
        if length == 1:
            bare = (ids < 0) & (code < 128)
            ids[bare] = byte_id[code[bare].astype(np.int64)]
            strange = ((ids < 0) & inside).any(axis=1)
        found.append((np.ascontiguousarray(ids.T), np.ascontiguousarray(words.score[ids].T)))
    best = np.full((width + 1, many), -np.inf)
    best[0] = 0
    last = np.zeros((width + 1, many), dtype=np.int64)
    which = np.zeros((width + 1, many), dtype=np.int32)
    for end in range(1, width + 1):
        for length in range(min(len(found), end), 0, -1):
            ids, score = found[length - 1]
            total = best[end - length] + score[end - length]
            better = total > best[end]
            best[end][better] = total[better]
            last[end][better] = length
            which[end][better] = ids[end - length][better]
    out = np.zeros((many, width), dtype=np.int32)
    at, fill, rows = size.copy(), np.full(many, width), np.arange(many)
    at[strange] = 0
    while (going := at > 0).any():
        r, a = rows[going], at[going]
        fill[r] -= 1
        out[r, fill[r]] = which[a, r]
        at[r] = a - last[a, r]
    return [None if s else out[i, fill[i] :].tobytes() for i, s in enumerate(strange)]


class Encoder:
    """Texts to ids with a memory of units."""

    def __init__(self, words: Vocabulary):
        self.words = words
        self.memory: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """One int32 array for each text."""
        cut = [_UNIT.findall(" " + text) if text else [] for text in texts]
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        memory = self.memory
        new = [u for u in dict.fromkeys(u for units in cut for u in units) if u not in memory]
        new.sort(key=len)
        short = [u for u in new if len(u) <= TOGETHER]
        for start in range(0, len(short), AT_ONCE):
            part = short[start : start + AT_ONCE]
            memory.update(zip(part, encode_together(self.words, part), strict=True))
        for u in new:
            if memory.get(u) is None:
                memory[u] = np.array(encode_alone(self.words, u), dtype=np.int32).tobytes()
        return [np.frombuffer(b"".join([memory[u] for u in units]), dtype=np.int32) for units in cut]


def decode(words: Vocabulary, ids) -> str:
    """The text of these ids: their bytes without the space put in front."""
    table = words.bytes_of
    return b"".join([table[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


@lru_cache(maxsize=4)
def encoder(model_file: str) -> Encoder:
    return Encoder(vocabulary(model_file))


def in_portions(texts: pa.Array, characters: int = PORTION):
    """The batch's texts in lists of about so many characters, a longer text alone."""
    portion, size = [], 0
    for value in texts:
        text = value.as_py()
        portion.append(text)
        size += len(text or "")
        if size >= characters:
            yield portion
            portion, size = [], 0
    if portion:
        yield portion


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    ends = np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int32)))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def ids_column(text: Column | str, model_file: str = MODEL_FILE) -> Column:
    """array<int>: the ids of every whole text."""

    def encoded(texts: pa.Array) -> pa.Array:
        return _lists([ids for part in in_portions(texts) for ids in encoder(model_file).encode(part)])

    return arrow_udf(encoded, "array<int>")(text)


def encoded_batches(batches: Iterator[pa.RecordBatch], model_file: str = MODEL_FILE) -> Iterator[pa.RecordBatch]:
    """Batches (doc_id, text) as batches (doc_id, ids, n_ids) of a portion each, so none is larger than that or one text."""
    for batch in batches:
        at = 0
        for part in in_portions(batch.column("text")):
            rows = encoder(model_file).encode(part)
            sizes = pa.array([len(r) for r in rows], pa.int64())
            columns = [batch.column("doc_id").slice(at, len(rows)), _lists(rows), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_ids"])
            at += len(rows)


def encoded_rows(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, ids, n_ids of every row; ids leave the workers in portions, however large Spark's batches are."""
    rows = docs.select(F.col("doc_id"), F.col("text"))
    kind = StructType([rows.schema["doc_id"], *StructType.fromDDL("ids array<int>, n_ids bigint").fields])
    return rows.mapInArrow(lambda batches: encoded_batches(batches, model_file), kind)


def text_column(ids: Column | str, model_file: str = MODEL_FILE) -> Column:
    """The text of every list of ids; null ids decode to the empty text."""

    def decoded(rows: pa.Array) -> pa.Array:
        words = vocabulary(model_file)
        return pa.array([decode(words, row.as_py() or []) for row in rows], type=pa.string())

    return arrow_udf(decoded, "string")(ids)


def encode_and_verify(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, n_ids, n_byte_ids, ids_sha256 (of the ids as little-endian int32), round_trip."""

    def digested(texts: pa.Array) -> pa.Array:
        import hashlib

        words = vocabulary(model_file)
        is_byte = np.zeros(len(words.bytes_of), dtype=bool)
        is_byte[words.byte_id] = True
        rows = []
        for part in in_portions(texts):
            for text, ids in zip(part, encoder(model_file).encode(part), strict=True):
                rows.append({
                    "n_ids": len(ids),
                    "n_byte_ids": int(np.count_nonzero(is_byte[ids])),
                    "ids_sha256": hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(),
                    "round_trip": decode(words, ids.tolist()) == (text or ""),
                })
        kind = [("n_ids", pa.int64()), ("n_byte_ids", pa.int64()), ("ids_sha256", pa.string()), ("round_trip", pa.bool_())]
        return pa.array(rows, type=pa.struct(kind))

    kind = "struct<n_ids: bigint, n_byte_ids: bigint, ids_sha256: string, round_trip: boolean>"
    return docs.select("doc_id", arrow_udf(digested, kind)("text").alias("p")).select("doc_id", F.col("p.*"))
