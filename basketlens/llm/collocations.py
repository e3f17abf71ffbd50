"""Phrase collocations from sorted count streams.

Every word occurrence gives one record: the word and the two that follow it in its piece (or the piece's end). Records
are sorted and counted in runs inside the tasks, so equal ones travel once a run. Runs are cut at bounds in prefix order
(language, first word, second, third) and dealt by the ranges between them; a range's runs are merged in that order. In
a merged range the records of a pair of words follow one another, as do those of a word: their counts are sums over
consecutive records. Groups at a range's ends may go on in the next one, so these few are added up afterwards; anything
else that comes up less than ``LEAST`` times is dropped on the spot. As bounds are whole records, neither a very
frequent word nor a very frequent pair makes a large range.

What is left are streams of phrases with their counts, which meet in merge joins: phrases in prefix order with the
counts of their first parts, phrases in suffix order with those of their rest and, as extensions, of the longer phrases
that hold them.

Bounds come from a sample of texts; they balance the ranges and have no influence on results.

What happens to odd input: a null text is an empty one, a null language is ``und`` and one with it. Text without words
adds nothing, and a language without a phrase that is frequent enough has no rows. Repeated rows, and rows that share a
doc_id, count as often as they come up. Very long texts are counted in several runs, with the whole text and its words
in memory at once. Ties are ordered by the phrase's bytes. An empty table gives no rows. Only the columns named are
read, so other columns may have any name. Counts may have up to 15 digits.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.operators.staging import staged

LEAST = 10
WORDS = 3
TOP = 2000
SCALE = 1_000_000
COVERED = 50  # percent of a phrase's count from which a longer one replaces it
UNKNOWN = "und"
RUN = 1_000_000  # word occurrences counted in one run
RANGES = 4  # ranges for each shuffle partition
SAMPLE = 2000  # texts whose words set the bounds
PER_TEXT = 200

_MARK = b"."
#: Fixed values of the contract: what ends a piece.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = bytes.maketrans(_ENDS, _MARK * len(_ENDS))
_CODEC = pa.Codec("zstd")

#: words: the words of a run's slice, sorted, split by line feeds; ids: places of first, second and third words in it, and counts.
RUNS = "lang string, range int, words binary, ids binary, records int, words_size int"
STREAM = "lang string, length int, first string, second string, third string, f bigint"


def tokens(text: bytes) -> list[bytes]:
    """The words of a text, A-Z in lower case, with a mark where a piece ends."""
    return text.lower().translate(_TABLE).replace(_MARK, b" . ").split()


def ordered(first: np.ndarray, second: np.ndarray, third: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Records in prefix order, equal ones added up."""
    order = np.lexsort((third, second, first))
    first, second, third, counts = first[order], second[order], third[order], counts[order]
    if not len(first):
        return first, second, third, counts
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (third[1:] != third[:-1])
    at = np.flatnonzero(new)
    return first[at], second[at], third[at], np.add.reduceat(counts, at)


def run_of(found: list[bytes]) -> tuple[list[bytes], tuple[np.ndarray, ...]]:
    """(sorted words, records) of marked words. Word 0 is the end of a piece."""
    vocabulary: dict = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    vocabulary[_MARK]  # noqa: B018 - the mark is word 0
    ids = np.fromiter(map(vocabulary.__getitem__, found), dtype=np.int32, count=len(found))
    words = list(vocabulary)
    order = sorted(range(1, len(words)), key=words.__getitem__)
    place = np.zeros(len(words), dtype=np.int32)
    place[order] = np.arange(1, len(words))
    ids = np.concatenate((place[ids], np.zeros(2, dtype=np.int32)))
    first, second, third = ids[:-2], ids[1:-1], ids[2:]
    third = np.where(second == 0, 0, third)
    real = first != 0
    return [b"", *(words[i] for i in order)], ordered(first[real], second[real], third[real], np.ones(int(real.sum()), dtype=np.int64))


def cuts(words: list[bytes], records: tuple[np.ndarray, ...], bounds: list[tuple[bytes, ...]]) -> list[int]:
    """Where the records are cut: the first place not before each bound."""
    out = []
    for bound in bounds:
        low, high = 0, len(records[0])
        for column, word in zip(records[:3], bound, strict=True):
            at = bisect_left(words, word)
            begin = low + int(np.searchsorted(column[low:high], at, "left"))
            if at < len(words) and words[at] == word:
                high = low + int(np.searchsorted(column[low:high], at, "right"))
            else:
                high = begin
            low = begin
        out.append(low)
    return out


def packed(words: list[bytes], records: tuple[np.ndarray, ...]) -> tuple[bytes, bytes, int, int]:
    """A slice of a run: (its words, ids and counts, both compressed; number of records, bytes of the words)."""
    used, inside = np.unique(np.concatenate(records[:3]), return_inverse=True)
    many = len(records[0])
    inside = inside.astype(np.int32)
    text = b"\n".join([words[i] for i in used])
    # First words ascend, so their steps are nearly all zero.
    steps = np.diff(inside[:many], prepend=np.int32(0)).astype(np.int32)
    ids = steps.tobytes() + inside[many:].tobytes() + records[3].astype(np.int64).tobytes()
    return _CODEC.compress(text, asbytes=True), _CODEC.compress(ids, asbytes=True), many, len(text)


def unpacked(words: bytes, ids: bytes, many: int, size: int) -> tuple[list[bytes], tuple[np.ndarray, ...]]:
    text = _CODEC.decompress(words, size, asbytes=True).split(b"\n")
    raw = _CODEC.decompress(ids, many * 20, asbytes=True)
    three = np.frombuffer(raw, dtype=np.int32, count=3 * many).reshape(3, many)
    return text, (np.cumsum(three[0], dtype=np.int32), three[1], three[2], np.frombuffer(raw, dtype=np.int64, offset=12 * many))


def merged(slices: list[tuple[list[bytes], tuple[np.ndarray, ...]]]) -> tuple[list[bytes], tuple[np.ndarray, ...]]:
    """The records of several sorted runs in one order, over the words of all."""
    words = sorted(set().union(*(s[0] for s in slices)))
    index = {w: i for i, w in enumerate(words)}
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for own, records in slices:
        place = np.fromiter(map(index.__getitem__, own), dtype=np.int32, count=len(own))
        for part, column in zip(parts, records[:3]):
            part.append(place[column])
        parts[3].append(records[3])
    return words, ordered(*(np.concatenate(p) for p in parts))


def streams(words: list[bytes], records: tuple[np.ndarray, ...], least: int) -> Iterator[tuple]:
    """(length, words..., count) of the phrases of a merged range: those found ``least`` times or more, and whatever
    may go on in the next range. Length 0 is the number of all word occurrences."""
    first, second, third, counts = records
    yield 0, None, None, None, int(counts.sum())
    end = words[0] == b""
    whole = np.flatnonzero((counts >= least) & (third != 0)) if end else np.flatnonzero(counts >= least)
    for i in whole:
        yield 3, words[first[i]], words[second[i]], words[third[i]], int(counts[i])
    change = np.ones(len(first), dtype=bool)
    change[1:] = first[1:] != first[:-1]
    for length in (1, 2):
        if length == 2:
            change[1:] |= second[1:] != second[:-1]
        at = np.flatnonzero(change)
        sums = np.add.reduceat(counts, at)
        keep = sums >= least
        keep[[0, -1]] = True
        if length == 2 and end:
            keep &= second[at] != 0
        for i, f in zip(at[keep], sums[keep]):
            yield length, words[first[i]], words[second[i]] if length == 2 else None, None, int(f)


# ---- Spark ----------------------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return docs.select(lang.alias("lang"), F.col("text").cast("binary").alias("text")).where("length(text) > 0")


def _records_of(text: bytes, seed: int) -> list[tuple[bytes, ...]]:
    """At most ``PER_TEXT`` of a text's records."""
    found = [b"" if t == _MARK else t for t in tokens(text)] + [b"", b""]
    real = [i for i in range(len(found) - 2) if found[i]]
    if len(real) > PER_TEXT:
        real = [real[i] for i in np.random.default_rng(seed).choice(len(real), PER_TEXT, replace=False)]
    return [(found[i], found[i + 1], found[i + 2] if found[i + 1] else b"") for i in real]


def bounds(docs: DataFrame, ranges: int) -> dict[str, list[tuple[bytes, ...]]]:
    """For each language the records at which its streams are cut, up to ``ranges`` - 1 in all.

    They come from a sample of about ``SAMPLE`` texts and at most ``PER_TEXT`` records of each.
    """
    texts = _texts(docs)
    many = texts.count()
    sample = texts.sample(min(1.0, SAMPLE / max(many, 1)), seed=3).limit(2 * SAMPLE)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                out += [(lang, *r) for r in _records_of(text.as_py(), len(out))]
            kinds = (pa.string(), pa.binary(), pa.binary(), pa.binary())
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "a", "b", "c"])

    found = sample.mapInArrow(work, "lang string, a binary, b binary, c binary").toArrow()
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("lang", "a", "b", "c"))))
    out: dict[str, list[tuple[bytes, ...]]] = {}
    for k in range(1, ranges):
        lang, *record = rows[k * len(rows) // ranges] if rows else (UNKNOWN, b"", b"", b"")
        if tuple(record) not in out.setdefault(lang, []):
            out[lang].append(tuple(record))
    return out


def runs(docs: DataFrame, at: dict[str, list[tuple[bytes, ...]]], run: int = RUN) -> DataFrame:
    """Sorted, counted slices of runs, see :data:`RUNS`."""
    kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32())
    names = ["lang", "range", "words", "ids", "records", "words_size"]

    def sliced(lang: str, found: list[bytes]) -> pa.RecordBatch:
        words, records = run_of(found)
        edges = [0, *cuts(words, records, at.get(lang, [])), len(records[0])]
        out = []
        for number, (begin, end) in enumerate(zip(edges, edges[1:])):
            if begin < end:
                out.append((lang, number, *packed(words, tuple(r[begin:end] for r in records))))
        columns = list(zip(*out)) or [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def pieces(found: list[bytes]) -> Iterator[list[bytes]]:
        """Parts of about ``run`` words, cut where a piece ends if one does."""
        begin = 0
        while len(found) - begin > 2 * run:
            try:
                end = found.index(_MARK, begin + run)
            except ValueError:
                break
            yield found[begin:end]
            begin = end
        yield found[begin:]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        words = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                found = tokens(text.as_py())
                own = held.setdefault(lang, [])
                own += found
                own.append(_MARK)
                words += len(found)
                if len(own) >= run:
                    words -= len(own)
                    for piece in pieces(held.pop(lang)):
                        yield sliced(lang, piece)
                elif words >= 2 * run:  # many languages with few words each
                    for other in list(held):
                        yield sliced(other, held.pop(other))
                    words = 0
        for lang, found in held.items():
            yield sliced(lang, found)

    return _texts(docs).mapInArrow(work, RUNS)


def count_streams(docs: DataFrame, least: int = LEAST, run: int = RUN, ranges: int | None = None) -> DataFrame:
    """lang, length, first, second, third, f: all phrases of up to three words that come up ``least`` times or more, and
    with length 0 the number of all word occurrences of the language."""
    spark = docs.sparkSession
    ranges = ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64())
    names = ["lang", "length", "first", "second", "third", "f"]

    def merge(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("words", "ids", "records", "words_size")]
        words, records = merged([unpacked(*s) for s in zip(*columns, strict=True)])
        out = [(length, a, b, c, f) for length, a, b, c, f in streams(words, records, least)]
        made = [pa.array([table.column("lang")[0].as_py()] * len(out), kinds[0])]
        for column, kind in zip(zip(*out), kinds[1:]):
            binary = pa.types.is_string(kind)
            made.append(pa.array(column, pa.binary()).view(pa.string()) if binary else pa.array(column, kind))
        return pa.Table.from_arrays(made, names)

    parts = runs(docs, bounds(docs, ranges), run).groupBy("lang", "range").applyInArrow(merge, STREAM)
    keys = ["lang", "length", "first", "second", "third"]
    return parts.groupBy(*keys).agg(F.sum("f").alias("f")).where((F.col("length") == 0) | (F.col("f") >= least))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exact."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    whole = F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(SCALE).cast("decimal(7,0)"), left * right)
    return whole.cast("bigint")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, run: int = RUN, ranges: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two and three words.

    a: the phrase's count; l, r: those of the two parts at its lowest-scoring cut; n: all word occurrences.
    """
    found = staged(count_streams(docs, least, run, ranges))

    def stream(length: int, names: dict[str, str], count: str) -> DataFrame:
        return found.where(F.col("length") == length).select("lang", *[F.col(c).alias(n) for c, n in names.items()], F.col("f").alias(count))

    def joined(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
        return left.join(right.hint("merge"), ["lang", *on], how)

    # Prefix order: a phrase next to its first parts. Suffix order: next to its rest.
    pairs = stream(2, {"first": "first", "second": "second"}, "a")
    pairs = joined(pairs, stream(1, {"first": "first"}, "l1"), ["first"])
    pairs = joined(pairs, stream(1, {"first": "second"}, "r1"), ["second"])
    three = stream(3, {"first": "first", "second": "second", "third": "third"}, "a")
    # Extension counts: the most frequent phrase that goes on with a pair, or ends with it.
    longer = three.select("lang", "first", "second", "a").union(three.select("lang", "second", "third", "a"))
    longer = longer.groupBy("lang", "first", "second").agg(F.max("a").alias("longer"))
    pairs = joined(pairs, longer, ["first", "second"], "left")
    pairs = pairs.where(F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a")))

    three = joined(three, stream(2, {"first": "first", "second": "second"}, "l2"), ["first", "second"])
    three = joined(three, stream(1, {"first": "first"}, "l1"), ["first"])
    three = joined(three, stream(2, {"first": "second", "second": "third"}, "r1"), ["second", "third"])
    three = joined(three, stream(1, {"first": "third"}, "r2"), ["third"])

    scored = pairs.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", F.array(_cut(1)).alias("cuts")).union(
        three.select("lang", F.concat_ws(" ", "first", "second", "third").alias("phrase"), "a", F.array(_cut(1), _cut(2)).alias("cuts"))
    )
    scored = scored.select("lang", "phrase", "a", F.array_min("cuts").alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # Spark keeps the first rows of each task before it brings a language's together.
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(stream(0, {}, "n"), "lang").select("lang", F.col("rank").cast("bigint"), "phrase", "a", "l", "r", "n", "score")


def _cut(words: int) -> Column:
    left, right = F.col(f"l{words}"), F.col(f"r{words}")
    score = _score(F.col("a"), left, right)
    return F.struct(score.alias("score"), F.lit(words).alias("words"), left.alias("l"), right.alias("r"))


#: DuckDB SQL for :func:`collocations`' rows.
COLLOCATION_SQL = f"""
WITH p AS (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
o AS (SELECT lang, piece, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM w),
n AS (SELECT lang, a, lead(a, 1) OVER s AS b, lead(a, 2) OVER s AS c FROM o WINDOW s AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS k, a AS phrase, count(*) AS f FROM n GROUP BY ALL
  UNION ALL SELECT lang, 2, concat_ws(' ', a, b), count(*) FROM n WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, concat_ws(' ', a, b, c), count(*) FROM n WHERE c IS NOT NULL GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM g WHERE k > 1 AND f >= {LEAST}),
cut AS (SELECT c.lang, c.phrase, c.k, c.f AS a, h.f AS l, r.f AS r, j,
    ({SCALE}::HUGEINT * c.f * c.f // (h.f::HUGEINT * r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN g h ON h.lang = c.lang AND h.k = j AND h.phrase = array_to_string(c.ws[1 : j], ' ')
  JOIN g r ON r.lang = c.lang AND r.k = c.k - j AND r.phrase = array_to_string(c.ws[j + 1 : c.k], ' ')),
least_cut AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (SELECT lang, array_to_string(ws[1 : 2], ' ') AS phrase, f FROM c WHERE k = 3
  UNION ALL SELECT lang, array_to_string(ws[2 : 3], ' '), f FROM c WHERE k = 3),
most AS (SELECT lang, phrase, max(f) AS f FROM longer GROUP BY lang, phrase),
kept AS (SELECT l.* FROM least_cut l LEFT JOIN most x ON x.lang = l.lang AND x.phrase = l.phrase
  WHERE x.f IS NULL OR 100 * x.f < {COVERED} * l.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM ranked JOIN t USING (lang) WHERE rank <= {TOP}
"""
