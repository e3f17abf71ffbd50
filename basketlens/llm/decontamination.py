"""Benchmark decontamination by a prefix-filtered join, in Spark's own column functions only.

Every benchmark item gives its windows of ``WINDOW`` words in a row (all its words if it has
fewer). Containing a window means containing its rarest word, so that word, the necessary prefix
of the window's words ordered by rarity, is all that is joined: documents' words with
their positions against the windows by their rarest word. Rarity is counted over all documents. A joined row whose
window would begin before the document or end after it (positional and length bounds) is dropped,
all others are verified against the document's words. Join and check happen in one pass over each
document; only found windows are shuffled.

The windows are sent to all tasks in blocks of ``BLOCK_BYTES`` at most, one pass over the
documents for each block, so a large benchmark needs more passes, not more memory.

Null and empty texts have no words; items without words have no windows. Several benchmark rows of
one item count as one item. A word is a run of ASCII letters, digits and characters beyond ASCII,
with A-Z in lower case. Of words equally rare in a window the smallest is its prefix. Each row of
the documents is judged by itself, so repeated rows have equal results; an empty table of documents
has none, an empty benchmark hits nothing. The words of a text, however long, are one array in one task. Other columns
than the id and the text are not read; :func:`decontaminated` hands them on, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import free_name
from basketlens.llm.native import words

WINDOW = 13
BLOCK_BYTES = 32 << 20
LEAST_SHARE = 20  # contaminated: at least one word in so many is hit
_EVERY = ""  # no word; stands once in every document to carry the number of its words


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """item, window (its words): every window of every item."""
    items = benchmark.select(F.col("item_id").alias("item"), words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    return items.select("item", F.explode(F.transform(starts, lambda i: F.slice(F.col("w"), i, size))).alias("window")).distinct()


def _small(df: DataFrame, bytes_: int) -> DataFrame:
    """Sent to all tasks if that many bytes are few, else left to Spark's choice of join."""
    return F.broadcast(df) if bytes_ <= BLOCK_BYTES else df


def _size(df: DataFrame, column: Column) -> int:
    return df.agg(F.sum(column)).first()[0] or 0


def prefixes(windows: DataFrame, docs: DataFrame, text: str) -> tuple[DataFrame, int]:
    """token, offset, window: every distinct window under its rarest word; and their bytes."""
    only = windows.select("window").distinct()
    vocabulary = only.select(F.explode("window").alias("token")).distinct()
    weight = _size(vocabulary, F.length("token") + 32)
    said = docs.select(F.explode(words(F.col(text))).alias("token"))
    counts = said.join(_small(vocabulary, weight), "token", "left_semi").groupBy("token").agg(F.count("*").alias("many"))
    placed = only.select("window", F.posexplode("window").alias("offset", "token"))
    ranked = placed.join(counts, "token", "left").withColumn("many", F.coalesce("many", F.lit(0)))
    best = ranked.groupBy("window").agg(F.min(F.struct("many", "token", "offset")).alias("p"))
    found = best.select("p.token", F.col("p.offset").cast("int").alias("offset"), "window").where("p.many > 0")
    return found, _size(only, F.aggregate("window", F.lit(64), lambda n, w: n + F.length(w) * 2 + 16))


def occurrences(docs: DataFrame, keys: list[str], text: str, found: DataFrame, bytes_: int) -> DataFrame:
    """keys, n_words, start, window of each occurrence, and one row without window per document."""
    blocks = max(1, -(-bytes_ // BLOCK_BYTES))
    read = docs.select(*keys, words(F.col(text)).alias("__words"))
    mark = found.sparkSession.range(1).select(
        F.lit(_EVERY).alias("token"), F.lit(0).alias("offset"), F.lit(None).cast("array<string>").alias("window")
    )
    parts = []
    for block in range(blocks):
        of = found.where(F.pmod(F.xxhash64("token"), F.lit(blocks)) == block) if blocks > 1 else found
        of = of.unionByName(mark) if block == 0 else of
        heard = F.concat("__words", F.array(F.lit(_EVERY))) if block == 0 else F.col("__words")
        each = read.select(*keys, "__words", F.posexplode(heard).alias("__pos", "token"))
        start = F.col("__pos") - F.col("offset")
        fits = (start >= 0) & (start + F.size("window") <= F.size("__words"))
        same = F.slice("__words", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window")
        parts.append(
            each.alias("d").join(
                F.broadcast(of.alias("w")),
                (F.col("d.token") == F.col("w.token")) & (F.col("window").isNull() | (fits & same)),
            ).select(*keys, F.size("__words").alias("n_words"), start.alias("start"), "window")
        )
    return reduce(DataFrame.unionByName, parts)


def contamination(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", size: int = WINDOW) -> DataFrame:
    """One row for each value of ``keys``: n_words, n_hit, n_items, items (sorted ids), contaminated.

    Rows with equal keys must have equal texts. contaminated: n_hit > 0 and
    ``LEAST_SHARE`` * n_hit >= n_words.
    """
    windows = benchmark_windows(benchmark, size)
    found, bytes_ = prefixes(windows, docs, text)
    rows = occurrences(docs, keys, text, found, bytes_)
    positions = F.when(
        F.col("window").isNotNull(), F.sequence(F.col("start"), F.col("start") + F.size("window") - 1)
    ).otherwise(F.array(F.lit(-1)))
    hit = (
        rows.select(*keys, "n_words", F.explode(positions).alias("__at")).distinct()
        .groupBy(*keys).agg(F.max("n_words").cast("bigint").alias("n_words"), F.count(F.when(F.col("__at") >= 0, 1)).alias("n_hit"))
    )
    in_items = (
        rows.where(F.col("window").isNotNull()).select(*keys, "window").distinct()
        .join(_small(windows, bytes_), "window")
        .groupBy(*keys).agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    )
    on = reduce(lambda a, b: a & b, [F.col(f"h.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys])
    whole = hit.alias("h").join(in_items.alias("i"), on, "left")
    whole = whole.select(
        *[f"h.{k}" for k in keys], "n_words", "n_hit",
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
    )
    return whole.select(
        *keys, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items",
        ((F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__row"))
    found = contamination(rows, benchmark, ["__row", "doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is contaminated."""
    key = free_name(docs, "__content")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(text, F.lit("")), 256))
    found = contamination(keyed.select(key, text), benchmark, [key], text)
    return keyed.join(found.where("contaminated").select(key), key, "left_anti").select(*docs.columns)


CONTAMINATION_SQL = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM lowered),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM doc_words, sizes WHERE len(w) >= size)),
found AS (
  SELECT d.doc_id, d.size, d.i, k.item_id FROM doc_windows d JOIN item_windows k ON d.size = k.size AND d.gram = k.gram),
hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM (SELECT DISTINCT doc_id, size, i FROM found))
  GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(m.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(m.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items m ON d.doc_id = m.doc_id
"""
