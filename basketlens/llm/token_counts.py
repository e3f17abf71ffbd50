"""Token counts that follow edits: a segment tree over the pre-token runs of a document.

A byte-level BPE with the given pre-token pattern never joins a character that is not white space
with white space that follows it, and what it makes of the text after such a place does not depend
on what stands before. A document is cut at some of these places into leaves of about ``LEAF``
characters. The tree holds characters and tokens of every leaf and their sums, so an edit finds
its leaves by their positions in the text. Only the touched leaves are encoded again, together
with as many neighbours as it takes until the region again starts with white space and ends
without, and the sums above are updated.

Edits are applied in order; positions are code points of the text as the earlier edits left it,
clipped to it (an end before the start counts as the start). A null text counts as an empty one,
null edits as none, a null replacement as the empty text, a null position as 0. Repeated rows give repeated
results, an empty table none; other columns may have any name. Texts may be of any length; runs of white space too.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

RANKS_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"
LEAF = 512
LONG_RUN = 10_000  # characters from which white space is encoded without the pattern
#: Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
EDITS = "array<struct<start: bigint, stop: bigint, replacement: string>>"
#: White space by the pattern's meaning (Unicode's White_Space), which is not Python's.
SPACES = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CUT = re.compile(rf"[^{SPACES}](?=[{SPACES}])")
_SPACE = re.compile(rf"[{SPACES}]")
_LONG_RUN = re.compile(rf"[{SPACES}]{{{LONG_RUN},}}")


@lru_cache(maxsize=4)
def encoding(ranks_file: str) -> tiktoken.Encoding:
    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(ranks_file: str, text: str) -> int:
    """Tokens of a text.

    The pattern's look-ahead walks back over a run of white space, which very long ones do not survive. So these
    are encoded as the one piece that the pattern makes of them: all but the last character before something
    else, all of them at the end.
    """
    whole, total, at = encoding(ranks_file), 0, 0
    for run in _LONG_RUN.finditer(text):
        stop = run.end() - (run.end() < len(text))
        total += len(whole.encode_ordinary(text[at : run.start()]))
        total += len(whole._encode_single_piece(text[run.start() : stop]))
        at = stop
    return total + len(whole.encode_ordinary(text[at:]))


def leaves(text: str, size: int = LEAF) -> list[str]:
    """The text in parts that can be encoded alone; a run without such a place is one part."""
    out, start = [], 0
    while len(text) - start > size:
        found = _CUT.search(text, start + size - 1)
        if not found:
            break
        out.append(text[start : found.end()])
        start = found.end()
    out.append(text[start:])
    return out


class TokenTree:
    """Characters and tokens of a document's leaves, summed up in a complete binary tree."""

    def __init__(self, text: str, ranks_file: str = RANKS_FILE, size: int = LEAF):
        self.file = ranks_file
        self.leaf = leaves(text, size)
        self.width = 1 << max(0, len(self.leaf) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        self.encoded = 0  # characters encoded by edits
        for i, part in enumerate(self.leaf):
            self.chars[self.width + i] = len(part)
            self.tokens[self.width + i] = count(ranks_file, part)
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaf)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf with this position, and the position in it; the end belongs to the last one."""
        node = 1
        while node < self.width:
            node *= 2
            if at >= self.chars[node] and self.chars[node + 1]:
                at -= self.chars[node]
                node += 1
        return node - self.width, at

    def _put(self, i: int, part: str, tokens: int) -> None:
        self.leaf[i] = part
        node = self.width + i
        self.chars[node], self.tokens[node] = len(part), tokens
        while node > 1:
            node //= 2
            self._sum(node)

    def _filled(self, i: int, step: int) -> int | None:
        """The next leaf that has characters, in the given direction."""
        i += step
        while 0 <= i < len(self.leaf) and not self.leaf[i]:
            i += step
        return i if 0 <= i < len(self.leaf) else None

    def edit(self, start: int, stop: int, replacement: str) -> None:
        start = min(max(start, 0), self.chars[1])
        stop = min(max(stop, start), self.chars[1])
        first, offset = self._find(start)
        last, end = self._find(stop)
        region = self.leaf[first][:offset] + replacement + self.leaf[last][end:]
        while (before := self._filled(first, -1)) is not None and not _SPACE.match(region):
            first, region = before, self.leaf[before] + region
        while (after := self._filled(last, 1)) is not None and (not region or _SPACE.match(region[-1])):
            last, region = after, region + self.leaf[after]
        self.encoded += len(region)
        self._put(first, region, count(self.file, region))
        for i in range(first + 1, last + 1):
            if self.leaf[i]:
                self._put(i, "", 0)


def _counted(ranks_file: str):
    def counted(texts: pa.Array, edits: pa.Array) -> pa.Array:
        rows = []
        for value, changes in zip(texts, edits, strict=True):
            tree = TokenTree(value.as_py() or "", ranks_file)
            before, many, chars = tree.total, 0, tree.chars[1]
            for e in changes.as_py() or []:
                if e is not None:
                    many += 1
                    tree.edit(e["start"] or 0, e["stop"] or 0, e["replacement"] or "")
            rows.append((chars, before, many, tree.total, tree.chars[1], tree.encoded, len(tree.leaf)))
        names = ("n_chars", "n_tokens", "n_edits", "n_tokens_edited", "n_chars_edited", "n_chars_encoded", "n_leaves")
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], list(names)
        )

    kind = "n_chars n_tokens n_edits n_tokens_edited n_chars_edited n_chars_encoded n_leaves".split()
    return arrow_udf(counted, f"struct<{', '.join(f'{name}: bigint' for name in kind)}>")


def token_counts(docs: DataFrame, edits: Column, ranks_file: str = RANKS_FILE) -> DataFrame:
    """Counts of every whole text before and after its edits (:data:`EDITS`), one row for each row.

    doc_id, n_chars, n_tokens, n_edits, n_tokens_edited, n_chars_edited, n_chars_encoded (by the
    edits), n_leaves.
    """
    return docs.select("doc_id", _counted(ranks_file)(F.col("text"), edits).alias("p")).select("doc_id", F.col("p.*"))


def sample_edits(text: Column) -> Column:
    """A replacement, an insertion and a deletion, at places that depend on the text's length."""
    size = F.coalesce(F.length(text), F.lit(0)).cast("bigint")
    quarter, half = F.floor(size / 4), F.floor(size / 2)

    def change(start: Column, stop: Column, replacement: Column) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), replacement.alias("replacement"))

    return F.array(
        change(quarter, quarter + 12, F.substring(text, 1, 20)),
        change(half, half, F.lit(" (see the note below)\n")),
        change(3 * quarter, 3 * quarter + 30, F.lit("")),
    )


def counts_with_sample_edits(docs: DataFrame, ranks_file: str = RANKS_FILE) -> DataFrame:
    return token_counts(docs, sample_edits(F.col("text")), ranks_file)
