"""Column helpers for operators that stay in the JVM: bound values, words, spans of matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\x01"
#: Everything but letters, digits and what lies beyond ASCII separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_BITS = 12
PIECE = 1 << PIECE_BITS
POWERS = [1 << bit for bit in range(31)]
NO_SPANS = "cast(array() as array<struct<start: int, stop: int, value: string>>)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    """The words of the whole text, A-Z in lower case; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def running(values: Column, joined: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    """An array whose place i joins ``values`` up to i, by default their sums.

    Arrays are copied by as many passes as the length has binary digits, not once for each value.
    """

    def doubled(so_far: Column, step: Column) -> Column:
        return F.transform(
            so_far, lambda value, i: F.when(i >= step, joined(F.get(so_far, i - step), value)).otherwise(value)
        )

    return F.aggregate(F.filter(F.array(*map(F.lit, POWERS)), lambda step: step < F.size(values)), values, doubled)


def below(ordered: Column, value: Column) -> Column:
    """How many values of a sorted array are less than ``value``, by halving."""
    steps = F.filter(F.array(*map(F.lit, reversed(POWERS))), lambda step: step <= F.size(ordered))

    def further(place: Column, step: Column) -> Column:
        less = F.coalesce(F.get(ordered, place + step - 1) < value, F.lit(False))
        return F.when(less, place + step).otherwise(place)

    return F.aggregate(steps, F.lit(0), further)


def pieces(text: Column) -> Column:
    """The text in pieces of :data:`PIECE` characters, for :func:`cut`."""
    many = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.length(text) <= PIECE, F.array(text)).otherwise(many)


def cut(parts: Column, start: Column, stop: Column) -> Column:
    """The characters from ``start`` up to ``stop`` of a text given as :func:`pieces`, without walking to them."""

    def inside(number: Column) -> Column:
        first = F.greatest(start - number * PIECE, F.lit(0))
        last = F.least(stop - number * PIECE, F.lit(PIECE))
        return F.substring(F.get(parts, number), first + 1, last - first)

    numbers = F.sequence(F.shiftright(start, PIECE_BITS), F.shiftright(stop - 1, PIECE_BITS))
    return F.when(start < stop, F.array_join(F.transform(numbers, inside), "")).otherwise(F.lit(""))


def matches(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` from the left, without overlaps, as (start, stop, value).

    Positions are code points. ``pattern`` must not match :data:`MARK` and ``text`` not hold it:
    matches are set off by marks, the text is split at these, and lengths are summed up.
    """
    parts = F.split(F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{MARK}")), MARK, -1)

    def spans(part: Column, stops: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(part) - 1, F.lit(2)),
            lambda i: F.struct(
                (F.get(stops, i) - F.length(F.get(part, i))).alias("start"),
                F.get(stops, i).alias("stop"),
                F.get(part, i).alias("value"),
            ),
        )

    def found(part: Column) -> Column:
        placed = let(running(F.transform(part, F.length)), lambda stops: spans(part, stops))
        return F.when(F.size(part) > 1, placed).otherwise(F.expr(NO_SPANS))

    return let(parts, found)
