"""Spans that patterns match in texts, found and digested in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string,value:string>>"


class Kind(NamedTuple):
    """A kind of span: its pattern, a cheap test that a text may hold one, what a match must pass,
    and the group of the pattern that is its value."""

    name: str
    pattern: str
    may_hold: Callable[[Column], Column]
    passes: Callable[[Column], Column] = lambda value: F.lit(True)
    value_group: int = 0


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` loops over it."""
    return F.transform(F.array(value), use)[0]


def _starts(gaps: Column, lengths: Column) -> Column:
    """Where each match starts, from the texts between matches and the matches' lengths.

    Sums run over whole chunks first and then inside a chunk, so long texts with very many matches
    do not take the square of their number.
    """
    n = F.size(lengths)
    steps = F.transform(lengths, lambda x, i: x + F.char_length(F.get(gaps, i)))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0), lambda a, x: a + x)

    def inner(steps: Column) -> Column:
        heads = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")),
                            lambda c: total(F.slice(steps, c * CHUNK + 1, F.lit(CHUNK))))
        return let(heads, lambda heads: let(
            F.transform(heads, lambda x, c: total(F.slice(heads, F.lit(1), c))),
            lambda bases: F.transform(lengths, lambda x, i: (
                F.get(bases, F.floor(i / CHUNK).cast("int"))
                + total(F.slice(steps, F.floor(i / CHUNK).cast("int") * CHUNK + 1, i % CHUNK))
                + F.char_length(F.get(gaps, i))))))

    return let(steps, inner)


def spans_of(text: Column, kind: Kind, kind_no: int) -> Column:
    """All spans of one kind in a text, by start: code points, end exclusive.

    Matches are leftmost and do not overlap; those that fail the kind's test are then dropped. The
    texts between the matches give their places.
    """
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = (F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value_group))
              if kind.value_group else matches)

    def placed(matches: Column, values: Column, gaps: Column) -> Column:
        lengths = F.transform(matches, lambda m: F.char_length(m))
        starts = let(lengths, lambda lengths: _starts(gaps, lengths))
        return let(starts, lambda starts: F.filter(
            F.transform(matches, lambda m, i: F.struct(
                F.get(starts, i).alias("start"), F.lit(kind_no).alias("kind_no"),
                (F.get(starts, i) + F.char_length(m)).alias("end"),
                F.lit(kind.name).alias("kind"), F.get(values, i).alias("value"))),
            lambda s: kind.passes(s["value"])))

    none = F.array().cast(SPAN)
    found = let(matches, lambda m: F.when(F.size(m) == 0, none).otherwise(
        let(values, lambda v: F.when(F.exists(v, kind.passes), let(
            F.split(text, kind.pattern, -1), lambda gaps: placed(m, v, gaps)))
            .otherwise(none))))
    return F.when(kind.may_hold(text), found).otherwise(none).cast(SPAN)


def blanked(text: Column, kinds: Sequence[Kind], blank: str = " ") -> Column:
    """The text with the spans of all kinds as blanks, so places stay and nothing else matches there.

    Kinds are taken one after another, each on what the ones before it left.
    """
    def without(text: Column, kind: Kind) -> Column:
        matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        values = (F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.value_group))
                  if kind.value_group else matches)

        def rebuilt(matches: Column, values: Column) -> Column:
            spaces = F.zip_with(matches, values, lambda m, v: F.when(
                kind.passes(v), F.repeat(F.lit(blank), F.char_length(m))).otherwise(m))
            return F.array_join(F.zip_with(F.split(text, kind.pattern, -1), spaces, lambda gap, m:
                                           F.concat(gap, F.coalesce(m, F.lit("")))), "")

        cut = let(matches, lambda m: F.when(F.size(m) == 0, text).otherwise(
            let(values, lambda v: F.when(F.exists(v, kind.passes), rebuilt(m, v)).otherwise(text))))
        return F.when(kind.may_hold(text), cut).otherwise(text)

    return reduce(lambda use, kind: lambda text: let(without(text, kind), use),
                  reversed(kinds), lambda text: text)(text)


def in_order(spans: Column) -> Column:
    """Spans by start, then as their kinds are listed."""
    return F.array_sort(spans)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans in order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind_no: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind_no"] == kind_no)).cast("bigint")


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    """Whether the digits of a value have a valid check digit."""
    digits = F.split(F.reverse(digits_of(value)), "")
    doubled = F.transform(F.filter(digits, lambda d: d != ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0
