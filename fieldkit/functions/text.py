"""Text columns: numbers out of lines, and rows into lines."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(line: Column) -> Column:
    """Split on any run of white space; leading and trailing space give no empty tokens."""
    return F.filter(F.split(line, r"\s+"), lambda t: t != "")


DECIMAL = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def number(token: Column) -> Column:
    """The double that a plain decimal number stands for.

    Anything else is null: words, hexadecimal numbers, numbers with a type letter, not-a-number, and
    what is infinite or too large for a double.
    """
    value = F.when(token.rlike(DECIMAL), token.try_cast("double"))
    return _once(value, lambda v: F.when(F.abs(v) < float("inf"), v))


def parse_numbers(line: Column) -> Column:
    """Numbers of a line separated by white space, each with optional commas around it.

    A token that is not a number becomes a null element for the caller to reject.
    """
    return F.transform(tokens(line), lambda t: number(F.btrim(t, F.lit(","))))


def is_clean(values: Column, width: int | None = None) -> Column:
    """True where every element parsed and, if given, there are exactly ``width`` of them."""
    def clean(found: Column) -> Column:
        complete = (F.size(found) > 0) & ~F.exists(found, lambda x: x.isNull())
        return complete if width is None else complete & (F.size(found) == width)

    return _once(values, clean)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def float_text(value: Column) -> Column:
    """A double as its shortest plain text with a decimal point, e.g. ``52.0``.

    Spark turns to exponents from 1e7 up and below 1e-3; between 1e-4 and 1e16 the digits are
    written out here.
    """
    size = F.abs(value)
    spark_plain = (size == 0) | size.between(1e-3, 9999999.0)
    spread = ((size >= 1e-4) & (size < 1e16))
    digits = F.regexp_replace(value.cast("decimal(38,21)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(~spark_plain & spread, digits).otherwise(value.cast("string"))


def float_list_text(values: Column) -> Column:
    """An array of doubles as ``[1.0, 2.5]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, float_text), ", "), F.lit("]"))


def tuple_text(columns: Sequence[Column]) -> Column:
    """Several doubles as ``(1.0, 2.5)``."""
    return F.concat(F.lit("("), F.concat_ws(", ", *[float_text(c) for c in columns]), F.lit(")"))
