"""Removing rows of large texts by decisions on them, without moving the texts where that can be."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldkit.session import settle

FEW_ROWS = 1_000_000


def checked(side: DataFrame, few_rows: int = FEW_ROWS) -> DataFrame:
    """A settled frame of narrow rows, hinted for broadcast while it counts ``few_rows`` at most.

    Beyond that the join shuffles as Catalyst sees fit; the result is the same.
    """
    return F.broadcast(side) if side.count() <= few_rows else side


def rows_in(docs: DataFrame, keys: dict[str, Column], listed: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose ``keys`` are (``left_semi``) or are not (``left_anti``) ``listed``.

    The names of ``keys`` are columns of ``listed``; null is equal to null. Columns of ``docs`` may
    have the same names.
    """
    mine = {name: f"__listed_{name}" for name in keys}
    same = reduce(and_, [value.eqNullSafe(F.col(mine[name])) for name, value in keys.items()])
    return docs.join(listed.select(*keys).withColumnsRenamed(mine), same, how)


def kept_rows(docs: DataFrame, keys: dict[str, Column], decided: DataFrame,
              few_rows: int = FEW_ROWS) -> DataFrame:
    """Rows of ``docs`` without those that ``decided`` says go, one row of those that are repeated.

    ``decided`` has the names of ``keys``, whether that row ``stays``, and how many such rows there
    are, ``n``; rows it does not name stay.
    """
    decided = settle(decided.filter("NOT stays OR n > 1"), "decided")
    alone = rows_in(docs, keys, checked(decided.select(*keys), few_rows), "left_anti")
    repeated = settle(decided.filter("stays").select(*keys), "repeated")
    if repeated.isEmpty():
        return alone
    several = rows_in(docs, keys, checked(repeated, few_rows), "left_semi").withColumns(
        {f"_{name}": value for name, value in keys.items()})
    one = several.dropDuplicates([f"_{name}" for name in keys])
    return alone.unionByName(one.select(docs.columns))
