"""Fold child rows into arrays of structs, and unfold them again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_list(element: Column) -> Column:
    """Array of the group's elements in a fixed order; NULL elements are left out."""
    return F.sort_array(F.collect_list(element))


def _collected(
    rows: DataFrame,
    keys: Sequence[str],
    arrays: Mapping[str, Column],
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key with sorted arrays. Every element moves once.

    Each task collects its own elements of a key first; only these partial arrays come together. A
    long group costs no task more than the document it becomes.
    """
    flags = flags or {}
    return rows.groupBy(*keys).agg(
        *[sorted_list(e).alias(n) for n, e in arrays.items()],
        *[F.bool_or(c).alias(n) for n, c in flags.items()],
    )


def fold(
    rows: DataFrame,
    keys: Sequence[str],
    out: str,
    element: Column,
    *,
    split_on: Sequence[str] = (),
    flags: Mapping[str, str] | None = None,
) -> DataFrame:
    """One document per key with the array ``out``.

    ``split_on`` names the identity of an element; one grouping makes the document without it.
    ``flags`` maps an output to a boolean column: whether it holds for any of the key's rows.
    """
    return _collected(rows, keys, {out: element}, flags)


def fold_many(
    children: Mapping[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str], *, split_on: str = ""
) -> DataFrame:
    """Fold several child tables of the same parent together.

    ``children`` maps the array name to (rows, element columns). The tables are stacked, each
    row carrying one struct, and grouped once, instead of one grouping and one join per table.
    Parents with children get every array, empty where a table has none.
    """
    stacked = None
    for name, (rows, fields) in children.items():
        layer = rows.select(*keys, F.struct(*fields).alias(f"__{name}"))
        stacked = (
            layer if stacked is None else stacked.unionByName(layer, allowMissingColumns=True)
        )
    return _collected(stacked, keys, {name: F.col(f"__{name}") for name in children})


def unfold(
    documents: DataFrame, array: str, keep: Sequence[str | Column], *, outer: bool = False
) -> DataFrame:
    """One row per array element: kept parent columns plus the element's fields."""
    spread = F.explode_outer(array) if outer else F.explode(array)
    return documents.select(*keep, spread.alias("__item")).select("*", "__item.*").drop("__item")
