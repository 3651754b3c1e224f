"""Rows to columns, alternative keys and totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.operators.skew import distinct_keys, group_apart


def category_columns(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    columns: Mapping[str, str],
    value: Column,
) -> DataFrame:
    """One summed, zero-filled column per category, in one aggregation.

    ``columns`` maps output name to category; rows of other categories do not count and
    do not make a key appear.
    """
    wanted = df.filter(F.col(category).isin(*columns.values()))
    sums = [
        F.coalesce(F.sum(F.when(F.col(category) == c, value)), F.lit(0)).alias(out) for out, c in columns.items()
    ]
    return wanted.groupBy(*keys).agg(*sums)


def stack_by_alt_key(
    df: DataFrame, cols: Sequence[str], locations: DataFrame, key: str, out: str
) -> DataFrame:
    """Rows keyed by each of several columns that names a listed location.

    A row whose columns both name one appears once per column.
    """
    listed = distinct_keys(locations, F.col(key).alias(out))
    return df.withColumn(out, F.explode(F.array(*cols))).join(listed, out, "left_semi")


def kind_lists(
    df: DataFrame, keys: Sequence[str], kind: str, lists: Mapping[str, tuple[str, Sequence[str]]]
) -> DataFrame:
    """One row per key with, per kind, the array of its rows' values, in one aggregation.

    ``lists`` maps output name to (kind, value columns). Whatever needs the kinds as columns can
    be read from this table, without reading or joining the rows again. A key's rows
    are held in one row, so keys should be as narrow as an invoice item.
    """
    wanted = df.filter(F.col(kind).isin(*[k for k, _ in lists.values()]))
    values = [
        F.collect_list(F.when(F.col(kind) == k, F.struct(*cols))).alias(out) for out, (k, cols) in lists.items()
    ]
    return wanted.groupBy(*keys).agg(*values)


def combinations(columns: Mapping[str, tuple[str, str]]) -> Column:
    """Every combination of one element of each list, as an array of structs; empty if a list is.

    ``columns`` maps field name to (list, field of its elements).
    """
    lists = list(dict.fromkeys(name for name, _ in columns.values()))

    def nest(picked: dict[str, Column]) -> Column:
        if len(picked) == len(lists):
            return F.array(F.struct(*[picked[name][field].alias(out) for out, (name, field) in columns.items()]))
        name = lists[len(picked)]
        return F.flatten(F.transform(F.col(name), lambda x: nest(picked | {name: x})))

    return nest({})


def conditions_wide(
    df: DataFrame, keys: Sequence[str], kind: str, columns: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """One row per key with a column per kind; keys lacking a kind are dropped.

    ``columns`` maps output name to (kind, value column). Keys with a repeated kind give
    every combination of its rows, as a join of the kinds would, but the rows are read once and nothing is
    joined: each kind's values are gathered in an array, and the arrays are exploded one after the other.
    """
    keys = list(keys)
    kinds = list(dict.fromkeys(k for k, _ in columns.values()))
    names = {k: f"_kind{i}" for i, k in enumerate(kinds)}
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    values = {names[k]: (k, list(dict.fromkeys(v for kk, v in columns.values() if kk == k))) for k in kinds}
    wide = kind_lists(df, keys, kind, values)
    for name in values:
        wide = wide.filter(F.size(name) > 0)
    for name in values:
        wide = wide.withColumn(name, F.explode(name))
    return wide.select(*keys, *[F.col(names[k])[v].alias(out) for out, (k, v) in columns.items()])


def with_header_totals(lines: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Lines with the sums of their header attached; lines without a key are dropped."""
    per_header = group_apart(lines, keys, {name: F.sum(expr) for name, expr in totals.items()})
    return lines.join(per_header, list(keys))
