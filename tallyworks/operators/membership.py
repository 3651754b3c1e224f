"""Membership tests, latest snapshots and imputation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import as_date
from tallyworks.operators.skew import distinct_keys


def _passes_nulls(col: str, other: DataFrame, key: str) -> Column:
    """What NULLs do to ``col NOT IN (other.key)``, from one look at the other side's counts.

    An empty list passes every row, a list with a NULL passes none, any other list passes
    the rows whose ``col`` is known.
    """
    rows, known = F.count(F.lit(1)), F.count(key)
    forced = other.agg(F.when(rows == 0, True).when(rows > known, False).alias("forced")).scalar()
    return F.coalesce(forced, F.col(col).isNotNull())


def not_in(df: DataFrame, col: str, other: DataFrame, key: str) -> DataFrame:
    """Rows whose ``col`` is NOT IN the other side's ``key``, with SQL's NULL rules.

    Same answer as the SQL predicate, by an anti join whose strategy follows the size of
    the sides; the predicate itself always broadcasts its list.
    """
    listed = distinct_keys(other, F.col(key).alias(col))
    return df.filter(_passes_nulls(col, other, key)).join(listed, col, "left_anti")


def mark_in(df: DataFrame, col: str, other: DataFrame, key: str, out: str) -> DataFrame:
    """Add a boolean: is ``col`` among the other side's keys. Unknown counts as no."""
    listed = distinct_keys(other, F.col(key).alias(col)).withColumn(out, F.lit(True))
    return df.join(listed, col, "left").withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def _marked(df: DataFrame, cols: Sequence[str], other: DataFrame, key: str) -> tuple[DataFrame, list[Column]]:
    hits = []
    for i, col in enumerate(cols):
        df = mark_in(df, col, other, key, f"_hit{i}")
        hits.append(F.col(f"_hit{i}"))
    return df, hits


def in_any(df: DataFrame, cols: Sequence[str], other: DataFrame, key: str) -> DataFrame:
    """Rows where at least one of ``cols`` is among the other side's keys."""
    marked, hits = _marked(df, cols, other, key)
    return marked.filter(reduce(or_, hits)).select(*df.columns)


def mark_sides(
    df: DataFrame, cols: Sequence[str], locations: DataFrame, key: str, out: str, inside: str, outside: str
) -> DataFrame:
    """Label rows as inside or outside a location list, tested on several columns.

    Inside: any column is listed. Outside: no column is, where a NULL column is unknown.
    A row with a NULL and no listed column is neither and gets NULL.
    """
    marked, hits = _marked(df, cols, locations, key)
    free = [_passes_nulls(col, locations, key) & ~hit for col, hit in zip(cols, hits)]
    side = F.when(reduce(or_, hits), inside).when(reduce(and_, free), outside)
    return marked.select(*df.columns, side.alias(out))


def split_by_membership(
    df: DataFrame, cols: Sequence[str], locations: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Rows (inside, outside) a location list; see :func:`mark_sides`."""
    marked = mark_sides(df, cols, locations, key, "_side", "in", "out")
    return tuple(marked.filter(F.col("_side") == s).drop("_side") for s in ("in", "out"))


def in_domain(df: DataFrame, col: str, values: Iterable[str]) -> DataFrame:
    """Keep rows whose value is in a fixed list; the list reaches the file scan."""
    return df.filter(F.col(col).isin(*values))


def snapshot_day(df: DataFrame, col: str, as_of: dt.date | str, lag: int = 3) -> DataFrame:
    """Rows dated ``lag`` days before ``as_of``."""
    return df.filter(F.col(col) == F.date_sub(as_date(as_of), lag))


def latest(df: DataFrame, col: str, source: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """Rows at the greatest value of ``col`` among the rows of ``source`` passing ``where``."""
    base = df if source is None else source
    if where is not None:
        base = base.filter(where)
    return df.filter(F.col(col) == base.agg(F.max(col)).scalar())


def latest_plan(plans: DataFrame, name: str = "tco_financial_plan_nm") -> Column:
    """Name of the latest plan, in text order, as a scalar for use in filters."""
    return plans.agg(F.max(name)).scalar()


def anti(df: DataFrame, other: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows without a partner on the paired columns; a NULL key has no partner."""
    listed = distinct_keys(other, *[F.col(r).alias(l) for l, r in on.items()])
    return df.join(listed, list(on), "left_anti")


def impute_mean(
    grid: DataFrame,
    observed: DataFrame,
    means: DataFrame,
    day_keys: Sequence[str],
    mean_keys: Sequence[str],
    value: str,
    mean: str,
) -> DataFrame:
    """Observed values on the grid; where a day has none, the group means.

    Repeated equal values of one day count once. Keys without any mean are dropped.
    """
    filled = grid.join(observed.select(*day_keys, value), list(day_keys), "left").join(
        means.select(*mean_keys, mean), list(mean_keys)
    )
    return filled.select(*grid.columns, F.coalesce(value, mean).alias(value)).distinct()
