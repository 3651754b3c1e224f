"""Daily spines and running balances.

A spine is never joined: each entity carries a generated array of days, so there is no
cross join and no exchange for the widening itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.functions import as_date
from tallyworks.operators.skew import group_apart


def date_spine(spark: SparkSession, as_of: dt.date | str, days: int = 30) -> DataFrame:
    """One row per day from ``as_of`` to ``as_of + days``, both included."""
    return spark.range(days + 1).select(F.date_add(as_date(as_of), F.col("id").cast("int")).alias("date"))


def horizon(as_of: dt.date | str, days: int = 30) -> Column:
    """The same days as an array column."""
    start = as_date(as_of)
    return F.sequence(start, F.date_add(start, days))


def spread_over(df: DataFrame, as_of: dt.date | str, days: int = 30, out: str = "date") -> DataFrame:
    """Repeat every row for each day of the horizon."""
    return df.withColumn(out, F.explode(horizon(as_of, days)))


def densify(df: DataFrame, keys: Sequence[str], as_of: dt.date | str, days: int = 30) -> DataFrame:
    """Every distinct key on every day."""
    return spread_over(df.select(*keys).distinct(), as_of, days)


def running_balance(
    df: DataFrame, partition: Sequence[str], order: str, changes: Mapping[str, Column]
) -> DataFrame:
    """Cumulative sums by ``order`` within ``partition``.

    Meant for daily rows: the caller aggregates to one row per key and day first, so a
    partition is as long as the horizon, whatever the size of the facts behind it.
    """
    w = (
        Window.partitionBy(*partition)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumns({name: F.sum(expr).over(w) for name, expr in changes.items()})


def running_balance_in_blocks(
    df: DataFrame, partition: Sequence[str], order: Sequence[str], changes: Mapping[str, Column]
) -> DataFrame:
    """Cumulative sums by ``order`` within ``partition``, for partitions of any size.

    Two levels of prefix sums: a block is a partition's rows of one value of the first order column. The blocks' totals are summed
    up over the small table of blocks, and rows only within their block, so the rows of a large partition
    go to as many tasks as it has blocks. The same as one window over the partition: NULLs are skipped, and
    until a known value comes the sum is NULL. NULL keys are a partition of their own and come first in the order.
    """
    lead, *rest = order
    keys = [*partition, lead]
    inner = Window.partitionBy(*keys).orderBy(*(rest or [lead]))
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = {name: f"_own{i}" for i, name in enumerate(changes)}
    before = {name: f"_before{i}" for i, name in enumerate(changes)}
    totals = group_apart(df, keys, {own[name]: F.sum(expr) for name, expr in changes.items()})
    ahead = Window.partitionBy(*partition).orderBy(lead).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        *[F.sum(own[name]).over(ahead).alias(before[name]) for name in changes],
    )
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    summed = df.withColumns({own[name]: F.sum(expr).over(inner) for name, expr in changes.items()})
    joined = summed.join(offsets, reduce(and_, same))

    def total(name: str) -> Column:
        kind = joined.schema[own[name]].dataType
        zero = F.lit(0).cast(kind)
        both = F.coalesce(own[name], zero) + F.coalesce(before[name], zero)
        return F.when(F.col(own[name]).isNotNull() | F.col(before[name]).isNotNull(), both.cast(kind))

    return joined.select(*df.columns, *[total(name).alias(name) for name in changes])
