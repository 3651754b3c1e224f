"""Percent allocation of costs to applications, owners and regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import as_factor, charge_share, exact, product


def split_cost(df: DataFrame, amount: Column, pct: Column) -> tuple[Column, Column]:
    """(allocated, remaining) parts of an amount of ``df``; a missing percentage allocates nothing."""
    share = charge_share(df, amount, pct)
    return share, exact(df, amount).col - share


def factor_of(df: DataFrame, pct: Column) -> Column:
    """Percent to factor, NULL staying NULL."""
    return as_factor(exact(df, pct)).col


def weigh(df: DataFrame, total: Column, pct: Column, digits: int | None = None) -> Column:
    """A summed amount times a percentage, optionally rounded; NULL percentage gives NULL."""
    out = product(exact(df, total), as_factor(exact(df, pct))).col
    return out if digits is None else F.round(out, digits)


def subtotal(df: DataFrame, keys: Sequence[str], value: Column, out: str) -> DataFrame:
    """Sum facts to the keys that later joins and groups need.

    Allocation reports join each cost line with every region or component of its
    application. Summing first gives the same totals, as decimals add exactly, and the
    joins then widen totals per application instead of cost lines.
    """
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def grid_sides(left: int, right: int, tasks: int) -> tuple[int, int]:
    """Blocks (of left, of right) whose product is about ``tasks``, with the fewest copies.

    Each row of a side is copied once per block of the other, so the larger side gets more blocks.
    """
    of_right = max(1, min(tasks, round((tasks * max(right, 1) / max(left, 1)) ** 0.5)))
    return max(1, -(-tasks // of_right)), of_right


def in_grid(left: DataFrame, right: DataFrame, rows: int, columns: int) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt over a grid, so that each pair of rows meets in one cell: join on ``_row`` and ``_column``.

    A row's own block follows from its values, so a task that runs again deals alike.
    """

    def block(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = left.withColumn("_row", block(left, rows)).withColumn("_column", each(columns))
    other = right.withColumn("_column", block(right, columns)).withColumn("_row", each(rows))
    return dealt, other


def pair_with(df: DataFrame, dimension: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every row with every row of a dimension, without a nested loop.

    The dimension is measured. If it is smaller than Spark's limit for broadcasts, its rows go along as one array and
    are exploded in place: no row of ``df`` is copied before, moved or joined. Otherwise both sides are measured and dealt
    over a grid of about ``tasks`` cells, by default four for each shuffle partition, and joined by cell.
    """
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    fields = [F.col(f"`{c}`") for c in dimension.columns]
    size = F.sum(F.length(F.to_json(F.struct(*fields)))).alias("size")
    n, size = dimension.agg(F.count(F.lit(1)).alias("n"), size).first()
    if (size or 0) < limit:
        whole = dimension.agg(F.collect_list(F.struct(*fields))).scalar()
        return df.withColumn("_pair", F.explode(whole)).select(*df.columns, "_pair.*")
    tasks = tasks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    left, right = in_grid(df, dimension, *grid_sides(df.count(), n, tasks))
    return left.join(right, ["_row", "_column"]).drop("_row", "_column")
