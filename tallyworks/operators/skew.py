"""Grouping and key lists that keep later joins on the same key splittable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def group_apart(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Named aggregates per key, as a result that may be joined back to skewed facts.

    A plain aggregate is left hash-partitioned by its keys, and a join on those keys then
    takes it without an exchange. The adaptive skew split needs an exchange on both sides,
    so a hot key's facts would all go to one task. Grouping by the keys as one struct
    hides that partitioning: the small per-key result is exchanged once more and hot
    partitions of the facts are split at run time.
    """
    grouped = df.groupBy(F.struct(*keys).alias("_key")).agg(*[expr.alias(name) for name, expr in aggs.items()])
    return grouped.select("_key.*", *aggs)


def distinct_keys(df: DataFrame, *cols: Column) -> DataFrame:
    """Distinct non-NULL key rows for semi, anti and flag joins, likewise splittable."""
    keys = df.select(F.struct(*cols).alias("_key")).distinct().select("_key.*")
    return keys.na.drop("any")


def spread_blank_keys(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], parts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_spread``, a further join key that deals out rows whose key is blank or NULL.

    Such keys stand for "not known" and are often shared by a good part of a table. Rows of ``left`` with one go to
    ``parts`` numbers (by default as many as shuffle partitions) by their values, rows of ``right`` with a blank one are
    repeated for each number, and all others have number 0. So an inner or left join on the key and
    ``_spread`` gives the same rows as on the key, and no task has all blank keys. A NULL matches nothing and isn't repeated.
    """
    parts = parts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blank(df: DataFrame, col: str) -> Column:
        return F.trim(F.col(col)) == "" if isinstance(df.schema[col].dataType, StringType) else F.lit(False)

    zero, row = F.lit(0), [F.col(f"`{c}`") for c in left.columns]
    unknown = reduce(or_, [F.col(l).isNull() | blank(left, l) for l in on])
    dealt = left.withColumn("_spread", F.when(unknown, F.pmod(F.xxhash64(*row), F.lit(parts)).cast("int")).otherwise(zero))
    known = reduce(and_, [F.col(r).isNotNull() for r in on.values()])
    shared = reduce(or_, [blank(right, r) for r in on.values()]) & known
    copies = F.when(shared, F.sequence(zero, F.lit(parts - 1))).otherwise(F.array(zero))
    return dealt, right.withColumn("_spread", F.explode(copies))
