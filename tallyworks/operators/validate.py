"""Rule sets and completeness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import flag


@dataclass(frozen=True)
class Rule:
    """A named condition with its message. The condition may use earlier rules' flags."""

    name: str
    condition: Column
    message: str


def validate(
    df: DataFrame, rules: Sequence[Rule], count: str = "error_count", message: str = "message"
) -> DataFrame:
    """One 0/1 flag per rule, their sum, and the messages of the broken rules in order."""
    for rule in rules:
        df = df.withColumn(rule.name, flag(rule.condition))
    total = F.lit(0)
    for rule in rules:
        total = total + F.col(rule.name)
    texts = [F.when(F.col(r.name) == 1, r.message).otherwise("") for r in rules]
    return df.withColumns({count: total, message: F.concat(*texts)})


def status_verdict(not_loaded: Column, count: Column, labels: tuple[str, str, str]) -> Column:
    """(not loaded, faulty, correct) by the first that applies."""
    return F.when(not_loaded, labels[0]).when(count != 0, labels[1]).otherwise(labels[2])


def flag_count(df: DataFrame, keys: Sequence[str], cond: Column, out: str) -> DataFrame:
    """Keys with at least one row meeting the condition, and how many."""
    return df.groupBy(*keys).agg(F.sum(flag(cond)).alias(out)).filter(F.col(out) > 0)


def total_by(df: DataFrame, keys: Mapping[str, str], value: str, out: str = "total_assignment") -> DataFrame:
    """Sum per key, keys renamed for the join to come."""
    return df.groupBy(*[F.col(src).alias(dst) for dst, src in keys.items()]).agg(F.sum(value).alias(out))


def sums_to(total: Column, target: int = 100) -> Column:
    """1 when the rounded total is the target; a missing total gives 0."""
    return flag(F.round(total, 0) == target)


def is_present(value: Column) -> Column:
    return flag(value.isNotNull())


def counts_match(assigned: Column, available: Column, total: Column) -> Column:
    """1 when as many are assigned as available and a total exists."""
    return flag((assigned == available) & total.isNotNull())


def coverage(part: Column, whole: Column) -> Column:
    """Share covered, to two digits; 1 when there is nothing to cover."""
    ratio = F.when(whole != 0, part.cast("double") / whole.cast("double"))
    return F.when(whole == 0, F.lit(1.0)).otherwise(F.round(ratio, 2))


def fully_covered(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(1)).otherwise(flag(part == whole))


def multi_valued(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Keys with more than one distinct value of ``col``."""
    return df.groupBy(*keys).agg(F.countDistinct(col).alias(out)).filter(F.col(out) > 1)


def zero_total(df: DataFrame, keys: Sequence[str], value: Column, out: str) -> DataFrame:
    """Keys whose values sum to exactly 0."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out)).filter(F.col(out) == 0)
