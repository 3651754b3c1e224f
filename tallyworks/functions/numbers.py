"""Numeric helpers, all native expressions on decimals."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = "decimal(18,2)"
QUANTITY = "decimal(28,6)"


def money(col: Column) -> Column:
    return col.cast(MONEY)


def quantity(col: Column) -> Column:
    """Fixed six-digit quantity, so that sums do not depend on task order."""
    return col.cast(QUANTITY)


def div0(num: Column, den: Column) -> Column:
    """``num / den``: 0 when the divisor is 0, NULL when either side is NULL."""
    a, b = num.cast("double"), den.cast("double")
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, F.lit(0.0)).otherwise(a / b)


class Exact(NamedTuple):
    """A decimal column with the digits of its type, so that products can be typed before they are made."""

    col: Column
    precision: int
    scale: int


#: Digits of the integer types, and of decimals made from floats and texts.
_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_OTHER = (28, 10)
#: Where a product would be wider than decimals can be, its wider factor keeps so many digits before the point at least,
#: and percentages so many. A value that doesn't fit is an error and not rounded.
WHOLE_DIGITS, PERCENT_DIGITS = 15, 9


def exact(df: DataFrame, col: Column) -> Exact:
    """A column of ``df`` as a decimal of its own width and scale; floats and texts get ten places."""
    kind = df.select(col).schema[0].dataType
    if isinstance(kind, DecimalType):
        p, s = kind.precision, kind.scale
    else:
        p, s = (_INTEGERS[kind.simpleString()], 0) if kind.simpleString() in _INTEGERS else _OTHER
    return Exact(col.cast(f"decimal({p},{s})"), p, s)


def as_factor(percent: Exact) -> Exact:
    """A percentage as a factor, with all its digits."""
    p, s = min(percent.precision, percent.scale + PERCENT_DIGITS, 35), percent.scale
    narrow = percent.col.cast(f"decimal({p},{s})")
    p, s = max(p, s + 2), s + 2
    return Exact((narrow * F.lit("0.01").cast("decimal(2,2)")).cast(f"decimal({p},{s})"), p, s)


def product(a: Exact, b: Exact) -> Exact:
    """The product with all digits of both, as far as 38 digits hold them."""
    if a.precision + b.precision >= 38:
        p = min(a.precision, max(37 - b.precision, a.scale + WHOLE_DIGITS))
        a = Exact(a.col.cast(f"decimal({p},{a.scale})"), p, a.scale)
    p, s = a.precision + b.precision, a.scale + b.scale
    if p < 38:
        return Exact((a.col * b.col).cast(f"decimal({p},{s})"), p, s)
    # too wide: the last places go, as few as possible
    s = max(min(s, 38 - (p + 1 - s)), min(s, 6))
    return Exact(a.col * b.col, 38, s)


def charge_share(df: DataFrame, amount: Column, *percents: Column) -> Column:
    """Amount times percentages, exact to the last digit of the input types; a missing percentage counts as 0."""
    share = exact(df, amount)
    for p in percents:
        given = exact(df, p)
        none = F.lit(0).cast(f"decimal({given.precision},{given.scale})")
        share = product(share, as_factor(given._replace(col=F.coalesce(given.col, none))))
    return share.col


def signed(amount: Column, mark: Column, plus: str = "S") -> Column:
    """Positive for the debit mark, negative for any other mark, NULL included."""
    return F.when(mark == plus, amount).otherwise(-amount)


def net_of(gross: Column, *deductions: Column) -> Column:
    for d in deductions:
        gross = gross - d
    return gross


def flag(cond: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def within_tolerance(diff: Column, tol: str) -> Column:
    bound = F.lit(tol).cast("decimal(18,6)")
    return diff.between(-bound, bound)


def outside_tolerance(diff: Column, tol: str) -> Column:
    return F.abs(diff) > F.lit(tol).cast("decimal(18,6)")


def override_by_prefix(code: Column, rate: Column, prefixes: tuple[str, ...], value: Column) -> Column:
    """``value`` where the code starts with one of the characters, else ``rate``."""
    return F.when(F.substring(code, 1, 1).isin(*prefixes), value).otherwise(rate)
