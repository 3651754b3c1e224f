"""Clearing, matching and consolidation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.functions import div0, within_tolerance
from tallyworks.operators.membership import not_in
from tallyworks.operators.skew import group_apart, spread_blank_keys


def key_verdicts(
    df: DataFrame, key: str, amount: str, tol: str | None = None, verdict: str = "balance_result"
) -> DataFrame:
    """Per key: the balance, and ZERO or BALANCE."""
    sums = group_apart(df, [key], {"balance_amount": F.sum(amount)})
    settled = F.col("balance_amount") == 0 if tol is None else within_tolerance(F.col("balance_amount"), tol)
    return sums.withColumn(verdict, F.when(settled, "ZERO").otherwise("BALANCE"))


def net_to_zero(
    df: DataFrame,
    key: str,
    amount: str,
    tol: str | None = None,
    rows: DataFrame | None = None,
    verdict: str = "balance_result",
) -> DataFrame:
    """Rows with the verdict of their key.

    The verdict is taken over ``df`` and attached to ``rows`` (default: ``df`` itself).
    Rows without a key are dropped.
    """
    verdicts = key_verdicts(df, key, amount, tol, verdict).select(key, verdict)
    return (df if rows is None else rows).join(verdicts, key)


@dataclass(frozen=True)
class ClearingRule:
    """Rows with equal ``key`` are cleared if their amounts sum to 0, give or take ``tol``.

    ``counts`` says which rows are summed, ``shown`` which of these get the verdict; by default all.
    Rows without a key take no part.
    """

    label: str
    key: Column
    counts: Column | None = None
    shown: Column | None = None
    tol: str | None = None


def judge_by_rules(
    df: DataFrame,
    rules: Sequence[ClearingRule],
    amount: str,
    verdict: str = "balance_result",
    rule: str = "balance_type",
) -> DataFrame:
    """Each row under each rule that shows it, with the rule's verdict (ZERO or BALANCE), label and ``rule_no``.

    All rules together take one pass: every row is dealt out to its (rule, key) pairs, and one
    aggregation sums them. The sums are small, and joined back so that a hot key's rows can be split.
    """
    yes = F.lit(True)
    pairs = []
    for i, r in enumerate(rules):
        shown = F.coalesce(yes if r.shown is None else r.shown, F.lit(False))
        counts = r.key.isNotNull() & (yes if r.counts is None else r.counts)
        pair = F.struct(F.lit(i).alias("no"), r.key.cast("string").alias("key"), shown.alias("shown"))
        pairs.append(F.when(counts, pair))
    dealt = df.withColumn("_pair", F.explode(F.array_compact(F.array(*pairs))))
    dealt = dealt.withColumns({"rule_no": F.col("_pair.no"), "_key": F.col("_pair.key"), "_shown": F.col("_pair.shown")})
    sums = group_apart(dealt, ["rule_no", "_key"], {"_sum": F.sum(amount)})
    by_rule = F.col("rule_no")
    tol, label = F.lit("0").cast("decimal(18,6)"), F.lit(None).cast("string")
    for i, r in enumerate(rules):
        tol = tol if r.tol is None else F.when(by_rule == i, F.lit(r.tol).cast("decimal(18,6)")).otherwise(tol)
        label = F.when(by_rule == i, r.label).otherwise(label)
    judged = dealt.filter("_shown").join(sums, ["rule_no", "_key"])
    settled = F.abs(F.col("_sum")) <= tol
    marks = {verdict: F.when(settled, "ZERO").otherwise("BALANCE"), rule: label}
    return judged.withColumns(marks).select(*df.columns, verdict, rule, "rule_no")


def staged_clearing(judged: DataFrame, verdict: str = "balance_result") -> tuple[DataFrame, DataFrame]:
    """The cleared and the open rows of rules judged in one pass; store ``judged`` where both are read."""
    return judged.filter(F.col(verdict) == "ZERO"), judged.filter(F.col(verdict) != "ZERO")


def uncleared(open_rows: DataFrame, cleared: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Open rows whose composite text key no rule has cleared, with NOT IN's NULL rules."""
    key = F.concat(*[F.col(k).cast("string") for k in keys])
    left = open_rows.withColumn("_key", key)
    return not_in(left, "_key", cleared.select(key.alias("_key")), "_key").drop("_key")


def uncleared_keys(stacked: DataFrame, keys: Sequence[str], verdict: str = "balance_result") -> DataFrame:
    """Keys that have open rows and that no rule has cleared, for keys without NULLs.

    The same keys as those of :func:`uncleared`, from one aggregation over the stacked
    verdicts instead of a join of their two halves.
    """
    zero = F.max(F.when(F.col(verdict) == "ZERO", 1).otherwise(0))
    still = F.max(F.when(F.col(verdict) != "ZERO", 1).otherwise(0))
    per_key = stacked.groupBy(*keys).agg(zero.alias("_zero"), still.alias("_open"))
    return per_key.filter((F.col("_open") == 1) & (F.col("_zero") == 0)).select(*keys)


def in_bands(
    sales: DataFrame, ledger: DataFrame, sales_amount: str, ledger_amount: str, tol: str
) -> tuple[DataFrame, DataFrame]:
    """Both sides with bands of their amounts, equal for every pair that may differ by at most ``tol``.

    Bands are twice the tolerance wide. A sale is in the band of its amount; a ledger row is repeated for the
    bands that its amount less and plus the tolerance are in, which are two at most, or three where numbers round.
    Open ledger lines are the shorter and narrower side, so it is they that are repeated. Rows without an amount have no band.
    """
    width = max(float(tol), 1e-6) * 2

    def band(amount: Column) -> Column:
        return F.floor(amount / width).cast("long")

    amount = F.col(ledger_amount).cast("double")
    reach = F.lit(float(tol) * (1 + 1e-6)) + F.abs(amount) * 1e-12
    bands = F.sequence(band(amount - reach), band(amount + reach))
    return (
        sales.withColumn("_sale_band", band(F.col(sales_amount).cast("double"))),
        ledger.withColumn("_ledger_band", F.explode(bands)),
    )


def tolerant_match(
    sales: DataFrame,
    ledger: DataFrame,
    on: Mapping[str, str],
    sales_amount: str,
    ledger_amount: str,
    tol: str | None = "0.1",
    difference: str = "difference",
) -> DataFrame:
    """Pairs equal on the paired columns whose amounts differ by at most ``tol``.

    Put every equality that is asked for (document key, date) into ``on``: all of them
    become join keys, and so does the band of the amount (see :func:`in_bands`), so a key that very
    many rows share, such as a blank reference, doesn't pair all of them with all. ``tol=None`` keeps every pair and
    only reports the difference.
    """
    cond = reduce(and_, [F.col(f"s.{s}") == F.col(f"l.{l}") for s, l in on.items()])
    if tol is not None:
        sales, ledger = in_bands(sales, ledger, sales_amount, ledger_amount, tol)
        cond = cond & (F.col("s._sale_band") == F.col("l._ledger_band"))
    pairs = sales.alias("s").join(ledger.alias("l"), cond).drop("_sale_band", "_ledger_band")
    pairs = pairs.withColumn(difference, F.col(f"s.{sales_amount}") - F.col(f"l.{ledger_amount}"))
    return pairs if tol is None else pairs.filter(within_tolerance(F.col(difference), tol))


def enrich_or_default(
    df: DataFrame, matched: DataFrame, keys: Sequence[str], defaults: Mapping[str, tuple[Column, Column]], missing: Column
) -> DataFrame:
    """Left join; each output column takes its default where the match is missing."""
    joined = df.join(matched, list(keys), "left")
    return joined.withColumns({out: F.when(missing, d).otherwise(v) for out, (d, v) in defaults.items()})


def product_class(group: Column, keep: Sequence[str] = ("8", "9", "A"), other: str = "OTHER") -> Column:
    """The group itself when it starts with a listed character, else one common class."""
    hit = F.lit(False)
    for p in keep:
        hit = hit | group.startswith(p)
    return F.when(hit, group).otherwise(F.lit(other))


def summarise_by_class(
    df: DataFrame, group: str, sums: Mapping[str, str], quantity: str, revenue: str, average: str = "average_cost"
) -> DataFrame:
    """Sums per product class with revenue per unit, rounded to two digits."""
    totals = (
        df.withColumn("_class", product_class(F.col(group)))
        .groupBy("_class")
        .agg(*[F.sum(c).alias(out) for out, c in sums.items()])
        .withColumnRenamed("_class", group)
    )
    unit = div0(F.col(revenue), F.col(quantity)).cast("decimal(28,6)")
    return totals.withColumn(average, F.round(unit, 2))


def fallback_pairs(
    left: DataFrame, right: DataFrame, primary: Mapping[str, str], fallback: Mapping[str, str]
) -> DataFrame:
    """Partners by the primary key (or none) and, below them, partners by the fallback key.

    A pair that both keys find is only listed by the primary key, so the usual case, both
    systems agreeing, does not double the rows. The sides' columns must differ in name.
    """

    found_before = F.coalesce(_equal(primary), F.lit(False))
    columns = [*left.columns, *right.columns]
    a, b = _spread(left, right, primary)
    by_primary = a.join(b, _equal({**primary, "_spread": "_spread"}), "left").select(*columns)
    a, b = _spread(left, right, fallback)
    by_fallback = a.join(b, _equal({**fallback, "_spread": "_spread"}) & ~found_before).select(*columns)
    return by_primary.unionByName(by_fallback)


def _equal(on: Mapping[str, str]) -> Column:
    return reduce(and_, [F.col(f"a.{l}") == F.col(f"b.{r}") for l, r in on.items()])


def _spread(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    a, b = spread_blank_keys(left, right, on)
    return a.alias("a"), b.alias("b")


def match_with_fallback(
    left: DataFrame,
    right: DataFrame,
    primary: Mapping[str, str],
    fallback: Mapping[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Distinct ``columns`` of the partners by either key; see :func:`fallback_pairs`."""
    return fallback_pairs(left, right, primary, fallback).select(*columns).distinct()


def two_key_pairs(
    left: DataFrame, right: DataFrame, primary: Mapping[str, str], fallback: Mapping[str, str]
) -> DataFrame:
    """Partners by either key, a row for each key and partner, with marks.

    Adds ``by_primary``, which key the row is for, and ``found``, whether it has a partner; a row of ``left`` without
    one by a key has one row for that key, with NULL partner columns. A NULL in a key matches nothing.
    Each key is looked up once, and who has no partner, the partners by the first key and those by the second
    are all read from the result. Blank and NULL keys are spread over the tasks. The sides' columns must differ in name.
    """

    def by(on: Mapping[str, str], first: bool) -> DataFrame:
        a, b = _spread(left, right.withColumn("found", F.lit(True)), on)
        joined = a.join(b, _equal({**on, "_spread": "_spread"}), "left").drop("_spread")
        return joined.withColumns({"found": F.coalesce("found", F.lit(False)), "by_primary": F.lit(first)})

    return by(primary, True).unionByName(by(fallback, False))


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Distinct rows of all inputs, by column name: each input is reduced before the one exchange."""
    return reduce(DataFrame.unionByName, frames).distinct()


def consolidate(df: DataFrame, keep: Column, columns: Sequence[str | Column]) -> DataFrame:
    """Distinct report rows passing ``keep``: one exchange for all nested unions."""
    return df.filter(keep).select(*columns).distinct()
