"""Numbers of rows in sorted order, without sorting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import staged


def numbered(rows: DataFrame, group: Sequence[str], order: Sequence[str], label: str) -> DataFrame:
    """Adds ``idx``, a row's number from 0 in the order of its group, and ``n``, the rows of its group.

    Group columns hold no nulls; in ``order`` nulls come first. ``rows`` is read twice, so it
    should be a stored table or come from an exchange.
    Rows are dealt out by ranges of (group, order) and stored as they are sorted; then only the counts
    of each task's groups are summed. Equal rows are dealt out by where they were read, so that any number of them can be
    spread over several tasks.
    """
    keys = [*group, *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = staged(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), label)
    stored = stored.withColumn("_part", F.shiftright("_at", 33))
    counts = stored.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count("*").alias("_count"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part",
        *group,
        "_first",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"),
        F.sum("_count").over(whole).alias("n"),
    )
    return (
        stored.join(starts, ["_part", *group])
        .withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before"))
        .drop("_part", "_at", "_first", "_before")
    )
