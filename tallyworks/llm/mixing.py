"""Mixing sources to target weights by whole repeats of documents.

Every document is taken floor(rate) times, and once more by a seeded draw whose chance is the rest of the rate. The draws of
a source are not independent: winners are those whose hash lies in an arc, cut by the words that the hashes hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.shared import staged

#: A word is a run of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The table of sources is broadcast up to this many rows (names of ordinary length); beyond, it is joined by key.
BROADCAST_SOURCES = 10_000
SEED = "mix-1"
#: Slots that a source's documents draw by hash, and places among them where an arc of winners may begin.
DRAWS, STARTS = 1024, 8


def size_of(text: Column) -> Column:
    """Words of a text; none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), cap: float = 2.0) -> DataFrame:
    """(source, source_size, target): what the mix should take from each source.

    ``sizes`` has one row per document: source and size. Sources in code point order, null last, weigh
    ``weights`` in turn and divide ``share`` times all sizes among them. A target stops at ``cap`` times its
    source's size and the excess goes to the others by weight. Of sources in the order of cap / weight, the
    first few stop at the cap; each other takes the level that the rest leaves, times its weight.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    weighed = per_source.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).alias("cap"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * share
    levels = weighed.withColumn("level", (total - before) / rest)
    # once a source is under its cap, all later ones are, and share its level, the highest of theirs
    under = F.max(F.when(F.col("level") < F.col("cap") / F.col("weight"), F.col("level"))).over(
        Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.coalesce(F.least("cap", under * F.col("weight")), "cap")
    return levels.withColumn("target", target).select("source", "source_size", "target")


def draw(doc_id: Column, text_digest: Column) -> Column:
    """A document's seeded hash, one of ``DRAWS`` slots; documents without a doc_id draw by their text."""
    key = F.coalesce(doc_id.cast("string"), text_digest)
    return F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), key)), 1, 8), 16, 10).cast("long") % DRAWS


def chosen_slots(drawn: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, source_size, target, begin, slots): the draws of each source that win one more copy.

    ``drawn`` has source, slot and size of every document. Each source's slots form a circle; the winners are an arc of it, whose
    share of the source's words is the fraction of the repetition rate. It begins at one of ``STARTS`` places and ends where the
    words come nearest to what the target leaves, and the place that comes nearest is taken. So a long document
    at the arc's end doesn't decide what a source gives. The sums are of at most ``DRAWS`` slots a source, whatever the input.
    """
    filled = drawn.groupBy("source", "slot").agg(F.sum("size").alias("size"))
    begins = F.array(*[F.lit(k * (DRAWS // STARTS)) for k in range(STARTS)])
    around = filled.select("source", "size", "slot", F.explode(begins).alias("begin"))
    around = around.withColumn("slots", (F.col("slot") - F.col("begin") + DRAWS) % DRAWS + 1)
    sofar = Window.partitionBy("source", "begin").orderBy("slots").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    around = around.withColumn("words", F.sum("size").over(sofar)).withColumnRenamed("source", "_source")
    wanted = F.col("target") - F.floor(rate()) * F.col("source_size")
    tried = sources.withColumn("wanted", wanted).join(around, F.col("source").eqNullSafe(F.col("_source")))
    best = F.min(F.struct(F.abs(F.col("words") - F.col("wanted")).alias("off"), "begin", "slots"))
    tried = tried.groupBy("source", "source_size", "target", "wanted").agg(best.alias("best"))
    none = F.col("wanted") <= F.col("best.off")  # no copy is as near
    return tried.select(
        "source", "source_size", "target", F.col("best.begin").alias("begin"), F.when(none, 0).otherwise(F.col("best.slots")).alias("slots")
    )


def copies() -> Column:
    """Whole repeats of a document: floor(rate), and one more if its slot lies in its source's arc."""
    wins = (F.col("slot") - F.col("begin") + DRAWS) % DRAWS < F.col("slots")
    return (F.floor(rate()) + F.when(wins, 1).otherwise(0)).cast("long")


def _with_sources(rows: DataFrame, drawn: DataFrame, share: float, weights: Sequence[float], cap: float) -> DataFrame:
    """The rows (with source and slot) beside their source's size, target and arc."""
    aims = staged(targets(drawn, share, weights, cap), "mix-sources")
    sources = staged(chosen_slots(drawn, aims), "mix-slots").withColumnRenamed("source", "_source")
    if sources.count() <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    return rows.join(sources, rows["source"].eqNullSafe(sources["_source"]), "left").drop("_source")


def rate() -> Column:
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def mix_digest(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), cap: float = 2.0) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, source) of every document.

    A null source is a source of its own and so is an empty one; null and empty texts have size 0 and are
    taken 0 words; repeated rows draw alike and each give a row; further columns are ignored. No rows give no rows.
    """
    sized = staged(_sized(docs), "mix-sizes")
    found = _with_sources(sized, sized, share, weights, cap).withColumn("copies", copies())
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "source")


def _sized(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        size_of(text).alias("size"),
        draw(F.col("doc_id").cast("long"), F.md5(F.coalesce(text, F.lit("")))).alias("slot"),
    )


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), cap: float = 2.0) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the input's columns, whatever their names.

    Documents without words weigh nothing and are repeated by their source's rate like the others. Nulls and repeated
    rows are as in ``mix_digest``; no rows give no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("source").cast("string").alias("source"),
        draw(F.col("doc_id").cast("long"), F.md5(text)).alias("slot"),
    )
    sizes = staged(_sized(docs).groupBy("source", "slot").agg(F.sum("size").alias("size")), "mix-sizes")
    found = _with_sources(plain, sizes, share, weights, cap).withColumn("_copies", copies())
    repeated = found.where("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return repeated.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 2.0::DOUBLE AS cap,
    ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1) % 3 + 1)] AS weight
  FROM per_source
), levels AS (
  SELECT *, (1.5::DOUBLE * (SELECT sum(source_size) FROM per_source)
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), aimed AS (
  SELECT source, source_size,
    coalesce(least(cap, weight * (SELECT max(level) FROM levels l WHERE l.level < l.cap / l.weight)), cap) AS target
  FROM levels
), drawn AS (
  SELECT doc_id, size, source_size, target, s.source,
    CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
    ('0x' || substr(md5('{SEED}:' || doc_id::VARCHAR), 1, 8))::BIGINT % {DRAWS} AS slot
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
), filled AS (
  SELECT source, slot, sum(size)::BIGINT AS size, any_value(target - whole * source_size) AS wanted FROM drawn GROUP BY source, slot
), around AS (
  SELECT source, wanted, b.begin, (slot - b.begin + {DRAWS}) % {DRAWS} + 1 AS slots,
    sum(size) OVER (PARTITION BY source, b.begin ORDER BY (slot - b.begin + {DRAWS}) % {DRAWS}) AS words
  FROM filled, (SELECT unnest(range({STARTS})) * {DRAWS // STARTS} AS begin) b
), arcs AS (
  SELECT source, begin, CASE WHEN wanted <= off THEN 0 ELSE slots END AS slots FROM (
    SELECT *, abs(words - wanted) AS off FROM around
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(words - wanted), begin, slots) = 1)
)
SELECT doc_id, size, source_size, target, source, whole + won AS copies, (whole + won) * size AS taken
FROM (
  SELECT d.*, ((slot - begin + {DRAWS}) % {DRAWS} < slots)::BIGINT AS won FROM drawn d JOIN arcs a ON d.source IS NOT DISTINCT FROM a.source
)
"""
