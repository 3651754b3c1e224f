"""Helpers of the operators in this subpackage: the shared folder, staged tables, hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.skew import group_apart


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where it is unset, a new one, in local mode only."""
    for conf in (spark.conf, spark.sparkContext.getConf()):
        if folder := conf.get("spark.checkpoint.dir", None):
            return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not hasattr(spark, "_llm_folder"):
        spark._llm_folder = f"file://{tempfile.mkdtemp(prefix='llm-')}"
    return spark._llm_folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, queries delete their shuffle files when they end; otherwise these stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and go on from it: lineage ends there, on files that outlive executors."""
    path = new_folder(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that none can clash with those an operator adds."""
    return F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])


def row_key(df: DataFrame) -> Column:
    """128 bits that tell rows apart by all their values, maps included; repeated rows share them."""
    return F.md5(F.to_json(whole_row(df)))


def unpacked(rows: DataFrame, like: DataFrame, name: str = "row") -> DataFrame:
    """The columns of ``like`` out of a struct made by ``whole_row``."""
    return rows.select(*[F.col(name).getField(c).alias(c) for c in like.columns])


def trim_memory() -> None:
    """Give freed memory back to the system: workers are kept between stages, and so is what they once needed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every system's C library has it
        ctypes.CDLL(None).malloc_trim(0)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links among 64-bit nodes made into one link from each node to the smallest node it reaches by them."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def components(edges: DataFrame, label: str) -> DataFrame:
    """The smallest node that each node reaches: (node, root), for nodes of at least one link.

    ``edges`` has longs ``a`` and ``b``. Alternating star steps: every node passes its least neighbour to
    its larger neighbours, then to its smaller ones, until all links point at roots. Each step is an
    aggregate joined back to the links, so a node with very many links is split like any skewed key, and
    each round is a written table.
    """

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    now = staged(
        edges.where("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = group_apart(both, ["a"], {"low": F.least(F.min("b"), F.min("a"))})
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a != b").distinct()
        low = group_apart(large, ["a"], {"low": F.min("b")})
        linked = large.join(low, "a")
        small = linked.select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b")).where("a != b")
        now = staged(small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), label)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]) if len(keys) else np.zeros(1, int)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches of sorted rows, dealt anew so that no group of equal keys is cut between two tables."""
    left: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for k in keys:
            v = batch.column(k).to_numpy(zero_copy_only=False)
            changed[1:] |= v[1:] != v[:-1]
            if left:
                changed[0] |= v[0] != left[-1].column(k)[-1].as_py()
        at = np.flatnonzero(changed)
        if len(at) and (len(at) > 1 or at[0] > 0 or left):
            cut = int(at[-1])
            head = [*left, batch.slice(0, cut)] if cut else left
            if head:
                yield pa.Table.from_batches(head)
            left = [batch.slice(cut)]
        else:
            left.append(batch)
    if left:
        yield pa.Table.from_batches(left)
