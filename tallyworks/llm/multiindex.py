"""Near-duplicate vectors by an inverted multi-index.

Each half of a vector has a codebook of its own, so pairs of codewords form a grid of cells. A vector
is stored in the cell of its nearest codewords and looks for links in cells in the order of how near
they can be: the distance to the bisector between its own codeword and another's is the least that a
vector in that half of the cell can be away. The traversal ends where this bound passes the distance
of the similarity asked for, at which recall is 1, or earlier for a lower target recall. All
candidates are verified in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import components, forest, staged, whole_groups
from tallyworks.operators.skew import group_apart

#: Codebooks are fitted on about this many different vectors, chosen by hash. All vectors are indexed.
SAMPLE = 8192
#: Codewords of each half: enough for cells of about so many vectors, at most so many.
CELL_VECTORS, MOST_CODEWORDS = 1024, 128
#: A cell with more vectors is dealt into blocks, each a group of its own.
BLOCK = 2048
_QUERIES = 512


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors of doubles, filled up with zeros, which changes no length and no product."""
    out = np.zeros((len(column), size))
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum([len(x) for x in column])
    for i, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends, strict=True)):
        out[i, : b - a] = flat[a:b]
    return out


class MultiIndex:
    """Two codebooks, and the traversal of their grid."""

    def __init__(self, sample: np.ndarray, codewords: int, rounds: int = 12):
        self.half = max(1, sample.shape[1] // 2)
        self.books = [self._fit(sample[:, : self.half], codewords, rounds), self._fit(sample[:, self.half :], codewords, rounds)]

    @staticmethod
    def _distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
        return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ book.T + (book**2).sum(axis=1), 0)

    @classmethod
    def _fit(cls, x: np.ndarray, k: int, rounds: int) -> np.ndarray:
        book = np.unique(x, axis=0)
        if len(book) <= k:
            return book
        book = book[np.random.default_rng(7).choice(len(book), k, replace=False)]
        for _ in range(rounds):
            near = cls._distances(x, book).argmin(axis=1)
            sums = np.zeros_like(book)
            np.add.at(sums, near, x)
            n = np.bincount(near, minlength=len(book))
            book[n > 0] = sums[n > 0] / n[n > 0, None]
        return np.unique(book, axis=0)

    def _bounds(self, x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest codeword, and squared distances from x to where each other codeword is nearer than any."""
        d = self._distances(x, book)
        apart = np.sqrt(self._distances(book, book))
        bound = np.zeros_like(d)
        for k in range(len(book)):
            gap = np.where(apart[k] > 0, apart[k], np.inf)
            bound = np.maximum(bound, (d - d[:, k : k + 1]) / (2 * gap))
        return d.argmin(axis=1), bound**2

    def traverse(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Own cells; rows and cells that each row visits, nearest first, up to a squared distance of ``reach``."""
        (u, first), (v, second) = (self._bounds(part, book) for part, book in zip((x[:, : self.half], x[:, self.half :]), self.books, strict=True))
        width = len(self.books[1])
        rows, cells = [], []
        for i in range(len(x)):
            a, b = np.argsort(first[i], kind="stable"), np.argsort(second[i], kind="stable")
            a, b = a[first[i][a] <= reach], b[second[i][b] <= reach]
            total = first[i][a][:, None] + second[i][b][None, :]
            p, q = np.nonzero(total <= reach)
            order = np.argsort(total[p, q], kind="stable")
            cells.append(a[p[order]] * width + b[q[order]])
            rows.append(np.full(len(order), i))
        return u * width + v, np.concatenate(rows), np.concatenate(cells)

    def reach(self, sample: np.ndarray, least: float, recall: float) -> float:
        """How far traversals go: to the bound that no link passes, or to where ``recall`` of the sample's links are found."""
        radius = 2 * (1 - least) * (1 + 1e-6) + 1e-9
        if recall >= 1:
            return radius
        found = []
        for at in range(0, len(sample), _QUERIES):
            a, b = np.nonzero(sample[at : at + _QUERIES] @ sample.T >= least)
            a, b = a[a + at < b], b[a + at < b]
            if len(a):
                bounds = [self._bounds(part, book) for part, book in zip((sample[:, : self.half], sample[:, self.half :]), self.books, strict=True)]
                (u, first), (v, second) = bounds
                found.append(first[a + at, u[b]] + second[a + at, v[b]])
        return min(radius, float(np.quantile(np.concatenate(found), recall))) if found else radius


def linked_vectors(vectors: DataFrame, least: float = 0.98, recall: float = 1.0) -> DataFrame:
    """(vec_id, n_links, component_id, kept): vectors linked by cosine >= ``least`` within their label.

    Vectors link only if their labels are equal and not null and they have the same length. Null and zero
    vectors and those with null or non-finite components have no links. ``n_links`` counts other rows, equal
    vectors included; ``component_id`` is the least vec_id that links reach and ``kept`` marks its row. A row with a
    null vec_id counts as a link, and has its component's id, null if no member has one; it is kept in that
    case. Equal vectors of a label are one entry of the index with their number; each row of the input gives a row, and further
    columns are ignored. No rows give no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.size("v") > 0
    sound &= F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(sound, F.lit(False))
    # adding 0 makes a negative zero a plain one, so that equal vectors have equal keys
    same = F.transform("v", lambda x: x + F.lit(0.0))
    rows = rows.withColumn("node", F.when(usable, F.xxhash64("label", same)))
    entries = rows.where("node is not null").groupBy("node").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    entries = staged(entries, "vectors")
    total, size = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    share = F.pmod(F.col("node"), F.lit(1_000_003)) < F.lit(1_000_003 * SAMPLE // total + 1)
    sample = entries.where(share).select("v").limit(2 * SAMPLE).toArrow().column(0).combine_chunks()
    if not len(sample):
        sample = entries.select("v").limit(1).toArrow().column(0).combine_chunks()
    units = _unit(_matrix(sample, size))
    index = MultiIndex(units, int(np.clip(round((total / CELL_VECTORS) ** 0.5), 1, MOST_CODEWORDS)))
    reach = index.reach(units, least, recall)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _QUERIES):
                part = batch.slice(at, _QUERIES)
                own, row, cell = index.traverse(_unit(_matrix(part.column(0), size)), reach)
                # a pair in two cells is found by the vector in the lower one alone
                ahead = cell > own[row]
                every, to = np.concatenate([np.arange(len(own)), row[ahead]]), np.concatenate([own, cell[ahead]])
                target = np.concatenate([np.ones(len(own), np.int8), np.zeros(int(ahead.sum()), np.int8)])
                taken = part.take(pa.array(every))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(to.astype(np.int32)), pa.array(target)], [*part.schema.names, "cell", "target"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["label", "dims", "cell", "block"]):
            columns = [table.column(c).combine_chunks() for c in ("v", "node", "n", "target", "home")]
            keys = [table.column(c).to_numpy() for c in ("label", "dims", "cell", "block")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1 if len(keys[0]) > 1 else []
            for a, b in zip([0, *change], [*change, len(keys[0])], strict=True):
                v, node, n, target, home = (c.slice(a, b - a) for c in columns)
                yield from _links(_unit(_matrix(v, size)), *(x.to_numpy() for x in (node, n, target, home)), keys[3][a], least)

    plain = entries.select("v", "node", "n", F.xxhash64("label").alias("label"), F.size("v").alias("dims"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    dealt = staged(plain.mapInArrow(deal, f"{kept}, cell int, target byte"), "vectors-dealt")
    cells = group_apart(dealt.where("target = 1"), ["label", "dims", "cell"], {"n_blocks": F.ceil(F.count("*") / F.lit(BLOCK)).cast("int")})
    # a vector lives in one block, its home, and asks in all others up to it; vectors of other cells ask in all
    asked = dealt.join(cells, ["label", "dims", "cell"]).withColumn("home", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))
    blocks = F.sequence(F.lit(0), F.when(F.col("target") == 1, F.col("home")).otherwise(F.col("n_blocks") - 1))
    asked = asked.withColumn("block", F.explode(blocks)).drop("n_blocks")
    order = ["label", "dims", "cell", "block"]
    found = asked.repartition(*order).sortWithinPartitions(*order).mapInArrow(compare, "a long, b long, n long")
    found = staged(found, "vector-links")
    numbers = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    reached = components(found.where("b is not null").select("a", "b"), "vector-components")
    named = (
        entries.select("node", "n", "first")
        .join(numbers.withColumnRenamed("a", "node"), "node", "left")
        .join(reached, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least_id = group_apart(named, ["root"], {"component_id": F.min("first")})
    named = named.join(least_id, "root").select("node", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    named = group_apart(named, ["node"], {"n_links": F.first("n_links"), "component_id": F.first("component_id")})
    out = rows.drop("v", "label").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )


def _links(units: np.ndarray, node: np.ndarray, n: np.ndarray, target: np.ndarray, home: np.ndarray, block: int, least: float) -> Iterator[pa.RecordBatch]:
    """Links of one block: each node's number of linked rows (a, null, n), and a spanning forest (a, b, 0)."""
    held = np.flatnonzero((target == 1) & (home == block))
    if not len(held):
        return
    count = np.zeros(len(node), np.int64)
    left, right = [], []
    for at in range(0, len(node), _QUERIES):
        ask = np.arange(at, min(at + _QUERIES, len(node)))
        near = units[ask] @ units[held].T >= least
        # vectors of this block meet once: the earlier asks
        inside = (target[ask] == 1) & (home[ask] == block)
        near &= ~(inside[:, None] & (ask[:, None] >= held[None, :]))
        i, j = np.nonzero(near)
        if len(i):
            i, j = ask[i], held[j]
            np.add.at(count, i, n[j])
            np.add.at(count, j, n[i])
            a, b = forest(node[i], node[j])
            left.append(a)
            right.append(b)
    some = np.flatnonzero(count)
    if len(some):
        a, b = forest(np.concatenate(left), np.concatenate(right))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([node[some], a])),
                pa.array(np.concatenate([np.zeros(len(some), np.int64), b]), mask=np.arange(len(some) + len(a)) < len(some)),
                pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)])),
            ],
            ["a", "b", "n"],
        )
