"""SimHash fingerprints of whole texts, and near duplicates among them by a generalised pigeonhole.

If two fingerprints differ in at most ``t`` bits and the bits are dealt into ``m`` parts, then for any
thresholds ``e_i`` of the parts with sum ``t - m + 1`` (-1 leaves a part out) some part differs in at most
``e_i`` bits. Correlated bits share a part, and a dynamic programme picks ``m`` and unequal thresholds
with the least estimated work; the estimates come from bit counts over all fingerprints. They change
the work only: every pair within ``t`` bits is found whatever they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import components, forest, row_key, runs, staged, unpacked, whole_groups, whole_row
from tallyworks.operators.skew import group_apart

BITS = 64
#: Estimated cost of comparing a pair, against that of shuffling and sorting one key.
PAIR_COST = 0.01
#: Buckets up to this many rows are compared by shifts over all rows at once; larger ones by blocks.
SMALL_BUCKET = 48
#: Larger buckets than this many rows are first divided by a pigeonhole over all bits within the task.
LARGE_BUCKET = 4096
BLOCK = 512


def _hashes(text: bytes, shingle: int, seed: int) -> np.ndarray:
    words = text.lower().split()
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1)[: len(words) - shingle + 1]
    h = xxhash.xxh64_intdigest
    found = [h(joined[a:b], seed) for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    return np.array(found, np.uint64)


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Bit b is set if it is set in over half of the shingles' hashes; no words give zero.

    A-Z count as a-z; words are runs of other bytes than ASCII white space; shingles are ``shingle`` words
    joined by spaces, repeats included, or the whole sequence if it is shorter.
    """
    hashes = _hashes(text or b"", shingle, seed)
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255 * 64):
        bits = np.unpackbits(hashes[at : at + 255 * 64].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        full = len(bits) // 255 * 255
        if full:  # sums of 255 bits fit a byte, and bytes add fastest
            counts += bits[:full].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[full:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", id_type: str = "long"
) -> DataFrame:
    """(doc_id, fingerprint): the fingerprint as a signed long. A null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).cast(id_type).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(work, f"doc_id {id_type}, fingerprint long")


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j set: 64 x 64 counts over all of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy())
            both += bits.T @ bits
            n += len(bits)
        if n:
            cells = np.append(both.ravel(), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "n"])

    found = prints.select("fingerprint").mapInArrow(count, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1)
    for cell, n in found.collect():  # 4,097 rows, whatever the input
        cells[cell] = n
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)


def correlated_parts(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits into m parts of nearly equal size, keeping strongly correlated bits together."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, parts = set(range(BITS)), []
    for i in range(m):
        rest = sorted(left)
        part = [rest[int(np.argmax(corr[np.ix_(rest, rest)].max(axis=1)))]]
        left.discard(part[0])
        while len(part) < BITS // m + (i < BITS % m):
            rest = sorted(left)
            part.append(rest[int(np.argmax(corr[np.ix_(rest, part)].mean(axis=1)))])
            left.discard(part[-1])
        parts.append(sorted(part))
    return parts


def allocate(n: int, both: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """Parts with their thresholds: the cheapest allocation over numbers of parts, by dynamic programming."""
    p = np.diag(both) / max(n, 1)
    differ = 2 * p * (1 - p)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(max(1, -(-(distance + 1) // 3)), distance + 2):
        parts = correlated_parts(n, both, m)
        total = distance - m + 1
        # table[s]: the least cost so far with thresholds of sum s
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for part in parts:
            within = np.zeros(3)  # chance that a pair differs in 0, 1, 2 bits of the part
            within[0] = 1.0
            for q in differ[part]:
                within[1:] = within[1:] * (1 - q) + within[:-1] * q
                within[0] *= 1 - q
            keys = (0, 1, 1 + len(part) / 2, 1 + len(part))
            new: dict[int, tuple[float, list[int]]] = {}
            for s, (cost, chosen) in table.items():
                for e in (-1, 0, 1, 2):
                    pairs = n * (n - 1) / 2 * within[: e + 1].sum() * (1 if e < 2 else 2)
                    c = cost + n * keys[e + 1] + PAIR_COST * pairs
                    if s + e not in new or c < new[s + e][0]:
                        new[s + e] = (c, [*chosen, e])
            table = new
        if total in table and (best is None or table[total][0] < best[0]):
            best = (table[total][0], list(zip(parts, table[total][1], strict=True)))
    assert best is not None
    return [(part, e) for part, e in best[1] if e >= 0]


def _keys(prints: np.ndarray, parts: list[tuple[list[int], int]]) -> Iterator[tuple[np.ndarray, ...]]:
    """(part, key, probe, fingerprint) of each part's value and its variants.

    Threshold 1: each value, and probes with one of its zero bits set, which meet the value one bit away.
    Threshold 2: each value and all variants one bit away, which also meet each other.
    """
    one = np.uint64(1)
    for i, (part, e) in enumerate(parts):
        mask = np.bitwise_or.reduce(one << np.array(part, np.uint64))
        value = prints & mask
        yield np.full(len(prints), i, np.int8), value, np.zeros(len(prints), np.int8), prints
        for bit in part if e else []:
            b = one << np.uint64(bit)
            rows = np.flatnonzero((value & b) == 0) if e == 1 else np.arange(len(prints))
            yield np.full(len(rows), i, np.int8), value[rows] ^ b, np.full(len(rows), e == 1, np.int8), prints[rows]


def _within(prints: np.ndarray, probe: np.ndarray, cut: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one bucket that are near; ``cut`` has the buckets' ends."""
    sizes = np.diff(cut)
    bucket = np.repeat(np.arange(len(sizes)), sizes)
    left, right = [], []
    for shift in range(1, min(int(sizes.max(initial=0)), SMALL_BUCKET)):
        a = np.flatnonzero((bucket[:-shift] == bucket[shift:]) & (sizes[bucket[shift:]] <= SMALL_BUCKET))
        a = a[(probe[a] & probe[a + shift]) == 0]
        a = a[np.bitwise_count(prints[a] ^ prints[a + shift]) <= distance]
        left.append(prints[a])
        right.append(prints[a + shift])
    for k in np.flatnonzero(sizes > SMALL_BUCKET):
        own = prints[cut[k] : cut[k + 1]]
        asked = probe[cut[k] : cut[k + 1]]
        for a, b in _large(own, asked, distance):
            left.append(a)
            right.append(b)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _large(prints: np.ndarray, probe: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    if len(prints) > LARGE_BUCKET:
        prints = np.unique(prints)
        width = -(-BITS // (distance + 1))
        for at in range(0, BITS, width):  # equal in one of distance + 1 ranges of bits
            part = (prints >> np.uint64(at)) & np.uint64((1 << width) - 1)
            order = np.argsort(part, kind="stable")
            cut = runs(part[order])
            for k in np.flatnonzero(np.diff(cut) > 1):
                yield from _blocks(prints[order[cut[k] : cut[k + 1]]], None, distance)
    else:
        yield from _blocks(prints, probe, distance)


def _blocks(prints: np.ndarray, probe: np.ndarray | None, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for at in range(0, len(prints), BLOCK):
        rows = prints[at : at + BLOCK]
        near = np.bitwise_count(rows[:, None] ^ prints[None, at:]) <= distance
        if probe is not None:
            near &= (probe[at : at + BLOCK, None] & probe[None, at:]) == 0
        a, b = np.nonzero(near)
        a, b = a[a < b], b[a < b]
        yield forest(rows[a], prints[at:][b])


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) that join what pairs within ``distance`` bits join; ``prints`` are distinct fingerprints.

    Each bucket yields a spanning forest of its near pairs, at most one link a row, not the pairs. Buckets
    hold distinct fingerprints only: copies of a text share one row, and a group of near copies has few
    distinct fingerprints in the bits it varies in.
    """
    parts = allocate(*bit_statistics(prints), distance)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, key, probe, own in _keys(batch.column(0).to_numpy().view(np.uint64), parts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array(key.view(np.int64)), pa.array(probe), pa.array(own.view(np.int64))],
                    ["part", "key", "probe", "fingerprint"],
                )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part", "key"]):
            part, key, probe, own = (table.column(i).to_numpy() for i in range(4))
            # sorted by part and key, so a change of either begins a bucket
            change = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
            cut = np.concatenate([[0], change, [len(key)]])
            a, b = forest(*_within(own.view(np.uint64), probe, cut, distance))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    dealt = prints.select("fingerprint").mapInArrow(deal, "part byte, key long, probe byte, fingerprint long")
    sorted_ = dealt.repartition("part", "key").sortWithinPartitions("part", "key")
    return sorted_.mapInArrow(compare, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): every document with the smallest doc_id that links reach.

    ``fingerprint`` has 16 lowercase hex digits. Fingerprints within ``distance`` bits link, equal ones
    included. A null or empty text has fingerprint zero and links like any other. A row with a null
    doc_id keeps it and gets the component of its fingerprint, null if no member has a doc_id. Repeated
    rows each give a row; further columns of the input are ignored; no rows give no rows.
    """
    prints = staged(fingerprints(docs, shingle, 42, id_col, text_col), "simhash-prints")
    classes = staged(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "simhash-classes")
    reach = components(links(classes, distance), "simhash-links")
    rooted = classes.join(reach, classes.fingerprint == reach.node, "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    least = group_apart(rooted, ["root"], {"component_id": F.min("first")})
    named = group_apart(rooted.join(least, "root"), ["fingerprint"], {"component_id": F.first("component_id")})
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each SimHash group, all columns kept, whatever their names: a row of its smallest doc_id.

    Of several rows with that doc_id the one with the least text stays. A group whose rows all lack a
    doc_id keeps one with its least text, a null text first. Repeated rows leave one; no rows give no rows.
    """
    keyed = docs.select(
        whole_row(docs).alias("row"),
        row_key(docs).alias("key"),
        F.col("doc_id").cast("long").alias("id"),
        F.col("text").cast("string").alias("text"),
    )
    prints = staged(fingerprints(keyed, shingle, 42, "key", "text", "string").withColumnRenamed("doc_id", "key"), "simhash-rows")
    # groups of rows instead of ids, so that rows without one, or with the same, are told apart
    ids = keyed.select("key", F.struct(F.col("id").isNull().alias("no_id"), "id", F.md5("text").alias("text"), "key").alias("rank"))
    ranked = prints.join(ids.dropDuplicates(["key"]), "key")
    classes = staged(ranked.groupBy("fingerprint").agg(F.min("rank").alias("first")), "simhash-classes")
    reach = components(links(classes, distance), "simhash-links")
    rooted = classes.join(reach, classes.fingerprint == reach.node, "left").select(
        "first", F.coalesce("root", "fingerprint").alias("root")
    )
    stays = group_apart(rooted, ["root"], {"first": F.min("first")}).select(F.col("first.key").alias("key"))
    return unpacked(keyed.select("row", "key").join(stays, "key", "left_semi").dropDuplicates(["key"]), docs)
