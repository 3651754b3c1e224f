"""Removal of passages of many words that several documents share, however few bytes they have.

As in ``suffixes``, every window of ``words`` words is given to one anchor in its first part, here the word from
which three words hash least, and only anchors are indexed. Anchors whose next words are found in one document
alone are dropped; runs of windows that are equal in several documents repeat whole; where the runs of an anchor
differ, their windows are compared one by one. White space between words doesn't count.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import staged
from tallyworks.llm.suffixes import least_runs, without_spans
from tallyworks.operators.skew import group_apart

#: Positions are stored with the run's two distances, of 16 bits each, in one long.
_PACK = 16
#: Windows dealt to anchors by one call.
_CHUNK = 1 << 22
#: Hashes of word sequences are polynomials over the words' hashes with one of these bases.
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _reach(words: int) -> int:
    """Places in a window where its anchor can be; at most 32, so that marks of a run's windows fit a long."""
    return min(32, 1 << ((max(words * 2 // 3, 1)).bit_length() - 1))


@lru_cache(2)
def _table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(b: int) -> np.ndarray:
        return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))

    return powers(base), powers(pow(base, -1, 1 << 64))


class _Words:
    """Hashes of the word sequences of a text."""

    def __init__(self, data: bytes):
        parts = data.split()  # white space of bytes is 0x20 and 0x09 to 0x0D
        self.n = len(parts)
        w = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, self.n)
        self.sums, self.back = [], []
        for base in _BASES:
            up, down = _table(base, 1 << max(self.n, 1 << 12).bit_length())
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * up[: self.n])]))
            self.back.append(down)

    def hashes(self, low: np.ndarray, high: np.ndarray, kind: int) -> np.ndarray:
        found = (self.sums[kind][high] - self.sums[kind][low]) * self.back[kind][low]
        found ^= found >> np.uint64(32)
        return found * np.uint64(_BASES[0])

    def anchors(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, first and last start of each run of windows that share an anchor."""
        n, reach = self.n - words + 1, _reach(words)
        some = min(3, words - reach + 1)
        out: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, n, _CHUNK):
            place = np.arange(at, at + min(_CHUNK, n - at) + reach - 1)
            for o, part in zip(out, least_runs(self.hashes(place, place + some, 0), reach), strict=True):
                o.append(part + at)
        return tuple(np.concatenate(o) if o else np.zeros(0, np.int64) for o in out)


def _long(column: np.ndarray) -> pa.Array:
    return pa.array(column.view(np.int64))


def passage_runs(docs: DataFrame, words: int) -> DataFrame:
    """(prefix, run, doc, at): hashes of the words from each anchor and of its whole run, and where it lies.

    ``at`` packs the anchor's word number and its distances from the run's first and last start.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seen = _Words(text.as_py())
                a, first, last = seen.anchors(words)
                if not len(a):
                    continue
                run = seen.hashes(first, last + words, 1)
                # the distances belong to the run: the same words with another anchor are no match
                run ^= ((a - first) * 65_537 + (a - last)).astype(np.uint64) * np.uint64(_BASES[0])
                at = (a << (2 * _PACK)) | ((a - first) << _PACK) | (a - last)
                columns = [_long(seen.hashes(a, a + words - _reach(words) + 1, 0)), _long(run), pa.array(np.full(len(a), doc)), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, ["prefix", "run", "doc", "at"])

    long_enough = docs.where(F.octet_length("text") >= 2 * words - 1)
    return long_enough.select("doc", F.col("text").cast("binary").alias("text")).mapInArrow(
        work, "prefix long, run long, doc long, at long"
    )


def run_windows(runs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(w0, w1, prefix, run, low, high, mask): every window of the runs, its hash and its bit in the run.

    ``runs`` has a ``place`` (doc, at) of each run, and the smallest and largest document with the run.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, text in zip(batch.column(0), batch.column(1), strict=True):
                prefix, run, low, high, at = (found.values.field(k).to_numpy() for k in range(5))
                a, far, near = at >> (2 * _PACK), (at >> _PACK) & 0xFFFF, at & 0xFFFF
                size = far - near + 1
                which = np.repeat(np.arange(len(at)), size)
                start = (a - far)[which] + np.arange(len(which)) - (np.cumsum(size) - size)[which]
                seen = _Words(text.as_py())
                columns = [_long(seen.hashes(start, start + words, kind)) for kind in range(2)]
                columns += [pa.array(c[which]) for c in (prefix, run, low, high)]
                columns.append(pa.array(np.int64(1) << (a[which] - start)))
                yield pa.RecordBatch.from_arrays(columns, ["w0", "w1", "prefix", "run", "low", "high", "mask"])

    wanted = runs.groupBy(F.struct("place.doc").alias("k")).agg(
        F.collect_list(F.struct("prefix", "run", "low", "high", "place.at")).alias("runs")
    )
    texts = docs.join(wanted.select(F.col("k.doc").alias("doc"), "runs"), "doc").select(
        "runs", F.col("text").cast("binary").alias("text")
    )
    return texts.mapInArrow(work, "w0 long, w1 long, prefix long, run long, low long, high long, mask long")


def shared_runs(docs: DataFrame, words: int) -> DataFrame:
    """(doc, spans): runs of each text that hold windows of other documents too, as ``at`` and a bit for each such window.

    ``docs`` has ``doc``, which tells documents apart, and ``text``. A mask of -1 means all windows of the run.
    """
    rows = staged(passage_runs(docs, words), "passages")
    several = group_apart(rows, ["prefix"], {"low": F.min("doc"), "high": F.max("doc")}).where("low != high")
    rows = staged(rows.join(several.select("prefix"), "prefix", "left_semi"), "passages-matched")
    runs = rows.groupBy("prefix", "run").agg(
        F.min("doc").alias("low"), F.max("doc").alias("high"), F.min(F.struct("doc", "at")).alias("place")
    )
    runs = staged(runs, "passage-runs")
    mixed = group_apart(runs, ["prefix"], {"kinds": F.count("*")}).where("kinds > 1").select("prefix")
    windows = staged(run_windows(runs.join(mixed, "prefix", "left_semi"), docs, words), "passage-windows")
    again = group_apart(windows, ["w0", "w1"], {"least": F.min("low"), "most": F.max("high")}).where("least != most")
    marks = windows.where("low = high").join(again.select("w0", "w1"), ["w0", "w1"], "left_semi").select("prefix", "run", "mask")
    marks = marks.unionByName(runs.where("low != high").select("prefix", "run", F.lit(-1).cast("long").alias("mask")))
    marks = group_apart(marks, ["prefix", "run"], {"mask": F.bit_or("mask")})
    spans = rows.join(marks, ["prefix", "run"]).select("doc", "at", "mask")
    # equal rows have the same runs
    spans = spans.groupBy(F.struct("doc").alias("k")).agg(F.collect_set(F.struct("at", "mask")).alias("spans"))
    return staged(spans.select("k.doc", "spans"), "passage-spans")


def _byte_spans(texts: pa.Array, runs: pa.ListArray, words: int) -> Iterator[list[tuple[int, int]]]:
    """The disjoint, ordered byte ranges that each text's marked windows cover, from first to last letter."""
    for text, found in zip(texts, runs, strict=True):
        if not found.is_valid or not text.is_valid:
            yield []
            continue
        raw = np.frombuffer(text.as_buffer(), np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], _WHITE[raw], [True]])))
        at, mask = found.values.field(0).to_numpy(), found.values.field(1).to_numpy()
        a, far, near = at >> (2 * _PACK), (at >> _PACK) & 0xFFFF, at & 0xFFFF
        change = np.zeros(len(edge) // 2 + 1, np.int64)
        whole = mask == -1
        np.add.at(change, (a - far)[whole], 1)
        np.add.at(change, (a - near)[whole] + words, -1)
        for j in range(_reach(words)):
            start = a[~whole & (mask >> j & 1 == 1)] - j
            np.add.at(change, start, 1)
            np.add.at(change, start + words, -1)
        turn = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(change) > 0])))
        yield list(zip(edge[turn[::2] * 2].tolist(), edge[turn[1::2] * 2 - 1].tolist(), strict=True))


def remove_passages(docs: DataFrame, words: int = 51) -> DataFrame:
    """The documents without sequences of ``words`` words that other documents have too, all copies gone.

    Words are `[^\\x20\\x09-\\x0D]+`; what stands between two words that go goes with them.
    Rows with the same doc_id and text are one document. Null texts stay null, and a text that loses everything
    stays as an empty one; ``n_chars``, where present, is counted anew; other columns and rows stay as they are.
    """

    def found(plain: DataFrame) -> DataFrame:
        keyed = plain.withColumn("doc", F.xxhash64(*[c for c in plain.columns if c in ("doc_id", "text")]))
        return keyed.join(shared_runs(keyed.select("doc", "text"), words).hint("merge"), "doc", "left")

    return without_spans(docs, found, lambda texts, runs: _byte_spans(texts, runs, words))
