"""Hierarchical packing of token ids into windows of several context sizes."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import trim_memory

#: Pieces that a task holds before it packs; it bounds memory and changes only who shares a window.
POOL = 512
#: Ids of documents encoded by one call, in bytes of text.
ENCODE_BYTES = 1 << 24

_COLUMNS = {
    "doc_id": pa.int64(),
    "start": pa.int64(),
    "length": pa.int64(),
    "ids_crc32": pa.int64(),
    "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(),
    "offset": pa.int64(),
    "tier": pa.int32(),
    "step_id": pa.int64(),
}


class Piece:
    """Some ids of one document, in order."""

    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc: int | None, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:n], self.total),
            Piece(self.doc, self.start + n, self.ids[n:], self.total),
        )


class Packer:
    """Packs the documents of one task; windows have the size of a tier and no padding.

    Full windows of the longest tier are cut off first. What is left of a document is routed to the
    shortest tier that holds it. Windows are packed from the longest piece down: the piece opens a window
    of its tier, and the gap is filled with the longest pieces of the same or shorter tiers that fit, the
    last one cut. What can't fill a window at the end is cut into windows of powers of two.
    """

    def __init__(self, tiers: Sequence[int], step_tokens: int, number: int):
        self.tiers = sorted(tiers)
        self.step_tokens = step_tokens
        self.base = number << 33
        self.sequences = self.steps = 0
        self.open_steps: dict[int, list[int]] = {}
        self.sizes: list[int] = []
        self.pieces: list[Piece] = []
        self.rows: list[tuple] = []

    def _step(self, tier: int) -> int:
        """A step group takes windows of one tier until it has ``step_tokens`` ids, so all steps weigh alike."""
        step = self.open_steps.get(tier)
        if step is None:
            step = self.open_steps[tier] = [self.steps, 0]
            self.steps += 1
        step[1] += tier
        if step[1] >= self.step_tokens:
            del self.open_steps[tier]
        return self.base | step[0]

    def _emit(self, window: list[Piece], tier: int) -> None:
        sequence, step, offset = self.base | self.sequences, self._step(tier), 0
        self.sequences += 1
        for p in window:
            n = len(p.ids)
            self.rows.append((p.doc, p.start, n, zlib.crc32(p.ids.astype("<u4").tobytes()), p.total, sequence, offset, tier, step))
            offset += n

    def _keep(self, piece: Piece) -> None:
        at = bisect.bisect_left(self.sizes, len(piece.ids))
        self.sizes.insert(at, len(piece.ids))
        self.pieces.insert(at, piece)

    def _take(self, at: int) -> Piece:
        del self.sizes[at]
        return self.pieces.pop(at)

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        longest = self.tiers[-1]
        piece = Piece(doc, 0, ids, len(ids))
        while len(piece.ids) > longest:
            full, piece = piece.cut(longest)
            self._emit([full], longest)
        if len(piece.ids) in self.tiers:
            self._emit([piece], len(piece.ids))
        elif len(piece.ids):
            self._keep(piece)
            if len(self.pieces) >= POOL:
                for left in self._pack():
                    self._keep(left)

    def _pack(self) -> list[Piece]:
        """Fill windows while pieces last; returns the pieces of a last window that stays short."""
        while self.pieces:
            window = [self._take(-1)]
            size = len(window[0].ids)
            tier = self.tiers[bisect.bisect_left(self.tiers, size)]
            gap = tier - size
            while gap and self.pieces:
                at = bisect.bisect_right(self.sizes, gap)
                if at:
                    window.append(self._take(at - 1))
                else:
                    part, rest = self._take(0).cut(gap)
                    window.append(part)
                    self._keep(rest)
                gap -= len(window[-1].ids)
            if gap:
                return window
            self._emit(window, tier)
        return []

    def flush(self) -> None:
        """Pack all that is held, the last short window as powers of two."""
        left = self._pack()
        while left:
            total = sum(len(p.ids) for p in left)
            size = 1 << (total.bit_length() - 1)
            window, rest, gap = [], [], size
            for p in left:
                if len(p.ids) > gap:
                    part, p = p.cut(gap) if gap else (None, p)
                    window += [part] if part else []
                    gap = 0
                    rest.append(p)
                else:
                    window.append(p)
                    gap -= len(p.ids)
            self._emit(window, size)
            left = rest

    def take_rows(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in _COLUMNS]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _COLUMNS.values(), strict=True)], list(_COLUMNS))


def pack(
    docs: DataFrame,
    tiers: Sequence[int] = (64, 128, 256, 512, 1024),
    step_tokens: int = 1 << 16,
    vocabulary: str | None = None,
) -> DataFrame:
    """Pieces of documents and their places in windows.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the window's tier (its
    size) and step_id (its step group). A document's ids end with id 0, so a null or empty text has that
    one. Each task packs the documents it reads, without a shuffle; only the rest that each task ends with
    makes windows shorter than the smallest tier, of powers of two. A null doc_id stays null; repeated rows are
    packed each; further columns are ignored; no rows give no rows. ``vocabulary`` is the path of the
    tokenizer's file, by default the public byte-level one.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tallyworks.llm.tokenize import encoder

        trim_memory()
        encode = encoder(vocabulary).encode
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId())
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                end, size = at, 0
                while end < len(ids) and (end == at or size < ENCODE_BYTES):
                    size += len(texts[end].as_buffer() or b"") if texts[end].is_valid else 0
                    end += 1
                for doc, found in zip(ids[at:end], encode(texts.slice(at, end - at).to_pylist()), strict=True):
                    packer.add(doc, np.append(found, found.dtype.type(0)))
                at = end
                if packer.rows:
                    yield packer.take_rows()
        packer.flush()
        yield packer.take_rows()

    schema = ", ".join(f"{c} {'int' if t == pa.int32() else 'long'}" for c, t in _COLUMNS.items())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, schema)
