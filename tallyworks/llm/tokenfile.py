"""Token ids in files of fixed-width packed bits, with random access by blocks.

Layout, little-endian: packed blocks of ``BLOCK`` ids each (the last one shorter), every block padded to
whole bytes; then int64 arrays: block offsets in bytes (with the end), start of each document in ids (with
the end), doc_ids; a byte per document that is 1 if it has no doc_id; and a trailer of five numbers and
the magic. Id k has the bits from ``k % BLOCK * width`` of its block, least significant first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.llm.files import filesystem, write_file
from tallyworks.llm.shared import new_folder, staged

BLOCK = 1 << 16
MAGIC = b"TOKBITS1"
_TRAILER = struct.Struct("<qqqqq8s")
#: Ids read back at once.
READ_IDS = 1 << 21
ENCODE_BYTES = 1 << 22
#: What the end of each document is marked by.
END_ID = 0


def id_width(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = (ids.astype(np.uint32)[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype("<u4")
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32).astype("<u4")


class TokenWriter:
    """Writes documents' ids one after the other."""

    def __init__(self, out, vocabulary: int):
        self.out, self.width = out, id_width(vocabulary)
        self.held: list[np.ndarray] = []
        self.n_held = 0
        self.offsets, self.starts = [0], [0]
        self.docs: list[int] = []
        self.nameless = bytearray()

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc or 0)
        self.nameless.append(doc is None)
        self.starts.append(self.starts[-1] + len(ids))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK:
            self._blocks(self.n_held // BLOCK * BLOCK)

    def _blocks(self, upto: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        for at in range(0, upto, BLOCK):
            data = pack_bits(ids[at : min(at + BLOCK, upto)], self.width)
            self.out.write(data)
            self.offsets.append(self.offsets[-1] + len(data))
        self.held = [ids[upto:].copy()]
        self.n_held -= upto

    def close(self) -> None:
        if self.n_held:
            self._blocks(self.n_held)
        for numbers in (self.offsets, self.starts, self.docs):
            self.out.write(np.array(numbers, "<i8").tobytes())
        self.out.write(bytes(self.nameless))
        self.out.write(_TRAILER.pack(self.width, BLOCK, len(self.offsets) - 1, len(self.docs), self.starts[-1], MAGIC))


class TokenFile:
    """Random access to a file of packed ids."""

    def __init__(self, path: str):
        system, name = filesystem(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        self.width, self.block, blocks, docs, self.n_ids, magic = _TRAILER.unpack(self.file.read_at(_TRAILER.size, size - _TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of packed ids")
        index = 8 * (blocks + 1 + docs + 1 + docs) + docs
        data = self.file.read_at(index, size - _TRAILER.size - index)
        numbers = np.frombuffer(data, "<i8", blocks + 2 * docs + 2)
        self.offsets, self.starts, self.docs = np.split(numbers, [blocks + 1, blocks + docs + 2])
        self.nameless = np.frombuffer(data, np.uint8, docs, 8 * len(numbers)).astype(bool)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the blocks that hold them."""
        if start >= stop:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        begin = int(self.offsets[first])
        data = self.file.read_at(int(self.offsets[last + 1]) - begin, begin)
        parts = []
        for b in range(first, last + 1):
            n = min(self.block, self.n_ids - b * self.block)
            parts.append(unpack_bits(data[int(self.offsets[b]) - begin : int(self.offsets[b + 1]) - begin], n, self.width))
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Encode documents and write their ids to files, in ascending order of doc_id over all files.

    Returns a stored table of the files: part, path, n_docs, n_ids; parts number the files in order.
    Documents without a doc_id come first; equal ids go by their text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from tallyworks.llm.tokenize import encoder

        context = TaskContext.get()
        part, encode = context.partitionId(), encoder(vocabulary)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        done: list[TokenWriter] = []

        def write(out) -> None:
            writer = TokenWriter(out, encode.vocabulary)
            for batch in (b for source in ([first], batches) for b in source):
                ids, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
                while at < len(ids):
                    end, size = at, 0
                    while end < len(ids) and (end == at or size < ENCODE_BYTES):
                        size += len(texts[end].as_buffer()) if texts[end].is_valid else 0
                        end += 1
                    for doc, found in zip(ids[at:end], encode.encode(texts.slice(at, end - at).to_pylist()), strict=True):
                        writer.add(doc, np.append(found, found.dtype.type(END_ID)))
                    at = end
            writer.close()
            done.append(writer)

        path = write_file(folder, f"part-{part:06d}.tokens", context.taskAttemptId(), write)
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": path, "n_docs": len(done[-1].docs), "n_ids": done[-1].starts[-1]}],
            pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(rows.mapInArrow(work, "part int, path string, n_docs long, n_ids long"), "token-files")


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, read back from them.

    ``start`` counts the ids of all documents before it.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(path)
                at = 0
                while at < len(file.docs):
                    end = max(at + 1, int(np.searchsorted(file.starts, file.starts[at] + READ_IDS, "right")) - 1)
                    end = min(end, len(file.docs))
                    starts = file.starts[at : end + 1]
                    ids = file.ids(int(starts[0]), int(starts[-1]))
                    cuts = (starts - starts[0]).tolist()
                    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(file.docs[at:end], mask=file.nameless[at:end]),
                            pa.array(starts[:-1] + before),
                            pa.array(np.diff(starts)),
                            pa.array(crc, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    at = end
                file.close()

    by_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(by_part), F.lit(0)).alias("before"))
    # the files, not their ids, pass that window; they are then dealt out to be read
    dealt = placed.repartition(max(1, min(4096, files.count())))
    return dealt.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the ids of all documents to files of packed bits and read them back; see ``read_tokens``.

    A null text counts as empty and has only the end id. Repeated rows are written each; further columns
    are ignored; no rows give no files and no rows.
    """
    return read_tokens(write_tokens(docs, new_folder(docs.sparkSession, "tokens"), vocabulary))
