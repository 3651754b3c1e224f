"""Removal of long repeated byte strings by a logarithmic family of sorted suffix arrays.

Every window of ``length`` bytes is given to one anchor in its first part: the position whose next bytes
hash least. Equal windows have the same anchor at the same distance, so only suffixes that begin at anchors
are indexed, about one in ``length / 3`` bytes. A suffix array here is a written table of such suffixes in
the order of their fingerprints: of all orders, the scans only need one in which equal prefixes are
neighbours. Batches of documents get arrays; a new array is merge-scanned against every level of the
family for matching prefixes; levels of equal size merge, so each suffix is rewritten a logarithmic
number of times. Suffixes matched in a scan are then compared as whole runs of windows, where runs differ
by blocks of windows, and where blocks overlap in part, window by window on their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.shared import staged
from tallyworks.operators.skew import group_apart

#: Positions are stored with the run's two distances, of 16 bits each, in one long.
_PACK = 16
#: Windows fingerprinted by one call.
_CHUNK = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last start of each run of windows that share an anchor, over a whole text."""
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    reach = 1 << ((length * 2 // 3).bit_length() - 1)  # an anchor is one of a window's first positions
    raw = np.frombuffer(data, np.uint8)
    found, lows, highs = [], [], []
    for at in range(0, n, _CHUNK):
        m = min(_CHUNK, n - at)
        size = m + reach - 1
        part = raw[at : at + size + 7]
        key = np.zeros(size, np.uint64)
        for b in range(min(8, length - reach + 1)):
            key = (key << np.uint64(8)) | part[b : b + size]
        key ^= key >> np.uint64(29)
        key *= _BASE
        for out, part in zip((found, lows, highs), least_runs(key, reach), strict=True):
            out.append(part + at)
    return np.concatenate(found), np.concatenate(lows), np.concatenate(highs)


def least_runs(key: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the least of each ``reach`` hashes in turn lies: its place, and the first and last start of the run it serves."""
    m = len(key) - reach + 1
    # least hash, then leftmost: the position within the chunk fills the low bits
    key = (key & ~np.uint64((1 << 24) - 1)) | np.arange(len(key), dtype=np.uint64)
    width = 1
    while width < reach:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    anchor = (key[:m] & np.uint64((1 << 24) - 1)).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1, [m]])
    return anchor[cut[:-1]], cut[:-1], cut[1:] - 1


def _prefix(length: int) -> int:
    """Bytes after an anchor that every window with this anchor contains."""
    return length - (1 << ((length * 2 // 3).bit_length() - 1)) + 1


def suffix_runs(docs: DataFrame, length: int) -> DataFrame:
    """(prefix, run, doc, at): fingerprints of each anchor's prefix and whole run, and where it lies.

    ``at`` packs the anchor and its distances from the run's first and last start.
    """
    prefix = _prefix(length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py()
                a, first, last = anchors(data, length)
                if not len(a):
                    continue
                h = xxhash.xxh3_64_intdigest
                keys = np.array([h(data[p : p + prefix]) for p in a.tolist()], np.uint64)
                whole = np.array([h(data[p : q + length]) for p, q in zip(first.tolist(), last.tolist(), strict=True)], np.uint64)
                # the distances belong to the run: the same bytes with another anchor are no match
                whole ^= ((a - first) * 65_537 + (a - last)).astype(np.uint64) * _BASE
                at = (a << (2 * _PACK)) | ((a - first) << _PACK) | (a - last)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(np.full(len(a), doc)), pa.array(at)],
                    ["prefix", "run", "doc", "at"],
                )

    return docs.where(F.octet_length("text") >= length).select("doc", F.col("text").cast("binary").alias("text")).mapInArrow(
        work, "prefix long, run long, doc long, at long"
    )


class SuffixFamily:
    """Levels of sorted suffix tables whose sizes are powers of two of a batch."""

    def __init__(self) -> None:
        self.levels: dict[int, DataFrame] = {}
        self.matched: list[DataFrame] = []

    def add(self, suffixes: DataFrame) -> None:
        """Build a batch's array, scan it against every level, then merge levels of equal size."""
        array = self._written(suffixes.groupBy("prefix").agg(F.count("*").alias("n")))
        self.matched.append(array.where("n > 1").select("prefix"))
        for level in self.levels.values():
            self.matched.append(array.select("prefix").join(level.select("prefix"), "prefix"))
        size = 0
        while size in self.levels:
            both = self.levels.pop(size).unionByName(array)
            array = self._written(both.groupBy("prefix").agg(F.sum("n").alias("n")))
            size += 1
        self.levels[size] = array

    @staticmethod
    def _written(array: DataFrame) -> DataFrame:
        return staged(array.sortWithinPartitions("prefix"), "suffix-array")

    def repeated(self) -> DataFrame:
        """Distinct prefixes that any scan has matched."""
        found = self.matched[0]
        for more in self.matched[1:]:
            found = found.unionByName(more)
        return found.select(F.struct("prefix").alias("k")).distinct().select("k.prefix")


def repeated_windows(runs: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(prefix, run, low, high): ranges of starts in a run, from its first, whose windows other runs have too.

    ``runs`` has one place (doc, at) of each distinct run of an anchor prefix that has several. Equal windows
    lie at the same distance from their anchor, so the windows of a run are cut into blocks by that distance.
    All windows of a block contain its core, and all lie in its hull, as far as the run has them: blocks with
    equal hulls repeat each other whole, and blocks whose cores differ share no window. Only where one core has
    several hulls are the windows themselves compared, once for each hull. Every step is a count by
    fingerprint, the same for a prefix of two runs and for one that a third of all texts share.
    """
    step = max(1, min(16, length // 4))
    wanted = runs.groupBy(F.struct("doc").alias("k")).agg(F.collect_list(F.struct("prefix", "run", "at")).alias("runs"))
    texts = docs.join(wanted.select(F.col("k.doc").alias("doc"), "runs"), "doc").select(
        "runs", F.col("text").cast("binary").alias("text")
    )

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, text in zip(batch.column(0), batch.column(1), strict=True):
                data = text.as_py()
                parts = []
                for r in found.as_py():
                    anchor, far, near = r["at"] >> (2 * _PACK), (r["at"] >> _PACK) & 0xFFFF, r["at"] & 0xFFFF
                    parts.append((r["prefix"], r["run"], far, near, data[anchor - far : anchor - near + length]))
                yield _batch(parts, {"prefix": pa.int64(), "run": pa.int64(), "first": pa.int32(), "last": pa.int32(), "data": pa.binary()})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_64_intdigest
        names = ("core", "hull", "prefix", "run", "first", "near", "far")
        types = dict(zip(names, [pa.uint64()] * 2 + [pa.int64()] * 2 + [pa.int32()] * 3, strict=True))
        for batch in batches:
            parts = []
            for prefix, run, first, last, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for block in range(last // step, first // step + 1):
                    near, far = max(last, block * step), min(first, block * step + step - 1)
                    core = h(data[first - block * step : first - block * step - step + 1 + length], block)
                    # equal bytes with fewer of the block's windows are another hull
                    hull = h(data[first - far : first - near + length], near << _PACK | far)
                    parts.append((core, hull, prefix, run, first, near, far))
            out = _batch(parts, types)
            yield pa.RecordBatch.from_arrays([c.view(pa.int64()) if c.type == pa.uint64() else c for c in out.columns], names=list(names))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_128_digest
        for batch in batches:
            for first, data, blocks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts, prints = [], []
                for b in blocks:
                    for j in range(b["near"], b["far"] + 1):
                        prints.append(h(data[first - j : first - j + length]))
                        parts.append((b["core"], b["hull"], 1 << (j % step)))
                both = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
                rest = _batch(parts, {"core": pa.int64(), "hull": pa.int64(), "mask": pa.int32()})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1])), *rest.columns],
                    names=["w0", "w1", *rest.schema.names],
                )

    fetched = texts.mapInArrow(fetch, "prefix long, run long, first int, last int, data binary")
    fetched = staged(fetched, "suffix-texts", compression="zstd")
    kinds = "core long, hull long, prefix long, run long, first int, near int, far int"
    blocks = staged(fetched.mapInArrow(cut, kinds), "suffix-blocks")
    hulls = blocks.groupBy("core", "hull").agg(
        F.count("*").alias("n"), F.min(F.struct("prefix", "run", "near", "far")).alias("place")
    )
    hulls = staged(hulls, "suffix-hulls")
    several = group_apart(hulls, ["core"], {"kinds": F.count("*")}).where("kinds > 1").select("core")
    mixed = hulls.join(several, "core").select("core", "hull", "place.*")
    mixed = mixed.groupBy("prefix", "run").agg(F.collect_list(F.struct("core", "hull", "near", "far")).alias("blocks"))
    single = fetched.join(mixed, ["prefix", "run"]).select("first", "data", "blocks")
    single = staged(single.mapInArrow(windows, "w0 long, w1 long, core long, hull long, mask int"), "suffix-windows")
    again = group_apart(single, ["w0", "w1"], {"n": F.count("*")}).where("n > 1").select("w0", "w1")
    marks = single.join(again, ["w0", "w1"], "left_semi").select("core", "hull", "mask")
    marks = marks.unionByName(hulls.where("n > 1").select("core", "hull", F.lit(-1).alias("mask")))
    marks = group_apart(marks, ["core", "hull"], {"mask": F.bit_or("mask")})
    whole = F.array(F.struct((F.col("first") - F.col("far")).alias("low"), (F.col("first") - F.col("near")).alias("high")))
    repeated = F.filter(F.sequence("near", "far"), lambda j: F.getbit("mask", j % step) == 1)
    some = F.transform(repeated, lambda j: F.struct((F.col("first") - j).alias("low"), (F.col("first") - j).alias("high")))
    found = blocks.join(marks, ["core", "hull"])
    return found.select("prefix", "run", F.inline(F.when(F.col("mask") == -1, whole).otherwise(some)))


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _merged(column: pa.ListArray) -> Iterator[list[tuple[int, int]]]:
    """The disjoint, ordered spans that each row's ranges cover; none for a null."""
    cut, ranges = column.offsets.to_numpy(), column.values
    lows, highs = ranges.field(0).to_numpy(), ranges.field(1).to_numpy()
    for i, given in enumerate(column.is_valid().to_pylist()):
        low, high = lows[cut[i] : cut[i + 1]], highs[cut[i] : cut[i + 1]]
        if not given or not len(low):
            yield []
            continue
        order = np.argsort(low)
        low, high = low[order], np.maximum.accumulate(high[order])
        begins = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))
        ends = np.concatenate([begins[1:], [len(low)]]) - 1
        yield list(zip(low[begins].tolist(), high[ends].tolist(), strict=True))


def repeated_spans(docs: DataFrame, length: int = 400, batches: int = 4) -> DataFrame:
    """(doc, spans): byte ranges [low, high) of each text that are covered by repeated windows.

    ``docs`` has ``doc``, a key of equal rows, and ``text``. Ranges may overlap and are unordered; texts
    without any have no row.
    """
    dealt = suffix_runs(docs, length).withColumn("batch", F.pmod(F.xxhash64("doc"), F.lit(batches)).cast("int"))
    path_rows = staged(dealt, "suffixes")
    family = SuffixFamily()
    for batch in range(batches):
        family.add(path_rows.where(F.col("batch") == batch).select("prefix"))
    rows = path_rows.drop("batch").join(family.repeated(), "prefix", "left_semi")
    rows = staged(rows, "suffixes-matched")
    runs = staged(
        rows.groupBy("prefix", "run").agg(F.count("*").alias("n"), F.min(F.struct("doc", "at")).alias("place")), "suffix-runs"
    )
    several = group_apart(runs, ["prefix"], {"kinds": F.count("*")}).where("kinds > 1")
    places = runs.join(several, "prefix").select("prefix", "run", "place.doc", "place.at")
    partial = repeated_windows(places, docs, length)
    ranges = partial.unionByName(
        runs.where("n > 1").select("prefix", "run", F.lit(0).alias("low"), F.lit(None).cast("int").alias("high"))
    )
    ranges = ranges.groupBy(F.struct("prefix", "run").alias("k")).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
    ranges = ranges.select("k.prefix", "k.run", "ranges")
    start = F.shiftright("at", 2 * _PACK) - F.shiftright("at", _PACK).bitwiseAND(F.lit(0xFFFF))
    last = F.shiftright("at", 2 * _PACK) - F.col("at").bitwiseAND(F.lit(0xFFFF))
    spans = rows.join(ranges, ["prefix", "run"]).select(
        "doc",
        F.transform(
            "ranges",
            lambda r: F.struct((start + r["low"]).alias("low"), (F.coalesce(start + r["high"], last) + length).alias("high")),
        ).alias("spans"),
    )
    return spans.groupBy(F.struct("doc").alias("k")).agg(F.flatten(F.collect_list("spans")).alias("spans")).select("k.doc", "spans")


def _with_spans(docs: DataFrame, length: int, batches: int) -> DataFrame:
    """Rows of ``docs`` (with ``text``) and their ``spans``, disjoint and in order, null if none.

    The spans are merged and staged, so that the shuffle files behind them are gone before the texts are moved.
    """

    def merge(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        for batch in batches_:
            spans = [[{"low": a, "high": b} for a, b in gone] for gone in _merged(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc", "spans"])

    keyed = docs.withColumn("doc", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c in ("doc_id", "text")]))
    spans = repeated_spans(keyed.select("doc", "text"), length, batches)
    spans = staged(spans.mapInArrow(merge, "doc long, spans array<struct<low: long, high: long>>"), "suffix-spans")
    return keyed.join(spans.hint("merge"), "doc", "left")


def repeat_digests(docs: DataFrame, length: int = 400, batches: int = 4) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of removing every repeated ``length``-byte string.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in the same or
    another text; all copies go. Strings don't cross texts. A null text counts as empty, and texts under
    ``length`` bytes keep all. A repeated row repeats its text, so both lose it. A null doc_id is kept as
    it is; further columns of the input are ignored; no rows give no rows.
    """
    import hashlib

    def work(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            out: list[list] = [[], [], [], []]
            for text, gone in zip(batch.column(1), _merged(batch.column(2)), strict=True):
                data = text.as_py() or b""
                kept, last = hashlib.sha256(), 0
                view = memoryview(data)
                for a, b in gone:
                    kept.update(view[last:a])
                    last = b
                kept.update(view[last:])
                for o, v in zip(out, (len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest()), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(o, t) for o, t in zip(out, [pa.int64()] * 3 + [pa.string()], strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _with_spans(rows, length, batches).select("doc_id", F.col("text").cast("binary").alias("text"), "spans")
    return rows.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400, batches: int = 4) -> DataFrame:
    """The documents without their repeated strings; ``n_chars``, where present, is counted anew.

    A character goes if all its bytes go, so the text stays valid. Null texts stay null, and a text that
    loses everything stays as an empty one; all other columns, whatever their names, and rows stay as they are.
    No rows give no rows.
    """

    return without_spans(
        docs,
        lambda plain: _with_spans(plain, length, batches),
        lambda texts, spans: _merged(spans),
    )


def without_spans(
    docs: DataFrame,
    found: Callable[[DataFrame], DataFrame],
    merged: Callable[[pa.Array, pa.ListArray], Iterable[list[tuple[int, int]]]],
) -> DataFrame:
    """The documents without byte ranges of their texts; ``n_chars``, where present, is counted anew.

    ``found`` adds a column ``spans`` to the documents, of which ``merged`` makes disjoint, ordered ranges of each text.
    """

    def work(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_:
            texts, given = [], batch.column(batch.schema.get_field_index("text"))
            spans = merged(given, batch.column(batch.num_columns - 1))
            for text, gone in zip(given, spans, strict=True):
                data = text.as_py()
                if data is None or not gone:
                    texts.append(data)
                    continue
                raw, parts, last = data.encode(), [], 0
                for a, b in gone:
                    while a < b and raw[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                    parts.append(raw[last:a])
                    last = b
                texts.append(b"".join([*parts, raw[last:]]).decode())
            i = batch.schema.get_field_index("text")
            columns = [pa.array(texts, pa.string()) if k == i else c for k, c in enumerate(batch.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    # columns go by number on the way, so that none clashes with those added here
    own = ("doc_id", "text", "n_chars")
    plain = docs.toDF(*[c if c in own else f"c{i}" for i, c in enumerate(docs.columns)])
    cut = found(plain).select(*plain.columns, "spans").mapInArrow(work, plain.schema)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))
    return cut.toDF(*docs.columns)
