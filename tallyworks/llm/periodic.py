"""Periodic runs of words, found by the dictionary of basic factors.

A basic factor is a stretch of words whose length is a power of two. Each is named so that equal factors of a text
have equal names; names of one length are made by sorting pairs of names of half that length, and only factors that
recur are named further. Three occurrences of a factor that follow each other at one distance, of at most twice its
length, are an arithmetic progression and propose that distance as a period. Proposals of one period that touch are
joined, extended word by word as far as the period holds, and listed once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run has at least so many words, and repeats its period at least so many times.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Texts worked on at once have about so many bytes; a longer text is worked on alone.
GROUP_BYTES = 1 << 22

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def proposals(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches (begin, end, period) that progressions of basic factors show to be periodic.

    ``words`` are numbers, equal for equal words of a text; numbers below zero match nothing.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    names = words.astype(np.int64)
    at = np.flatnonzero(names >= 0)
    length = 1
    while len(at):
        at = at[np.argsort(names[at], kind="stable")]
        ranked = names[at]
        same = ranked[1:] == ranked[:-1]
        gap = np.diff(at)
        first = np.flatnonzero(same[:-1] & same[1:] & (gap[:-1] == gap[1:]) & (gap[:-1] <= 2 * length))
        period = gap[first]
        # occurrences that leave words between them show the period for the first two only
        found.append((at[first], at[first] + period * np.where(period <= length, 2, 1) + length, period))
        recurs = np.zeros(len(at), bool)
        recurs[1:] = same
        recurs[:-1] |= same
        number = np.concatenate([[0], np.cumsum(~same)])
        names = np.full(len(words), -1, np.int64)
        names[at[recurs]] = number[recurs]
        at = np.sort(at[recurs])
        at = at[at + length < len(words)]
        right = names[at + length]
        at, right = at[right >= 0], right[right >= 0]
        pairs = names[at] * (len(number) + 1) + right
        names = np.full(len(words), -1, np.int64)
        names[at] = pairs
        length *= 2
    return tuple(np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def _joined(begin: np.ndarray, end: np.ndarray, period: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Stretches of one period joined where they overlap by a period or more."""
    order = np.lexsort((begin, period))
    begin, end, period = begin[order], end[order], period[order]
    held: list[int] | None = None
    for b, e, p in zip(begin.tolist(), end.tolist(), period.tolist(), strict=True):
        if held and held[2] == p and b <= held[1] - p:
            held[1] = max(held[1], e)
        else:
            if held:
                yield tuple(held)
            held = [b, e, p]
    if held:
        yield tuple(held)


def _extended(words: np.ndarray, begin: int, end: int, period: int) -> tuple[int, int]:
    step = 16
    while end < len(words):
        stop = min(end + step, len(words))
        same = words[end:stop] == words[end - period : stop - period]
        if not same.all():
            end += int(same.argmin())
            break
        end, step = stop, min(2 * step, 1 << 16)
    step = 16
    while begin > 0:
        stop = max(begin - step, 0)
        same = (words[stop:begin] == words[stop + period : begin + period])[::-1]
        if not same.all():
            begin -= int(same.argmin())
            break
        begin, step = stop, min(2 * step, 1 << 16)
    return begin, end


def find_runs(words: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> np.ndarray:
    """Rows (start, length, period) of the maximal runs of a sequence of numbers, by start, then period.

    Numbers below zero separate texts; they must all differ. The period is the smallest of its run: the
    progression's distances are those of the nearest successors, so no shorter one fits.
    """
    if times < LEAST_TIMES:
        raise ValueError(f"runs of fewer than {LEAST_TIMES} periods need not hold a progression of three factors")
    runs = set()
    known = (0, 0, 0)
    for begin, end, period in _joined(*proposals(words)):
        if known[2] == period and end <= known[1]:  # in the stretch that was extended last
            continue
        begin, end = _extended(words, begin, end, period)
        known = (begin, end, period)
        if end - begin >= max(least, times * period):
            runs.add((begin, end - begin, period))
    return np.array(sorted(runs, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _work(texts: pa.Array, least: int, times: int) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, offsets = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)  # white space at either end leaves an empty word
    offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
    words = words.filter(pa.array(full))
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    counts = np.diff(offsets)
    text = np.repeat(np.arange(len(texts)), counts)
    # one separator before each text; words of different texts differ
    at = np.arange(len(numbers)) + text + 1
    line = -1 - np.arange(len(numbers) + len(texts), dtype=np.int64)
    line[at] = text * (len(numbers) + 1) + numbers
    runs = find_runs(line, least, times)
    begins = offsets[:-1] + np.arange(len(texts)) + 1  # of each text on the line
    owner = np.searchsorted(begins, runs[:, 0], "right") - 1
    drop = np.zeros(len(line) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(drop)[at] == 0
    cuts = np.concatenate([[0], np.cumsum(keep)])[offsets]
    kept = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.filter(pa.array(keep)))
    rows = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - begins[owner] if len(runs) else runs[:, 0]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(_RUNS.value_type)
    )
    each = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(each, pa.int32()), rows), pc.binary_join(kept, " ")]


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the periodic runs of each text and the text without their repeats.

    Words are separated by spaces and the characters 9 to 13. A run is a maximal stretch of at least ``least``
    words and ``times`` repeats of its smallest period; ``runs`` are structs (start, length, period), numbers of words from 0, by
    start, then period. ``collapsed`` joins by a space the words that no run holds after its first period. Texts are
    worked on whole, each by itself, without a shuffle.

    A null or empty text has no words, no runs and an empty ``collapsed``. Null and repeated doc_ids are kept as they
    are, a row for each; further columns, of whatever name, are ignored; no rows give no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin = batch.column(1), 0
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            while begin < batch.num_rows:
                base = int(sizes[begin - 1]) if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, base + GROUP_BYTES, "right")))
                part = texts.slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), *_work(part, least, times)], ["doc_id", "n_words", "runs", "collapsed"]
                )
                begin = end

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, schema)


def looped_text(doc_id: Column, text: Column) -> Column:
    """The text, a tenth of the documents (by the crc32 of the doc_id) looping their words from some word on.

    With h that crc32, g the tenth of it, rounded down, and n words, each word from a = g % n on becomes that at a + (i - a) % p,
    where p = 1 + floor((n - a) / (3 + g % 8)). A text that doesn't loop, or has no words or no doc_id, stays as it is.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def loop(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    # the words are bound once, as the element of an array, so that they aren't split again for each word
    looped = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, loop(w)).otherwise("")), F.lit(0))
    return F.when(h % 10 == 0, looped).otherwise(text)


def run_digest(docs: DataFrame) -> DataFrame:
    """The longest run, digests of all runs and of the collapsed text of each document after ``looped_text``.

    Columns: doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256; see ``periodic_runs``
    for nulls, repeats, further columns and empty tables. Ties of length go to the smallest start, then period.
    """
    found = periodic_runs(docs.select("doc_id", looped_text(F.col("doc_id"), F.col("text").cast("string")).alias("text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    text = F.when(F.size("runs") > 0, F.concat(rows, F.lit("\n"))).otherwise("")
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest.start")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest.period")).alias("period"),
        F.floor(1000 * F.col("_longest.length") / -F.col("_longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
