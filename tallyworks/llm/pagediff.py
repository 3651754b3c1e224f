"""Main text of HTML pages by differencing each page with those at the nearest URLs of its host.

Pages of a host are put in order of their URL's path, segment by segment, and each is paired with the one before and
the one after. The lines of a pair are aligned by their longest common subsequence; lines that both have belong to the
site and not to the page, and are deleted. What the markup itself names settles the rest: lines in what is
called a menu, notice or comment go even if no other page has them, and lines of an article or main element stay even if a neighbour
quotes them too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.markup import FURNITURE, MAIN, page_lines
from tallyworks.llm.order import numbered

#: Pages in a row that one task pairs before others may go on; the first and last go along with the rows beside them.
STRETCH = 256
#: Two pages without a marked main text that share so much of it are versions of one page, and show no furniture.
SAME_PAGE = 0.8
#: Alignments whose table has more bits than this are split in half.
TABLE_BITS = 1 << 26

_URL = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^?#]*)")


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host in lower case, and the path with its segments marked off so that it sorts segment by segment."""
    found = _URL.match((url or "").strip())
    host, path = (found[1].lower(), found[2]) if found else ("", re.split(r"[?#]", url or "")[0])
    return host, path.rstrip("/").replace("/", "\x01")


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """After each item of ``a``: a number whose zero bits are where the subsequence gets longer along ``b``."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(bits == 0)])


def _aligned(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    if not len(a) or not len(b):
        return []
    if len(a) * len(b) > TABLE_BITS and len(a) > 1:
        half = len(a) // 2
        both = _lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(both.argmax())
        return _aligned(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _aligned(a[half:], b[cut:])]
    rows = list(_rows(a, b))
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if i and not rows[i - 1] >> (j - 1) & 1:
            continue
        j -= 1
        out.append((i, j))
    return out[::-1]


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two sequences of numbers have their longest common subsequence."""
    head = 0
    short = min(len(a), len(b))
    if short:
        differ = np.flatnonzero(a[:short] != b[:short])
        head = int(differ[0]) if len(differ) else short
        differ = np.flatnonzero(a[::-1][: short - head] != b[::-1][: short - head])
        tail = int(differ[0]) if len(differ) else short - head
    else:
        tail = 0
    left = head + np.flatnonzero(np.isin(a[head : len(a) - tail], b[head : len(b) - tail]))
    right = head + np.flatnonzero(np.isin(b[head : len(b) - tail], a[head : len(a) - tail]))
    pairs = np.array(_aligned(a[left].tolist(), b[right].tolist()), np.int64).reshape(-1, 2)
    first, last = np.arange(head), np.arange(tail)
    return (
        np.concatenate([first, left[pairs[:, 0]], len(a) - tail + last]),
        np.concatenate([first, right[pairs[:, 1]], len(b) - tail + last]),
    )


def _page_key() -> Column:
    """128 bits of the URL and the page, so that copies of a row are worked on once."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col("url"), F.col("html"))]
    return F.unhex(F.md5(F.concat(*parts)))


def _line_numbers(pages: DataFrame) -> DataFrame:
    """(key, host, path, lines, said, chars) of each page: its lines as 64-bit hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = xxhash.xxh3_64_intdigest
        for batch in batches:
            out: list[tuple] = []
            for key, url, page in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lines, said = page_lines(page or "")
                hashes = np.array([h(x) for x in lines], np.uint64).view(np.int64)
                chars = np.array([len(x) for x in lines], np.int64)
                out.append((key, *host_and_path(url), hashes.tobytes(), bytes(said), chars.tobytes()))
            kinds = (pa.binary(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.binary())
            columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["key", "host", "path", "lines", "said", "chars"]
            )

    schema = "key binary, host string, path string, lines binary, said binary, chars binary"
    return pages.select("key", "url", "html").mapInArrow(work, schema)


def _is_version(said: np.ndarray, chars: np.ndarray, shared: np.ndarray) -> bool:
    """Whether two pages that share these lines are versions of one, going by what may be main text."""
    if (said == MAIN).any():
        return False  # its main text stays in any case
    open_to = np.where(said == FURNITURE, 0, chars)
    return bool(open_to[shared].sum() >= SAME_PAGE * open_to.sum())


def shared_lines(numbers: DataFrame) -> DataFrame:
    """(key, shared): for each line of a page whether a page at the nearest URLs before and after has it too.

    ``numbers`` has the pages' lines (see ``_line_numbers``), a row for each key. Stretches of the order go to a task each, with
    the page before and the one after, so a host of any size is spread and every neighbour is met.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(pages: list[tuple]) -> pa.RecordBatch:
            masks = []
            read = [(np.frombuffer(p[4], np.int64), np.frombuffer(p[5], np.uint8), np.frombuffer(p[6], np.int64)) for p in pages]
            masks = [np.zeros(len(r[0]), bool) for r in read]
            for k in range(len(pages) - 1):
                if pages[k][1] != pages[k + 1][1] or pages[k][3] != pages[k + 1][3]:  # stretch, host
                    continue
                for n, at in zip((k, k + 1), common(read[k][0], read[k + 1][0]), strict=True):
                    if not _is_version(read[n][1], read[n][2], at):
                        masks[n][at] = True
            own = [k for k, p in enumerate(pages) if p[2]]
            return pa.RecordBatch.from_arrays(
                [pa.array([pages[k][0] for k in own], pa.binary()), pa.array([masks[k].tolist() for k in own], pa.list_(pa.bool_()))], ["key", "shared"]
            )

        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[-1][1] != row[1]:
                    yield finish(held)
                    held = []
                held.append(row)
        if held:
            yield finish(held)

    placed = numbered(numbers, [], ["host", "path", "key"], "pages-order")
    at = F.floor(F.col("idx") / STRETCH).cast("long")
    to = F.array(at, F.when(F.col("idx") % STRETCH == 0, at - 1), F.when(F.col("idx") % STRETCH == STRETCH - 1, at + 1))
    dealt = placed.withColumn("stretch", F.explode(F.filter(to, lambda s: s.isNotNull()))).withColumn("own", F.col("stretch") == at)
    dealt = dealt.repartition("stretch").sortWithinPartitions("stretch", "idx")
    return dealt.select("key", "stretch", "own", "host", "lines", "said", "chars").mapInArrow(work, "key binary, shared array<boolean>")


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, lines, says, shared, text): the lines of each page and the main text they leave.

    ``lines`` are the page's blocks of text in order, ``says`` what the markup says of each (0 furniture, 1 nothing, 2 main
    text) and ``shared`` whether a page at the nearest URLs of the host has it too. ``text`` joins by a space the lines of main text and
    those of which the markup says nothing and that no neighbour shares.

    Pages of a host that share most of what may be main text are taken as versions of one page and say nothing about each
    other. A null page counts as empty and has no lines; a null URL, or one without a host, belongs to the nameless host.
    Repeated rows and page_ids are kept, a row for each; further columns, of whatever name, are ignored; no rows give no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_lines(x or "") for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([lines for lines, _ in found], pa.list_(pa.string())),
                    pa.array([said for _, said in found], pa.list_(pa.int8())),
                ],
                ["page_id", "url", "key", "lines", "says"],
            )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("key", _page_key())
    # copies of a page go together by an exchange, which also spares the sort's two passes from parsing twice
    numbers = _line_numbers(rows).dropDuplicates(["key"])
    # grouped by a struct so that the join keeps its exchanges, and can split a row that repeats very often
    shared = shared_lines(numbers).groupBy(F.struct("key").alias("_key")).agg(F.first("shared").alias("shared")).select("_key.key", "shared")
    texts = rows.select("page_id", "url", "key", "html").mapInArrow(
        work, "page_id long, url string, key binary, lines array<string>, says array<byte>"
    )
    own = F.filter("lines", lambda x, i: (F.get("says", i) == MAIN) | ((F.get("says", i) != FURNITURE) & ~F.get("shared", i)))
    return texts.join(shared, "key").select("page_id", "url", "lines", "says", "shared", F.array_join(own, " ").alias("text"))


def page_digest(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each page; see ``page_texts``."""
    return page_texts(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
