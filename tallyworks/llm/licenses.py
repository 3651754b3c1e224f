"""License scans by patience alignment of texts with license notices."""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.notices import templates

#: Texts and notices by name.
TEMPLATES: dict[str, str] = templates()
#: Share of a notice's words that must align.
LEAST = 0.75
#: Words too common to point at a notice.
_COMMON = frozenset("a all an and any are as at be by for from in is it of on or that the this to use with you your".split())
#: Notices of at most so many words must align whole but for these words ...
_SHORT = 12
_WEAK = frozenset(b"this work is the of licensed released under license version".split())
#: ... and longer ones in the names of licenses; all must in numbers of versions.
_NAMES = frozenset(b"affero apache gnu lesser mit mozilla".split())
_VERSION = re.compile(rb"v?\d+(\.\d+)*\Z")
_STRIP = b"\"'.,;:!?()[]{}<>*#%&|$`"


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case without marks around them."""
    return [w for w in (x.strip(_STRIP) for x in text.lower().split()) if w]


def _longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tops: list[int] = []
    ends: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect.bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            ends.append(i)
        else:
            tops[k], ends[k] = v, i
        back[i] = ends[k - 1] if k else -1
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[bytes], notice: list[bytes]) -> list[tuple[int, int]]:
    """Aligned words (place in text, place in notice), in order.

    Words that occur once in both are anchors; a longest increasing run of them stays, and the gaps
    between are aligned in turn. Where a gap has no such word, equal words at its ends are taken and
    what is then left is aligned again.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(notice))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == notice[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == notice[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a >= b or c >= d:
            continue
        n, m = Counter(text[a:b]), Counter(notice[c:d])
        places = {w: c + k for k, w in enumerate(notice[c:d]) if m[w] == 1 and n[w] == 1}
        anchors = [(a + k, places[w]) for k, w in enumerate(text[a:b]) if w in places]
        if not anchors:
            continue
        last = (a, c)
        for k in _longest_increasing([y for _, y in anchors]):
            x, y = anchors[k]
            found.append((x, y))
            todo.append((last[0], x, last[1], y))
            last = (x + 1, y + 1)
        todo.append((last[0], b, last[1], d))
    return sorted(found)


def must_align(notice: list[bytes]) -> frozenset[int]:
    """Places of a notice without which a text is another license or none."""
    short = len(notice) <= _SHORT
    return frozenset(k for k, w in enumerate(notice) if _VERSION.match(w) or w in _NAMES or (short and w not in _WEAK))


def compact(pairs: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """The most consecutive pairs that lie within so many words of the text, the first such."""
    best, low = (0, 0), 0
    for high in range(len(pairs)):
        while pairs[high][0] - pairs[low][0] >= width:
            low += 1
        if high + 1 - low > best[1] - best[0]:
            best = (low, high + 1)
    return pairs[best[0] : best[1]]


class Scanner:
    """Finds the notices in a text."""

    def __init__(self, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST):
        self.least = least
        self.notices = {name: words_of(t.encode()) for name, t in templates.items()}
        self.counts = {name: Counter(w) for name, w in self.notices.items()}
        self.needed = {name: must_align(notice) for name, notice in self.notices.items()}
        self.least_words = {name: max(1, math.ceil(least * len(notice) - 1e-9)) for name, notice in self.notices.items()}
        # words of a notice that matter for where it is; one of common words alone is looked for by them
        self.telling = {
            name: frozenset(w for w in c if w.decode() not in _COMMON) or frozenset(c) for name, c in self.counts.items()
        }
        self.by_word: dict[bytes, list[str]] = {}
        for name, notice in self.notices.items():
            for w in self._signs(name, notice):
                self.by_word.setdefault(w, []).append(name)
        self.pattern = re.compile(b"|".join(sorted(map(re.escape, self.by_word), key=len, reverse=True)) or b"(?!)")

    def _signs(self, name: str, notice: list[bytes]) -> set[bytes]:
        """Words of which a text with the notice has at least one: a word that must align, or more than may be missing."""
        if needed := self.needed[name]:
            return {max((notice[k] for k in needed), key=lambda w: (len(w), w))}
        longest = sorted(notice, key=lambda w: (-len(w), w))
        return set(longest[: len(notice) - self.least_words[name] + 1])

    def _regions(self, text: list[bytes], name: str, hits: list[int]) -> Iterator[tuple[int, int]]:
        """Stretches of the text around words of a notice, that begin anew where a word comes once too often."""
        size, most = len(self.notices[name]), self.counts[name]
        seen: Counter = Counter()
        first = last = -1
        for at in hits:
            if first >= 0 and (at - last > size or seen[text[at]] >= most[text[at]]):
                yield first, last
                first, seen = -1, Counter()
            first = at if first < 0 else first
            last = at
            seen[text[at]] += 1
        if first >= 0:
            yield first, last

    def _may_align(self, name: str, words: list[bytes]) -> bool:
        """Whether a stretch of text has enough of a notice's words, in any order, and those that must align."""
        there, most = Counter(words), self.counts[name]
        if any(not there[self.notices[name][k]] for k in self.needed[name]):
            return False
        return sum(min(n, there[w]) for w, n in most.items()) >= self.least_words[name]

    def _find(self, text: list[bytes], name: str, places: list[int]) -> Iterator[tuple[str, float, int, int]]:
        notice = self.notices[name]
        regions = list(self._regions(text, name, places))
        for k, (first, last) in enumerate(regions):
            # as far as the notice's length to both sides, with and without what belongs to other regions
            low, high = max(0, first - len(notice)), min(len(text), last + len(notice) + 1)
            if not self._may_align(name, text[low:high]):
                continue
            after = max(low, regions[k - 1][1] + 1) if k else low
            until = min(high, regions[k + 1][0]) if k + 1 < len(regions) else high
            tried = []
            for lo, hi in {(low, high), (after, high), (low, until), (after, until)}:
                # the notice stands together: words far before or after the rest are chance
                pairs = compact(align(text[lo:hi], notice), len(notice) + len(notice) // 4)
                if len(pairs) >= self.least_words[name] and self.needed[name] <= {y for _, y in pairs}:
                    start, width = lo + pairs[0][0], pairs[-1][0] - pairs[0][0]
                    tried.append((-len(pairs), width, abs(start - first), start))
            if tried:
                n, width, _, start = min(tried)  # of equal finds the one beside the region's first word
                yield name, -n / len(notice), start, start + width

    def scan(self, data: bytes) -> list[tuple[str, float, int, int]]:
        """(notice, coverage, first word, last word) of every notice found, best first; of overlapping finds the best alone."""
        if not self.pattern.search(data.lower()):
            return []
        text = words_of(data)
        where: dict[bytes, list[int]] = {}
        for at, w in enumerate(text):
            where.setdefault(w, []).append(at)
        found = set()
        for name in sorted({n for w in self.by_word.keys() & where.keys() for n in self.by_word[w]}):
            places = sorted(p for w in self.telling[name] for p in where.get(w, ()))
            found.update(self._find(text, name, places))
        out: list[tuple[str, float, int, int]] = []
        taken: list[tuple[int, int]] = []  # in order, without overlaps
        for f in sorted(found, key=lambda f: (-round(f[1] * len(self.notices[f[0]])), -f[1], f[0], f[2])):
            at = bisect.bisect_left(taken, (f[2], f[2]))
            if (at == 0 or taken[at - 1][1] < f[2]) and (at == len(taken) or taken[at][0] > f[3]):
                taken.insert(at, (f[2], f[3]))
                out.append(f)
        return out


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word, n_notices, notices): the notices in every text.

    ``license`` is the notice with the most aligned words, with its coverage and the places of its first
    and last word; ``notices`` lists all found, without repeats, in order. A text without any, and a null or empty one, has nulls, coverage 0 and no
    notices. Whole texts are scanned. Names of licenses and numbers of versions must align, and the whole of short notices but for words
    like "licensed"; the find must lie within a stretch a quarter longer than its notice. Of an expression of identifiers the
    first counts. Ties go to the notice found whole, then by the notice's name, then place. A null doc_id stays; repeated rows
    give a row each; further columns are ignored; no rows give no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            found = [scanner.scan(t.as_py() or b"") for t in batch.column(1)]
            best = [f[0] if f else (None, 0.0, None, None) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([b[k] for b in best], t) for k, t in enumerate((pa.string(), pa.float64(), pa.int64(), pa.int64()))),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([sorted({x[0] for x in f}) for f in found], pa.list_(pa.string())),
                ],
                ["doc_id", "license", "coverage", "first_word", "last_word", "n_notices", "notices"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(
        work, "doc_id long, license string, coverage double, first_word long, last_word long, n_notices long, notices array<string>"
    )
