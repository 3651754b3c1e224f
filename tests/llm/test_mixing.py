import math
import re
from collections import Counter, defaultdict

import pytest

from checks.compare import connect, difference
from tallyworks.llm import mixing


def brute_targets(sizes, share=1.5, weights=(5, 2, 1), cap=2.0):
    """Share by weight, stop at caps, share the excess again, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out


def test_targets_and_copies(spark, documents):
    texts = ["a b c", "", None, "x", "one\x0btwo\x85y z", "w " * 500]
    rows = [(i, texts[i % 6], [None, "", "b", "Z", "é", "a", "a", "a"][i % 8]) for i in range(400)]
    rows += [(None, "lone words", "b"), (None, "other lone words", "b")] + rows[:5]
    got = mixing.mix_digest(documents(rows)).collect()
    size = {t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in {r[1] for r in rows}}
    total = defaultdict(int)
    for _, t, s in rows:
        total[s] += size[t]
    want = brute_targets(total)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == total[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        rate = r.target / r.source_size
        assert r.copies in (math.floor(rate), math.ceil(rate))
    mixed = mixing.mix(documents(rows))
    assert mixed.columns == documents(rows).columns
    taken = Counter((r.doc_id, r.text, r.source) for r in mixed.collect() if r.doc_id is not None)
    assert taken == Counter({k: n for k, n in sum((Counter({(i, t, s): c}) for (i, t, s), c in _copies(rows, got)), Counter()).items() if n})
    assert mixing.mix(documents([])).count() == mixing.mix_digest(documents([])).count() == 0


def _copies(rows, got):
    by_id = {r.doc_id: r.copies for r in got}
    return [((i, t, s), by_id[i]) for i, t, s in rows if i is not None]


def test_all_sources_empty(spark, documents):
    got = mixing.mix_digest(documents([(1, "", "a"), (2, None, None)])).collect()
    assert {(r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert difference(mixing.mix_digest(docs), connect(sf_dir), mixing.ORACLE) is None


def nearness(rows):
    """(taken / target, largest document / size) of each source with words."""
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    return [
        (sum(r.taken for r in own) / own[0].target, max(r["size"] for r in own) / own[0].source_size)
        for own in by.values()
        if own[0].source_size
    ]


def test_sources_meet_their_targets(spark, sf_dir):
    near = nearness(mixing.mix_digest(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect())
    assert all(abs(got - 1) < 0.05 for got, largest in near if largest < 0.05)
    assert all(abs(got - 1) <= 0.05 + largest / 2 for got, largest in near)


def test_a_long_document_does_not_decide(spark, documents):
    rows = [(i, "w " * (1 + i % 9), "s%d" % (i % 3)) for i in range(1500)] + [(9000 + k, "w " * 400, "s%d" % k) for k in range(3)]
    assert all(abs(got - 1) < 0.02 for got, _ in nearness(mixing.mix_digest(documents(rows)).collect()))
