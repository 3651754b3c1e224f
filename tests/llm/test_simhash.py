import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallyworks.llm import simhash
from tests.llm.conftest import brute_components


def slow_fingerprint(text, k=4):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def test_fingerprint_of_odd_texts():
    rng = random.Random(1)
    long = " ".join(rng.choice(["Ab", "é", "cd e", "X\x85"]) for _ in range(70_000))
    for text in [None, "", " \t\n", "One", "a b c", "a b c d", "Ä A B\x0bC  d\x1ce f", "the cat " * 50, long]:
        assert simhash.fingerprint(None if text is None else text.encode()) == slow_fingerprint(text)


@pytest.mark.parametrize("distance", [0, 1, 2, 4, 6])
def test_every_near_pair_is_linked(spark, distance, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL_BUCKET", 6)
    monkeypatch.setattr(simhash, "LARGE_BUCKET", 40)
    rng = random.Random(distance)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = {0, 2**64 - 1, 2**63}
    for _ in range(500):
        x = rng.choice(centres)
        for _ in range(rng.randrange(12)):
            x ^= 1 << rng.choice([rng.randrange(64), rng.randrange(8)])
        prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fingerprint long")
    got = simhash.components(simhash.links(df, distance), "t").collect()
    root = {r.node % 2**64: r.root for r in got}
    want = brute_components(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= distance)
    groups = Counter()
    for p, w in zip(prints, want):
        groups[(root.get(p, p - 2**64 if p >> 63 else p), w)] += 1
    assert len({a for a, _ in groups}) == len(groups) == len({b for _, b in groups})


def test_thresholds_follow_the_pigeonhole():
    rng = np.random.default_rng(3)
    bits = rng.random((5000, 64)) < rng.random(64)
    both = bits.astype(float).T @ bits
    for distance in range(8):
        parts = simhash.allocate(10**9, both, distance)
        assert sum(e + 1 for _, e in parts) == distance + 1
        assert len({b for p, _ in parts for b in p}) == sum(len(p) for p, _ in parts)


def test_groups(spark, documents):
    base = " ".join(f"word{i % 37}x{i}" for i in range(400))
    rows = [(9, base), (4, base), (4, base), (None, base), (7, base.replace("word5x5 ", "other ")), (1, ""), (3, None), (2, "\n"), (8, "Hi"), (None, "lone text")]
    got = simhash.simhash_groups(documents(rows)).collect()
    prints = [slow_fingerprint(t) for _, t in rows]
    label = brute_components(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    want = []
    for (i, _), p, l in zip(rows, prints, label):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == l and rows[k][0] is not None]
        want.append((i, f"{p:016x}", min(ids, default=None)))
    assert Counter(map(tuple, got)) == Counter(want)
    assert simhash.simhash_groups(documents([])).count() == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_groups(docs).collect()}
    rows = sorted((r.doc_id, slow_fingerprint(r.text)) for r in docs.collect())
    label = brute_components(len(rows), lambda a, b: (rows[a][1] ^ rows[b][1]).bit_count() <= 4)
    assert got == {i: (f"{p:016x}", rows[l][0]) for (i, p), l in zip(rows, label)}
