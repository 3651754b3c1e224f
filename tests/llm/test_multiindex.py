from collections import Counter

import numpy as np
import pytest

from tallyworks.llm import multiindex
from tests.llm.conftest import brute_components


def brute(rows, least=0.98):
    def sound(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def linked(i, j):
        (_, v, a), (_, w, b) = rows[i], rows[j]
        if not (sound(v, a) and sound(w, b)) or a != b or len(v) != len(w):
            return False
        v, w = (np.array(x, np.float32).astype(float) for x in (v, w))
        return v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least

    label = brute_components(len(rows), linked)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        n = sum(linked(min(i, j), max(i, j)) for j in range(len(rows)) if j != i)
        members = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        low = min(members, default=None)
        out.append((vec, n, low, vec == low))
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], c, "x", 1) for i, v, c in rows],
                                 "vec_id long, embedding array<float>, label int, node string, n int")


@pytest.mark.parametrize("seed,block,cells", [(1, 2048, 1024), (2, 7, 5), (3, 20, 40)])
def test_against_all_pairs(spark, monkeypatch, seed, block, cells):
    monkeypatch.setattr(multiindex, "BLOCK", block)
    monkeypatch.setattr(multiindex, "CELL_VECTORS", cells)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 7))
    rows = [(i, centres[rng.integers(9)] + rng.normal(size=7) * rng.choice([0, 0.02, 0.15]), int(rng.integers(2))) for i in range(220)]
    odd = [None, [], [0.0] * 7, [np.nan] * 7, [np.inf] + [1] * 6, [None] + [1] * 6, [1.0], [2.0], [0.0, 1, -0.0], [-0.0, 3, 0.0]]
    rows += [(300 + i, v, 0) for i, v in enumerate(odd)] + [(400, centres[0], None), (None, centres[0], 0), (None, centres[1] * 3, 1), (None, [5.0, -5.0], 1)]
    rows += [(500 + i, centres[0], 0) for i in range(30)] + [(0, centres[2], 1)]
    assert Counter(map(tuple, multiindex.linked_vectors(frame(spark, rows)).collect())) == brute(rows)


def test_nothing_to_link(spark):
    assert multiindex.linked_vectors(frame(spark, [])).count() == 0
    assert [tuple(r) for r in multiindex.linked_vectors(frame(spark, [(3, None, 1), (4, [1], None)])).collect()] == [(3, 0, 3, True), (4, 0, 4, True)]


def test_lower_target_recall(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(150, 8))
    sample = multiindex._unit(np.concatenate([base, base + rng.normal(size=base.shape) * 0.03]))
    index = multiindex.MultiIndex(sample, 6)
    full, some = index.reach(sample, 0.98, 1.0), index.reach(sample, 0.98, 0.9)
    assert some <= full
    own, rows, cells = index.traverse(sample, some)
    visited = set(zip(rows.tolist(), cells.tolist()))
    links = [(a, b) for a in range(300) for b in range(a + 1, 300) if sample[a] @ sample[b] >= 0.98]
    assert np.mean([(a, own[b]) in visited or (b, own[a]) in visited for a, b in links]) >= 0.9


def test_whole_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = Counter(map(tuple, multiindex.linked_vectors(table).collect()))
    assert got == brute([(r.vec_id, r.embedding, r.label) for r in table.collect()])
