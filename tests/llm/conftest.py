import itertools

import pytest

TEXT = "doc_id long, text string, lang string, source string, n_chars long, root string, node string, part int, n int"


def brute_components(n, linked):
    """Smallest index reachable, by repeated relabelling over all pairs."""
    label = list(range(n))
    pairs = [p for p in itertools.combinations(range(n), 2) if linked(*p)]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return label


@pytest.fixture(scope="session")
def documents(spark):
    """A maker of documents tables with extra, clashing columns, from (doc_id, text[, source[, lang]]) tuples."""

    def make(rows):
        full = [(r[0], r[1], r[3] if len(r) > 3 else None, r[2] if len(r) > 2 else None) for r in rows]
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t), "x", None, 7, 8) for i, t, lang, src in full], TEXT
        )

    return make
