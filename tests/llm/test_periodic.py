import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyworks.llm import periodic


def brute_runs(words, least=6, times=4):
    """Every period by itself: maximal stretches in which words that far apart are equal, of smallest period."""
    out = {}
    n = len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                out.setdefault((i, j + q - i), q)
            i = j
    return sorted(((s, length, q) for (s, length), q in out.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=12), st.integers(1, 9), st.lists(st.integers(0, 3), max_size=20), st.integers(0, 30))
def test_runs_are_those_of_brute_force(root, times, tail, cut):
    words = (root * times + tail + root * 5)[cut:]
    got = [tuple(r) for r in periodic.find_runs(np.array(words, np.int64)).tolist()]
    assert got == brute_runs(words)


def test_random_binary_words_and_one_long_run():
    rng = np.random.default_rng(3)
    for n in (50, 200, 400):
        words = rng.integers(0, 2, n)
        assert [tuple(r) for r in periodic.find_runs(words).tolist()] == brute_runs(words.tolist())
    assert periodic.find_runs(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (
        doc_id,
        len(runs),
        *top,
        None if top[0] is None else 1000 * top[1] // top[2],
        hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def by_doc(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_documents_against_brute_force(spark, documents):
    looping = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(i % 90))) for i in range(60)]
    rows += [(i, " ".join(f"u{k}" for k in range(5 + i % 40))) for i in looping]
    rows += [(7, "again"), (7, "again"), (None, None), (None, "a " * 9), (500, None), (501, ""), (502, " \t\x0b\x0c\r\n ")]
    rows += [(503, "ha " * 3_000), (504, "  x y z x y z x y z\nx y z end"), (505, "é é é é é é \x1f \x1f \x1f \x1f \x1f \x1f")]
    got = by_doc(periodic.run_digest(documents(rows)).collect())
    assert got == by_doc(expected(*r) for r in rows)


def test_texts_in_small_groups_and_clashing_columns(spark, documents, monkeypatch):
    monkeypatch.setattr(periodic, "GROUP_BYTES", 10)
    rows = [(1, "a b a b a b a b c"), (2, "c c c c c c"), (3, None)]
    docs = documents(rows).selectExpr("*", "'x' AS runs", "1 AS n_words", "2 AS collapsed", "3 AS start", "4 AS _longest")
    assert by_doc(periodic.run_digest(docs).collect()) == by_doc(expected(*r) for r in rows)
    out = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert out[1].collapsed == "a b c" and [tuple(r) for r in out[1].runs] == [(0, 8, 2)] and out[1].n_words == 9
    assert out[3].collapsed == "" and out[3].runs == []


def test_empty_table(spark, documents):
    none = documents([(1, "x")]).limit(0)
    assert periodic.run_digest(none).collect() == []
    assert periodic.run_digest(none).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_words_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 3000")
    got = by_doc(periodic.run_digest(docs).collect())
    assert got == by_doc(expected(r.doc_id, r.text) for r in docs.collect())
