import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tallyworks.llm import passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words):
    """Texts without windows of words that stand in another (doc_id, text) too."""
    where = defaultdict(set)
    found = [[m.group() for m in WORD.finditer(t or "")] for _, t in rows]
    for row, ws in zip(rows, found):
        for k in range(len(ws) - words + 1):
            where[tuple(ws[k : k + words])].add(row)
    out = []
    for (i, t), ws in zip(rows, found):
        places = [m.span() for m in WORD.finditer(t or "")]
        lost = {k + j for k in range(len(ws) - words + 1) if len(where[tuple(ws[k : k + words])]) > 1 for j in range(words)}
        gone = [False] * len(t or "")
        for k in lost:
            a, b = places[k][0], places[k + 1][0] if k + 1 in lost else places[k][1]
            gone[a:b] = [True] * (b - a)
        out.append((i, None if t is None else "".join(c for c, g in zip(t, gone) if not g)))
    return out


def random_rows(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice(["a", "bé", "cd", "中e", "x."]) + rng.choice([" ", " ", "\n", " \t", "\x0b"]) for _ in range(n))
    pool = [text(rng.randrange(10, 150)) for _ in range(9)]
    out = []
    for i in range(70):
        t = ""
        for _ in range(rng.randrange(5)):
            p = rng.choice(pool).split(" ")
            a = rng.randrange(len(p))
            t += rng.choice([text(20), " ".join(p[a : a + rng.randrange(1, 120)]), " ".join(p)]) + rng.choice(["", " "])
        out.append((i if i % 7 else None, t))
    return out


@pytest.mark.parametrize("words,seed", [(51, 1), (20, 3), (5, 4), (1, 5)])
def test_against_all_windows(spark, documents, words, seed):
    rows = random_rows(seed) + [(90, None), (91, ""), (92, "a " * 300), (93, "a " * 300), (94, "own b " * 200), (95, " \n"), (None, "bé")]
    rows += rows[:5]
    got = passages.remove_passages(documents(rows), words).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(brute(rows, words))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.root == "x" for r in got)
    assert passages.remove_passages(documents([]), words).count() == 0


def test_anchors_across_chunks(monkeypatch):
    seen = passages._Words(" ".join(t for _, t in random_rows(8)).encode())

    def starts():
        return {s: a for a, f, l in zip(*(x.tolist() for x in seen.anchors(51))) for s in range(f, l + 1)}

    whole = starts()
    monkeypatch.setattr(passages, "_CHUNK", 77)
    assert starts() == whole and sorted(whole) == list(range(seen.n - 50))


def test_short_passages_leave_the_pipeline(spark, documents):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    passage = " ".join(word() for _ in range(53))
    fifty = " ".join(word() for _ in range(50))
    own = [[word() for _ in range(150)] for _ in range(24)]
    rows = [(i, " ".join([*w[:70], passage if i < 4 else fifty, *w[70:]] if i < 8 else w), "s", "en") for i, w in enumerate(own)]
    assert len(passage) < 400
    docs = documents(rows)
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, "")
    want = {i: " ".join(own[i][:70]) + "  " + " ".join(own[i][70:]) if i < 4 else t for i, t, _, _ in rows}
    assert {r.doc_id: r.text for r in docs.collect()} == want
