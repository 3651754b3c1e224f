import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyworks.llm import suffixes


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if starts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def random_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    pool = [text(rng.randrange(40, 200)) for _ in range(8)]
    out = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            parts.append(rng.choice([text(20), p[a : a + rng.randrange(20, 900)], p]))
        t = " ".join(parts)
        if t and rng.random() < 0.5:
            i = rng.randrange(len(t))
            t = t[:i] + "Q" + t[i + 1 :]
        out.append(t)
    return out


@pytest.mark.parametrize("length,seed", [(400, 1), (400, 2), (50, 3), (6, 4)])
def test_against_all_windows(spark, documents, length, seed):
    texts = random_texts(seed) + [None, "", "x" * 1500, "xy" * 700, "é" * 300, "short", "z" * length, "w" * (length + 1)]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    rows += rows[:3]
    got = suffixes.repeat_digests(documents(rows), length, batches=3).collect()
    want = brute([t for _, t in rows], length)
    assert Counter(map(tuple, got)) == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert suffixes.repeat_digests(documents([]), length).count() == 0


def test_anchors_across_chunks(monkeypatch):
    text = random_texts(5)
    data = " ".join(text).encode()
    whole = list(zip(*(x.tolist() for x in suffixes.anchors(data, 100))))
    starts = {s: a for a, f, l in whole for s in range(f, l + 1)}
    monkeypatch.setattr(suffixes, "_CHUNK", 777)
    parts = list(zip(*(x.tolist() for x in suffixes.anchors(data, 100))))
    assert starts == {s: a for a, f, l in parts for s in range(f, l + 1)}
    assert sorted(starts) == list(range(len(data) - 99))


def test_texts_stay_valid(spark, documents):
    passage = "é" * 250 + "".join(chr(0x4E00 + i) for i in range(300))
    rows = [(1, "a" + passage + "b"), (2, "é" + passage), (3, None), (4, "own text"), (None, passage), (4, "own text")]
    got = suffixes.remove_repeats(documents(rows), 400).collect()
    kept = Counter((r.doc_id, r.text, r.n_chars) for r in got)
    assert kept[(4, "own text", 8)] == 2 and kept[(3, None, None)] == 1 and kept[(1, "ab", 2)] == 1
    assert len(got) == 6 and set(got[0].asDict()) == set(documents([]).columns) and {r.root for r in got} == {"x"}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    want = {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows], 400))}
    assert {r[0]: tuple(r[1:]) for r in suffixes.repeat_digests(docs).collect()} == want


def test_last_step_moves_texts_and_merged_spans_only(spark, documents, capsys):
    rng = random.Random(7)
    passage, other = ("".join(rng.choice("abcdefg ") for _ in range(900)) for _ in range(2))
    rows = [(1, "a" + passage + "b" + other), (2, passage), (3, "own text"), (4, passage[:450] + "-" + other[300:]), (5, None)]
    cut = suffixes._with_spans(documents(rows), 400, 2)
    capsys.readouterr()
    cut.explain()
    assert capsys.readouterr().out.count("Exchange ") == 2
    got = {r.doc_id: r.spans and [tuple(s) for s in r.spans] for r in cut.collect()}
    assert got == {1: [(1, 901), (1202, 1802)], 2: [(0, 900)], 3: None, 4: [(0, 450), (451, 1051)], 5: None}


def test_staged_tables_leave_no_shuffle_files(spark):
    import time

    from tallyworks.llm.shared import staged

    def kept():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(blocks.apply(i).length() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_"))

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before, before = spark.conf.get(name), kept()
    rows = staged(spark.range(200_000).groupBy((F.col("id") % 100_000).alias("k")).count(), "shuffles")
    end = time.time() + 20
    while kept() > before and time.time() < end:
        time.sleep(0.2)
    assert kept() <= before and spark.conf.get(name) == set_before
    assert rows.count() == 100_000
