import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyworks.llm import packing, tokenize


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenize.tokenizer_path())


ODD = ["", None, " a", "a ", "a  b", "a\n\nb", "it's  \t x", "don't. 'tis 12's a.b'c %%'s", "x y", "a \nb", "\nfoo",
       "foo\n", "日本 語。です!", "a<|endoftext|>b c", "\x00 a", "éa b. ½. ²! x_y", "ab\x1cc d", "a.́ b", '10.5%, (x) [y]. "q"', "...", "a\r\nb"]


def test_encoder_equals_the_library(library, monkeypatch):
    monkeypatch.setattr(tokenize, "CACHED_WORDS", 50)
    monkeypatch.setattr(tokenize, "WORDS_A_CALL", 7)
    rng = random.Random(2)
    alphabet = "aB é.,'\n1_ %x’ß中"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(600)]
    found = []
    for at in range(0, len(texts), 40):
        found += tokenize.encoder().encode(texts[at : at + 40])
    for text, ids in zip(texts, found):
        assert ids.tolist() == (library.encode(text, add_special_tokens=False).ids if text else []), repr(text)


def check(rows, docs, library):
    """Each id lies in one piece, windows are gapless, and nothing needs padding."""
    want = [(i, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in docs]
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == {i for i, _ in want}
    by_id = dict(want)
    for i, found in pieces.items():
        if sum(k == i for k, _ in want) > 1:
            continue
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            part = np.array(by_id[i][at : at + r.length], "<u4")
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(by_id[i]), zlib.crc32(part.tobytes())) and r.length > 0
            at += r.length
        assert at == len(by_id[i])
    steps = defaultdict(int)
    for found in windows.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0 and {r.tier for r in found} == {at}
        steps[found[0].step_id] += at
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in want)
    assert max(steps.values(), default=0) <= 1 << 16


def test_pieces(spark, documents, library, monkeypatch):
    monkeypatch.setattr(packing, "POOL", 9)
    rng = random.Random(3)
    texts = ODD + [" ".join("w%d" % rng.randrange(99) for _ in range(n)) for n in [*range(0, 900, 37), 64, 20_000]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (3, "same id")]
    check(packing.pack(documents(rows).coalesce(1)).collect(), rows, library)
    check(packing.pack(documents(rows).repartition(5)).collect(), rows, library)
    assert packing.pack(documents([])).count() == 0


def test_full_pool_keeps_what_fills_no_window(monkeypatch):
    monkeypatch.setattr(packing, "POOL", 9)
    packer = packing.Packer((64, 128), 1 << 10, 0)
    rng = random.Random(5)
    sizes = [3] * 9 + [rng.randrange(1, 200) for _ in range(300)]
    for i, n in enumerate(sizes):
        packer.add(i, np.arange(n, dtype=np.int32))
    packer.flush()
    held = defaultdict(int)
    for row in packer.rows:
        held[row[0]] += row[2]
    assert held == dict(enumerate(sizes))


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(packing.pack(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()], library)


def test_full_cache_keeps_words_in_use(monkeypatch):
    monkeypatch.setattr(tokenize, "CACHED_WORDS", 40)
    encoder, learned = tokenize.WordEncoder(tokenize.tokenizer_path()), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new, first: (learned.extend(new), learn(new, first)))
    for batch in range(30):
        encoder.encode(["the same " + " ".join(f"w{batch}x{k}" for k in range(9))] * 3)
    assert learned.count("same") == 1 and len(encoder.words) + len(encoder.old) <= 80
