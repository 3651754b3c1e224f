import hashlib
import zlib

import pytest

from tallyworks.llm import manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climbed(nodes, arity=2):
    """The root, and each node's siblings from level to level, by plain recursion over whole levels."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = i // arity * arity
            proofs[k].append((level[run:i], level[i + 1 : run + arity]))
            at[k] = i // arity
        level = [H(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return level[0], proofs


def expected(rows):
    trees = {}
    for doc_id, text, source, lang, n_chars in rows:
        leaf = H(*map(field, (doc_id, source, lang, n_chars, text)))
        bad = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None:
            bad = H(*map(field, (doc_id, source, lang, n_chars + 1, text)))
        trees.setdefault((lang is not None, (lang or "").encode()), []).append((doc_id is not None, doc_id or 0, leaf, bad, doc_id))
    names = sorted(trees)
    made = []
    for name in names:
        trees[name].sort(key=lambda r: r[:3])
        made.append(climbed([r[2] for r in trees[name]]))
    if not made:
        return []
    root, above = climbed([m[0] for m in made])
    out = []
    for name, (subroot, proofs), top in zip(names, made, above):
        for (_, _, leaf, bad, doc_id), proof in zip(trees[name], proofs):
            own = bad
            for before, after in proof + top:
                own = H(*before, own, *after)
            digests = [d for before, after in proof + top for d in before + after]
            out.append((doc_id, leaf, subroot, root, H(*digests), own, own == root))
    return out


def by_doc(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def table(spark, rows):
    wide = [(*r, "x", "y", 1, 2, "z", "t") for r in rows]
    return spark.createDataFrame(
        wide,
        "doc_id long, text string, source string, lang string, n_chars long, tree string, leaf string, idx long, n long, digest string, _tampered string",
    )


ODD = [
    (None, "no id", "s", "en", 5),
    (None, "no id", "s", "en", 5),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, "é" * 5, "s:1", "dé", 5),
    (5, "tie", "s", "dé", 3),
    (14, "z" * 300_000, "s", "zz", None),
]


@pytest.mark.parametrize("block_levels", [1, 2, 12])
def test_manifest_against_recursion(spark, monkeypatch, block_levels):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", block_levels)
    rows = ODD + [(i, f"text {i % 9}", f"s{i % 3}", ["en", "de", None, "en", "en"][i % 5], i) for i in range(10, 60)]
    rows += [(77, "copy", "s", "en", 4)] * 9 + [(78, "alone", "s", "only", 4)]
    assert by_doc(manifest.proof_digest(table(spark, rows)).collect()) == by_doc(expected(rows))


def test_many_languages_and_single_leaves(spark, monkeypatch):
    monkeypatch.setattr(manifest, "BLOCK_LEVELS", 2)
    rows = [(i, "t", "s", f"l{i}", 1) for i in range(21)]
    assert by_doc(manifest.proof_digest(table(spark, rows)).collect()) == by_doc(expected(rows))
    one = [(1, "t", "s", "en", 1)]
    assert by_doc(manifest.proof_digest(table(spark, one)).collect()) == by_doc(expected(one))


def test_empty_table(spark):
    got = manifest.proof_digest(table(spark, ODD).limit(0))
    assert got.collect() == []
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 27, 28])
@pytest.mark.parametrize("arity", [2, 3])
def test_sweeps_of_one_block(n, arity):
    leaves = [H(str(i)) for i in range(n)]
    root, proofs = climbed(leaves, arity)
    height = manifest.levels(n, arity)
    got, sent = manifest.sweep(leaves, height, arity)
    assert got == root
    steps = manifest.sweep_back(n, height, sent, ["rest."], arity)
    assert [p[:-1] for p in steps] == [["".join(a) + "." + "".join(b) for a, b in p] for p in proofs]


def test_proofs_verify_only_what_they_were_made_for(spark):
    rows = [(i, f"t{i}", "s", "en", i) for i in range(11)]
    found = manifest.manifest(table(spark, rows))
    ok = found.select((manifest.fold(found.leaf, found.proof) == found.root).alias("ok"), "leaf", "proof", "root").collect()
    assert all(r.ok for r in ok)
    swapped = spark.createDataFrame([(ok[0].leaf, ok[1].proof, ok[0].root)], "leaf string, proof array<string>, root string")
    assert not swapped.select((manifest.fold(swapped.leaf, swapped.proof) == swapped.root).alias("ok")).first().ok


def test_rows_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in docs.collect()]
    got = manifest.proof_digest(docs).collect()
    assert by_doc(got) == by_doc(expected(rows))
    assert {r.verified for r in got} == {True, False}
