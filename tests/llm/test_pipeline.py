import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyworks.llm import language, mixing, tokenize
from tests.llm.conftest import brute_components
from tests.llm.test_packing import check
from tests.llm.test_simhash import slow_fingerprint


def brute_cut(texts, length=400):
    data = [t.encode() for t in texts]
    starts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if starts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept, at = [], 0
        for c in d.decode():
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        out.append("".join(kept))
    return out


def test_stages_and_run(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / name))
        docs = results[name] = spark.read.parquet(str(tmp_path / name))
        if name != "pack":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = {k: v.collect() for k, v in results.items()}
    source = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    # language: only texts without letters or in no language go
    clean = {r.doc_id for r in source if re.search("[a-z]{3}", r.text)}
    assert len(clean & {r.doc_id for r in rows["language"]}) >= 0.99 * len(clean)
    # near duplicates: the smallest id of each group stays
    own = sorted(rows["language"], key=lambda r: r.doc_id)
    prints = [slow_fingerprint(r.text) for r in own]
    label = brute_components(len(own), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert sorted(r.doc_id for r in rows["near_duplicates"]) == [own[k].doc_id for k in sorted(set(label))]
    # repeats
    own = sorted(rows["near_duplicates"], key=lambda r: r.doc_id)
    want = brute_cut([r.text for r in own])
    assert sorted((r.doc_id, r.text, r.n_chars) for r in rows["repeats"]) == [(r.doc_id, t, len(t)) for r, t in zip(own, want)]
    # mix
    digest = {r.doc_id: r.copies for r in mixing.mix_digest(results["repeats"]).collect()}
    assert Counter(r.doc_id for r in rows["mix"]) == Counter({i: n for i, n in digest.items() if n})
    # pack
    library = Tokenizer.from_file(tokenize.tokenizer_path())
    check(rows["pack"], [(r.doc_id, r.text) for r in rows["mix"]], library)
    assert corpus_pipeline.run(spark, sf_dir).agg({"length": "sum"}).first()[0] == sum(r.length for r in rows["pack"])


def test_odd_rows(spark, documents, tmp_path):
    some = [(i, "the cat and the dog ran over hills %d" % i, "s%d" % (i % 3), "en") for i in range(30)]
    odd = [(None, None, None, None), (None, "no id here at all", None, "en"), (5, "", "s1", "en"), *some[:3], (31, "é" * 2000, "s1", "en")]
    for k, rows in enumerate([some + odd, []]):
        docs = documents(rows)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{k}-{name}")
            stage(spark, docs, "").write.parquet(path)
            docs = spark.read.parquet(path)
            assert name == "pack" or docs.columns == columns
        assert (docs.count() > 0) == bool(rows)


def test_clashing_columns(spark, documents, tmp_path):
    words = "the cat and the dog ran over hills with some more words to tell them apart".split()
    rows = [(i, " ".join(words[(i * k + k * k) % len(words)] for k in range(20 + i)), "s%d" % (i % 3), "en") for i in range(30)]
    extra = ["doc", "spans", "_spans", "_row", "row", "key", "bucket", "heir", "slot", "begin", "size", "target", "c0", "a.b", "id"]
    docs = documents(rows)
    docs = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in extra}).withColumn("_map", F.create_map("doc_id", "source"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.count() > 0
        if name != "pack":
            assert docs.columns == columns
            for r in docs.collect():
                assert all(r[c] == f"{c}-{r.doc_id}" for c in extra) and r["_map"] == {r.doc_id: r.source}
