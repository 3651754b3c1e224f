import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyworks.llm import tokenfile, tokenize, warc
from tallyworks.llm.files import finished_files
from tests.llm.test_packing import ODD


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 256, 257, 50_257, 65_537, 1 << 20])
def test_random_access(tmp_path, monkeypatch, vocabulary):
    monkeypatch.setattr(tokenfile, "BLOCK", 10)
    rng = np.random.default_rng(vocabulary)
    docs = [rng.integers(0, vocabulary, n).astype(np.uint32) for n in [0, 1, 9, 10, 11, 0, 57]]
    with open(tmp_path / "x", "wb") as out:
        writer = tokenfile.TokenWriter(out, vocabulary)
        for i, ids in enumerate(docs):
            writer.add(None if i == 2 else i - 1, ids)
        writer.close()
    file = tokenfile.TokenFile(str(tmp_path / "x"))
    every = np.concatenate(docs)
    for a in range(0, len(every) + 1, 7):
        for b in range(a, len(every) + 1, 5):
            assert (file.ids(a, b) == every[a:b]).all()
    assert np.diff(file.starts).tolist() == [len(d) for d in docs] and file.nameless.tolist() == [False, False, True] + [False] * 4
    assert tokenfile.id_width(50_257) == 16 and tokenfile.id_width(3) == 2


def token_rows(rows):
    library = Tokenizer.from_file(tokenize.tokenizer_path())
    at, out = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return Counter(out)


def test_tokens(spark, documents):
    rng = random.Random(1)
    rows = [(rng.randrange(-50, 50), t) for t in ODD] + [(None, "no id"), (None, None), (200, "w " * 30_000), (200, "w " * 30_000)]
    assert Counter(map(tuple, tokenfile.token_digest(documents(rows)).collect())) == token_rows(rows)
    assert tokenfile.token_digest(documents([])).count() == 0


def test_tokens_of_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = Counter(map(tuple, tokenfile.token_digest(docs).collect()))
    assert got == token_rows([(r.doc_id, r.text) for r in docs.collect()])


def brute_archive(rows, least=0):
    data = [(i, (h or "").encode()) for i, h in rows]
    out = []
    for i, d in data:
        first = min((k for k, x in data if x == d and k is not None), default=None)
        revisit = len(d) >= least and first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(d).digest()).decode()
        out.append((i, len(d), digest, "revisit" if revisit else "response", first if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, least):
    html = ["", None, "<p>é</p>", "a\r\n\r\nb", "same", "longer same", "x" * 300_000, "tiny"]
    rows = [(i - 3, html[i % 8]) for i in range(40)] + [(None, "same"), (None, "only here"), (7, "longer same"), (-3, "")]
    pages = spark.createDataFrame([(i, "http://a/\r\nX: 1" if i else None, h, "extra", "d") for i, h in rows],
                                  "page_id long, url string, html string, first string, digest string")
    got = warc.archive_digest(pages, least)
    assert Counter(map(tuple, got.collect())) == brute_archive(rows, least)
    assert warc.archive_digest(pages.limit(0)).count() == 0


def test_predicates_reach_the_reader(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "page %d" % (i % 4)) for i in range(20)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/a"
    warc.write_archives(pages, folder)
    for path, _ in finished_files(folder):  # any gzip reader reads them
        assert gzip.open(path.removeprefix("file://")).read().startswith(b"WARC/1.1\r\n")
    records = warc.read_archives(spark, folder)
    revisits = records.where("record_type = 'revisit' and payload_bytes > 0")
    assert revisits.count() == 16 and records.where("record_type in ('response')").count() == 4
    reader = warc.WarcReader({"path": folder})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "response"), warc.EqualTo(("payload_bytes",), 6)]))
    assert len(left) == 1 and sum(len(list(reader.read(p))) for p in reader.partitions()) == 4
    assert {r.payload for r in warc.read_archives(spark, folder, payloads=False).collect()} == {None}


def test_archive_of_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert Counter(map(tuple, warc.archive_digest(pages).collect())) == brute_archive([(r.page_id, r.html) for r in pages.collect()])


def standard_records(newline="\r\n"):
    """An archive by hand: warcinfo, request, response, chunked response, revisit without HTTP headers, resource."""
    long_url = "http://h/" + "x" * 3000
    http = "HTTP/1.1 200 OK\r\nServer: a\r\nContent-Type: text/html\r\n\r\n".encode()
    chunked = "HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n".encode()
    sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()
    page, web = b"<p>one</p>\r\n\r\ntwo\n\n", "application/http;msgtype="
    records = [
        ("warcinfo", "application/warc-fields", b"software: x\r\n\r\n", None, {}),
        ("request", web + "request", b"GET / HTTP/1.1\r\nHost: h\r\n\r\n", None, {"WARC-Target-URI": "<http://h/1>"}),
        ("response", web + "response", http + page, sha1(page), {"WARC-Target-URI": long_url}),
        ("response", web + "response", chunked + b"3\r\nabc\r\n0\r\n\r\n", sha1(b"abc"), {"WARC-Target-URI": "http://h/3"}),
        ("revisit", web + "response", b"", sha1(page), {"WARC-Refers-To": "<urn:2>"}),
        ("resource", "text/plain", "é".encode() * 100_000, "sha256:00", {"X-Folded": "a\r\n b", "WARC-Target-URI": "http://h/5"}),
        ("response", web + "response", b"HTTP/1.1 204 No Content\r\nA: b\r\n\r\n", None, {}),
    ]
    out = []
    for k, (kind, media, block, digest, more) in enumerate(records):
        lines = [f"content-type: {media}", f"WARC-Record-ID: <urn:{k}>", f"Content-Length: {len(block)}", f"WARC-Type:{kind}"]
        lines += [f"{n}: {v}" for n, v in more.items()] + ([f"WARC-Payload-Digest: {digest}"] if digest else [])
        out.append(newline.join(["WARC/1.0", *lines, "", ""]).encode() + block + b"\r\n\r\n")
    want = [
        ("warcinfo", "<urn:0>", None, 15, b"software: x\r\n\r\n"), ("request", "<urn:1>", "http://h/1", 0, b""),
        ("response", "<urn:2>", long_url, len(page), page), ("response", "<urn:3>", "http://h/3", 13, b"3\r\nabc\r\n0\r\n\r\n"),
        ("revisit", "<urn:4>", None, None, None), ("resource", "<urn:5>", "http://h/5", 200_000, "é".encode() * 100_000),
        ("response", "<urn:6>", None, 0, b""),
    ]
    return out, want


@pytest.mark.parametrize("newline", ["\r\n", "\n"])
@pytest.mark.parametrize("form", ["plain", "members", "one member"])
def test_ordinary_archives(spark, tmp_path, form, newline):
    records, want = standard_records(newline)
    data = {"plain": b"".join(records), "members": b"".join(map(gzip.compress, records)), "one member": gzip.compress(b"".join(records))}[form]
    (tmp_path / "x.warc").write_bytes(data)
    (tmp_path / "empty.warc").write_bytes(b"")
    for path in (f"file://{tmp_path}", f"file://{tmp_path}/x.warc"):
        got = warc.read_archives(spark, path)
        assert [(r.record_type, r.record_id, r.target_uri, r.payload_bytes, r.payload and bytes(r.payload)) for r in got.collect()] == want
    assert [r.record_id for r in got.where("record_type = 'resource'").collect()] == ["<urn:5>"]
    bare = warc.read_archives(spark, f"file://{tmp_path}", payloads=False).collect()
    assert [(r.record_id, r.payload_bytes, r.payload) for r in bare] == [(w[1], w[3], None) for w in want]
    (tmp_path / "x.warc").write_bytes(data[: len(data) * 2 // 3])
    with pytest.raises(Exception, match="cut short"):
        warc.read_archives(spark, f"file://{tmp_path}").collect()


def test_very_long_headers(spark):
    rows = [(1, "data:" + "u" * 1_200_000, "a"), (2, "http://h/", "a"), (3, None, "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert Counter(map(tuple, warc.archive_digest(pages).collect())) == brute_archive([(i, h) for i, _, h in rows])
