import random
import re
import time

from tallyworks.llm import licenses


def test_alignment():
    words = lambda s: s.encode().split()
    assert licenses.align(words("x a b c y d"), words("a b c d")) == [(1, 0), (2, 1), (3, 2), (5, 3)]
    assert licenses.align(words("c b a"), words("a b c")) in ([(0, 2)], [(1, 1)], [(2, 0)])
    assert licenses.align([], words("a")) == [] == licenses.align(words("a a"), words("b"))
    assert licenses.align(words("q a a k a a"), words("a a k a a")) == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice(b"abcdefgh") for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_notices(spark, documents):
    prose = " ".join(f"wörd{i} the of under" for i in range(300))
    rows, want = [], {}
    for k, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        rows.append((k, f"{prose}\n{notice.upper()}\n{prose}"))
        want[k] = name
    rows += [
        (1000, prose), (1001, ""), (1002, None), (None, licenses.TEMPLATES["MIT"]), (1003, (licenses.TEMPLATES["MIT"] + " ") * 3),
        (1004, "(All rights reserved) " + prose * 40 + " Licensed under CC BY-NC 4.0."), (1005, "rights all reserved of the"),
        (1006, licenses.TEMPLATES["MIT-full"].replace("hereby", "").replace("Software", "Program")), (1003, "same id"),
    ]
    got = licenses.scan_licenses(documents(rows)).collect()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(rows) and all(by_id[k][0].license == name and by_id[k][0].coverage == 1 for k, name in want.items())
    for k in (1000, 1001, 1002, 1005):
        assert (by_id[k][0].license, by_id[k][0].coverage, by_id[k][0].n_notices) == (None, 0.0, 0)
    assert by_id[None][0].license == "MIT" and by_id[1003][0].n_notices == 3 and by_id[1003][0].notices == ["MIT"]
    assert by_id[1004][0].notices == ["CC-BY-NC-4.0", "reserved"]
    assert by_id[1006][0].license == "MIT-full" and 0.8 < by_id[1006][0].coverage < 1
    assert licenses.scan_licenses(documents([])).count() == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: set(r.notices) for r in licenses.scan_licenses(docs).collect()}
    for r in docs.collect():
        text = " ".join(w.decode() for w in licenses.words_of(r.text.encode()))
        for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0", "reserved"):
            there = re.search(rf"(?<!\S){re.escape(' '.join(w.decode() for w in licenses.words_of(licenses.TEMPLATES[name].encode())))}(?!\S)", text)
            assert not there or name in got[r.doc_id]


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next_row(row, x, b)
    return row[-1]


def _next_row(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


def test_alignment_is_longest_where_words_are_unique():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (rng.sample(range(40), rng.randrange(30)) for _ in range(2))
        assert len(licenses.align(a, b)) == longest_common(a, b)


def test_licenses_that_look_alike():
    scanner = licenses.Scanner()
    names = lambda t: sorted({f[0] for f in scanner.scan(t.encode())})
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("x licensed under CC BY-SA 3.0. y") == ["CC-BY-SA-3.0"]
    assert names("all rights not reserved") == [] == names("Licensed under CC 4.0") == names("licensed under CC BY-SA 5.0")
    assert names("You should know that licensed under the old rules cc users by 4.0 metres") == []
    assert names("// SPDX-License-Identifier: MIT") == ["MIT-identifier"]
    assert names("SPDX-License-Identifier: (GPL-2.0-or-later OR MIT)") == ["GPL-2.0-or-later-identifier"]
    assert names("Licensed under the Apache-2.0 license") == ["Apache-2.0-named"]
    two, three = (licenses.TEMPLATES[f"BSD-{k}-Clause-text"] for k in (2, 3))
    assert (names(two), names(three)) == (["BSD-2-Clause-text"], ["BSD-3-Clause-text"])
    assert names(licenses.TEMPLATES["MIT-text"].replace("\"as is\"", "").upper()) == ["MIT-text"]
    for version, family in (("2", "GPL-2.0"), ("3", "GPL")):
        assert names(licenses.TEMPLATES[f"{family}-notice"]) == [f"{family}-notice"]
    assert names(licenses.TEMPLATES["LGPL-2.1-notice"]) == ["LGPL-2.1-notice"]


def test_very_long_texts_of_repeats():
    scanner = licenses.Scanner()
    start = time.process_time()
    found = scanner.scan(b"All rights reserved. " * 16_000)
    taken = time.process_time() - start
    assert [f[2] for f in found] == list(range(0, 48_000, 3)) and {f[0] for f in found} == {"reserved"}
    start = time.process_time()
    assert len(scanner.scan(b"All rights reserved. " * 64_000)) == 64_000
    assert time.process_time() - start < 8 * max(taken, 0.2)
    mixed = " ".join([licenses.TEMPLATES["GPL-notice"], "plain words here", licenses.TEMPLATES["MIT"]] * 300)
    assert len(scanner.scan(mixed.encode())) == 600
