import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyworks.llm import markup, pagediff


def brute_length(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 26, 12])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(pagediff, "TABLE_BITS", bits)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), max_size=25))
    def check(a, b):
        left, right = pagediff.common(np.array(a, np.int64), np.array(b, np.int64))
        assert [a[i] for i in left] == [b[j] for j in right]
        assert (np.diff(left) > 0).all() and (np.diff(right) > 0).all()
        assert len(left) == brute_length(a, b)

    check()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav><!-- <p>gone</p> -->
<div class="cookie-notice">We use cookies</div><div class="ad">Buy {0}</div>
<article><header><h1>Title {0}</h1></header><p>One&nbsp;&amp; two <b>bo<i>ld</i><p>Thr&eacute;e<br>lines &lt;b&gt;
<script>x<y</script><form><input value="a>b"><label>Mail</label></form><aside>See also {0}</aside></article>
<section id="comments"><p>Nice, {0}!</p></section><footer>&copy; host {0}</footer></body></html>"""


def test_lines_of_a_page():
    lines, said = markup.page_lines(PAGE.format(7))
    main = [x for x, s in zip(lines, said) if s == markup.MAIN]
    assert main == ["Title 7", "One & two bold", "Thrée", "lines <b>"]
    furniture = [x for x, s in zip(lines, said) if s == markup.FURNITURE]
    assert furniture == ["Site", "Home", "News", "We use cookies", "Buy 7", "Mail", "See also 7", "Nice, 7!", "© host 7"]
    assert len(lines) == len(main) + len(furniture)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", []),
        ("a < b &am &amp c", ["a < b &am & c"]),
        ("<p>a<p>b</div></p>c", ["a", "b", "c"]),
        ("<p>x<!-- never ends <p>y", ["x"]),
        ("<script>never ends <p>y", []),
        ("<p title='a>b'>x</p><p title=\"it's\">y</p><p class=>z", ["x", "y", "z"]),
        ("<p>open <a href='x", ["open"]),
        ("<div hidden>no</div><p style='display: none'>no<p>yes", ["yes"]),
        ('<p>a<span class="ad"><span>b</span>c</span>d', ["a", "bc", "d"]),
        ("<ul><li class=ad>x<li>y</ul>", ["x", "y"]),
        ("<template><p>no</p></template><noscript>no</noscript><select><option>no</select><p>a \x0bb", ["a b"]),
        ("</p></b></nope><P>A</P>", ["A"]),
    ],
)
def test_odd_markup(page, text):
    assert markup.page_lines(page)[0] == text


def test_markup_is_read_in_linear_time():
    for piece in ("<b>", "<div>", "<p class='", '<a "', "<!--", "</div>", "&amp;", "<", "<span class=ad>", "<li>"):
        markup.page_lines(piece * 40_000)


def test_urls():
    assert pagediff.host_and_path("HTTPS://u@WWW.a.org:80/x/y/?q#f") == ("www.a.org", "\x01x\x01y")
    assert pagediff.host_and_path(None) == ("", "") and pagediff.host_and_path("a/b?c") == ("", "a\x01b")


def brute(rows):
    """Each page against its neighbours in the order of distinct pages, with one mask a line."""
    def key(r):
        import hashlib
        part = ["-" if x is None else f"{len(x)}:{x}" for x in (r[1], r[2])]
        return hashlib.md5("".join(part).encode()).digest()

    order = sorted({(*pagediff.host_and_path(r[1]), key(r), r[2]) for r in rows}, key=lambda r: (r[0].encode(), r[1].encode(), r[2]))
    text = {}
    for k, (host, _, mine, page) in enumerate(order):
        lines, said = markup.page_lines(page or "")
        shared = set()
        for n in (k - 1, k + 1):
            if not 0 <= n < len(order) or order[n][0] != host:
                continue
            theirs = markup.page_lines(order[n][3] or "")[0]
            pair = (lines, theirs) if n > k else (theirs, lines)
            names = {x: i for i, x in enumerate(sorted(set(lines) | set(theirs)))}
            found = pagediff.common(*(np.array([names[x] for x in p], np.int64) for p in pair))
            at = set((found[0] if pair[0] is lines else found[1]).tolist())
            weigh = [0 if s == markup.FURNITURE else len(x) for x, s in zip(lines, said)]
            if markup.MAIN in said or sum(weigh[i] for i in at) < 0.8 * sum(weigh):
                shared |= at
        text[mine] = " ".join(x for i, (x, s) in enumerate(zip(lines, said)) if s == markup.MAIN or (s == markup.PLAIN and i not in shared))
    return sorted(((r[0], r[1], text[key(r)], len(text[key(r)])) for r in rows), key=repr)


def pages_table(spark, rows):
    wide = [(*r, "x", "y", 1, "z", 5, True) for r in rows]
    return spark.createDataFrame(wide, "page_id long, url string, html string, key string, host string, idx long, lines string, n int, shared boolean")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def bare(k, site):
    """A page without any telling names: only its neighbours show what is furniture."""
    words = random.Random(k).sample(["sun", "moon", "rain", "wind", "snow", "hail", "fog"], 5)
    return f"<div>Menu of {site}</div><div>About us</div>" + "".join(f"<p>{w} {k}</p>" for w in words) + f"<div>All by {site}</div>"


@pytest.mark.parametrize("stretch", [2, 5, 256])
def test_pages_against_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(pagediff, "STRETCH", stretch)
    rows = [(k, f"http://h{k % 2}.org/a/{k * 7 % 40}", bare(k, k % 2)) for k in range(40)]
    rows += [(100 + k, f"https://main.org/{k}.html?x", PAGE.format(k)) for k in range(9)]
    rows += [rows[3], rows[3], (3, rows[4][1], rows[4][2]), (200, "http://alone.org/", bare(9, 9)), (None, None, None), (300, None, "<p>free"), (301, "", "")]
    rows += [(400 + k, f"http://copies.org/{k}", bare(1, "copies")) for k in range(5)]
    out = got(pagediff.page_digest(pages_table(spark, rows)))
    assert out == brute(rows)
    texts = {r[0]: r[2] for r in out}
    assert texts[0] == " ".join(re.findall(r"<p>(.*?)</p>", bare(0, 0)))  # furniture found by its neighbours alone
    assert texts[104] == "Title 4 One & two bold Thrée lines <b>"
    assert texts[402].startswith("Menu of copies")  # versions of one page show nothing


def test_very_long_page_and_empty_table(spark):
    long = "<p>same</p>" * 20_000
    rows = [(1, "http://l.org/1", long + "<p>one</p>"), (2, "http://l.org/2", "<p>two</p>" + long), (3, "http://l.org/3", "<p>three words here</p><p>same</p>")]
    texts = {r[0]: r[2] for r in got(pagediff.page_digest(pages_table(spark, rows)))}
    assert texts[3] == "three words here" and texts[1].endswith("one")
    empty = pagediff.page_digest(pages_table(spark, rows).limit(0))
    assert empty.collect() == [] and empty.columns == ["page_id", "url", "text", "n_chars"]


def test_articles_of_the_test_table(spark):
    """Articles as the table's generator marks them, by a plain pattern."""
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = []
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        text = " ".join(html.unescape(re.sub(r"</?(?:p|h1|br)>", "\n", re.sub(r"</?b>", "", article))).split())
        want.append((r.page_id, r.url, text, len(text)))
    assert got(pagediff.page_digest(pages)) == sorted(want, key=repr)
