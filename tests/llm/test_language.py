import random

from tallyworks.llm import language

WORDS = {
    "en": "the of and to in is that for was with his they this have from one had word but what some can out other".split(),
    "fr": "le la les des une est que pour dans qui sur avec pas plus vous sont mais comme été deux même aussi leur".split(),
    "de": "der die und das nicht ist ein ich mit auf sich dem eine auch nach wie über für wenn noch schön größe nur".split(),
}


def text(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) for _ in range(n))


def labelled(rng, n=150):
    return [(i, text(rng, lang, 40), "src%d" % (i % 5), lang) for i, lang in enumerate(list(WORDS) * (n // 3))]


def test_documents(spark, documents):
    rng = random.Random(1)
    rows = labelled(rng)
    model = language.train(documents(rows))
    odd = [
        (1000, None, "a", "en"), (1001, "", "a", "en"), (1002, "123 456 !!", None, "en"),
        (1003, "zqx jvkw qqz xxj wvvq kkz " * 40, "a", "en"),  # in none of the languages
        (1004, text(rng, "de", 60), "a", "en"),  # declared wrongly
        (1005, text(rng, "fr", 60_000), None, None), (None, text(rng, "en", 50), None, None), (1006, "und", "a", "de"),
    ]
    everything = documents(rows + odd + odd[-2:])
    found = language.identify(language.document_rows(everything, everything.doc_id), model, ["doc_id"]).collect()
    assert len(found) == everything.count()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].language == lang and by_id[i].kept for i, _, _, lang in rows)
    for i in (1000, 1001, 1002):
        assert (by_id[i].language, by_id[i].posterior, by_id[i].kept) == (None, 0.0, False)
    assert by_id[1003].language == "und" and not by_id[1003].kept
    assert by_id[1004].language == "de" and by_id[1005].language == "fr" and by_id[None].language == "en"
    own = language.train(everything)  # this model has seen the odd rows too
    found = language.identify(language.document_rows(everything, everything.doc_id), own, ["doc_id"]).collect()
    kept = language.identified_documents(everything)
    assert kept.columns == everything.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in found if r.kept)
    assert language.identified_documents(documents([])).count() == 0


def test_evidence_beside_the_text(spark, documents):
    rng = random.Random(2)
    model = language.train(documents(labelled(rng)))
    page = lambda lang, body: f'<!DOCTYPE html><HTML class=x lang="{lang}-XX"><script>the the the</script><p>{body}</p>'
    rows = [(i, page(lang, text(rng, lang, 30)), f"http://www.h{i % 2}.{'com' if lang == 'en' else lang}/x", None, True)
            for i, lang in enumerate(["en", "fr", "de"] * 40)]
    # no text evidence to speak of: markup, suffix or host decide
    rows += [(900, page("fr", "ok"), None, None, True), (901, "<p>ok</p>", "http://new.other.de/1", None, True), (902, "<p>ok</p>", "not a url", None, True)]
    pages = spark.createDataFrame([(i, h, u) for i, h, u, _, _ in rows], "page_id long, html string, url string")
    found = {r.page_id: r for r in language.identify(language.page_rows(pages, pages.page_id), model, ["page_id"]).collect()}
    assert found[900].language == "fr" and found[901].language == "de"
    assert len(found) == len(rows) and all(found[i].language == ["en", "fr", "de"][i % 3] for i in range(120))
    empty = language.identify(language.page_rows(pages.limit(0), pages.page_id), model, ["page_id"])
    assert empty.count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where("doc_id % 2 = 0"))
    rest = docs.where("doc_id % 2 = 1").drop("lang").selectExpr("*", "cast(null as string) as lang")
    found = {r.doc_id: r for r in language.identify(language.document_rows(rest, rest.doc_id), model, ["doc_id"]).collect()}
    truth = {r.doc_id: r.lang for r in docs.where("doc_id % 2 = 1").collect()}
    assert sum(found[i].language == lang for i, lang in truth.items()) >= 0.97 * len(truth)
    assert sum(found[i].kept for i in truth) >= 0.99 * len(truth)
