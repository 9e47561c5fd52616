"""Language ID: accuracy, and what each kind of evidence adds."""

import numpy as np

from fleetpulse.llm import language_id


def test_documents_and_pages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = language_id.identify(docs, pages).cache()
    assert got.count() == docs.count() + pages.count()
    of_docs = got.filter("kind = 'document'").drop("lang_").join(
        docs.select("doc_id", docs.lang.alias("label")), "doc_id")
    assert of_docs.filter("lang = label").count() >= 0.98 * docs.count()
    of_pages = got.filter("kind = 'page'")
    fused = of_pages.filter("lang = declared").count()
    alone = of_pages.filter("text_lang = declared").count()
    assert fused >= alone and fused >= 0.97 * pages.count()


def model():
    table = np.log(np.full((language_id.GRAM_ROWS, 2), 1e-4))
    return language_id.Likelihoods(("aa", "bb"), table.astype("float32"))


def test_host_decides_without_text(spark):
    """Texts that say nothing go by what the rest of the host says."""
    strong = language_id.Likelihoods(("aa", "bb"), np.log(np.full(
        (language_id.GRAM_ROWS, 2), 1e-4)).astype("float32"))
    h, _ = language_id._triplets(*_bytes("xyzxyzxyz"))
    strong.table[h, 1] += 6
    h, _ = language_id._triplets(*_bytes("qrsqrsqrs"))
    strong.table[h, 0] += 6
    rows = ([("page", None, i, "xyz" * 9, "b.example.com") for i in range(20)]
            + [("page", None, 100 + i, "qrs" * 9, "a.example.com") for i in range(20)]
            + [("page", None, 200, None, "b.example.com"), ("page", None, 201, "", "a.example.com"),
               ("page", None, 202, None, None)])
    frame = spark.createDataFrame(rows, "kind string, doc_id long, page_id long, text string, "
                                        "host string").selectExpr(
        "*", "substring_index(host, '.', -2) AS domain", "CAST(NULL AS string) AS ending",
        "CAST(NULL AS string) AS declared")
    got = {r.page_id: r for r in language_id.fuse(frame, strong).collect()}
    assert got[200].lang == "bb" and got[201].lang == "aa" and got[200].text_lang is None
    assert got[0].lang == "bb" and got[100].lang == "aa" and got[202].lang in ("aa", "bb")
    assert got[202].confidence < 0.75 < got[200].confidence


def _bytes(text):
    raw = np.frombuffer(text.encode(), dtype="uint8")
    return raw, np.array([0, len(raw)])


def test_every_label_is_learned(spark):
    """Forty labels, the rarest with its own words; one has a long text only."""
    rng = np.random.default_rng(1)
    rows = []
    for j in range(40):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)]
        for i in range(3 if j < 39 else 1):
            n = 60 if j < 39 else 4000
            rows.append((100 * j + i, " ".join(rng.choice(words, n)), f"l{j:02}", "one"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = language_id.learn(docs)
    assert sorted(model.languages) == [f"l{j:02}" for j in range(40)]
    got = language_id.fuse(language_id.document_evidence(docs), model)
    label = {r[0]: r[2] for r in rows}
    assert {r.doc_id: (r.lang, r.text_lang) for r in got.collect()} == {
        i: (x, x) for i, x in label.items()}


def test_address_parts(spark):
    urls = ["https://User@Blog.Example.CO.uk:8080/FR/x?y", "http://a.de", "nothing", "", None,
            "http://a.b/xyz/de#t", "//x/y"]
    frame = spark.createDataFrame([(i, u, f"<HTML class=x LANG='pt-BR'>{i}") for i, u in
                                   enumerate(urls)], "page_id long, url string, html string")
    got = [(r.host, r.domain, r.ending, r.declared) for r in
           language_id.page_evidence(frame).orderBy("page_id").collect()]
    assert got[0] == ("blog.example.co.uk", "co.uk", "uk/fr", "pt")
    assert got[1][:3] == ("a.de", "a.de", "de")
    assert got[5][:3] == ("a.b", "a.b", "b/de")
