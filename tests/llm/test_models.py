"""Toxicity, language, personal data, main text."""

import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import html_text, html_tree, language, pii, toxicity
from llm.conftest import AWKWARD

DATA = "/root/testdata/sf0.01"


def test_toxicity_on_held_out_rows(prepared):
    docs, labels = (prepared.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    scores = toxicity.scored(docs, toxicity.fit(docs, labels))
    rows = scores.join(labels, "doc_id").filter("pmod(crc32(cast(doc_id as string)), 4) = 2").collect()
    clean = [r for r in rows if not r.toxic]
    toxic = [r for r in rows if r.toxic]
    assert sum(r.score >= 0.3 for r in clean) <= 0.02 * len(clean)
    assert sum(r.score >= 0.3 for r in toxic) >= 0.5 * len(toxic)


def test_toxicity_of_awkward_rows(prepared, documents):
    docs = documents(AWKWARD + [(50, "you stupid idiot, you moron")])
    none = prepared.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, none)
    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert found[50] >= 0.3 and found[1] < 0.3 and found[2] == found[1]
    kept = toxicity.without_toxic(docs.withColumn("score", F.lit(1)), model)
    assert kept.count() == len(AWKWARD) and kept.columns[-1] == "score"
    assert toxicity.scored(documents([]), model).count() == 0


def test_language_on_held_out_rows(prepared):
    docs = prepared.read.parquet(f"{DATA}/documents.parquet")
    rows = language.identify(docs).filter("held_out").join(docs, "doc_id").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_language_of_awkward_rows(documents):
    found = {r.doc_id: r for r in language.identify(documents(AWKWARD)).collect()}
    assert {found[i].lang_pred for i in (1, 2, 5)} == {"und"}
    assert found[6].lang_pred in ("en", "de", "es") and 0 <= found[6].score <= 1
    assert language.identify(documents([])).count() == 0


@pytest.mark.parametrize("labels", [2, 3, 5, 6, 12])
def test_codewords_are_apart(labels):
    code = language.codewords(labels)
    assert (abs(code.sum(axis=0)) < labels).all()
    apart = [(code[i] != code[j]).sum() for i in range(labels) for j in range(i)]
    assert min(apart) >= 1


def base_by_hand(text):
    found = []
    for kind, pattern in (
        (0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        (1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        (2, r"[0-9]([\x20-]?[0-9])+"),
        (3, r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            d = [int(c) for c in reversed(digits)]
            luhn = sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
            good = {
                0: True,
                1: all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                2: 12 <= len(digits) <= 19 and luhn % 10 == 0,
                3: 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans():
    rng = np.random.default_rng(1)
    alphabet = list("ab1234567890.@+-() %_") + ["@a.b", "1.2.3.4", "4111 1111 1111 1111", "+49 30 1234567"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet, size=rng.integers(0, 30)))
        assert pii.base_spans(text) == base_by_hand(text), text


def test_terms_that_reveal(documents):
    rows = [(i, f"plain words number {i} agent smithers wrote to ann@example.com about it") for i in range(6)]
    rows += [(100 + i, f"plain words number {i} and nothing else about it") for i in range(60)]
    docs = documents(rows + AWKWARD).withColumn("hash", F.lit(5))
    found = {r.id: r.spans for r in pii.findings(docs).collect() if r.id is not None}
    terms = {rows[0][1][s.start : s.end] for s in found[0] if s.disclosure is not None}
    assert {"smithers", "agent", "wrote"} <= terms and not terms & {"plain", "words", "about", "it"}
    assert not found[100] and not found[1000 - 993]
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = clean.filter("doc_id = 0").first().text
    assert "ann@" not in text and "smithers" not in text and "plain words" in text
    assert pii.findings(documents([])).count() == 0


def test_terms_far_from_the_entity(documents):
    """A name in the header reveals the address in the footer; counts are those by hand."""
    rng = np.random.default_rng(5)
    fill = [f"fill{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    rows = []
    for i in range(90):
        body = " ".join(rng.choice(fill, 120))
        head, foot = ("Smithers", "ann@example.com") if i < 6 else ("Burns", "bob@example.com") if i < 13 else ("Nobody", "end")
        rows.append((i, f"{head} {body} {'agent ' if i in (0, 1, 2, 7, 40) else ''}{body} {foot}"))
    rows += [rows[0], (0, rows[1][1])]
    df = Counter(w for _, text in rows for w in {w for w, _, _ in pii.words_outside(text, pii.base_spans(text))})
    whole = Counter(w for _, text in rows for w in set(pii.NAME.findall(text.lower())))
    want = {}
    for foot in ("ann@example.com", "bob@example.com", "@example.com"):  # the last is their domain
        texts = [text for _, text in rows if foot in text]
        both = Counter(w for text in texts for w in {w for w, _, _ in pii.words_outside(text, pii.base_spans(text))})
        for w, shared in both.items():
            pmi = np.log2(len(rows) * shared / (whole[w] * len(texts)))
            if shared >= pii.SUPPORT and pmi / np.log2(len(rows) / len(texts)) >= pii.GENERALISE:
                want[foot, w] = shared
    assert ("ann@example.com", "smithers") in want and ("bob@example.com", "burns") in want and df["smithers"] == 8
    for r in pii.findings(documents(rows)).collect():
        texts = [text for name, text in rows if name == r.id]
        marked = [{(s.start, s.end) for s in r.spans if s.disclosure is not None}]
        expected = [
            {(s, e) for w, s, e in pii.words_outside(text, pii.base_spans(text)) if any(f in text and (f, w) in want for f, _ in want)}
            for text in texts
        ]
        assert marked[0] in expected


LONG = "Some long paragraph of text, with many words in it, that goes on and on. It ends here."


@pytest.fixture(scope="module")
def trees():
    from pyspark.sql import SparkSession

    return html_text.fit(SparkSession.active().read.parquet(f"{DATA}/pages.parquet"))


def text_of(trees, source):
    nodes = html_tree.parse(source)
    return html_text.main_text(nodes, trees.score(html_text.features_of(nodes)))


def test_main_text_without_boilerplate(spark, trees):
    page = (
        f"<body><nav><ul><li><a>x</a></ul></nav><aside><p>{LONG}</p></aside><div class='cookie-notice'>We use it</div>"
        f"<article><h1>A &amp; B</h1><p>{LONG}<br>more<div class='ad'>buy</div><form><label>Mail</label></form>"
        f"<p>{LONG}<script>var t='</p>'</script></article><section id='comments'><div class='comment'><p>{LONG}</p>"
        "</div></section><footer>c</footer></body>"
    )
    assert text_of(trees, page) == f"A & B\n\n{LONG} more\n\n{LONG}"


def test_decoding_never_contradicts_ancestors(spark):
    nodes = html_tree.parse("<div><p>a</p><div><p>b</p></div></div>")
    rng = np.random.default_rng(0)
    for _ in range(200):
        kept = html_text.decode(nodes, rng.normal(size=len(nodes)) * 3)
        assert all(not k or n.parent < 0 or kept[n.parent] for k, n in zip(kept, nodes, strict=True))


def test_pages_match_their_articles(prepared, trees):
    pages = prepared.read.parquet(f"{DATA}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages, model=trees).collect()}
    import html

    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\0", re.sub(r"<[a-zA-Z/][^>]*\Z", "", inner))))
        blocks = (" ".join(html.unescape(b).split()) for b in inner.split("\0"))
        assert found[r.page_id] == "\n\n".join(b for b in blocks if b)


def test_awkward_pages(prepared, trees):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<"), (4, "u", "<div"), (4, "u", "a < b"), (5, "u", "<p a='")]
    pages = prepared.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    out = html_text.extract(pages, model=trees).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_deep_pages_are_read_in_time():
    started = time.perf_counter()
    for opening in ("<div>", "<table><div>", "<p><table><div>", "<ul><li><div>", "<b><section>"):
        nodes = html_tree.parse(opening + "<div>" * 100_000 + "text" + "</div>" * 50_000 + "</nothing>" * 1000)
        assert nodes[-1].text == "text" and nodes[-1].depth > 100_000
    assert time.perf_counter() - started < 10


def test_samples_are_bounded(prepared):
    """One id, or none, with very many rows."""
    many = prepared.range(60_000).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("some words "), "id").alias("text"), F.lit("en").alias("lang"))
    labels = prepared.createDataFrame([(4, 1)], "doc_id long, toxic int")
    sample, _ = toxicity._sample(many, labels, "doc_id", "text", "toxic", 100)
    assert 50 < sample.count() <= 200
    some = many.limit(300).withColumn("lang", F.lit("de"))
    model = language.fit(many.withColumn("doc_id", F.lit(None).cast("long")).unionByName(some), per_label=100)
    assert model.labels == ["de", "en"]


def test_labels_are_bounded(prepared, monkeypatch):
    monkeypatch.setattr(language, "MOST_LABELS", 3)
    rows = [(i, f"some words in label {i % 9}", f"l{i % 9 if i < 90 else i % 3}") for i in range(120)]
    model = language.fit(prepared.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.labels == ["l0", "l1", "l2"]


def test_long_texts_have_the_margins_of_short_ones():
    model = language.Model(["a", "b", "c"], np.random.default_rng(1).integers(0, 9, (3, language.FEATURES)).astype(float))
    grams = np.random.default_rng(2).integers(0, language.FEATURES, 3000)
    assert np.allclose(model.margins(grams), model.margins(np.tile(grams, 20)), atol=1e-4)
