"""URL filters: the contract's rules by hand, the index against all rules on all urls."""

import re

import pytest
from conftest import SMALL

from martflow.llm import url_filters
from martflow.llm.url_filters import Rule, regex_of, rule_rows, tokens_of

URLS = [
    None, "", "no scheme/org/", "http://", "http://org", "http://org/", "HTTP://ORG/x", "http://a.Org/", "http://aorg/",
    "http://example.org/es/", "http://www.EXAMPLE.org/es/x", "http://example.org/ES/x", "http://badexample.org/es/x",
    "http://example.org/en/1", "http://example.org/en/12?x", "http://example.org/en/?1", "http://example.org/en/2",
    "x://y.com/fr/1://z.org/", "http://com/de/", "http://a.com/de", "http://a.com/de/#q", "http://a.com?/de/",
    "http://www.cheap-pills.example.net/en/3", "http://spam-farm.example.net/", "http://a.net/a.JPG", "http://a.net/a.jpg?b",
    "http://a.net/login", "http://a.net/loginx", "http://a.net/login?next=1", "http://b.edu/casino/x", "http://ñandú.net/",
    "://only.org/path", "http://a.org:80/x", "http://xn--a.xxx", "http://a.net/" + "x/" * 50_000 + "porn/",
]


def by_hand(url):
    """Host, path, and the contract's rule with its verdict."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    known = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
    fits = []
    for rule in known:
        of, prefix = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + prefix):
            fits.append(rule)
    rule = max(fits, key=len, default=None)
    return host, path, rule, known.get(rule)


def pages_of(spark, urls):
    rows = [(i, u, "mine", 1) for i, u in enumerate(urls)] + [(None, "http://org/", "mine", 1), (0, "http://b.com/de/", "mine", 1)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, token int"), rows


def test_contract_by_hand(prepared):
    pages, rows = pages_of(prepared, URLS * 2)
    found = url_filters.judge(pages).collect()
    assert len(found) == len(rows)
    got = sorted(((r.page_id, r.host, r.path, r.rule) for r in found), key=str)
    assert got == sorted(((r[0], *by_hand(r[1])[:3]) for r in rows), key=str)
    verdicts = {r.page_id: r.verdict for r in found if r.page_id}
    for i, url in enumerate(URLS):
        want = by_hand(url)[3]
        if i and want:
            assert verdicts[i] == want


@pytest.mark.parametrize(
    "url, verdict, pattern",
    [
        ("http://www.cheap-pills.example.net/en/3", "block", "||cheap-pills."),
        ("http://spam-farm.example.net/", "block", "||spam-"),
        ("http://a.net/a.JPG", "block", ".jpg|"),
        ("http://a.net/a.jpg?b", "allow", None),
        ("http://a.net/login?next=1", "block", "/login^"),
        ("http://a.net/login", "block", "/login^"),
        ("http://a.net/loginx", "allow", None),
        ("http://b.edu/casino/x", "block", "/casino/"),
        ("http://ñandú.net/", "allow", None),
        (None, "allow", None),
    ],
)
def test_patterns(prepared, url, verdict, pattern):
    (row,) = url_filters.judge(prepared.createDataFrame([(1, url)], "page_id long, url string")).collect()
    assert (row.verdict, row.pattern, row.rule) == (verdict, pattern, None)


def test_index_finds_what_all_rules_find(prepared):
    """Every rule run on every url by Python's own engine, no index."""
    extra = [Rule("block", "*"), Rule("block", "a*b.c^"), Rule("allow", "|www.x.net/|"), Rule("block", "Con.Tent"), Rule("block", "/é/")]
    rules = url_filters.RULES + extra
    urls = URLS + ["http://www.x.net/", "http://a1b.c/", "http://con.tent.net", "http://x.net/con.tents", "http://a/é/b", "http://aXXb.c"]
    distinct = prepared.createDataFrame([(u,) for u in sorted({u for u in urls if u})], "url string")
    parsed = url_filters.read_rules(rule_rows(prepared, rules))
    found = {(r.url, r.pattern) for r in url_filters.matches(distinct, parsed).collect()}
    want = set()
    for url in {u for u in urls if u}:
        host, _, _, _ = by_hand(url)
        rest = url.split("://", 1)[1] if "://" in url else ""
        subject = host + rest[len(host) :]
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in subject)
        for r in rules:
            if subject and re.search(regex_of(r).replace(r"\z", r"\Z"), subject if r.listed else folded):
                want.add((url, r.pattern))
    assert found == want


def test_tokens_are_whole():
    assert tokens_of(Rule("allow", "org/", True)) == ["org"]
    assert tokens_of(Rule("block", "example.org/en/1", True)) == ["en", "example", "org"]
    assert tokens_of(Rule("block", "-pills.")) == ["pills"]
    assert tokens_of(Rule("block", "pills.x*y^")) == []
    assert tokens_of(Rule("block", "||Ads.")) == ["ads"]
    assert tokens_of(Rule("block", ".jpg|")) == ["jpg"]


def test_rules_are_filed_under_the_rarest_token(prepared):
    tokens = prepared.createDataFrame([("org",)] * 3 + [("example",)] * 2 + [("en",)] * 2, "token string")
    rules = url_filters.read_rules(rule_rows(prepared, [*url_filters.LISTED, Rule("block", "x*")]))
    filed = {r.pattern: r.token for r in url_filters.index_rules(rules, tokens).collect()}
    assert filed["example.org/en/1"] == "en" and filed["example.org/es/"] == "es"
    assert filed["org/"] == "org" and filed["x*"] == ""


def test_nothing(prepared):
    pages, rows = pages_of(prepared, URLS)
    assert url_filters.judge(pages.limit(0)).count() == 0
    assert {r.verdict for r in url_filters.judge(pages, rule_rows(prepared, [])).collect()} == {"allow"}


def test_kept_pages(prepared):
    pages, rows = pages_of(prepared, ["http://a.com/de/", "http://a.com/fr/", None])
    left = url_filters.kept(pages)
    assert left.columns == pages.columns
    assert sorted(str(r.url) for r in left.collect()) == ["None", "http://a.com/fr/", "http://org/"]


def test_query_on_the_small_table(prepared):
    from martflow.llm.queries import QUERIES

    found = QUERIES["op12_url_filters"](prepared, SMALL).collect()
    urls = {r.page_id: r.url for r in prepared.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert {r.page_id: (r.host, r.path, r.rule) for r in found} == {i: by_hand(u)[:3] for i, u in urls.items()}
