import re

import pytest

from ledgerline.llm import url_vocabulary as U
from tests.llm.data import SF, frame, with_clash

PAGES = "page_id long, url string, html string"


def brute(url, strict=U.STRICT, soft=U.SOFT, rules=U.RULES):
    """Regular expressions, one a term, and every rule tried."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, path = "".join(c.lower() if c < "\x7f" else c for c in rest[:cut]), re.split(r"[?#]", rest[cut:])[0]
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    fit.sort(key=lambda r: (-len(r.text), -len(r.host)))
    text = re.sub(r"%([0-7][0-9a-fA-F])", lambda m: chr(int(m[1], 16)), url or "")
    text = "".join(c.lower() if c < "\x7f" else c for c in text)
    hits = [sum(bool(re.search(rf"(?<![^\W\d_]){re.escape(t)}(?![^\W\d_])", text)) for t in ts) for ts in (strict, soft)]
    verdict = fit[0].verdict if fit else "block" if hits[0] or hits[1] >= 2 else "allow"
    return host, path, fit[0].text if fit else None, verdict, *hits


URLS = [None, "", "no scheme", "http://", "http:///x", "HTTP://WWW.Example.ORG/es/1?x=/fr/", "http://example.org/en/1", "http://a.example.org/en/12",
        "http://notexample.org/es/1", "http://org/", "http://x.org", "http://x.org?/es/", "http://u@x.com:80/de/", "http://x.com/de/", "http://x.com/fr/y",
        "http://fr.com.net/de/", "ftp://x.net/sex", "http://x.net/essex/sexton", "http://x.net/SEX", "http://x.net/s%65x", "http://x.net/%73%65%78",
        "http://x.net/sex%C3%A9", "http://x.net/séx/ésex", "http://x.net/ésex", "http://x.net/sex1", "http://cheap-pills.net/", "http://cheap.net/cheap",
        "http://free.net/win#a", "http://x.net/winner/win", "http://x.net/#a://b/porn", "http://x.net/" + "a" * 50000 + "/porn", "x://y://z/w", "http://x.net/sexsex",
        "http://x.net/nude-nudes", "http://example.org/es", "http://.org/", "http://x.net/a\nfree\nbet"]


@pytest.mark.parametrize("url", URLS)
def test_against_regular_expressions(url):
    assert U.judge(url, U.Rules(U.RULES), U.Vocabulary(U.STRICT, U.SOFT)) == brute(url)


def test_terms_within_terms():
    v = U.Vocabulary(["a b"], ["a", "b", "ab"])
    assert v.count("a b") == (1, 2) and v.count("ab") == (0, 1) and v.count("aab") == (0, 0) and U.Vocabulary([], []).count("x") == (0, 0)


def test_rules_of_equal_length():
    rules = [U.Rule("block", "a.b", "/cd"), U.Rule("allow", "b", "/cdef"), U.Rule("block", "b", "/cdef")]
    assert U.Rules(rules).find("a.b", "/cdef") == rules[0] and U.Rules(rules).find("b", "/cdef") == rules[1]
    assert U.Rules([]).find("a.b", "/") is None


def test_many_rules_and_terms_are_refused(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_ENTRIES", 3)
    with pytest.raises(ValueError):
        U.query(frame(spark, [], PAGES))


def test_query(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, "http://x.net/sex", "h"), (3, "http://x.net/sex", None)] * 2
    df = with_clash(frame(spark, rows, PAGES), "host", "path", "rule", "verdict", "_u")
    got = [tuple(r) for r in U.query(df).collect()]
    assert sorted(got, key=str) == sorted(((r[0], *brute(r[1])) for r in rows), key=str)
    assert U.query(df.limit(0)).collect() == []
    kept = U.keep_allowed(df)
    assert kept.columns == df.columns and kept.count() == sum(g[4] == "allow" for g in got)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = sorted(tuple(r) for r in U.query(pages).collect())
    assert got == sorted((r.page_id, *brute(r.url)) for r in pages.collect()) and {g[4] for g in got} == {"allow", "block"}
