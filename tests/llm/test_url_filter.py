import re

from starwise.llm import url_filter
from starwise.llm.queries import URL_RULES


def judged(spark, pages):
    rows = [(n, url, html) for n, (url, html) in enumerate(pages)]
    found = url_filter.judge_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string"), URL_RULES)
    return {r.page_id: r for r in found.collect()}, found


def test_hosts_paths_and_rules(spark):
    urls = [
        "http://a.example.com/en/x?q#f", "HTTPS://WWW.Example.COM/en/1", "http://sub.www.example.com/en/", "http://x.net/es/a",
        "http://net/fr/", "http://xnet/es/a", "http://x.net/esx", "http://y.com", "ftp://É.com/Ä", "no address", None, "", "http://x.org?a/b://c",
        "a://b://c/d", "http://x.net/es/\nnew", "http://com/",
    ]
    found, _ = judged(spark, [(u, None) for u in urls])

    def brute(url):
        host, path = "", ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        return host, path, best and best.name, best.verdict if best else "allow"

    for n, url in enumerate(urls):
        assert tuple(found[n])[1:] == brute(url), url


def test_blocks_reach_aliases(spark):
    pages = [
        ("http://x.net/es/a", None),  # 0 blocked by rule
        ("https://www.x.net/es", None),  # 1 no rule
        ("http://x.net/es", "text"),  # 2 spelling of 1
        ("http://p.org/1", '<link rel="canonical" href="http://x.net/es/a">'),  # 3 canonical of 0
        ("http://p.org/2", '<META HTTP-EQUIV=refresh content="0; URL=/1">'),  # 4 redirects to 3
        ("https://p.org/2/?utm_source=f#top", None),  # 5 spelling of 4
        ("http://q.com/3", "<link href='http://p.org/2' rel='canonical'>"),  # 6 allowed by rule
        ("http://r.org/", '<a href="http://x.net/es/a">link</a>'),  # 7 an ordinary link
        ("http://s.org/", '<meta property="og:url" content="http://z.net/fr/only-named">'),  # 8 names a blocked address
        ("http://t.org/?page=2", None), ("http://t.org/?page=3", '<link rel=canonical href=http://t.org/?page=3>'),  # 9, 10
    ]
    found, _ = judged(spark, pages)
    verdicts = {n: r.verdict for n, r in found.items()}
    assert verdicts == {0: "block", 1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow", 8: "block", 9: "allow", 10: "allow"}


def test_odd_rows(spark):
    pages = [("http://x.net/es/a", None)] * 3 + [(None, "<link rel=canonical href=http://x.net/es/a>"), ("", None)]
    found, frame = judged(spark, pages)
    assert len(found) == 5 and found[3].verdict == found[4].verdict == "allow"
    wide = spark.createDataFrame([(1, "http://x.net/es/a", "", "v")] * 2, "page_id int, url string, html string, verdict string")
    assert [r.verdict for r in url_filter.judge_pages(wide, URL_RULES).collect()] == ["block", "block"]
    assert url_filter.judge_pages(wide.limit(0), URL_RULES).count() == 0
    assert "CartesianProduct" not in frame._jdf.queryExecution().toString()


def test_relative_targets_and_entities(spark):
    blocked = "http://x.net/es/a/b"
    forms = [
        '<meta http-equiv="refresh" content="0; url=next.html">', '<meta http-equiv=refresh content="3;URL=\'../up\'">',
        '<link rel="canonical" href="?id=7&amp;x=1">', '<link href="./a/../c?p=1&#38;q=2" rel="nofollow canonical">',
        '<base href="/other/"><meta property="og:url" content="page">', '<meta content="0, //h.org/z" http-equiv="Refresh">',
    ]
    targets = ["http://p.org/d/next.html", "http://p.org/up", "http://p.org/d/e?id=7&x=1", "http://p.org/d/c?p=1&q=2", "http://p.org/other/page", "http://h.org/z"]
    assert [url_filter.links_of(form, "http://p.org/d/e?f=1#g") for form in forms] == [[t] for t in targets]
    none = ["mailto:a@b.org", "javascript:go()", "", "//[bad/x"]
    assert not any(url_filter.links_of(f'<link rel=canonical href="{address}">', "http://p.org/d") for address in none)
    assert url_filter.links_of('<meta http-equiv="refresh" content="5"><a href="x">canonical</a>', "http://p.org/d") == []
    assert url_filter.links_of('<link rel=canonical href="../f">', "gopher://p.org/d/e") == ["gopher://p.org/f"]

    pages = [(f"http://n{n}.org/d/e?f=1", form.replace("//h.org", f"//n{n}.org")) for n, form in enumerate(forms)]
    ends = [t.replace("p.org", f"n{n}.org").replace("h.org", f"n{n}.org") for n, t in enumerate(targets)]
    pages += [(end, f"<link rel=canonical href={blocked}>") for end in ends]
    pages.append(("http://x.net/q", '<link rel=canonical href="es/a/b">'))
    found, _ = judged(spark, pages)
    assert {r.verdict for r in found.values()} == {"block"}
