"""Rules and lists against plain Python."""

from llm_helpers import frame  # noqa: F401

from linepulse.llm import url_filter as u


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i, c in enumerate(rest) if c in "/?#"]
    host, after = (rest[: ends[0]], rest[ends[0] :]) if ends else (rest, "")
    stop = [i for i, c in enumerate(after) if c in "?#"]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, after[: stop[0]] if stop else after


def plain_rule(host, path):
    fits = [
        (of + start, verdict)
        for verdict, of, start in u.RULES
        if (host == of or host.endswith("." + of)) and path.startswith(start)
    ]
    return max(fits, key=lambda x: len(x[0]), default=(None, None))


URLS = [
    "http://A.Example.COM/en/1", "https://www.example.com/en/", "http://example.com", "http://example.com/", "http://x.net/es/",
    "http://net/fr/2", "http://net/de/", "http://notnet/es/", "http://É.com/a", "no scheme/en/", "", None, "a://b://c/d",
    "http://site.org/a/?b=2&a=1&utm_x=3#top", "https://WWW.site.org:443/a?a=1&b=2", "http://site.org/a", "http://site.org?ref=1",
    "http://two\nlines.org/en/\nx?y", "http://", "http://org#/x", "http://sub.example.com/fr/", "http://wwwexample.com/en/",
]


def test_rules_and_parts(frame):
    pages = frame([(i, x, "clash", None) for i, x in enumerate(URLS)] + [(None, URLS[0], "", ""), (0, URLS[0], "", "")], "page_id long, url string, host string, key string")
    listed = frame([("https://site.org/a?a=1&b=2",), ("http://site.org",), (None,), ("",), ("http://a.example.com/en/1/",)], "url string")
    got = u.judge(pages, listed).collect()
    assert len(got) == len(URLS) + 2
    known = {13, 14, 16, 0}
    for r in got:
        url = URLS[r.page_id or 0]
        assert (r.host, r.path) == plain_parts(url)
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule
        assert r.listed == ((r.page_id or 0) in known)
        assert r.verdict == (verdict or ("block" if r.listed else "allow"))


def test_bloom_passes_all_that_is_listed_and_little_else(frame):
    keys = frame([(f"site{i}.org/{i}",) for i in range(4000)], "key string")
    listed = keys.where("crc32(key) % 2 = 0")
    n = listed.count()
    blocks = -(-n // u.URLS_A_BLOCK)
    table = u.bloom(listed, blocks)
    seen = keys.withColumn("block", u._block(u.F.col("key"), blocks)).join(table, "block", "left")
    passed = u.F.lit(True)
    for i, w in enumerate(u._WORDS):
        passed = passed & (u.F.col(w).bitwiseAND(u._bits(u.F.col("key"), i)) == u._bits(u.F.col("key"), i))
    through = seen.where(passed)
    assert through.where("crc32(key) % 2 = 0").count() == n
    assert through.count() - n < 0.03 * (4000 - n)
    exact = u.listed(keys, listed)
    assert exact.where("listed != (crc32(key) % 2 = 0)").count() == 0
    assert exact.count() == 4000


def test_empty(frame):
    pages, urls = frame([], "page_id long, url string"), frame([], "url string")
    assert u.judge(pages, urls).count() == 0
    assert u.judge(frame([(1, "http://a.org/")], "page_id long, url string"), urls).first().verdict == "allow"
