"""URL judgements against a loop over all rules."""

import random

import pytest

from vendorscope.llm import urls as U

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    host, path = "", ""
    if rest is not None:
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
           if (host == h or (h and host.endswith("." + h))) and path.startswith(p)]
    return (host, path, *(max(fit)[3:] if fit else (None, default)))


def table(spark, rules):
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def compare(spark, urls, rules, **kw):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(4)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judged(df, table(spark, rules), **kw).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == plain(u, rules, kw.get("default", "allow")), u


ODD = ["http://x.net", "http://x.net/", "http://NET/a", "http://a.example.net/en/x?/y", "http://a.example.net/en", "http://b.example.net#/en/",
       "http://notexample.net/en/", "https://m.org/fr/1://x", "example.com/de/", "://example.com/de/", "", None, "http://example.com/de",
       "http://example.com:80/de/", "http://a@example.com/de/", "http://ÉX.example.com/de/é", "a http://x.org/fr/", "http://net./", "http://..net/",
       "http:///net/", "http://x.net/\nen/", "http://" + "a." * 3000 + "example.com/de/" + "b/" * 30000, "http://x.net/" * 2]


def test_odd_urls(spark):
    compare(spark, ODD, RULES)
    compare(spark, ODD, RULES, default="block")


def test_random_rules_and_urls(spark):
    rng = random.Random(3)

    def host():
        return ".".join(rng.choice(["a", "b", "net"]) for _ in range(rng.randrange(1, 5)))

    def path():
        return "".join(rng.choice(["/", "/x", "/y", "z"]) for _ in range(rng.randrange(0, 6)))

    rules = [(host(), p if (p := path())[:1] in ("", "/") else "/" + p, rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [(h, p, "allow") for h, p, _ in rules[:5]] + [("", "", "block")]
    compare(spark, [f"http://{host()}/{path()}" for _ in range(400)] + ODD, rules)


def test_rules_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(U, "BROADCAST_BYTES", 0)
    compare(spark, ODD * 3, RULES)


def test_rows_and_columns_are_kept(spark):
    schema = "page_id long, url string, host string, rule int, `a.b` map<string,int>, `x y` struct<`p q`:int>, _row long"
    rows = [(1, "http://x.net/", "h", 7, {"k": 1}, (2,), 5)] * 3 + [(None, None, None, None, None, None, None)]
    out = U.judged(spark.createDataFrame(rows, schema), table(spark, RULES))
    assert out.columns == ["page_id", "url", "a.b", "x y", "_row", "host", "path", "rule", "verdict"]
    got = out.collect()
    assert sum(r.page_id == 1 and r["a.b"] == {"k": 1} and r._row == 5 and r.verdict == "block" for r in got) == 3 and len(got) == 4


def test_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert U.judged(empty, table(spark, RULES)).collect() == []
    one = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in U.judged(one, table(spark, [])).collect()] == [(None, "allow")]
    assert [r.rule for r in U.judged(one, table(spark, [("NET", None, "block"), (None, "/", "block")])).collect()] == ["net"]


def test_unknown_verdict(spark):
    one = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    with pytest.raises(Exception, match="unknown verdict"):
        U.judged(one, table(spark, [("net", "/", "maybe")])).collect()
