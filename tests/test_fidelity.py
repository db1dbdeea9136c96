"""Cases that limits and shortcuts once got wrong, on hand-written input."""

import pytest
from pyspark.sql import functions as F

from vendorscope.operators import enrich as EN
from vendorscope.operators import facts as FX
from vendorscope.operators import tokens as TK
from vendorscope.operators import vendors as V

COMPLETIONS = [
    # raw, status, cleaned text (None: as it came), kept sources
    ('{"phone":"9"}\n\nNote: done', "invalid", None, None),
    ('{"phone":"1","phone":"2"}', "ok", None, None),
    ('{"rating": NaN, "x": [Infinity, -Infinity]}', "ok", None, None),
    ('{"a":1}{"b":2}', "invalid", None, None),
    ('{"a":1},{"b":2}', "invalid", None, None),
    ("", "invalid", None, None),
    ('{"sources":"Overview"}', "ok", None, None),
    ('{"zz": 1, "sources" : [ "Overview" ,"b",  " JustDial " ], "a":{"sources":["Overview"]}}', "ok",
     '{"zz": 1, "sources" : ["b"], "a":{"sources":["Overview"]}}', ["b"]),
    ('{"note":"\\"sources\\":[","sources":["Official Website", 7, null]}', "ok", None, ["Official Website", "7", None]),
    ('{"sources":["x","weddingwire.in",2.5],"é":"ü"}', "ok", '{"sources":["x",2.5],"é":"ü"}', ["x", "2.5"]),
    ('{"sources":["Overview"],"sources":["y"]}', "ok", None, ["y"]),
    ('["Overview"]', "not_object", None, None),
    ("{'a':1}", "invalid", None, None),
    ('{"a":"x\ny"}', "invalid", None, None),
    ('{"a":"x\\ny", "b":"\\u00e9"}', "ok", None, None),
    ('{"a":"\\x"}', "invalid", None, None),
    ('{"a":01}', "invalid", None, None),
    ('{"a":.5}', "invalid", None, None),
    ('{"a":1e5,"b":-0.5E-3}', "ok", None, None),
    ('{a:1}', "invalid", None, None),
    ('{"a":1,}', "invalid", None, None),
    ('{"a":"NaN, Infinity","b":[NaN,-Infinity]}', "ok", None, None),
    ("NaN", "not_object", None, None),
    ("null", "not_object", None, None),
    ('"sources"', "not_object", None, None),
    (' \n{"a":1}\t', "ok", None, None),
    ('\ufeff{"a":1}', "invalid", None, None),
    ('{"a":1} // c', "invalid", None, None),
    ('{"sources":[["Overview"],"Overview"]}', "ok", '{"sources":[["Overview"]]}', ['["Overview"]']),
    ('{"sources":[],"b":"\\"sources\\":[\\"Overview\\"]"}', "ok", None, []),
    ('{"b":"x]","sources":["a]","JustDial","b\\"]"],"c":["Overview"]}', "ok", '{"b":"x]","sources":["a]","b\\"]"],"c":["Overview"]}', ["a]", 'b"]']),
    ('{"sources":["y"],"sources":"x"}', "ok", None, None),
    ('{"a":"{","sources":["Overview","z"]}', "ok", '{"a":"{","sources":["z"]}', ["z"]),
]


def test_completions_keep_everything_but_blacklisted_sources(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(COMPLETIONS)], "i int, raw string")
    got = {r.i: r for r in EN.with_sources(df).collect()}
    for i, (raw, status, text, sources) in enumerate(COMPLETIONS):
        assert (got[i].parse_status, got[i].cleaned, got[i].sources) == (status, raw if text is None else text, sources), raw


def test_wrong_types_stay_in_the_saved_text(spark):
    raw = '{"services_offered":"a","phone":12,"zz":{"k":[1]}}'
    r = EN.profile_record(spark.createDataFrame([(raw,)], "raw string")).first()
    assert (r.services_offered, r.phone, r.extra_keys, r.profile_json) == ([], "12", ["zz"], raw)


def test_blocks_without_a_source(spark):
    text = "Parameter: rating Value: 4.5 Parameter: phone Value: 1 Source URL: http://x"
    rows = FX.facts(spark.createDataFrame([(1, text)], "id int, t string"), "t", ["id"]).orderBy("pos").collect()
    assert [(r.parameter, r.value, r.source_url) for r in rows] == [("rating", "4.5", None), ("phone", "1", "http://x")]


@pytest.mark.parametrize("parameter,url,rank", [
    ("price_range", "https://www.instagram.com/p/1", 3), ("price_range", "https://fb.com/a", 4), ("price_range", "https://a.in/pricing", 2),
    ("price_range", "https://a.in", 1), ("price_range", "https://my-blog.com/x", 5), ("price_range", "https://www.justdial.com/x", 6),
    ("phone", "https://www.justdial.com/x", 5), ("rating", "https://g.page/x", 1), ("rating", "https://www.instagram.com/p", 99),
    ("services_offered", "https://a.in/portfolio", 2), ("services_offered", "https://a.in/event-gallery", 5),
    ("services_offered", "https://a.in/reviews", 6), ("phone", "https://a.in/portfolio", 1), ("phone", None, 99), ("phone", "none", 99)])
def test_sources_rank_by_the_groups_own_names(spark, parameter, url, rank):
    df = spark.createDataFrame([(parameter, url)], "parameter string, source_url string")
    assert FX.with_source_rank(df).first().source_rank == rank


def test_list_fields_unite_all_sources(spark):
    rows = [(1, 1, "services_offered", "c", "https://fb.com/a"), (1, 2, "services_offered", "b , a", "https://a.in"),
            (1, 3, "services_offered", "a,d", "https://a.in"), (1, 4, "phone", "9", "https://a.in"), (2, 1, "phone", "8", None)]
    fx = spark.createDataFrame(rows, "v int, pos int, parameter string, value string, source_url string")
    got = {r.v: r for r in FX.profile_wide(FX.resolve(fx, "v", ["pos"]), "v", fx, ["pos"]).collect()}
    assert got[1].services_offered == ["b", "a", "d", "c"] and got[1].phone == "9"
    assert got[2].services_offered == [] and got[2].phone == "8" and got[2].website == ""


def overview(body):
    return f'<html><body><div class="Kevs9"><h2>AI <b>Over</b>view&#32;</h2>{body}</div></body></html>'


@pytest.mark.parametrize("body,text", [
    ("<p><b><i><em><strong><u><b><i><s>DEEP</s></i></b></u></strong></em></i></b></p>", "DEEP"),
    ("<p>a</p><button aria-hidden='true'><span>no</span></button><p>b</p>", "a\n\nb"),
    ('<p>a</p><sup class="citation"><span>no</span></sup><table class="source"><tr><td><p>no</p></td></tr></table>', "a"),
    ("<p><!-- c -->x</p><p>y</p>", "y"), ("<p>x<br></p><li>y</li>", "y"), ("<p><b></b>x</p><span>y</span>", "y"),
    ("<div><p>same</p></div><p>same</p><li>Show more</li><p>it&rsquo;s</p>", "same\n\nit’s")])
def test_overview_blocks(spark, body, text):
    pages = spark.createDataFrame([(1, overview(body)), (2, "<div><p>no anchor</p></div>"), (3, None)], "page_id int, html string")
    assert [(r.page_id, r.overview_text) for r in TK.overview_blocks(pages).collect()] == [(1, text)]
    assert {r.page_id: r.status for r in TK.page_status(pages).collect()} == {1: "ok", 2: "no_overview", 3: "error"}


def test_last_write_wins_is_one_result(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("n", None, "x"), ("n", None, "y")], "k string, o int, v string")
    assert {r.k: r.v for r in V.last_write_wins(df, ["k"], "o").collect()} == {"k": "b", "n": "y"}


def test_long_ids(spark):
    from vendorscope.functions import text as T
    df = spark.createDataFrame([("9223372036854775807",), ("9223372036854775808",), ("007",)], "x string")
    assert [r.y for r in df.select(T.id_cast(F.col("x")).alias("y")).collect()] == [9223372036854775807, None, 7]


def test_json_status_is_that_of_the_strict_parser(spark):
    """Random edits of valid texts against the standard library's parser."""
    import json
    import random
    rng = random.Random(6)
    base = ['{"a":1,"b":[true,null,"x\\n"],"c":{"d":-1.5e3}}', '{"sources":["Overview","y"],"zz":NaN}', "[1, 2]", '"s"', "{}", "-0"]
    texts = set(base)
    for _ in range(1500):
        t = rng.choice(base)
        for _ in range(rng.randrange(1, 4)):
            k = rng.randrange(len(t) + 1)
            t = t[:k] + rng.choice(['"', "'", "{", "}", "[", "]", ",", ":", "0", "1", ".", "e", "-", " ", "\n", "\\", "t", "NaN", ""]) + t[k + rng.randrange(2):]
        texts.add(t)

    def status(t):
        try:
            return "ok" if isinstance(json.loads(t), dict) else "not_object"
        except ValueError:
            return "invalid"

    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    bad = [(r.raw, r.s) for r in df.select("raw", EN.json_status(F.col("raw")).alias("s")).collect() if r.s != status(r.raw)]
    assert not bad, bad[:5]


def test_long_completion(spark):
    raw = '{"a":[' + ",".join(f'"x{i}"' for i in range(60000)) + '],"sources":["Overview","z"]}'
    r = EN.with_sources(spark.createDataFrame([(raw,)], "raw string")).first()
    assert r.parse_status == "ok" and r.sources == ["z"] and len(r.cleaned) == len(raw) - len('"Overview",')


CONTACTS = [
    ("see (https://x.example/a_(b)), or https://y.example/z.", ["https://x.example/a_(b)", "https://y.example/z"], []),
    ("[https://x.example/q?a=[1]]; **https://y.example**", ["https://x.example/q?a=[1]", "https://y.example"], []),
    ("'https://x.example/it's' (https://x.example/(1)(2))!?", ["https://x.example/it's", "https://x.example/(1)(2)"], []),
    ("on 2024-05-06 12, 2024-05-06 12:30, 06.05.2024 11, 2021 2022 2023", [], []),
    ("+91 98765 43210; +1 (017) 555-7713 and +442079460018", [], ["+91 98765 43210", "+1 (017) 555-7713", "+442079460018"]),
    ("(022) 2345-6789, 080 2345 6789, 98765-43210, 9876543210", [], ["(022) 2345-6789", "080 2345 6789", "98765-43210", "9876543210"]),
    ("card 1234567890123456, id A9876543210, 10 000 000 Rs, 12 34, 192.168.100.200", [], []),
]


def test_contacts_of_labelled_texts(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CONTACTS)], "i int, text string")
    got = FX.route_contacts(df, "text", ["i"]).collect()
    urls = FX.extract_urls(df, "text", ["i"]).collect()
    for i, (text, sites, calls) in enumerate(CONTACTS):
        mine = sorted((r for r in got if r.i == i), key=lambda r: r.pos)
        assert [r.value for r in mine if r.kind == "website"] == sites == [r.url for r in sorted(urls, key=lambda r: r.pos) if r.i == i], text
        assert [r.value for r in mine if r.kind == "phone"] == calls, text
