"""Readers for the driver tables and the inputs derived from them.

Every derived input is a lazy DataFrame over the parquet tables, so column
pruning and filters reach the scans, and its size grows with the tables.
Only ``nation`` and ``region`` (fixed 25 / 5 rows) are ever broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tasks that text-heavy tables are dealt into; unset (the default on a cluster), the scan's own splits are kept.
TEXT_TASKS = "spark.vendorscope.textTasks"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_text(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan of the named columns of a table feeding CPU-heavy text work.

    The session setting ``spark.vendorscope.textTasks`` deals the rows into that many tasks; ``build_session`` sets it to the number
    of cores of a local master, and to nothing on a cluster. Without it nothing is shuffled, whatever the input's size.
    """
    return dealt(read_table(spark, sf_dir, name).select(*columns))


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in as many tasks as the session's ``TEXT_TASKS`` says; as it is where that is unset."""
    tasks = df.sparkSession.conf.get(TEXT_TASKS, None)
    return df.repartition(int(tasks)) if tasks else df


# Tasks per core that a narrow table is dealt into where much is made of each of its rows.
TASKS_A_CORE = 4


def read_narrow(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan of a few short columns that long texts, or many rows, are made from.

    Such a table is small beside what is made of it: its scan has few splits, and one row group, which no scan can cut, may hold
    millions of rows. So its rows are always dealt: into ``TEXT_TASKS`` where that is set, else into as many tasks as the scan has splits
    and at least ``TASKS_A_CORE`` for each core. Only the named columns are shuffled.
    """
    df = read_table(spark, sf_dir, name).select(*columns)
    if spark.conf.get(TEXT_TASKS, None):
        return dealt(df)
    return df.repartition(max(df.rdd.getNumPartitions(), TASKS_A_CORE * spark.sparkContext.defaultParallelism))


def pages(spark, sf_dir) -> DataFrame:
    """Raw web pages: page_id, url, html."""
    return read_text(spark, sf_dir, "pages", "page_id", "url", "html")


def _geo(spark, sf_dir) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # Fixed-size dimensions (25 and 5 rows): broadcast is bounded.
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)


def vendors(spark, sf_dir) -> DataFrame:
    """Clean vendors: id, name, city, state, category (one per customer)."""
    c = read_narrow(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    g = _geo(spark, sf_dir)
    return (c.join(F.broadcast(g), c.c_nationkey == g.n_nationkey)
            .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                    F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                    F.col("c_mktsegment").alias("category")))


def raw_vendors(spark, sf_dir) -> DataFrame:
    """Raw vendor export, all strings, with dirty ids, null names and slug collisions."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    ks = key.cast("string")
    rid = (F.when(key % 10 == 0, F.concat(F.lit("x"), ks))
           .when(key % 10 == 1, F.concat(F.lit(" "), ks, F.lit(" ")))
           .when(key % 10 == 2, F.concat(F.lit("00"), ks))
           .otherwise(ks))
    name = (F.when(key % 50 == 0, F.lit(None).cast("string"))
            .when(key % 7 == 0, F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("  (events) ")))
            .otherwise(F.col("c_name")))
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .select(key.alias("c_custkey"), rid.alias("id"), name.alias("name"),
                    F.col("n_name").alias("city_name"), F.lit("IN").alias("state_name")))


def question_answers(spark, sf_dir) -> DataFrame:
    """User turns with the following assistant turn: conv_id, turn, question, answer."""
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    q = conv.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    a = conv.where(F.col("role") == "assistant").select(
        F.col("conv_id").alias("a_conv"), (F.col("turn") - 1).alias("a_turn"), F.col("text").alias("answer"))
    return dealt(q.join(a, (q.conv_id == a.a_conv) & (q.turn == a.a_turn), "left")
                 .select("conv_id", "turn", "question", "answer"))


def _esc(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def answer_pages(spark, sf_dir) -> DataFrame:
    """AI-answer pages built around each question/answer turn: conv_id, turn, html, question."""
    qa = question_answers(spark, sf_dir)
    lead = F.when(F.col("conv_id") % 4 == 0, F.lit("Menu")).otherwise(F.lit("You said:"))
    table = F.when(F.col("conv_id") % 3 == 1, F.concat(
        F.lit("<table><tr><th>Feature of</th><th>Turn</th></tr><tr><td>turn</td><td>"), F.col("turn").cast("string"),
        F.lit("</td></tr></table>"))).otherwise("")
    html = F.concat(
        F.lit('<div id="main"><style>p{}</style><div>'), lead,
        F.lit("</div><p>"), _esc(F.col("question")), F.lit("</p><div>Thinking</div><p>"),
        _esc(F.coalesce(F.col("answer"), F.lit("loading"))), F.lit("</p>"), table,
        F.lit('<script>var a="</p>";</script><div>All</div><div>AI can make mistakes</div><p>tail</p></div>'))
    return qa.select("conv_id", "turn", html.alias("html"), "question")


# Fetched pages: an answer page within a page of other things; some conversations' pages could not be fetched.
PAGE_TOP = '<html><body><div class="top"><p>You said:</p><p>outside</p></div>'
PAGE_FOOT = '<div class="kp-blk">short</div></body></html>'
FETCH_FAILS = "conv_id % 11 = 5"
FETCH_ERROR = "Timeout while waiting for the page"
FETCHED_AT = "2024-01-01 00:00:00"
# Snapshots of a fetched page: an early one that is still loading, then the page; late for some conversations.
EARLY_PAGE = '<html><body><div id="main"><p>Thinking about the question you asked</p><div>loading</div></div></body></html>'
LATE = "conv_id % 13 = 3"


def fetched_pages(spark, sf_dir) -> DataFrame:
    """Answer pages as fetched: conv_id, turn, question, html (null where fetching failed), ts, error."""
    fails = F.expr(FETCH_FAILS)
    ts = F.expr(f"timestamp_ntz'{FETCHED_AT}' + make_dt_interval(0, 0, CAST(conv_id AS INT), turn)")
    return answer_pages(spark, sf_dir).select(
        "conv_id", "turn", "question", F.when(~fails, F.concat(F.lit(PAGE_TOP), "html", F.lit(PAGE_FOOT))).alias("html"), ts.alias("ts"),
        F.when(fails, F.lit(FETCH_ERROR)).alias("error"))


def page_snapshots(spark, sf_dir) -> DataFrame:
    """Two snapshots of every fetched page, with the time its question was asked: conv_id, turn, question, asked_ts, ts, html, error."""
    p = fetched_pages(spark, sf_dir).withColumn("asked_ts", F.col("ts"))
    seconds = F.when(F.expr(LATE), F.lit(80)).otherwise(F.lit(30))
    shots = F.array(F.struct(F.col("ts").alias("ts"), F.lit(EARLY_PAGE).alias("html"), F.lit(None).cast("string").alias("error")),
                    F.struct((F.col("ts") + F.make_dt_interval(secs=seconds)).alias("ts"), "html", "error"))
    return p.select("conv_id", "turn", "question", "asked_ts", F.inline(shots))


# Search groups that the categories of vendors ask for (names of the fixed catalogue's groups).
CATEGORY_GROUPS = {
    "AUTOMOBILE": ["contact", "reviews", "pricing", "services"],
    "BUILDING": ["contact", "pricing"],
    "FURNITURE": ["reviews"],
    "HOUSEHOLD": ["services", "contact"],
    "MACHINERY": ["pricing", "reviews", "contact"],
}
# Of these, the categories with an output model: their groups' fields that the fixed model has, and the sources.
MODELLED = ("AUTOMOBILE", "BUILDING", "MACHINERY")


def category_models() -> tuple[dict, dict]:
    """Search groups and output models of the vendors' categories, made from the fixed catalogue."""
    from vendorscope import fixed
    groups = {g: (g, about, fields) for g, about, fields in fixed.SEARCH_MODELS["WEDDING_PLANNERS"]}
    models = {c: [groups[g] for g in names] for c, names in CATEGORY_GROUPS.items()}
    kinds = dict(fixed.OUTPUT_MODELS["WEDDING_PLANNERS"])
    outputs = {c: [(f, kinds[f]) for _, _, fields in models[c] for f in fields if f in kinds] + [("sources", "array")] for c in MODELLED}
    return models, outputs


def overview_pages(spark, sf_dir) -> DataFrame:
    """AI-overview pages built around each question/answer turn: page_id, html.

    The overview container (class ``Kevs9``) holds the question and the answer
    as leaf blocks, plus a link, a hidden span and a "Show more" line.
    """
    qa = question_answers(spark, sf_dir)
    html = F.concat(
        F.lit('<html><body><div id="main"><div class="Kevs9"><h2>AI Overview</h2><p>'), _esc(F.col("question")),
        F.lit("</p><ul><li>"), _esc(F.coalesce(F.col("answer"), F.lit(""))),
        F.lit('</li></ul><a href="#">source</a><span aria-hidden="true">hidden</span><p>Show more</p>'
              "</div></div></body></html>"))
    return qa.select((F.col("conv_id") * 100 + F.col("turn")).alias("page_id"), html.alias("html"))


def snapshots(spark, sf_dir) -> DataFrame:
    """Page snapshots per question: question_id, event_id, ts, asked_ts, answer.

    ``asked_ts`` is the first snapshot of the question: a partial-aggregated
    min joined back (skew-safe under AQE) rather than an unbounded window.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    asked = ev.groupBy("user_id").agg(F.min("ts").alias("asked_ts"))
    answer = F.when(F.col("event_type") == "error", F.lit("loading")).otherwise(
        F.rpad(F.concat(F.lit("answer "), F.col("event_type"), F.lit(" ")), 90, "x"))
    return (ev.join(asked, "user_id")
            .select(F.col("user_id").alias("question_id"), "event_id", "ts", "asked_ts", answer.alias("answer")))


# Table markup by part key modulo 4 (closed; a table within a cell; cells and a table left open; noise nested in a cell).
# {brand} and {type} stand for the part's columns; the rows beside each are what its tables read as.
TABLE_CASES = [
    ("<table><tr><th>Feature set</th><th>Value</th><th>Note</th></tr><tr><td>brand</td><td>{brand} IBM +4</td></tr><tr><td> </td></tr>"
     "<tr><td>type</td><td>{type}</td><td>a  b</td></tr></table>",
     [[["Feature", "Value", "Note"], ["brand", "{brand}"], ["type", "{type}", "a b"]]]),
    ("<div><table><tr><th>Outer</th><th>Inner</th></tr><tr><td>brand</td><td>{brand}<table><tr><td>k</td><td>{type}</td></tr>"
     "<tr><td></td></tr></table></td></tr><tr><td>last</td><td>z</td></tr></table></div>",
     [[["Outer", "Inner"], ["brand", "{brand} k {type}", "k", "{type}", ""], ["k", "{type}"], ["last", "z"]], [["k", "{type}"]]]),
    ("<div><table><tr><td>brand<td>{brand}</tr><tr><th>feature<td>{type}</table><table><tr><td>second</td></tr></table></div><p>after",
     [[["brand {brand}", "{brand}"], ["feature {type}", "{type}"]], [["second"]]]),
    ("<table><tr><th>FEATURES</th><th>Value</th></tr><tr><td>svg<svg><svg><svg>x</svg>y</svg><text>L1</text></svg></td>"
     "<td>{type}<noscript><table><tr><td>n</td></tr></table></noscript></td></tr></table><table><tr><td><script>t</script></td></tr></table>",
     [[["Feature", "Value"], ["svg", "{type}"]]]),
]


def _filled(template: str, **columns) -> "F.Column":
    """A template's text with its {names} replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[columns[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def _by_case(key, columns: list) -> "F.Column":
    """One of ``columns`` by the remainder of ``key``."""
    out = columns[-1]
    for i, c in reversed(list(enumerate(columns[:-1]))):
        out = F.when(key % len(columns) == i, c).otherwise(out)
    return out


def table_pages(spark, sf_dir) -> DataFrame:
    """HTML tables per part (``TABLE_CASES``: header rule, ragged and empty rows, source junk, nesting, open cells, noise)."""
    p = read_narrow(spark, sf_dir, "part", "p_partkey", "p_brand", "p_type")
    cases = [_filled(html, brand=F.col("p_brand"), type=F.col("p_type")) for html, _ in TABLE_CASES]
    return p.select(F.col("p_partkey").alias("page_id"), _by_case(F.col("p_partkey"), cases).alias("html"))


# Overview blocks appended to raw pages, by page id modulo 7: markup with the {url}, the container's place behind the first
# tag (None: not found) and how it is found from an h2 anchor.
_CARD = ('<h2>AI Over<b>view</b></h2><p>{url}</p><style>p</style><ul><li>page &amp; text</li></ul><a href="#">link</a>'
         '<span aria-hidden="true">hidden</span><div class="x citation"><p>badge</p></div><p>Show more</p><p>open one<p>open two')
OVERVIEW_CASES = [
    ("<div><div><div data-attrid='k'>" + _CARD + "</div></div></div>", 2, "climb"),
    ("<div><div data-attrid><div><div><div><div>" + _CARD + "</div></div></div></div></div></div>", 1, "climb"),
    ("<div><div data-attrid='far'><div><div><div><div><div>" + _CARD + "</div></div></div></div></div></div></div>", 1, "climb"),
    ("<div><div><svg><svg></svg></svg><div><div>" + _CARD + "</div></div></div></div>", 1, "climb"),
    ("<section><div><div>" + _CARD + "</div></div></section>", None, None),
    ("<section><p class='Kevs9'>no</p><div><div class='a Kevs9'>" + _CARD + "</div></div></section>", 5, "fallback"),
    ("<section><div><div class='AI_Overview-1'>" + _CARD + "</div></div></section>", 2, "fallback"),
]
PAGE_END = "</body></html>"


def overview_raw_pages(spark, sf_dir) -> DataFrame:
    """Raw pages with one of ``OVERVIEW_CASES`` at the end of their body: page_id, html."""
    p = pages(spark, sf_dir)
    cases = [_filled(html, url=_esc(F.col("url"))) for html, _, _ in OVERVIEW_CASES]
    return p.select("page_id", F.concat(F.regexp_replace("html", PAGE_END + r"\z", ""), _by_case(F.col("page_id"), cases),
                                        F.lit(PAGE_END)).alias("html"))


# Markup that ends a raw page, by page id modulo 7, and the page's status; None: the page was not fetched.
STATUS_CASES = [
    (None, "error"),
    ("<div id='captcha-form'>AI Overview</div>", "blocked"),
    ("<p>Our systems have detected unusual traffic</p>", "blocked"),
    ("<div>AI <i>Overview</i></div>", "container_unparsed"),
    ("<div class='Kevs9'><h3>AI&#32;Overview</h3><a><p>x</p></a><p>one <b>two</b></p></div>", "empty_text"),
    ("<div class='Kevs9'><h3>AI Overview</h3><p>one</p></div>", "ok"),
    ("<p>AI Overview outside of a heading</p>", "no_overview"),
]


def status_pages(spark, sf_dir) -> DataFrame:
    """Raw pages with one of ``STATUS_CASES`` at the end: page_id, html."""
    p = pages(spark, sf_dir)
    cases = [F.lit(None).cast("string") if html is None else F.concat("html", F.lit(html)) for html, _ in STATUS_CASES]
    return p.select("page_id", _by_case(F.col("page_id"), cases).alias("html"))


def fact_answers(spark, sf_dir) -> DataFrame:
    """Answer texts in the Parameter/Value/Source URL reply format, one per line item."""
    li = read_narrow(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    ln = F.col("l_linenumber")
    src = (F.when(ln % 3 == 0, F.lit("https://www.instagram.com/p"))
           .when(ln % 3 == 1, F.lit("https://www.facebook.com/p"))
           .when(F.col("l_suppkey") % 2 == 0, F.lit("https://site.example.com/pricing"))
           .otherwise(F.lit("https://site.example.com")))
    rating = (F.when(ln == 1, F.lit("Not Found"))
              .when(F.col("l_partkey") % 2 == 0, (F.col("l_partkey") % 5).cast("string"))
              .otherwise(ln.cast("string")))
    answer = F.concat(
        F.lit("Parameter: website Value: http://s"), F.col("l_suppkey").cast("string"),
        F.lit(".example.com Source URL: "), src, F.lit(" Parameter: rating Value: "), rating,
        F.when(ln % 4 != 0, F.lit(" Source URL: none")).otherwise(F.concat(
            F.lit(" Parameter: price_range Value: "), F.col("l_suppkey").cast("string"), F.lit(" Source URL: "), src,
            F.lit(" Parameter: services_offered Value: s"), (F.col("l_suppkey") % 3).cast("string"),
            F.lit(", common ,t"), (F.col("l_suppkey") % 4).cast("string"), F.lit(" Source URL: "), src,
            F.lit(" Parameter: address Value: "), F.col("l_suppkey").cast("string"), F.lit(" Main Road, Pune Source URL: "), src,
            F.lit(" Parameter: review_count Value: "), (F.col("l_partkey") % 900).cast("string"), F.lit(" Source URL: "), src)))
    return li.select(F.col("l_partkey").alias("vendor_id"), "l_orderkey", "l_linenumber", answer.alias("answer"))


def completions(spark, sf_dir) -> DataFrame:
    """Model completions per order: vendor_id, raw (valid, invalid, non-object, missing)."""
    o = read_text(spark, sf_dir, "orders", "o_orderkey")
    k = F.col("o_orderkey")
    raw = (F.when(k % 14 == 0, F.lit("not json"))
           .when(k % 14 == 7, F.lit('{"phone":"9","sources":["Overview"]}\n\nNote: done'))
           .when(k % 7 == 1, F.lit("[1]"))
           .when(k % 7 == 2, F.lit('{"phone":"","sources":"x"}'))
           .when(k % 7 == 3, F.lit(None).cast("string"))
           .otherwise(F.concat(
               F.lit('{"website":"http://o'), k.cast("string"),
               F.lit('.example","sources":["Overview"," JustDial ","Official Website",'
                     '"https://www.justdial.com/x"],"zz":1}'))))
    return o.select(k.alias("vendor_id"), raw.alias("raw"))


# Contact lines put behind documents, by document id modulo their number, and the contacts they state in order.
CONTACT_CASES = [
    ("Visit (https://a.example.com/b_(c)). Mail desk@a.example.org.", [("website", "https://a.example.com/b_(c)"), ("email", "desk@a.example.org")]),
    ("Seen 2024-05-06 12:30, 06/05/2024 and 2019 2020 2021; price 10 000 000.", []),
    ("Call +91 98765 43210, or (022) 2345-6789!", [("phone", "+91 98765 43210"), ("phone", "(022) 2345-6789")]),
    ("Posts: https://www.instagram.com/x_1/, https://fb.com/y; [https://m.facebook.com/z]",
     [("instagram", "https://www.instagram.com/x_1/"), ("facebook", "https://fb.com/y"), ("facebook", "https://m.facebook.com/z")]),
    ("Order 1234567890123456, part A9876543210 and v1.2.3.4567890; phone 9876543210.", [("phone", "9876543210")]),
    ("Office 080 2345 6789 / 555-123-4567 on 5-6-2024 9", [("phone", "080 2345 6789"), ("phone", "555-123-4567")]),
]


def contact_texts(spark, sf_dir) -> DataFrame:
    """Whole documents with one of ``CONTACT_CASES`` on a line of its own: doc_id, text."""
    d = documents(spark, sf_dir)
    cases = _by_case(F.col("doc_id"), [F.lit(text) for text, _ in CONTACT_CASES])
    return d.select("doc_id", F.concat("text", F.lit("\n"), cases).alias("text"))


def documents(spark, sf_dir) -> DataFrame:
    return read_text(spark, sf_dir, "documents", "doc_id", "text")


__all__ = ["read_table", "read_narrow", "pages", "vendors", "raw_vendors", "question_answers", "answer_pages", "fetched_pages", "page_snapshots",
           "category_models", "overview_pages",
           "snapshots", "table_pages", "overview_raw_pages", "status_pages", "fact_answers", "completions", "contact_texts", "documents"]
