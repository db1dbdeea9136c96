"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorscope.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TOKENIZERS: dict[str, str] = {}  # file name -> path; a name that isn't here is looked up in the public package


def tokenizer_path(name: str) -> str:
    if name in TOKENIZERS:
        return TOKENIZERS[name]
    import public_tokenizers

    return str(public_tokenizers.path(name))


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of all documents: 4-word shingles, links at 4 bits or fewer."""
    from vendorscope.llm.simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@register
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all whole documents under the 32k piece model, with the 4096-token limit."""
    from vendorscope.llm.tokens import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), limit=4096)


@register
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed along a Hilbert curve into sequences of 2048 ids; one row per piece."""
    from vendorscope.llm.packing import digests, pack

    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), length=2048, end=1)
    return digests(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3 (repeating), at most 3 times each."""
    from vendorscope.llm.mixing import with_copies

    mixed = with_copies(table(spark, sf_dir, "documents"), weights=(1.0, 2.0, 3.0), most=3.0,
                        columns=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@register
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by trigram mixtures, learned from the documents that aren't held out."""
    from vendorscope.llm.langid import held_out, identified, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()))
    found = identified(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@register
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that repeated 35-word windows cover, removed; digest of what is kept."""
    from vendorscope.llm.substrings import removed_counts

    return removed_counts(table(spark, sf_dir, "documents"), window=35)


from vendorscope.llm.mixing import ORACLE as _MIXING  # noqa: E402

ORACLES["op5_mixing"] = _MIXING
ORACLES["op10_substrings"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT r, p, array_to_string(w[p:p + 34], ' ') AS t
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
m AS (SELECT t FROM s GROUP BY t HAVING count(*) > 1),
c AS (SELECT DISTINCT r, p + k AS p FROM (SELECT r, p FROM s SEMI JOIN m USING (t)), range(0, 35) AS o(k)),
g AS (SELECT r, list(p) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                   ELSE array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(gone, i)], ' ') END)
         AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""


@register
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records (equal payloads once) and read back from the archives."""
    from vendorscope.llm.archives import page_records, page_summary, write_archive
    from vendorscope.sources.io import work_path

    pages = table(spark, sf_dir, "pages")
    return page_summary(spark, write_archive(page_records(pages), work_path(spark, "warc")))


ORACLES["op8_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> original THEN original END AS refers_to
FROM g
"""


@register
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found by cosine of every embedding whose id is divisible by 50, on an NN-descent graph of all."""
    from vendorscope.llm.ann import neighbours

    rows = table(spark, sf_dir, "embeddings")
    return neighbours(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


@register
def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best rows by integer inner product of every embedding whose id is divisible by 50, exact."""
    from vendorscope.llm.topk import top_k

    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


ORACLES["op7_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(256.0::DOUBLE * x::DOUBLE)::BIGINT FOR x IN embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x::DOUBLE[], c.x::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@register
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of all documents: family, calibrated probability and cover of the nearest template."""
    from vendorscope.llm.licenses import license_lines, train

    docs = table(spark, sf_dir, "documents")
    found = license_lines(docs, train(docs))
    return found.select("doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"),
                        F.round("cover", 6).alias("cover"))


@register
def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by four rules on hosts and paths."""
    from vendorscope.llm.urls import judged

    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
                                   ("org", "/fr/", "allow")], "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op11_urls"] = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                      ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT max_by(h || p, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT max_by(v, length(h || p)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
                'allow') AS verdict
FROM u
"""


@register
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged by rule, and the cheapest edits that restore the order of roles."""
    from vendorscope.llm.common import saved
    from vendorscope.llm.repair import damaged, digests, summaries

    given = table(spark, sf_dir, "conversations")
    rows = damaged(given)
    found = digests(rows, saved(summaries(rows), "edits")).withColumnRenamed("conv_id", "_id")
    every = given.select("conv_id").distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@register
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling groups of all words of six letters or more that stand five times in the documents."""
    from vendorscope.llm.spelling import variants

    return variants(table(spark, sf_dir, "documents"))


# crc32 by its rule: a table of 256 remainders, then one step per UTF-8 byte (letters beyond ASCII are C3 and their code less 64).
ORACLES["op13_spelling"] = r"""
WITH RECURSIVE remainders AS (
  SELECT list(list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END, i::BIGINT)
              ORDER BY i) AS t FROM range(256) AS x(i)),
runs AS (
  SELECT id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS r
        FROM documents) GROUP BY ALL),
coded AS (
  SELECT w, n, flatten([CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END
                        FOR c IN string_split(id || ':' || w, '')]) AS bytes FROM runs),
hashed AS (
  SELECT w, n, xor(list_reduce(bytes, lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM coded, remainders),
v AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM v)),
shorter AS (SELECT DISTINCT c.word AS a, v.word AS b FROM cuts c JOIN v ON c.rest = v.word),
near AS (
  SELECT DISTINCT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.p = y.p AND x.rest = y.rest AND x.word <> y.word
  UNION ALL SELECT a, b FROM shorter UNION ALL SELECT b, a FROM shorter),
best AS (
  SELECT a, count(*) AS n_near, arg_min(b, (-v.n, b)) AS b, max(v.n) AS n FROM near JOIN v ON v.word = near.b GROUP BY a),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best.n >= 5 * v.n THEN b END AS form,
         CASE WHEN best.n >= 5 * v.n THEN best.n END AS form_n
  FROM v LEFT JOIN best ON best.a = v.word),
chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
