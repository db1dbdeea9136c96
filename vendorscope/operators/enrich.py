"""Prompt building, completions and JSON clean-up (PRJ-13/14, JOIN-3/6, UDF-1, JSN-1..4, AGG-5).

The prompt template is split once on the driver (it is a constant) and
filled with one ``concat`` per row: a single pass, so text that contains
``$city`` is never re-expanded. Completions arrive as a table joined on the
prompt hash, or from a user function run with ``mapInPandas`` over the
distinct prompts only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vendorscope import fixed
from vendorscope.functions import text as T
from vendorscope.operators.pages import fence
from vendorscope.sources import catalogue as C


def prompt_template(platform: str = fixed.PROMPT_PLATFORM) -> str:
    """The extraction prompt text with the platform name set."""
    return fixed.PROMPT_TEMPLATE.replace("<<platform>>", platform)


def template_pieces(template: str | None = None) -> list:
    """Literal text and ``("slot",)`` markers of a ``$name`` template, in order."""
    template = prompt_template() if template is None else template
    out, pos = [], 0
    for m in re.finditer(r"\$(\w+)", template):
        out.append(template[pos:m.start()])
        out.append((m.group(1),))
        pos = m.end()
    out.append(template[pos:])
    return out


def fill_template(slots: dict[str, Column], template: str | None = None) -> Column:
    """PRJ-13: single-pass substitution; a null slot renders as ``None``."""
    parts = [T.py_str(slots[p[0]]) if isinstance(p, tuple) else F.lit(p) for p in template_pieces(template)]
    return F.concat(*parts)


def build_prompts(df: DataFrame, content: str = "combined_text", category: str = C.DEFAULT_CATEGORY,
                  name: str = "name", city: str = "city", state: str = "state",
                  platform: str = fixed.PROMPT_PLATFORM, model: Column | None = None) -> DataFrame:
    """PRJ-13 + JOIN-3: prompt per vendor with its SHA-256 key; the output model of ``category``, or the column ``model``."""
    if model is None:
        model = F.lit(C.output_model_text(category) if category in fixed.OUTPUT_MODELS else None).cast("string")
    prompt = fill_template({"vendor_name": F.col(name), "city": F.col(city), "state": F.col(state),
                            "content": F.col(content), "output_format": model}, prompt_template(platform))
    return df.withColumn("prompt", prompt).withColumn("prompt_sha", F.sha2(F.col("prompt"), 256))


def attach_completions(prompts: DataFrame, completions: DataFrame, on: str | list[str] = "prompt_sha") -> DataFrame:
    """JOIN-6: left join of completions (``raw``); a vendor without one keeps its row."""
    return prompts.join(completions, on, "left")


# Prompts that a user function gets at once: prompts are long, so a batch of Spark's is handed over in small parts.
CALL_ROWS = 256


def _calls(batches: Iterator[pa.RecordBatch], rows: int = CALL_ROWS) -> Iterator[pd.DataFrame]:
    """The rows of Arrow batches as small pandas frames: only these, not a whole batch, are held as Python strings."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows).to_pandas()


def enrich_with(prompts: DataFrame, fn: Callable[[pd.Series], pd.Series], prompt: str = "prompt") -> DataFrame:
    """UDF-1: run a user function (batch of at most ``CALL_ROWS`` prompts -> batch of completions) once per distinct prompt.

    Prompts are de-duplicated by hash before the Python stage, so repeated
    prompts cost one call; the result joins back with ``attach_completions``.
    """
    distinct = prompts.select(F.sha2(F.col(prompt), 256).alias("prompt_sha"), F.col(prompt).alias("_p")) \
        .dropDuplicates(["prompt_sha"])

    kind = pa.schema([("prompt_sha", pa.string()), ("raw", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _calls(batches):
            done = pd.DataFrame({"prompt_sha": b["prompt_sha"], "raw": fn(b["_p"]).astype(object)})
            yield pa.RecordBatch.from_pandas(done, kind, preserve_index=False)

    return distinct.mapInArrow(run, "prompt_sha string, raw string")


STORE = "prompt_sha string, raw string, error string"


def enrich_into(prompts: DataFrame, fn: Callable[[pd.Series], pd.Series], store: str, prompt: str = "prompt",
                retry_failed: bool = False, waves: int = 8) -> DataFrame:
    """UDF-1, resumable: completions of distinct prompts, kept in ``store`` (a shared folder) under the prompt's SHA-256.

    Prompts that the store knows are not asked again, so a run that was ended goes on where it stopped: prompts are asked in ``waves``
    by their hash, and each wave is appended when it is done. A batch on which ``fn`` fails is asked prompt by prompt; a prompt
    that fails alone gets a row with its ``error``, which later runs leave alone unless ``retry_failed``. Output: prompt_sha, raw, error
    of the given prompts.
    """
    spark = prompts.sparkSession
    spark.createDataFrame([], STORE).write.mode("append").parquet(store)
    asked = prompts.select(F.sha2(F.col(prompt), 256).alias("prompt_sha"), F.col(prompt).alias("_p")).dropDuplicates(["prompt_sha"])

    def one(text: str) -> tuple:
        try:
            return fn(pd.Series([text])).iloc[0], None
        except Exception as e:  # noqa: BLE001 - recorded with the prompt
            return None, f"{type(e).__name__}: {e}"

    kind = pa.schema([(c, pa.string()) for c in ("prompt_sha", "raw", "error")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _calls(batches):
            try:
                rows = [(r, None) for r in fn(b["_p"])]
            except Exception:  # noqa: BLE001 - find the prompts that fail
                rows = [one(p) for p in b["_p"]]
            done = pd.DataFrame({"prompt_sha": b["prompt_sha"], "raw": pd.Series([r for r, _ in rows], dtype=object, index=b.index),
                                 "error": pd.Series([e for _, e in rows], dtype=object, index=b.index)})
            yield pa.RecordBatch.from_pandas(done, kind, preserve_index=False)

    def known() -> DataFrame:
        # Of a prompt asked again after a failure the answer counts.
        rows = spark.read.schema(STORE).parquet(store)
        return rows.groupBy("prompt_sha").agg(F.max("raw").alias("raw"), F.min("error").alias("error")).select(
            "prompt_sha", "raw", F.when(F.col("raw").isNull(), F.col("error")).alias("error"))

    for wave in range(waves):
        done = known().where(F.col("error").isNull()) if retry_failed else known()
        mine = asked.where(F.pmod(F.xxhash64("prompt_sha"), F.lit(waves)) == wave).join(done.select("prompt_sha"), "prompt_sha", "left_anti")
        mine.mapInArrow(run, STORE).write.mode("append").parquet(store)
    return known().join(asked.select("prompt_sha"), "prompt_sha", "left_semi")


# One JSON token: a string, a sign, white space, or a number or word.
JSON_TOKEN = r'(?s)"(?:[^"\\]++|\\.)*+"|[{}\[\]:,]|\s++|[^"{}\[\]:,\s]++|"'
# The words for numbers that a completion may hold; read as null where only validity matters.
JSON_WORDS = r"(?<![^:,\[\s])-?(?:NaN|Infinity)(?![^\s,}\]])"
# Every token of JSON, nothing but tokens, to the end: double-quoted strings without raw control characters, numbers without leading
# zeros, the known words. What order they may come in is the parser's to check.
JSON_TOKENS = (r'\A(?:[ \t\n\r]++|[{}\[\]:,]|"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*+"'
               r"|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?|true|false|null|-?Infinity|NaN)*+\z")


def is_json(raw: Column) -> Column:
    """Whether the whole text is one JSON value by the strict grammar; repeated keys, NaN and Infinity are allowed, text after the value isn't.

    SQL's JSON functions are lenient about tokens (single quotes, raw line breaks in strings), so the tokens are checked first, and
    stop at the end of the first value: inside ``[...]`` and inside ``{"v":...}`` anything behind
    it breaks the syntax of one of the two or makes a second element.
    """
    text = F.when(raw.contains("NaN") | raw.contains("Infinity"), F.regexp_replace(raw, JSON_WORDS, "null")).otherwise(raw)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("\n]"))) == 1
    value = F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("\n}"))).isNotNull()
    return F.coalesce(F.when(raw.rlike(JSON_TOKENS), alone & value), F.lit(False))


def json_status(raw: Column) -> Column:
    """JSN-1: ``missing`` / ``invalid`` / ``not_object`` / ``ok``."""
    first = F.substring(T.strip_ws(raw), 1, 1)
    return (F.when(raw.isNull(), "missing").when(~is_json(raw), "invalid")
            .when(first != "{", "not_object").otherwise("ok"))


# Of an object: what stands up to the value of its last "sources", and that value if it is a list (without lists inside).
FLAT_SOURCES = r'(?s)\A(.*"sources"[ \t\n\r]*:[ \t\n\r]*)(\[(?:[^"\]]++|"(?:[^"\\]++|\\.)*+")*+\])?'


def sources_span(tokens: Column) -> Column:
    """Struct (s, f): 0-based places of the brackets of the list under the top-level key ``sources``, -1 if it isn't a list.

    One pass over the tokens with a state of fixed size: nesting depth, whether a key is expected, and how much
    of ``"sources" : [`` was just read. Of repeated keys the last counts.
    """
    def pick(**cols: Column) -> Column:
        return F.struct(*[c.alias(n) for n, c in cols.items()])

    def step(st: Column, t: Column) -> Column:
        blank, top = t.rlike(r"^\s"), st["d"] == 1
        key = top & st["e"] & (t == '"sources"')
        begins = top & (st["k"] == 2) & (t == "[")
        ends = (st["d"] == 2) & st["o"] & (t == "]")
        return pick(
            i=st["i"] + 1,
            d=st["d"] + F.when(t.isin("{", "["), 1).when(t.isin("}", "]"), -1).otherwise(0),
            k=F.when(blank, st["k"]).when(key, 1).when(top & (st["k"] == 1) & (t == ":"), 2).otherwise(0),
            e=F.when(blank, st["e"]).otherwise(((t == "{") & (st["d"] == 0)) | ((t == ",") & top)),
            o=F.when(begins, True).when(ends, False).otherwise(st["o"]),
            s=F.when(key, -1).when(begins, st["i"]).otherwise(st["s"]),
            f=F.when(key, -1).when(ends, st["i"]).otherwise(st["f"]))

    zero = pick(i=F.lit(0), d=F.lit(0), k=F.lit(0), e=F.lit(False), o=F.lit(False), s=F.lit(-1), f=F.lit(-1))
    return F.aggregate(tokens, zero, step, lambda st: pick(s=st["s"], f=st["f"]))


def with_sources(df: DataFrame, raw: str = "raw", blacklist: list[str] = fixed.INVALID_SOURCES) -> DataFrame:
    """JSN-2: ``df`` with ``parse_status``, ``sources`` (kept items as text; null when not a list) and ``cleaned``.

    ``cleaned`` is the completion with the blacklisted items (stripped, lower-cased) cut from the top-level ``sources``
    list and everything else as it was: order, extra keys, spelling of values. Text that is no JSON object, or has no such
    list, passes through unchanged. Each step is computed once, behind a fence.
    """
    staged = fence(df.select("*", json_status(F.col(raw)).alias("parse_status")))
    may = (F.col("parse_status") == "ok") & F.col(raw).contains('"sources"')
    # In an object without others inside, the last ``"sources" :`` is the key (within strings quotes are escaped), so its list can be cut out
    # by a pattern unless lists are nested; anything else is read token by token.
    flat = may & (F.length(raw) - F.length(F.replace(F.col(raw), F.lit("{"), F.lit(""))) == 1)
    staged = fence(staged.select("*", F.when(flat, F.regexp_extract(raw, FLAT_SOURCES, 1)).alias("_a"),
                                 F.when(flat, F.regexp_extract(raw, FLAT_SOURCES, 2)).alias("_l0"), may.alias("_may")))
    plain = F.col("_a").isNotNull() & ~F.col("_l0").substr(2, 1 << 30).contains("[")
    staged = fence(staged.select("*", plain.alias("_flat")).select(
        "*", F.when(F.col("_may") & ~F.col("_flat"), F.regexp_extract_all(F.col(raw), F.lit(JSON_TOKEN), 0)).alias("_t")))
    staged = fence(staged.select("*", sources_span(F.col("_t")).alias("_p")))
    s, f, n = F.col("_p.s"), F.col("_p.f"), F.size("_t")
    listed_at = (s >= 0) & (f > s)
    before = F.when(F.col("_flat"), F.col("_a")).otherwise(F.array_join(F.slice("_t", F.lit(1), F.greatest(s, F.lit(0))), ""))
    inside = F.when(F.col("_flat"), F.nullif("_l0", F.lit(""))).when(listed_at, F.array_join(F.slice("_t", s + 1, f - s + 1), ""))
    staged = fence(staged.select("*", before.alias("_b"), inside.alias("_l")))
    bl = F.array(*[F.lit(b) for b in blacklist])

    def listed(x: Column) -> Column:
        return F.array_contains(bl, F.lower(T.strip_ws(F.coalesce(x, F.lit("None")))))

    items = F.from_json("_l", "array<string>")
    # Items keep their JSON type: the variants are cut by the places of the kept texts.
    parts = F.try_variant_get(F.try_parse_json("_l"), "$", "array<variant>")
    kept = F.filter(parts, lambda x, i: ~listed(F.get(items, i)))
    text = F.when(F.exists(items, listed), F.coalesce(F.to_json(kept), F.col("_l"))).otherwise(F.col("_l"))
    after = F.when(F.col("_flat"), F.substr(F.col(raw), F.length("_b") + F.length("_l") + 1)).otherwise(
        F.array_join(F.slice("_t", f + 2, F.greatest(n - f - 1, F.lit(0))), ""))
    joined = F.concat("_b", text, after)
    return staged.select(*[c for c in df.columns if c not in ("parse_status", "sources", "cleaned")], "parse_status",
                         F.filter(items, lambda x: ~listed(x)).alias("sources"),
                         F.when(F.col("_l").isNotNull(), joined).otherwise(F.col(raw)).alias("cleaned"))


def profile_record(df: DataFrame, raw: str = "raw", category: str = C.DEFAULT_CATEGORY) -> DataFrame:
    """JSN-3/4: the output model's fields beside the cleaned completion.

    Fields have ``""`` / ``[]`` defaults, and these too where the value's type isn't the field's; ``sources`` is the JSN-2
    list. ``profile_json`` is the cleaned completion text, so extra keys, their order and values of other types are kept;
    text that is no JSON object passes through. ``extra_keys`` names the keys outside the model.
    """
    schema = C.output_schema(category)
    base = [c for c in df.columns if c not in ("sources", "cleaned")]
    staged = with_sources(df, raw)
    ok = F.col("parse_status") == "ok"
    model = F.array(*[F.lit(f) for f, _ in C.output_fields(category)])
    staged = fence(staged.select(
        *base, "parse_status", "cleaned", F.col("sources").alias("_src"), F.when(ok, F.from_json(F.col(raw), schema)).alias("_rec"),
        F.when(ok, F.array_except(F.json_object_keys(F.col(raw)), model)).alias("extra_keys")))
    cols = []
    for f, kind in C.output_fields(category):
        if f == "sources":
            val = F.coalesce(F.col("_src"), F.array().cast("array<string>"))
        elif kind == "string":
            val = F.coalesce(F.col("_rec")[f], F.lit(""))
        else:
            val = F.coalesce(F.col("_rec")[f], F.array().cast("array<string>"))
        cols.append(val.alias(f))
    return staged.select(*base, *cols, "extra_keys", "parse_status", F.col("cleaned").alias("profile_json"))


def text_lengths(df: DataFrame, prompt: str = "prompt", result: str = "raw") -> DataFrame:
    """PRJ-14: prompt and result lengths in characters."""
    return df.withColumn("prompt_chars", F.length(F.col(prompt)).cast("bigint")) \
        .withColumn("result_chars", F.coalesce(F.length(F.col(result)), F.lit(0)).cast("bigint"))


def observed(df: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """AGG-5 within the main pass: ``df`` unchanged, and an observation that holds the run's metrics once ``df`` was written.

    Metrics: n_vendors, n_completed, prompt_chars, result_chars. They are counted where the rows pass, without a second scan.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("n_vendors"), F.count("raw").alias("n_completed"),
                      F.coalesce(F.sum(F.length("prompt")), F.lit(0)).cast("bigint").alias("prompt_chars"),
                      F.coalesce(F.sum(F.length("raw")), F.lit(0)).cast("bigint").alias("result_chars")), seen


def run_metrics(df: DataFrame, by: list[str]) -> DataFrame:
    """AGG-5: vendors, completions and character volumes per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n_vendors"),
        F.count("raw").alias("n_completed"),
        F.sum("prompt_chars").cast("bigint").alias("prompt_chars"),
        F.sum("result_chars").cast("bigint").alias("result_chars"))

