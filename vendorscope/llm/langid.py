"""Language identification by mixture inference.

A document's character trigrams (letters in lower case, everything else a boundary) are
taken as drawn from a mixture of the languages' trigram distributions.
Expectation-maximisation estimates the proportions; the set of languages is the one
with the largest penalised likelihood, found by dropping the smallest proportion as
long as the likelihood loses less than the penalty of one language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendorscope.llm.common import packed, rows, unpacked

BUCKETS = 1 << 16
SMOOTH = 0.05          # added to every trigram's count
PENALTY = 0.02         # of one more language: so much of the trigrams, and the BIC term
UNKNOWN = "und"
SPREAD = 5.0           # standard deviations that a known text's likelihood per trigram may lie below its language's mean


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])


def trigrams(text: str | None) -> np.ndarray:
    """Buckets (uint16) of a text's trigrams; empty if it has no letter."""
    if not text:
        return np.zeros(0, np.uint16)
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(letters()[code], code, 0).astype(np.uint64)
    code = np.concatenate([[np.uint64(0)], code, [np.uint64(0)]])
    code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]  # one boundary between words
    if len(code) < 3:
        return np.zeros(0, np.uint16)
    a, b, c = code[:-2], code[1:-1], code[2:]
    a, b, c = (x[(b != 0)] for x in (a, b, c))  # a word's trigrams have a letter in the middle
    x = (a << np.uint64(42)) ^ (b << np.uint64(21)) ^ c
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)


@dataclass(frozen=True)
class Model:
    """Trigram distributions of the learned languages; bounded by buckets x languages."""

    names: tuple[str, ...]
    p: np.ndarray          # buckets x languages
    total: np.ndarray | None = None   # smoothed count of all trigrams per language

    def known(self, text: str | None, proportions: dict[str, float], levels: dict[str, tuple[float, float, float]]) -> bool:
        """Whether the text's mean log-likelihood under ``proportions`` is one that texts of these languages have.

        ``levels``: see ``levels``. A language without a level accepts what it wins.
        """
        if not proportions or any(k not in levels for k in proportions):
            return bool(proportions)
        x = trigrams(text)
        share = np.array(list(proportions.values()))
        p = self.p[:, [self.names.index(k) for k in proportions]][x] @ share
        mean, between, within = share @ np.array([levels[k] for k in proportions])
        return bool(np.log(p).mean() >= mean - SPREAD * np.hypot(between, within / np.sqrt(len(x))))

    def predict(self, text: str | None, rounds: int = 60) -> tuple[str, float, dict[str, float]]:
        """Main language, its proportion, and the proportions of the selected set."""
        x = trigrams(text)
        if not len(x) or not self.names:
            return UNKNOWN, 0.0, {}
        x, n = np.unique(x, return_counts=True)
        p, total = self.p[x], n.sum()
        single = n @ np.log(p)
        best = int(single.argmax())
        charge = PENALTY * total + 0.5 * np.log(total)
        chosen = np.arange(len(self.names))
        share, like = mixture(p, n, rounds)
        while len(chosen) > 2:
            if like - single[best] <= charge:  # the whole set gains less than one language costs
                break
            keep = np.delete(np.arange(len(chosen)), share.argmin())
            less, less_like = mixture(p[:, chosen[keep]], n, rounds)
            if like - less_like > charge:
                break
            chosen, share, like = chosen[keep], less, less_like
        if like - single[best] <= charge * (len(chosen) - 1):
            return self.names[best], 1.0, {self.names[best]: 1.0}
        top = int(share.argmax())
        return self.names[chosen[top]], float(min(1.0, share[top])), {
            self.names[c]: float(s) for c, s in zip(chosen, share)}


def mixture(p: np.ndarray, n: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood by expectation-maximisation from equal shares."""
    share = np.full(p.shape[1], 1 / p.shape[1])
    total = n.sum()
    for _ in range(rounds):
        seen = p @ share
        new = share * ((n / seen) @ p) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share / share.sum(), float(n @ np.log(p @ share))


def held_out(doc_id):
    """crc32 of the id as text, modulo 4, is 2; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, per_language: int = 4000, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trigram counts per language over a sample of about ``per_language`` texts of each.

    The sample takes texts by a hash of the text, at a rate of ``per_language`` over the language's number of
    texts; smaller languages are used whole. Rows with a null text or language are left out.
    """
    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return Model((), np.zeros((BUCKETS, 0)))
    names = tuple(sorted(sizes))
    rate = F.create_map(*[F.lit(v) for k in names for v in (k, min(1.0, per_language / sizes[k]))])
    chance = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.where(chance < rate[F.col("lang")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in rows(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                counts[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at])], names=["lang", "bucket", "n"])

    sums = (sample.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket")
            .agg(F.sum("n").alias("n")).toArrow())  # at most languages x buckets rows
    table = np.full((BUCKETS, len(names)), SMOOTH)
    column = {k: i for i, k in enumerate(names)}
    np.add.at(table, (sums["bucket"].to_numpy(), [column[x] for x in sums["lang"].to_pylist()]), sums["n"].to_numpy())
    return Model(names, table / table.sum(axis=0), table.sum(axis=0))


def levels(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang") -> dict[str, tuple[float, float, float]]:
    """Per language: mean over its texts of the mean log-likelihood of a text's trigrams, the deviation between texts
    and the deviation within a text.

    A text is scored by its language without the text's own counts, so that a learned text is like a new one; texts that
    training's sample left out are scored so too, which lowers them a little. All texts of ``docs`` are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        column = {k: i for i, k in enumerate(m.names)}
        sums: dict[str, np.ndarray] = {}
        for b in rows(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                x, n = np.unique(trigrams(text), return_counts=True)
                if not len(x) or lang not in column:
                    continue
                i, size = column[lang], n.sum()
                left = np.maximum(m.p[x, i] * m.total[i] - n, SMOOTH) / max(m.total[i] - size, SMOOTH * BUCKETS)
                like = np.log(left)
                mean = n @ like / size
                sums[lang] = sums.get(lang, np.zeros(4)) + [1, mean, mean * mean, n @ (like - mean) ** 2 / size]
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), *[pa.array([v[j] for v in sums.values()]) for j in range(4)]],
                                             names=["lang", "n", "s", "ss", "v"])

    labelled = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    found = (labelled.mapInArrow(measured, "lang string, n double, s double, ss double, v double").groupBy("lang")
             .agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss", "v")]).collect())  # one row per language
    return {r.lang: (r.s / r.n, max(0.0, r.ss / r.n - (r.s / r.n) ** 2) ** 0.5, (r.v / r.n) ** 0.5) for r in found}


def identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the main language's proportion) and ``proportions``.

    Reads whole texts and nothing else. Null texts, texts without a letter, and every text
    if no language was learned: ``und``, 0.0 and an empty map. Repeated rows give repeated rows, an empty
    table an empty one; other columns come through untouched (columns of the three names are replaced).
    Row-local. The model is broadcast: 512 KB per learned language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in rows(batches):
            got = [m.predict(t) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([list(g[2].items()) for g in got], pa.map_(pa.string(), pa.float64()))],
                names=[*b.schema.names, "lang_pred", "score", "proportions"])

    own = docs.drop("lang_pred", "score", "proportions")
    own = packed(own, text_col)
    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
            T.StructField("proportions", T.MapType(T.StringType(), T.DoubleType()))]
    out = own.mapInArrow(predicted, T.StructType([*own.schema.fields, *made]))
    return unpacked(out, [c for c in docs.columns if c not in ("lang_pred", "score", "proportions")], *(f.name for f in made))


def accepted(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents with a known language that makes up at least ``least`` of them.

    Learns from the texts and languages of ``docs`` that are not held out. A text that its languages fit far worse
    than their own texts (see ``Model.known``) is in a language that was not learned. If
    nothing can be learned, only texts without a letter are rejected. Null, empty and letterless texts go; repeated rows are judged alike;
    other columns stay with their row, whatever their names and types; an empty table gives an empty one.
    """
    learned = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    model = train(learned)
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast((model, levels(learned, model)))

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, usual = shared.value
        for b in rows(batches):
            keep = []
            for text in b.column("text").to_pylist():
                name, score, parts = m.predict(text)
                keep.append(name != UNKNOWN and score >= least and m.known(text, parts, usual))
            yield b.filter(pa.array(keep, pa.bool_()))

    own = packed(docs, "doc_id", "text")
    return unpacked(own.mapInArrow(fitting, own.schema), docs.columns)
