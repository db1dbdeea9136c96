"""Substring dedup: windows of words that start more than once, found behind a count-min prefilter.

A window is ``window`` consecutive words of one document.

1. Every partition adds the *anchors* of its windows to a count-min sketch. The
   anchor of a window is its ``gram``-word run with the least hash (the leftmost
   of equals), so equal windows have equal anchors at the same place within them, and two
   places of one window give two places of its anchor. The merged sketch therefore never
   underestimates how often a window occurs; far fewer anchors than windows
   are counted. Partition sketches travel as sorted cell numbers (a cell at most
   twice) and are added up cell range by cell range.
2. Only windows whose anchor is estimated to occur twice are grouped exactly, by 128-bit hashes of their
   words. A window that does repeat is never left out, whatever the sketch's load; a fuller sketch only lets more in.
   Windows in copied stretches are grouped in runs first: window starts are cut where a hash of the following words
   says so, and a run of windows whose whole stretch of words occurs twice is settled by one row. The
   other windows are then grouped one by one, together with those of one copy of every settled run.
3. Documents with a repeated window are joined to their positions, and the covered words go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vendorscope.llm.common import packed, rows, saved, unpacked

SLICE_BITS = 16                       # cells of one slice of the sketch
MAX_CELL_BITS = 28                    # a sketch row has at most 2**28 cells: 32 MB as a bitmap
DEPTH = 3                             # rows of the sketch
CHARS_PER_CELL = 8                    # anchors are rarer than one in 50 characters of prose
RUN = 16                              # windows of a run, on average
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(h: np.ndarray, size: int, odd: int) -> np.ndarray:
    """Hash of each run of ``size`` neighbouring values: a polynomial modulo 2**64 by repeated doubling."""
    out, have, base = None, 0, h
    span, power, bit = 1, U(odd), 1
    while bit <= size:
        if size & bit:  # append a run of ``bit`` values to what is there
            if out is None:
                out, have = base, bit
            else:
                n = len(h) - have - bit + 1
                out, have = out[:n] * power + base[have:have + n], have + bit
        bit <<= 1
        if bit <= size:
            n = len(base) - span
            base = mixed(base[:n] * power + base[span:span + n])
            span, power = span * 2, U((int(power) * int(power)) % (1 << 64))
    return mixed(out)


def anchors(h: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each gram, position of each window's anchor) for a document of at least ``window`` words."""
    g = rolling(h, gram, ODD[2])
    wide = np.lib.stride_tricks.sliding_window_view(g, window - gram + 1)
    at = np.concatenate([wide[lo:lo + 65536].argmin(axis=1) for lo in range(0, len(wide), 65536)])
    return g, at + np.arange(len(wide))


def cells(g: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mixed(g ^ U(ODD[r] * 3 % (1 << 64))) >> U(64 - bits)).astype(np.uint32) for r in range(DEPTH)]


def sketch(docs: DataFrame, bits: int, window: int, gram: int, text_col: str) -> list[np.ndarray]:
    """Per row of the merged sketch, a bitmap of the cells counted at least twice (bounded: 2**bits bits)."""
    per_slice = min(SLICE_BITS, bits)

    def emitted(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for r, c in enumerate(cells(np.concatenate(parts), bits)):
            c.sort()
            keep = np.ones(len(c), bool)
            keep[2:] = c[2:] != c[:-2]  # a cell at most twice
            c = c[keep]
            number = c >> per_slice
            cut = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(c)]])
            low = (c & ((1 << per_slice) - 1)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [pa.array((number[cut[:-1]].astype(np.int64) * DEPTH + r).astype(np.int32)),
                 pa.array([low[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                names=["slice", "cells"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for b in rows(batches):
            for text in b.column(0).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                if len(words) < window:
                    continue
                g, at = anchors(word_hashes(words), window, gram)
                parts.append(g[np.unique(at)])
                n += len(parts[-1])
                if n >= 2_000_000:
                    yield from emitted(parts)
                    parts, n = [], 0
        if parts:
            yield from emitted(parts)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for b in rows(batches, 4096):
            for s, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                have = counts.setdefault(s, np.zeros(1 << per_slice, np.uint8))
                new = np.bincount(np.frombuffer(c, np.uint16), minlength=1 << per_slice)
                np.minimum(have + new, 2, out=have, casting="unsafe")
        for s, have in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([s], pa.int32()), pa.array([np.packbits(have >= 2, bitorder="little").tobytes()], pa.binary())],
                names=["slice", "cells"])

    form = "slice int, cells binary"
    twice = docs.select(text_col).mapInArrow(partial, form).repartition("slice").mapInArrow(merged, form)
    maps = [np.zeros((1 << bits) // 8 or 1, np.uint8) for _ in range(DEPTH)]
    wide = (1 << per_slice) // 8
    for s, c in twice.collect():  # the bitmaps: at most DEPTH * 2**MAX_CELL_BITS bits
        at = s // DEPTH * wide
        maps[s % DEPTH][at:at + wide] = np.frombuffer(c, np.uint8)
    return maps


def runs(g: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 window of each run: cuts depend on the words that follow, and long runs are cut evenly."""
    cut = np.flatnonzero((g[:windows] >> U(40)) % U(RUN) == 0)
    cut = np.unique(np.concatenate([[0], cut]))
    gap = np.diff(np.concatenate([cut, [windows]]))
    if gap.max() > 8 * RUN:
        cut = np.concatenate([np.arange(a, a + n, 8 * RUN) for a, n in zip(cut, gap)])
    return cut, np.concatenate([cut[1:], [windows]])


def marked_words(docs: DataFrame, window: int = 35, gram: int = 16, text_col: str = "text",
                 digest: bool = False) -> DataFrame:
    """``docs`` with three more columns: ``n_words``, ``n_removed`` and ``kept`` (binary, the kept words joined by one space).

    With ``digest``, ``kept`` is the SHA-256 of these bytes (binary) and ``text_col`` isn't returned.

    A word goes if a window covers it whose word sequence also starts anywhere
    else, in the same document or another; windows are judged on the input. Null,
    empty and wordless texts have no words and keep the empty string. Texts
    shorter than a window keep all words. Repeated rows are separate
    documents, so their windows repeat. An empty table gives an empty one. The
    other columns of ``docs`` come through untouched, whatever their names
    (a column named like one of the three new ones is replaced).
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    bits = min(MAX_CELL_BITS, max(10, (chars // CHARS_PER_CELL).bit_length()))
    shared = spark.sparkContext.broadcast(sketch(docs, bits, window, gram, text_col))

    def estimated(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes of words, hashes of grams, which windows are estimated to occur twice)."""
        h = word_hashes(words)
        g, at = anchors(h, window, gram)
        seen = np.ones(len(g), bool)
        for bitmap, c in zip(shared.value, cells(g, bits)):
            seen &= (bitmap[c >> 3] >> (c & 7).astype(np.uint8) & 1).astype(bool)
        return h, g, seen[at]

    def finished(words: list[bytes]) -> bytes:
        joined = b" ".join(words)
        return hashlib.sha256(joined).digest() if digest else joined

    kept_columns = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept") and not (digest and c == text_col)]
    own = packed(docs.drop("n_words", "n_removed", "kept"), text_col)
    names = [c for c in own.columns if not (digest and c == text_col)]
    form = [own.schema[c] for c in names]

    def with_fields(more: str) -> T.StructType:
        """Schema of the rows' own columns and the fields of a text like ``a long, b binary``."""
        kinds = {"int": T.IntegerType(), "long": T.LongType(), "binary": T.BinaryType()}
        made = [x.split() for x in more.split(", ")]
        return T.StructType([*form, *(T.StructField(n, T.ArrayType(kinds[k[6:-1]]) if k.startswith("array") else kinds[k]) for n, k in made)])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, part = 0, TaskContext.get().partitionId()
        for b in rows(batches):
            ids = range((part << 33) + row, (part << 33) + row + b.num_rows)
            row += b.num_rows
            total, kept, left, cols = [], [], [], ([], [], [])
            for text in b.column(text_col).cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                total.append(len(words))
                if len(words) >= window:
                    h, g, ok = estimated(words)
                if len(words) < window or not ok.any():
                    kept.append(finished(words))
                    left.append(None)
                    for c in cols:
                        c.append(None)
                    continue
                kept.append(None)
                left.append(text)
                lo, hi = runs(g, len(ok))
                full = np.logical_and.reduceat(ok, lo) & (hi - lo > RUN // 4)
                lo, hi = lo[full], hi[full]
                cols[0].append(lo.astype(np.int32))
                cols[1].append(hi.astype(np.int32))
                cols[2].append([xxhash.xxh3_128_digest(h[x:y + window - 1].tobytes()) for x, y in zip(lo, hi)])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(total, pa.int64()), pa.array(kept, pa.binary()),
                 pa.array(ids, pa.int64()), pa.array(left, pa.binary()), pa.array(cols[0], pa.list_(pa.int32())),
                 pa.array(cols[1], pa.list_(pa.int32())), pa.array(cols[2], pa.list_(pa.binary()))],
                names=[*names, "n_words", "kept", "__row", "__text", "__lo", "__hi", "__run"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes of the windows to be grouped one by one, and of those of the first copy of each settled run."""
        for b in rows(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for text, settled in zip(b.column("__text").to_pylist(), b.column("__settled").to_pylist()):
                h, _, ok = estimated(text.split())
                first = np.zeros(len(ok), bool)
                for r in settled or []:
                    ok[r["__lo"]:r["__hi"]] = False
                    first[r["__lo"]:r["__hi"]] = r["first"]
                one, two = rolling(h, window, ODD[0]).view(np.int64), rolling(h, window, ODD[1]).view(np.int64)
                for c, v in zip(out, (np.flatnonzero(ok).astype(np.int32), one[ok], two[ok], one[first], two[first])):
                    c.append(v)
            kinds = [pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([b.column("__row"), *(pa.array(c, pa.list_(k)) for c, k in zip(out, kinds))],
                                             names=["__row", "at", "one", "two", "one1", "two1"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            gone, kept = [], []
            for text, at, settled in zip(*(b.column(c).to_pylist() for c in ("__text", "__starts", "__settled"))):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int32)
                np.add.at(edge, np.asarray(at or [], int), 1)
                np.add.at(edge, np.asarray(at or [], int) + window, -1)
                for r in settled or []:
                    edge[r["__lo"]] += 1
                    edge[r["__hi"] + window - 1] -= 1
                covered = np.cumsum(edge[:-1]) > 0
                keep = [w for w, c in zip(words, covered.tolist()) if not c]
                gone.append(len(words) - len(keep))
                kept.append(finished(keep))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), b.column("n_words"), pa.array(gone, pa.int64()), pa.array(kept, pa.binary())],
                names=[*names, "n_words", "n_removed", "kept"])

    found = saved(own.mapInArrow(searched, with_fields(
        "n_words long, kept binary, __row long, __text binary, __lo array<int>, __hi array<int>, __run array<binary>")), "windows")
    some = found.where("__text is not null")
    stretches = some.select("__row", F.explode(F.arrays_zip("__lo", "__hi", "__run")).alias("r")).select("__row", "r.*")
    twice = (stretches.groupBy("__run").agg(F.count("*").alias("n"), F.min(F.struct("__row", "__lo")).alias("f"))
             .where("n > 1").select("__run", "f"))
    settled = saved(stretches.join(twice, "__run").select(
        "__row", F.struct("__lo", "__hi", (F.struct("__row", "__lo") == F.col("f")).alias("first")).alias("r"))
        .groupBy("__row").agg(F.collect_list("r").alias("__settled")), "settled")
    each = saved(some.select("__row", "__text").join(settled, "__row", "left").mapInArrow(
        spread, "__row long, at array<int>, one array<long>, two array<long>, one1 array<long>, two1 array<long>"), "spots")
    spots = each.select("__row", F.explode(F.arrays_zip("at", "one", "two")).alias("s")).select("__row", "s.*")
    others = each.select(F.explode(F.arrays_zip("one1", "two1")).alias("s")).select(
        F.col("s.one1").alias("one"), F.col("s.two1").alias("two"), F.lit(0).alias("w"))
    # A window repeats if it is there twice, or once beside a settled run.
    repeated = (spots.select("one", "two", F.lit(1).alias("w")).unionByName(others).groupBy("one", "two")
                .agg(F.count("*").alias("n"), F.max("w").alias("w")).where("n > 1 and w = 1").select("one", "two"))
    starts = spots.join(repeated, ["one", "two"]).groupBy("__row").agg(F.collect_list("at").alias("__starts"))
    done = (some.select(*names, "n_words", "__row", "__text").join(settled, "__row", "left").join(starts, "__row", "left")
            .mapInArrow(cut, with_fields("n_words long, n_removed long, kept binary")))
    rest = found.where("__text is null").select(*names, "n_words", F.lit(0).cast("long").alias("n_removed"), "kept")
    return unpacked(rest.unionByName(done), kept_columns, "n_words", "n_removed", "kept")


def removed_counts(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and the SHA-256 of the kept words."""
    out = marked_words(docs.select("doc_id", "text"), window, digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = 35) -> DataFrame:
    """``docs`` without the covered words. Texts that lose none stay as they are; ``n_chars`` follows the new text.

    Null and empty texts stay; of repeated rows' texts all repeated windows go, from each of them. Other columns stay with their row,
    whatever their names and types; an empty table gives an empty one.
    """
    own = packed(docs, "text", "n_chars")
    out = marked_words(own, window)
    changed = F.col("n_removed") > 0
    out = out.withColumn("text", F.when(changed, F.col("kept").cast("string")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return unpacked(out, docs.columns)
