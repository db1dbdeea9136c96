"""Packing along a space-filling curve.

Every document becomes token ids and one closing id. Its ids are hashed into a
vector of signed counts, the vector is projected to three dimensions, and the
cell of the projection gets its place on a Hilbert curve. Documents are range
partitioned and sorted by that place, and the ids are laid end to end along the
curve: sequence ``k`` holds the ids ``k * length`` to ``(k + 1) * length - 1``, so neighbours
on the curve share sequences and only the last sequence of all has padding.
"""

from __future__ import annotations

import math
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope.llm.common import rows, saved

DIMS, BITS, TIE_BITS = 3, 8, 28       # 24 bits of curve and 28 bits against ties: exact as a double
VECTOR = 256                          # length of the hashed vector
GROUP_BYTES = 6 << 20                 # bytes of text that are encoded together
CACHE_WORDS = 1_500_000                 # words whose ids a worker keeps


class WordIds:
    """Token ids of texts, by words.

    The tokenizer drops white space and never joins what white space separates, so the
    ids of a text are those of its words (split at ASCII white space) end to end.
    Words seen before are looked up; the others go through the tokenizer in batches.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.kind, self.code = (np.uint16, "H") if self.tok.get_vocab_size() <= 1 << 16 else (np.uint32, "I")
        self.known: dict[bytes, bytes] = {}
        rng = np.random.default_rng(7)
        size = self.tok.get_vocab_size()
        self.slot, self.sign = rng.integers(0, VECTOR, size), rng.choice([-1.0, 1.0], size)
        self.project = rng.standard_normal((VECTOR, DIMS))

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, ``end`` behind each; where each text starts, and the total).

        Words are split and numbered by Arrow; only distinct words are looked up, and the ids of all
        places are gathered at once.
        """
        # Lower case is what the tokenizer makes of words anyway, but a special token in a text must stay as it is.
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        split = pc.ascii_split_whitespace(texts)
        count = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        words = split.flatten().dictionary_encode()
        here = self.looked_up(words.dictionary.cast(pa.binary()).to_pylist())
        size = np.fromiter(map(len, here), np.int64, len(here)) // np.dtype(self.kind).itemsize
        pool, first = np.frombuffer(b"".join(here), self.kind), np.cumsum(size) - size
        word = words.indices.to_numpy(zero_copy_only=False)
        long = size[word]
        ends = np.cumsum(long)
        total = int(ends[-1]) if len(ends) else 0
        ids = pool[np.repeat(first[word] - (ends - long), long) + np.arange(total)]
        # Tokens before each text, and one more place for every closing id.
        before = np.concatenate([[0], ends])[np.cumsum(count)]
        starts = np.concatenate([[0], before + np.arange(1, len(count) + 1)])
        out = np.full(total + len(count), end, self.kind)
        own = np.ones(len(out), bool)
        own[starts[1:] - 1] = False
        out[own] = ids
        return out, starts

    def looked_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of some distinct words."""
        if len(self.known) > CACHE_WORDS:  # the words of these texts stay
            self.known = {w: self.known[w] for w in words if w in self.known}
        known = self.known
        new = [w for w in words if w not in known]
        for lo in range(0, len(new), 20_000):
            part = new[lo:lo + 20_000]
            for w, e in zip(part, self.tok.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)):
                known[w] = array(self.code, e.ids).tobytes()
        return [known[w] for w in words]

    def places(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Cell coordinates (0 .. 2**BITS - 1) of each text."""
        n = len(starts) - 1
        row = np.repeat(np.arange(n), np.diff(starts))
        v = np.bincount(row * VECTOR + self.slot[ids], weights=self.sign[ids], minlength=n * VECTOR).reshape(n, VECTOR)
        v = np.sign(v) * np.sqrt(np.abs(v))
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        flat = (v @ self.project).ravel().tolist()
        unit = np.array([0.5 * (1 + math.erf(x / math.sqrt(2))) for x in flat]).reshape(n, DIMS)
        return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates (n x dimensions)."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the excess rotations, highest bit first
        for i in range(n):
            on = (x[:, i] & q) > 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(on, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = top
    while q > 1:
        t ^= np.where(x[:, n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[:, i] >> b & 1
    return key


def sized(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, one row at least."""
    for b in batches:
        ends = np.cumsum(np.nan_to_num(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False).astype(float)))
        lo = 0
        while lo < b.num_rows:
            before = ends[lo - 1] if lo else 0.0
            hi = max(lo + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi


def encoded(docs: DataFrame, path: str, end: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, key, ids): length with the closing id, sort key, ids as little-endian numbers."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, part, row = word_ids(path), TaskContext.get().partitionId(), 0
        for b in sized(batches, GROUP_BYTES):
            ids, starts = w.ids(b.column(1), end)
            curve = hilbert(w.places(ids, starts))
            # Rows in one cell are dealt by a hash of their place in the table, so a crowded cell can be cut.
            tie = (np.arange(row, row + b.num_rows, dtype=np.uint64) + np.uint64(part << 33)) * np.uint64(0x9E3779B97F4A7C15)
            row += b.num_rows
            key = (curve << TIE_BITS) | ((tie ^ (tie >> np.uint64(29))) >> np.uint64(64 - TIE_BITS)).astype(np.int64)
            data = ids.tobytes()
            at = (starts * ids.itemsize).tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(starts)), pa.array(key),
                 pa.array([data[x:y] for x, y in zip(at[:-1], at[1:])], pa.binary())], names=[id_col, "n", "key", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(made, f"`{id_col}` {kind}, n long, key long, ids binary")


RANGE_BYTES = 64 << 20   # ids that one task cuts into sequences


def pack(docs: DataFrame, path: str, length: int = 2048, end: int = 1, id_col: str = "doc_id",
         text_col: str = "text", partitions: int | None = None) -> DataFrame:
    """Pieces of all documents in packed sequences of ``length`` ids.

    Columns: id, ``start`` (the document's ids before the piece), ``length``, ``doc_tokens`` (with the
    closing id), ``sequence_id``, ``offset`` (of the piece within the sequence) and ``ids`` (little-endian
    unsigned 32-bit numbers). Null, empty and white-space texts are the closing id alone. Repeated rows
    are separate documents; a null id is kept. An empty table gives no pieces. Other columns are not read.

    The encoded documents are written once; range bounds and the ids before each range
    come from narrow scans (one number per range reaches the driver), and the ids are shuffled once. There are ``partitions``
    ranges, by default one per ``RANGE_BYTES`` of ids, and one per core at least.
    """
    spark = docs.sparkSession
    enc = saved(encoded(docs, path, end, id_col, text_col), "encoded")
    total = enc.agg(F.sum("n")).first()[0] or 0
    count = partitions or max(spark.sparkContext.defaultParallelism, math.ceil(4 * total / RANGE_BYTES))
    cuts = enc.approxQuantile("key", [i / count for i in range(1, count)], 0.1 / count) if count > 1 else []
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    if len(splits) == 2:
        ranged = enc.withColumn("range", F.lit(0))
    else:
        ranged = Bucketizer(splits=splits, inputCol="key", outputCol="range").transform(enc)
        ranged = ranged.withColumn("range", F.col("range").cast("int"))
    sums = dict(ranged.groupBy("range").agg(F.sum("n")).collect())
    base, at = {}, 0
    for r in range(len(splits) - 1):
        base[r] = at
        at += sums.get(r, 0)
    kind = np.uint16 if word_ids(path).kind is np.uint16 else np.uint32

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for b in rows(batches, 256):
            source, out = [], []
            ids_out = []
            for i, (r, n, ids) in enumerate(zip(b.column("range").to_pylist(), b.column("n").to_pylist(), b.column("ids"))):
                if r != now:
                    now, at = r, base[r]
                wide = np.frombuffer(ids.as_buffer(), kind).astype("<u4")
                start = 0
                while start < n:
                    size = min(n - start, length - at % length)
                    source.append(i)
                    out.append((start, size, n, at // length, at % length))
                    ids_out.append(wide[start:start + size].tobytes())
                    start, at = start + size, at + size
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).take(pa.array(source, pa.int64())), *(pa.array(c, pa.int64()) for c in cols),
                 pa.array(ids_out, pa.binary())],
                names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    id_kind = docs.schema[id_col].dataType.simpleString()
    return (ranged.repartitionById(len(splits) - 1, F.col("range")).sortWithinPartitions("range", "key")
            .mapInArrow(cut, f"`{id_col}` {id_kind}, start long, length long, doc_tokens long, sequence_id long, "
                             "offset long, ids binary"))


def digests(pieces: DataFrame) -> DataFrame:
    """Pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
