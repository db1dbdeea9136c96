"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: the majority vote of XXH64 over word shingles. Links: two
fingerprints that differ in at most ``max_bits`` bits. The 64 bits are grouped
into partitions of correlated bits; partition ``i`` gets a threshold ``t_i >= -1``
with ``sum(t_i) = max_bits - m + 1``. If two fingerprints differ in at most
``max_bits`` bits, they differ in at most ``t_i`` bits within some partition ``i``
(otherwise the distances add up to at least ``sum(t_i + 1) = max_bits + 1``), so
probing each partition's values within ``t_i`` finds every pair. Number of
partitions and thresholds are chosen by dynamic programming on candidate counts
estimated from all fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope.llm.common import byte_texts, packed, rows, saved, unpacked
from vendorscope.llm.graph import components

# Relative costs: a probe row travels through a shuffle, a candidate pair is one XOR and a bit count.
PROBE_COST, PAIR_COST = 1.0, 0.003
VOTES = 1 << 16  # shingles counted at a time


def fingerprint(text: bytes | None, words: int) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    w = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(w) > words:
        starts, ends = starts[:len(w) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    votes, n = np.zeros(64, np.int64), len(starts)
    for at in range(0, n, VOTES):
        cut = [joined[a:b] for a, b in zip(starts[at:at + VOTES].tolist(), ends[at:at + VOTES].tolist())]
        bits = np.frombuffer(b"".join(map(xxhash.xxh64_digest, cut, repeat(42))), np.uint8)
        votes += np.unpackbits(bits.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): the fingerprint as a signed long, one row per row of ``docs``. Row-local."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches):
            fp = np.array([fingerprint(t, words) for t in byte_texts(b, text_col)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(made, f"`{id_col}` {kind}, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64x64 counts of bits set together, over all rows of ``fps``."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((64, 64))
        for b in rows(batches, 65536):
            x = bits_of(b.column(0).to_numpy(zero_copy_only=False))
            n, both = n + len(x), both + x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *range(4096)], pa.int32()), pa.array([n, *both.ravel().astype(np.int64).tolist()], pa.int64())], names=["k", "n"])

    got = dict(fps.select("fp").mapInArrow(partial, "k int, n long").groupBy("k").agg(F.sum("n")).collect())
    return int(got.get(-1, 0)), np.array([got.get(k, 0) for k in range(4096)], float).reshape(64, 64)


def bits_of(fp: np.ndarray) -> np.ndarray:
    """0/1 matrix, column 0 the highest bit."""
    return np.unpackbits(fp.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32)


def grouped_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of bits of nearly equal width, correlated bits together (greedy)."""
    p = both.diagonal() / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    r = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(r, 0)
    left, groups = set(range(64)), []
    for g in range(m):
        width = 64 // m + (g < 64 % m)
        order = sorted(left)
        group = [max(order, key=lambda b: (r[b, order].sum(), -b))]
        left.discard(group[0])
        while len(group) < width:
            order = sorted(left)
            nxt = max(order, key=lambda b: (r[b, group].sum(), -b))
            group.append(nxt)
            left.discard(nxt)
        groups.append(sorted(group))
    return groups


def projection(fp, group: list[int]):
    """The bits of a group, packed, as a column (bit 0 is the highest)."""
    out = F.lit(0).cast("long")
    runs: list[list[int]] = []
    for b in group:  # one shift per run of neighbouring bits
        if runs and runs[-1][-1] == b - 1:
            runs[-1].append(b)
        else:
            runs.append([b])
    for run in runs:
        part = F.shiftrightunsigned(fp, 63 - run[-1]).bitwiseAND(F.lit((1 << len(run)) - 1).cast("long"))
        out = F.shiftleft(out, len(run)).bitwiseOR(part)
    return out


def within(p: np.ndarray, most: int) -> np.ndarray:
    """Chance that two fingerprints differ in at most t of the bits, t = 0 .. most, bits taken as independent."""
    dist = np.zeros(most + 1)
    dist[0] = 1
    for q in 2 * p * (1 - p):
        dist = dist * (1 - q) + np.concatenate([[0], dist[:-1]]) * q
    return np.maximum(np.cumsum(dist), 1e-300)


def allocate(cost: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds t_i >= -1 with the given sum and the least cost; ``cost[i][t]`` for t = 0 .. (t = -1 is free)."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for c in cost:
        step: dict[int, tuple[float, list[int]]] = {}
        for s, (have, ts) in best.items():
            for t in range(-1, len(c)):
                new = (have + (c[t] if t >= 0 else 0.0), ts + [t])
                if s + t not in step or new < step[s + t]:
                    step[s + t] = new
        best = step
    return best[total]


def plan(fps: DataFrame, max_bits: int, choices=(2, 3, 4, 5, 6)) -> list[tuple[list[int], int]]:
    """Groups of bits with their thresholds, the cheapest over the numbers of partitions in ``choices``.

    Counts of equal projections are taken over all fingerprints (one grouped
    count per partition, summed to one row); larger thresholds are scaled from
    them by the bits' own frequencies.
    """
    n, both = bit_statistics(fps)
    layouts = [grouped_bits(n, both, m) for m in choices]
    flat = [(k, g, grp) for k, groups in enumerate(layouts) for g, grp in enumerate(groups)]
    pieces = F.array(*[F.struct(F.lit(i).alias("i"), projection(F.col("fp"), grp).alias("v"))
                       for i, (_, _, grp) in enumerate(flat)])
    equal = dict(fps.select(F.explode(pieces).alias("p")).groupBy("p.i", "p.v").count()
                 .groupBy("i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2)).collect())
    p, best = both.diagonal() / max(n, 1), None
    for k, groups in enumerate(layouts):
        cost = []
        for i, (kk, _, grp) in enumerate(flat):
            if kk != k:
                continue
            near = within(p[grp], max_bits)
            pairs = np.minimum(equal.get(i, 0.0) * near / near[0], n * (n - 1) / 2)
            cost.append([PROBE_COST * max(n, 1) * sum(comb(len(grp), j) for j in range(t + 1)) + PAIR_COST * pairs[t]
                         for t in range(max_bits + 1)])
        got = allocate(cost, max_bits - len(groups) + 1)
        if best is None or got[0] < best[0]:
            best = (got[0], [(g, t) for g, t in zip(groups, got[1]) if t >= 0])
    return best[1]


def local_links(own: np.ndarray, probes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, smallest node) that connect what the links among ``own`` and between ``own`` and ``probes`` connect."""
    own = np.unique(own)
    nodes = np.unique(np.concatenate([own, probes]))
    bits, at, label = nodes.view(np.uint64), np.searchsorted(nodes, own), np.arange(len(nodes))
    for lo in range(0, len(own), 256):  # 256 rows of the distance matrix at a time
        a = at[lo:lo + 256]
        i, j = np.nonzero(np.bitwise_count(bits[a, None] ^ bits[None, :]) <= max_bits)
        i = a[i]
        while True:  # join labels along the links of this slice until they agree
            li, lj = label[i], label[j]
            open_ = li != lj
            if not open_.any():
                break
            i, j = i[open_], j[open_]
            parent = np.arange(len(nodes))
            np.minimum.at(parent, np.maximum(li, lj)[open_], np.minimum(li, lj)[open_])
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            label = parent[label]
    far = np.nonzero(label != np.arange(len(nodes)))[0]
    return nodes[far], nodes[label[far]]


def _signatures(part: int, own, masks: list[int]):
    """Array of (part, value, probe): the projected value itself and the values that differ from it by a mask."""
    return F.transform(F.lit([0, *masks]).cast("array<bigint>"), lambda x: F.struct(
        F.lit(part).alias("part"), own.bitwiseXOR(x).alias("value"), (x != 0).alias("probe")))


def links(fps: DataFrame, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """Rows (u, v) of distinct fingerprints (column fp) that connect exactly what the links of ``max_bits`` bits connect.

    A bucket (partition, projected value) holds fingerprints and probes. Buckets of
    more than ``block`` rows are dealt into blocks, and each pair of blocks is
    one group, so no group is larger than twice ``block`` (by expectation). Within a group distances
    are computed as a matrix, 256 rows at a time, and only stars (node, smallest node of its connected part)
    leave it: a group of n copies gives fewer than n rows.
    """
    parts = []
    for k, (group, t) in enumerate(plan(fps, max_bits)):
        own = projection(F.col("fp"), group)
        masks = [sum(1 << (len(group) - 1 - b) for b in c)
                 for j in range(1, t + 1) for c in combinations(range(len(group)), j)]
        parts.append(_signatures(k, own, masks))
    spread = fps.select("fp", F.explode(F.concat(*parts)).alias("s")).select("fp", "s.*")
    hot = (spread.groupBy("part", "value").count().where(F.col("count") > block)
           .select("part", "value", F.ceil(F.col("count") / block).cast("int").alias("blocks")))
    dealt = spread.join(hot, ["part", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = (dealt.groupBy("part", "value", F.least("mine", "other").alias("b1"), F.greatest("mine", "other").alias("b2"))
               .agg(F.collect_list(F.when(~F.col("probe"), F.col("fp"))).alias("own"),
                    F.collect_list(F.when(F.col("probe"), F.col("fp"))).alias("probes"))
               .where((F.size("own") > 0) & (F.size("own") + F.size("probes") > 1)).select("own", "probes"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 2048):
            out = [local_links(own.values.to_numpy(zero_copy_only=False).astype(np.int64),
                               probes.values.to_numpy(zero_copy_only=False).astype(np.int64), max_bits)
                   for own, probes in zip(b.column(0), b.column(1))]
            u, v = (np.concatenate([x[k] for x in out]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return grouped.mapInArrow(linked, "u long, v long")


def _rooted(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Written (id, fp) of every row, and (fp, root): the group of every distinct fingerprint, with ``first``, the smallest id that has it."""
    marked = saved(fingerprints(docs, words, id_col, text_col), "fingerprints")
    nodes = saved(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "nodes")
    roots = saved(components(links(nodes.select("fp"), max_bits)), "roots")
    return marked, nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, ``fp`` (signed long) and ``component_id``.

    ``component_id`` is the smallest id reachable through links of fingerprints
    that differ in at most ``max_bits`` bits. Null, empty and wordless texts have the fingerprint zero and are
    linked like any other. Equal fingerprints are collapsed before the search,
    so copies cost one row each. Null ids are kept and never the smallest
    (a component of null ids only has a null id). Repeated rows give repeated
    rows; an empty table gives an empty one; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    marked, named = _rooted(docs, words, max_bits, id_col, text_col)
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, "root").select(F.col("fp").alias("node"), F.col("component_id").cast(kind))
    return marked.join(by_fp, marked["fp"] == by_fp["node"]).select(marked[id_col], "fp", "component_id")


def hex_fingerprint(fp):
    """16 lowercase hex digits of a signed long column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def first_of_each(docs: DataFrame, words: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest ``doc_id``, null ids last.

    Groups are of rows: of two rows with one id and different texts both stay, of equal or
    near texts one does, also without an id. Null, empty and wordless texts are
    near-duplicates of each other. Other columns stay with their row, whatever their names and types; an empty table gives an empty one.

    An id that one row has names its row, so texts are joined to the kept ids and not written. Rows without an id, and rows that share
    one, can only be told apart by number: these alone are written, numbered, and the first of each kept (id, fingerprint) is taken.
    """
    marked, named = _rooted(docs, words, max_bits, "doc_id", "text")
    rooted = marked.join(named.select("fp", "root"), "fp")
    kept = saved(rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("k"))
                 .select("k.doc_id", "k.fp"), "kept")
    shared = marked.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    own = packed(docs, "doc_id", "text")
    plain = own.join(kept.where("doc_id is not null").join(shared, "doc_id", "left_anti").select("doc_id"), "doc_id", "left_semi")
    rest = own.where("doc_id is null").unionByName(own.join(shared, "doc_id", "left_semi").select(*own.columns))
    rest = saved(rest.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    prints = fingerprints(rest, words, "__row", "text").join(rest.select("__row", F.col("doc_id").alias("__id")), "__row")
    firsts = (prints.join(kept, prints["__id"].eqNullSafe(kept["doc_id"]) & (prints["fp"] == kept["fp"]))
              .groupBy("__id", prints["fp"]).agg(F.min("__row").alias("__row")).select("__row"))
    told = rest.join(firsts, "__row", "left_semi").select(*own.columns)
    return unpacked(plain.select(*own.columns).unionByName(told), docs.columns)
