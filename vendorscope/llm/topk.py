"""Exact top-k by inner product over a pivot-distance index.

Vectors ``x`` become ``(x, sqrt(M - |x|^2))`` with ``M`` the largest square norm, queries ``(q, 0)``; then
``|q - x|^2 = |q|^2 + M - 2 q.x``, and the largest inner product is the smallest distance. Every vector is
keyed by its nearest pivot and a ring of distances around it. For a query at distance ``d`` from a
pivot, the triangle inequality puts all vectors of a ring ``[lo, hi]`` at least
``max(0, d - hi, lo - d)`` away, which bounds their scores from above. A query first visits the rings with the
best bounds, which gives it a k-th score; then it visits the remaining rings whose bound reaches that
score, and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendorscope.llm.common import rows, saved
from vendorscope.llm.vectors import matrix, usable

BLOCK = 512            # vectors, or queries, that are compared as one matrix
SAMPLE = 2048          # vectors that pivots are chosen from
MAX_RINGS = 64         # per pivot: pivots x rings bounds what is broadcast


def scaled(x: np.ndarray) -> np.ndarray:
    """floor(256 x) as whole numbers held in doubles."""
    return np.floor(256.0 * x)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, as int64; Python integers where doubles would not be exact."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if bound < 2 ** 53:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m], dtype=object)
    return (whole(q) @ whole(x).T).astype(np.int64)  # raises if a score is no 64-bit number


def farthest_first(sample: np.ndarray, n: int) -> np.ndarray:
    chosen = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2 * a @ b.T, 0))


def best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, least: list) -> list[tuple[list[int], list[int]]]:
    """Per row of ``scores`` the k best (ids, scores) that reach its ``least``, ties to the smaller id.

    ``ids`` ascend; a row's own id is out; a ``least`` of None is no bound.
    """
    out = []
    for row, me, bar in zip(scores, own, least):
        keep = ids != me if bar is None else (ids != me) & (row >= bar)
        s, i = row[keep], ids[keep]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            s, i = s[s >= least], i[s >= least]
        order = np.argsort(-s, kind="stable")[:k]
        out.append((i[order].tolist(), s[order].tolist()))
    return out


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, pivots: int = 32, first: int = 3, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's ``k`` best rows of ``df`` by integer inner product.

    Components are ``floor(256 x)``. A query's own id is no candidate; ties go to the smaller id; all
    candidates are returned if there are fewer than ``k``. Rows that take no part: see ``usable`` (the
    same holds for ``queries``). Zero vectors do take part. Empty tables give no rows. Other columns are not read.

    Pivots, ring limits and ring counts (at most pivots x ``MAX_RINGS``) are broadcast. A ring holds any
    number of vectors; it is stored in blocks of about ``BLOCK``, its queries likewise, and only blocks meet.
    """
    spark = df.sparkSession
    base = saved(usable(df, id_col, vec_col), "vectors")
    total, top = base.agg(F.count("*"), F.max(F.aggregate(
        F.transform("vec", lambda x: F.floor(x * 256.0).cast("double")), F.lit(0.0), lambda a, x: a + x * x))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not total:
        return spark.createDataFrame([], schema)

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.hstack([x, np.sqrt(np.maximum(top - (x ** 2).sum(axis=1), 0))[:, None]])

    some = base.orderBy(F.xxhash64("id")).limit(SAMPLE).toArrow()  # a fixed number of rows
    sample = lifted(scaled(matrix(some["vec"].combine_chunks())))
    centre = farthest_first(sample, pivots)
    rings = int(max(1, min(MAX_RINGS, total // (128 * len(centre)))))
    d = distances(sample, centre)
    edges = np.quantile(d.min(axis=1), np.arange(1, rings) / rings) if rings > 1 else np.zeros(0)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 4096):
            x = scaled(matrix(b.column("vec")))
            d = distances(lifted(x), centre)
            near = d.argmin(axis=1)
            at = d[np.arange(len(d)), near]
            ring = near * rings + np.searchsorted(edges, at)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(ring.astype(np.int32)),
                 pa.array(at)], names=["id", "x", "ring", "d"])

    index = saved(base.mapInArrow(keyed, "id long, x binary, ring int, d double"), "index")
    limits = index.groupBy("ring").agg(F.min("d").alias("lo"), F.max("d").alias("hi"), F.count("*").alias("n")).toArrow()
    ring, lo, hi, size = (limits[c].to_numpy() for c in ("ring", "lo", "hi", "n"))
    parts = dict(zip(ring.tolist(), np.ceil(size / BLOCK).astype(int).tolist()))
    share = F.create_map(*[F.lit(v) for r, n in parts.items() for v in (r, n)])
    blocks = saved(index.withColumn("part", F.pmod(F.xxhash64("id"), share[F.col("ring")]).cast("int"))
                   .groupBy("ring", "part").agg(F.sort_array(F.collect_list(F.struct("id", "x"))).alias("rows"))
                   .select("ring", "part", "rows.id", "rows.x"), "blocks")

    def visits(batches: Iterator[pa.RecordBatch], again: bool) -> Iterator[pa.RecordBatch]:
        """(ring, query) pairs: the ``first`` best rings, or with the k-th scores known those of the rest that can matter."""
        slack = 1e-9 * max(top, 1.0)
        for b in rows(batches, 1024):
            q = scaled(matrix(b.column("vec")))
            q0 = np.hstack([q, np.zeros((len(q), 1))])
            to = distances(q0, centre)[:, ring // rings]
            gap = np.maximum(np.maximum(to - hi, lo - to) * (1 - 1e-9) - 1e-6, 0)
            bound = ((q ** 2).sum(axis=1)[:, None] + top - gap ** 2) / 2 + slack
            order = np.argsort(-bound, axis=1, kind="stable")
            early = np.zeros(bound.shape, bool)
            np.put_along_axis(early, order[:, :first], True, axis=1)
            if again:
                kth = np.array([-np.inf if v is None else v for v in b.column("kth").to_pylist()])
                chosen = ~early & (bound >= kth[:, None])
            else:
                chosen = early
            i, j = np.nonzero(chosen)
            packed = pa.array([r.tobytes() for r in q], pa.binary())
            for at in range(0, len(i), 8192):
                one = pa.array(i[at:at + 8192])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ring[j[at:at + 8192]].astype(np.int32)), b.column("id").take(one), packed.take(one),
                     b.column("kth").take(one)], names=["ring", "query_id", "q", "kth"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 8):
            qid, vid, score = [], [], []
            for own, qs, least, ids, xs in zip(*(b.column(c).to_pylist() for c in ("query_ids", "qs", "kths", "id", "x"))):
                q = np.frombuffer(b"".join(qs)).reshape(len(qs), -1)
                x = np.frombuffer(b"".join(xs)).reshape(len(xs), -1)
                for me, (i, s) in zip(own, best(exact_products(q, x), np.array(ids), np.array(own), k, least)):
                    qid += [me] * len(i)
                    vid += i
                    score += s
            yield pa.RecordBatch.from_arrays([pa.array(qid, pa.int64()), pa.array(vid, pa.int64()), pa.array(score, pa.int64())],
                                             names=["query_id", "vec_id", "score"])

    def found(asked: DataFrame, again: bool) -> DataFrame:
        pairs = asked.mapInArrow(lambda it: visits(it, again), "ring int, query_id long, q binary, kth long")
        # Queries of a ring are dealt into groups of about BLOCK as well, by their share of all queries.
        packs = (pairs.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)))
                 .groupBy("ring", "part").agg(F.collect_list(F.struct("query_id", "q", "kth")).alias("qs"))
                 .select("ring", F.col("qs.query_id").alias("query_ids"), F.col("qs.q").alias("qs"), F.col("qs.kth").alias("kths")))
        met = packs.join(blocks.select("ring", "id", "x"), "ring").select("query_ids", "qs", "kths", "id", "x")
        return met.mapInArrow(compared, "query_id long, vec_id long, score long")

    def merged(parts: DataFrame) -> DataFrame:
        order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i"))))
        return parts.groupBy("query_id").agg(F.slice(order, 1, k).alias("best"))

    asked = saved(usable(queries, id_col, vec_col), "queries")
    groups = max(1, -(-asked.count() // (BLOCK // 2)))
    one = saved(merged(found(asked.withColumn("kth", F.lit(None).cast("long")), False)), "first")
    kth = one.select(F.col("query_id").alias("id"), F.when(F.size("best") == k, -F.col("best")[k - 1]["s"]).alias("kth"))
    two = found(asked.join(kth, "id", "left"), True)
    held = one.select("query_id", F.explode("best").alias("b")).select(
        "query_id", F.col("b.i").alias("vec_id"), (-F.col("b.s")).alias("score"))
    return (merged(held.unionByName(two)).select("query_id", F.posexplode("best").alias("p", "b"))
            .select("query_id", (F.col("p") + 1).alias("rank"), F.col("b.i").alias("vec_id"),
                    (-F.col("b.s")).alias("score")))
