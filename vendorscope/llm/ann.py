"""Approximate nearest neighbours by cosine: an NN-descent graph and greedy search on it.

Equal vectors are one node that remembers its smallest ids, so a hot vector is one
node. The first neighbours come from blocks of vectors with equal random sign
patterns. Each round joins neighbours of neighbours: the ids of edges are brought together by node (a node's
incoming edges are sampled), nodes with a new edge are sent their neighbours' vectors, compare those pairs of them
of which at least one is new, and tell their nodes about pairs that are nearer than what they have. Rounds end when they
change hardly any list entry. Queries start
from the best of a fixed set of entry nodes, and from their own node if their vector is indexed, and
repeatedly expand the unexpanded of their best nodes until none is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendorscope.llm.common import dropped, rows, saved
from vendorscope.llm.vectors import matrix, usable

ENTRIES = 1024     # entry nodes, a fixed number, broadcast
CELL = 2048        # vectors that are compared as one block at the start, on average
CELLS = 1024       # blocks at the start of which the limits are learned, at most; larger ones are cut in order
SAMPLE = 16384     # vectors that these limits are learned from
PART = 64 << 20    # bytes of vectors in a partition of the graph that is searched
SETTLED = 0.001    # share of all list entries; a round that changes no more of them is the last
HALF = np.float16  # vectors in messages; scores of results are made from the original vectors


def nodes_of(df: DataFrame, members: int, id_col: str, vec_col: str) -> DataFrame:
    """(node, vec, ids, unit): one row per distinct vector, with its ``members`` smallest ids; zero vectors are out.

    The ranking is limited per partition before the shuffle, so copies of one vector send few rows.
    """
    base = usable(df, id_col, vec_col).where(F.exists("vec", lambda x: x != 0))
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    few = base.withColumn("rank", rank).where(F.col("rank") <= members)
    grouped = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 4096):
            x = matrix(b.column("vec"))
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("vec"), b.column("ids"),
                 pa.array([r.tobytes() for r in x.astype(HALF)], pa.binary())], names=["node", "vec", "ids", "unit"])

    return grouped.select(F.col("ids")[0].alias("node"), "vec", "ids").mapInArrow(
        scaled, "node long, vec array<double>, ids array<long>, unit binary")


def units(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0), np.float32)
    x = b"".join(column.to_pylist())
    return np.frombuffer(x, HALF).reshape(len(column), -1).astype(np.float32)


def start(nodes: DataFrame, k: int, trees: int, seed: int) -> DataFrame:
    """(node, told: array of (near, sim)) from ``trees`` orders by random sign patterns, compared in cells of about ``CELL`` rows.

    Cells are cut at quantiles of a sample, not by the shuffle's partitions, so their size doesn't depend on these.
    """
    cells = min(-(-nodes.count() // CELL), CELLS)
    trees = trees if cells > 1 else 1  # one cell holds all pairs

    def order(x: np.ndarray, t: int) -> np.ndarray:
        plane = np.random.default_rng([seed, t]).standard_normal((x.shape[1], 16)).astype(np.float32)
        y = x @ plane
        return ((y > 0) @ (1 << np.arange(15, -1, -1))) + (1 / (1 + np.exp(-4 * y[:, 0].astype(float))))

    sample = units(nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("unit").toArrow()["unit"].combine_chunks())
    cuts = [np.quantile(order(sample, t), np.arange(1, cells) / cells) for t in range(trees)]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 4096):
            x = units(b.column("unit"))
            for t, cut in enumerate(cuts):
                key = order(x, t)
                cell = t * cells + np.searchsorted(cut, key)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(key), b.column("node"), b.column("unit")],
                                                 names=["cell", "key", "node", "unit"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            ids, x = b["node"].to_numpy(), units(b["unit"].combine_chunks())
            for lo in range(0, len(ids), 512):
                yield nearest(ids[lo:lo + 512], ids, x[lo:lo + 512] @ x.T, k)

    keyed = nodes.select("node", "unit").mapInArrow(dealt, "cell long, key double, node long, unit binary")
    keyed = keyed.repartition("cell").sortWithinPartitions("cell", "key", "node")
    return listed(keyed.mapInArrow(compared, "node long, near long, sim float"))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of ``cell`` as tables of one cell each; cells of twice ``CELL`` rows or more are cut into such of ``CELL`` or more."""
    held = None
    for b in batches:
        held = pa.concat_tables([*([held] if held is not None else []), pa.Table.from_batches([b])])
        cell = held["cell"].to_numpy()
        ends = [*(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
        lo = 0
        for hi in ends:
            while hi - lo >= 2 * CELL:
                yield held.slice(lo, CELL)
                lo += CELL
            if hi < len(cell):
                yield held.slice(lo, hi - lo)
                lo = hi
        held = held.slice(lo)
    if held is not None and held.num_rows:
        yield held


def nearest(left: np.ndarray, right: np.ndarray, sim: np.ndarray, k: int, least: np.ndarray | None = None) -> pa.RecordBatch:
    """For each of ``left`` its up to ``k`` most similar of ``right``, above ``least`` if given, itself left out."""
    sim = np.where(left[:, None] == right[None, :], -np.inf, sim)
    take = min(k, len(right))
    top = np.argpartition(-sim, take - 1, axis=1)[:, :take]
    s = np.take_along_axis(sim, top, axis=1)
    ok = s > (-np.inf if least is None else least[:, None])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.broadcast_to(left[:, None], top.shape)[ok]), pa.array(right[top][ok]), pa.array(s[ok].astype(np.float32))],
        names=["node", "near", "sim"])


def best(node: np.ndarray, near: np.ndarray, sim: np.ndarray, late: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` most similar of every node, in order of node and similarity; of a repeated neighbour the first not ``late``."""
    at = np.lexsort((-sim, late, near, node))
    at = at[np.r_[True, (np.diff(node[at]) != 0) | (np.diff(near[at]) != 0)][:len(at)]]
    at = at[np.lexsort((near[at], -sim[at], node[at]))]
    place = np.arange(len(at))
    first = np.r_[True, np.diff(node[at]) != 0][:len(at)]
    return at[place - np.maximum.accumulate(np.where(first, place, 0)) < k]


def listed(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("node").agg(F.collect_list(F.struct("near", "sim")).alias("told"))


def kept(graph: DataFrame, told: DataFrame, k: int) -> DataFrame:
    """(node, unit, near, sims, fresh): each node's ``k`` most similar of what it had and was told, in order; ``fresh`` are the new ones."""
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 1024):
            had, new = b.column("near"), b.column("told")
            size = [np.array([len(x) if x.is_valid else 0 for x in c], np.int64) for c in (had, new)]
            node = np.concatenate([np.repeat(np.arange(b.num_rows), n) for n in size])
            near, sim = (np.concatenate([h.to_numpy(zero_copy_only=False), t.to_numpy(zero_copy_only=False)]) for h, t in (
                (had.flatten(), new.flatten().field("near")), (b.column("sims").flatten(), new.flatten().field("sim"))))
            late = np.arange(len(node)) >= size[0].sum()
            at = best(node, near, sim, late, k)
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(node[at], minlength=b.num_rows))].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("unit"), pa.ListArray.from_arrays(ends, pa.array(near[at].astype(np.int64))),
                 pa.ListArray.from_arrays(ends, pa.array(sim[at].astype(np.float32))), pa.ListArray.from_arrays(ends, pa.array(late[at]))],
                names=["node", "unit", "near", "sims", "fresh"])

    return graph.select("node", "unit", "near", "sims").join(told, "node", "left").mapInArrow(
        merged, "node long, unit binary, near array<long>, sims array<float>, fresh array<boolean>")


def sides(graph: DataFrame, most: int, seed: int) -> DataFrame:
    """(node, other, fresh), dealt by node: the edges of every node, its own list and up to ``most`` incoming ones, fresh ones first, then at random."""
    out = graph.select("node", F.explode(F.arrays_zip("near", "fresh")).alias("e")).select(
        "node", F.col("e.near").alias("other"), F.col("e.fresh").alias("fresh"), F.lit(False).alias("back"))
    back = out.select(F.col("other").alias("node"), F.col("node").alias("other"), "fresh", F.lit(True).alias("back"))
    # One shuffle of ids serves the ranking and all that groups by node.
    rank = F.row_number().over(Window.partitionBy("node", "back").orderBy(F.desc("fresh"), F.xxhash64("node", "other", F.lit(seed))))
    both = out.unionByName(back).repartition("node").withColumn("rank", rank).where(~F.col("back") | (F.col("rank") <= most))
    return both.groupBy("node", "other").agg(F.max("fresh").alias("fresh"))


def descend(graph: DataFrame, k: int, seed: int) -> DataFrame:
    """One round: every node compares the neighbours it has in either direction, if at least one of the two is fresh."""
    part = sides(graph, k, seed).withColumn("live", F.max("fresh").over(Window.partitionBy("node"))).where("live").drop("live")
    worst = F.when(F.size("sims") >= k, F.element_at("sims", -1)).otherwise(F.lit(-2.0)).cast("float").alias("worst")
    sender = graph.select(F.col("node").alias("other"), "unit", worst)
    groups = part.join(sender, "other").groupBy("node").agg(
        F.collect_list(F.struct("other", "unit", "worst", "fresh")).alias("l")).select("l")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 1024):
            got = []
            col = b.column("l")
            flat, ends = col.flatten(), np.cumsum([0, *[len(x) for x in col]])
            ids = flat.field("other").to_numpy(zero_copy_only=False)
            least = flat.field("worst").to_numpy(zero_copy_only=False)
            fresh = flat.field("fresh").to_numpy(zero_copy_only=False).astype(bool)
            x = units(flat.field("unit"))
            for lo, hi in zip(ends[:-1], ends[1:]):
                if hi - lo > 1:
                    v, f = x[lo:hi], fresh[lo:hi]
                    sim = np.where(f[:, None] | f[None, :], v @ v.T, -np.inf)
                    got.append(nearest(ids[lo:hi], ids[lo:hi], sim, k, least[lo:hi]))
            if got:
                # What a node is told by several lists of a batch is put together before the shuffle.
                node, near, sim = (c.to_numpy() for c in pa.Table.from_batches(got).columns)
                at = best(node, near, sim, np.zeros(len(node), bool), k)
                yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(near[at]), pa.array(sim[at])], names=["node", "near", "sim"])

    return kept(graph, listed(groups.mapInArrow(joined, "node long, near long, sim float")), k)


def build(nodes: DataFrame, k: int = 32, trees: int = 4, rounds: int | None = None, seed: int = 11) -> DataFrame:
    """(node, near, units): the neighbour graph with the neighbours' vectors beside their ids.

    Rounds are repeated until one changes at most ``SETTLED`` of all list entries, or ``rounds`` times if given.
    Lists only get nearer, so this ends.
    """
    none = nodes.select("node", "unit", F.expr("cast(array() as array<long>)").alias("near"), F.expr("cast(array() as array<float>)").alias("sims"))
    graph = saved(kept(none, start(nodes, k, trees, seed), k), "graph")
    for r in count() if rounds is None else range(rounds):
        old, graph = graph, saved(descend(graph, k, seed + r), "graph")
        dropped(old)
        changed, entries = graph.agg(F.sum(F.size(F.filter("fresh", lambda f: f))), F.sum(F.size("near"))).first()
        if (changed or 0) <= SETTLED * (entries or 0):
            break
    # Search follows edges in both directions; a node's incoming edges beyond k / 2 are left to the others' lists.
    named = graph.select(F.col("node").alias("other"), "unit")
    return saved(sides(graph, k // 2, seed).join(named, "other").groupBy("node")
                 .agg(F.collect_list(F.struct("other", "unit")).alias("l"))
                 .select("node", F.col("l.other").alias("near"), F.col("l.unit").alias("units")), "graph")


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, beam: int = 96, expand: int | None = None,
           hops: int | None = None) -> DataFrame:
    """(query_id, unit, found): greedy search of each query (query_id, unit, own); ``found`` has up to ``beam`` nodes, best first.

    Searches start from the best of ``ENTRIES`` fixed nodes and, where the query's vector is indexed itself, from its
    node ``own`` (null: it isn't).
    A query's state is its best ``beam`` nodes and which of them it has expanded. A hop joins the unexpanded
    nodes of all queries (the best ``expand`` of each, if given) with the graph; it ends when no query has one left,
    or after ``hops`` if given.
    """
    spark, expand = nodes.sparkSession, expand or beam
    entry = nodes.orderBy(F.xxhash64("node")).limit(ENTRIES).select("node", "unit").toArrow()  # a fixed number of rows
    ids, x = entry["node"].to_numpy(), units(entry["unit"].combine_chunks())
    form = "query_id long, unit binary, found array<struct<node:long,sim:float,done:boolean>>"
    item = pa.list_(pa.struct([("node", pa.int64()), ("sim", pa.float32()), ("done", pa.bool_())]))

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 512):
            sim = units(b.column("unit")) @ x.T
            top = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
            found = [[{"node": own, "sim": 1.0, "done": False}] * (own is not None)
                     + [{"node": int(ids[i]), "sim": float(s[i]), "done": False} for i in t if int(ids[i]) != own]
                     for t, s, own in zip(top, sim, b.column("own").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("unit"), pa.array(found, item)],
                                             names=["query_id", "unit", "found"])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 256):
            q = units(b.column("unit"))
            near, sims = [], []
            # What is less similar than all of a full beam is not told.
            for v, u, n, w in zip(q, b.column("units"), b.column("near"), b.column("worst").to_numpy()):
                sim = units(u.values) @ v
                near.append(n.values.to_numpy(zero_copy_only=False)[sim >= w])
                sims.append(sim[sim >= w])
            size = [len(n) for n in near]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column("query_id").to_numpy(), size)), pa.array(np.concatenate(near).astype(np.int64)),
                 pa.array(np.concatenate(sims).astype(np.float32))], names=["query_id", "node", "sim"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 256):
            out = []
            for found, new in zip(b.column("found").to_pylist(), b.column("new").to_pylist()):
                todo = [f["node"] for f in found if not f["done"]][:expand]
                now = {f["node"]: {**f, "done": f["done"] or f["node"] in todo} for f in found}
                for n in new or []:
                    now.setdefault(n["node"], {"node": n["node"], "sim": n["sim"], "done": False})
                out.append(sorted(now.values(), key=lambda f: (-f["sim"], f["node"]))[:beam])
            yield pa.RecordBatch.from_arrays([b.column("query_id"), b.column("unit"), pa.array(out, item)],
                                             names=["query_id", "unit", "found"])

    # The graph is dealt by node once, on the executors' disks, so that a hop shuffles its queries only.
    held = (graph.agg(F.sum(F.size("near"))).first()[0] or 0) * (x.itemsize // 2 * x.shape[1] + 8)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // PART))
    graph = graph.repartition(parts, "node").persist(StorageLevel.DISK_ONLY)
    state = saved(queries.mapInArrow(entered, form), "search")
    worst = F.when(F.size("found") >= beam, F.element_at("found", -1)["sim"]).otherwise(F.lit(-2.0)).cast("float").alias("worst")
    for _ in count() if hops is None else range(hops):
        todo = F.slice(F.filter("found", lambda f: ~f["done"]), 1, expand)
        ask = state.select("query_id", "unit", worst, F.explode(todo["node"]).alias("node"))
        if ask.isEmpty():
            break
        told = (ask.join(graph, "node").select("query_id", "unit", "worst", "near", "units")
                .mapInArrow(scored, "query_id long, node long, sim float")
                .groupBy("query_id").agg(F.collect_set(F.struct("node", "sim")).alias("new")))
        old, state = state, saved(state.join(told, "query_id", "left").mapInArrow(merged, form), "search")
        dropped(old)
    graph.unpersist()
    return state


def neighbours(df: DataFrame, queries: DataFrame, k: int = 5, degree: int = 32, rounds: int | None = None, beam: int = 96,
               id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the nearest found of ``df`` for each row of ``queries``, by cosine.

    Scores are made in double precision from the original vectors; ties go to the smaller id; a query's own id
    is no candidate. Rows that take no part: see ``usable``, and zero vectors; the same holds for queries. A table of
    fewer than ``k`` candidates gives them all; empty tables give no rows. Other columns are not read. All rows are
    indexed; equal vectors share a node, of whose ids the ``k + 1`` smallest can be among the answers.
    """
    nodes = saved(nodes_of(df, k + 1, id_col, vec_col), "nodes")
    if nodes.isEmpty():
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    graph = build(nodes, degree, rounds=rounds)
    asked = saved(nodes_of(queries.select(id_col, vec_col), 1, id_col, vec_col).select("vec", "unit"), "asked")
    rows_of = usable(queries, id_col, vec_col).select(F.col("id").alias("query_id"), "vec")
    # Queries with equal vectors are searched once, under the hash of the vector.
    asked = asked.withColumn("key", F.xxhash64("vec"))
    indexed = nodes.select(F.col("node").alias("own"), "vec")
    found = search(asked.join(indexed, "vec", "left").select(F.col("key").alias("query_id"), "unit", "own"), nodes, graph, beam)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 2048):
            a, c = matrix(b.column("q")), matrix(b.column("vec"))
            score = (a * c).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("ids"), pa.array(score)], names=["key", "ids", "score"])

    pairs = found.select(F.col("query_id").alias("key"), F.explode("found.node").alias("node"))
    exact = (pairs.join(asked.select("key", F.col("vec").alias("q")), "key")
             .join(nodes.select("node", "vec", "ids"), "node").select("key", "q", "vec", "ids")
             .mapInArrow(scored, "key long, ids array<long>, score double"))
    best = exact.select("key", F.explode("ids").alias("vec_id"), "score").groupBy("key").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i")))),
                1, k + 1).alias("l"))
    each = rows_of.withColumn("key", F.xxhash64("vec")).drop("vec").join(best, "key")
    mine = F.slice(F.filter("l", lambda x: x["i"] != F.col("query_id")), 1, k)
    return each.select("query_id", F.posexplode(mine).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score"))
