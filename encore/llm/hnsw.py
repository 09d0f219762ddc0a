"""Approximate nearest neighbours: a navigable small-world graph per shard.

The distinct vectors are dealt by hash to shards of about ``shard_rows``. Every
shard becomes one hierarchical graph stored as flat arrays: a level per vector
(geometric, from the hash of its least id), and per level the members and a
fixed number of neighbour slots each, -1 where empty. Neighbours come from the
exact nearest candidates of the shard by blocks of matrix products, thinned by
the diversity rule (a candidate is taken if it is nearer to the vector than to
any neighbour taken before), plus reverse links. Inner product is made a metric
by one more dimension that gives all vectors of a shard the same length.

Queries are dealt in blocks to all shards and run a beam search level by level,
many queries per numpy step; the shards' results are
merged by a window per query. Every row is indexed, none is sampled. Copies
of a vector share a graph node that lists their ids; a search for the ``k``
nearest needs the ``k + 1`` least ids of a node (the query's own may be among
them), so these travel with the graph and the number of copies beside them.

Results: null, zero and empty vectors and vectors with null or non-finite
components or another number of dimensions than most take no part: they are
neither queries nor candidates. Scores are inner products in double precision of
the original components; ties go to the smaller id. Rows without an id are not
indexed. Repeated ids count as one candidate at their best score. Empty tables
give empty results; fewer candidates than ``k`` give all that were found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, mix

SHARD_ROWS = 8192
LINKS = 24              # neighbours above the lowest level; twice as many on it
CANDIDATES = 48         # nearest candidates that the diversity rule chooses from
BEAM = 64
UPPER = 32              # beam on the levels above the lowest
BLOCK = 1024            # queries searched together
_STEP = 4               # beam entries expanded per query and step


def usable(vec: str) -> Column:
    """Vectors that take part."""
    v = F.col(vec)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return (v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True))
            & F.exists(v, lambda x: x != 0))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """One row per vector: its least id, the ``k + 1`` least ids, and how many rows it has."""
    key = ["h", "vec"]
    keyed = rows.select("id", "vec", F.xxhash64("vec").alias("h"))
    counts = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    ranked = (keyed.distinct().withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy("id")))
                   .filter(F.col("r") <= k + 1)
                   .groupBy(*key).agg(F.sort_array(F.collect_list("id")).alias("ids")))
    return counts.join(ranked, key)


def _levels(ids: np.ndarray) -> np.ndarray:
    u = (mix(ids.astype(np.int64).view(np.uint64), 71) >> np.uint64(11)).astype(float) / float(1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-18)) / math.log(LINKS)).astype(np.int64)


def _padded(x: np.ndarray) -> np.ndarray:
    """Vectors with one more dimension, so that all have the longest one's length."""
    square = np.einsum("ij,ij->i", x, x)
    return np.hstack([x, np.sqrt(np.maximum(square.max() - square, 0))[:, None]]).astype(np.float32)


def _link(x: np.ndarray, slots: int, above: np.ndarray) -> np.ndarray:
    """Neighbour slots (rows of ``x``) of one level; ``above``: its rows that reach the next level.

    Besides its diverse nearest neighbours every row is linked, both ways, with
    the nearest row of the next level, so that a tight group stays reachable.
    """
    n = len(x)
    take = min(CANDIDATES, n - 1)
    if take <= 0:
        return np.full((n, slots), -1, np.int32)
    forward = slots if slots == LINKS else slots // 2
    us, vs, anchors = [], [], []
    for lo in range(0, n, 512):
        block = np.arange(lo, min(lo + 512, n))
        sims = x[block] @ x.T
        sims[np.arange(len(block)), block] = -np.inf
        near = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        order = np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        own = np.take_along_axis(sims, near, 1)
        among = np.matmul(x[near], x[near].transpose(0, 2, 1))
        taken = np.zeros(near.shape, bool)
        for c in range(take):
            crowded = (np.where(taken, among[:, c], -np.inf) > own[:, c:c + 1]).any(axis=1)
            taken[:, c] = ~crowded & (taken.sum(axis=1) < forward)
        row, col = np.nonzero(taken)
        us.append(block[row])
        vs.append(near[row, col])
        if len(above) > 1:
            up = sims[:, above]
            anchors.append(above[up.argmax(axis=1)])
    u = np.concatenate([*us, np.arange(n if anchors else 0)])
    v = np.concatenate([*vs, *anchors])
    pair = np.unique(np.concatenate([u * n + v, v * n + u]))
    u, v = pair // n, pair % n
    sim = np.einsum("ij,ij->i", x[u], x[v])
    if anchors:
        anchor = np.concatenate(anchors)
        forced = (anchor[u] == v) | (anchor[v] == u)
        sim = np.where(forced, sim + 4 * np.abs(sim).max(), sim)
    order = np.lexsort((-sim, u))
    u, v = u[order], v[order]
    place = np.arange(len(u)) - np.searchsorted(u, u)
    out = np.full((n, slots), -1, np.int32)
    fits = place < slots
    out[u[fits], place[fits]] = v[fits]
    return out


class Graph:
    """One shard: padded vectors and, per level from the lowest, members and neighbour slots."""

    def __init__(self, x: np.ndarray, members: list[np.ndarray], slots: list[np.ndarray]):
        self.x, self.members, self.slots = x, members, slots

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray) -> Graph:
        x = _padded(vectors)
        level = _levels(ids)
        members = [np.flatnonzero(level >= top) for top in range(int(level.max()) + 1)]
        above = [np.searchsorted(m, up) for m, up in zip(members, members[1:])] + [np.zeros(0, np.int64)]
        return cls(x, members, [_link(x[m], LINKS * (1 if i else 2), up)
                                for i, (m, up) in enumerate(zip(members, above))])

    def search(self, queries: np.ndarray, beam: int):
        """Rows of the nearest found, best first, -1 where none.

        The top level's members start the search; each level's best start the next.
        """
        q = np.hstack([queries, np.zeros((len(queries), 1), np.float32)])
        start = np.broadcast_to(self.members[-1][:UPPER], (len(q), min(UPPER, len(self.members[-1]))))
        for members, slots in zip(self.members[:0:-1], self.slots[:0:-1]):
            start = self._beam(q, members, slots, start, UPPER)
        return self._beam(q, self.members[0], self.slots[0], start, beam)

    def _beam(self, q, members, slots, start, beam):
        n = len(q)
        beam = max(beam, start.shape[1])
        node = np.full((n, beam), -1)
        sims = np.full((n, beam), -np.inf, np.float32)
        done = np.zeros((n, beam), bool)
        node[:, :start.shape[1]] = start
        sims[:, :start.shape[1]] = np.where(start < 0, -np.inf, np.einsum("ij,ikj->ik", q, self.x[start]))
        seen = np.zeros((n, len(self.x) + 1), bool)       # the last column stands for empty slots
        np.put_along_axis(seen, start, True, axis=1)
        seen[:, -1] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(done[live] | (node[live] < 0), -np.inf, sims[live])
            pick = np.argsort(-waiting, axis=1, kind="stable")[:, :_STEP]
            ready = np.take_along_axis(waiting, pick, 1) > -np.inf
            live, pick, ready = live[ready.any(axis=1)], pick[ready.any(axis=1)], ready[ready.any(axis=1)]
            if not len(live):
                break
            row = live[:, None]
            done[row, pick] |= ready
            near = slots[np.searchsorted(members, np.where(ready, node[row, pick], members[0]))]
            near = np.where(ready[:, :, None] & (near >= 0), members[near], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[row, near]] = -1
            seen[row, near] = True
            got = np.einsum("ij,ikj->ik", q[live], self.x[near], optimize=True).astype(np.float32)
            got[near < 0] = -np.inf
            all_node = np.hstack([node[live], near])
            all_sims = np.hstack([sims[live], got])
            all_done = np.hstack([done[live], np.zeros(near.shape, bool)])
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            node[live] = np.take_along_axis(all_node, top, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            done[live] = np.take_along_axis(all_done, top, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(np.where(sims > -np.inf, node, -1), order, 1)


_GRAPH = ("shard int, least array<long>, ids array<array<long>>, copies array<long>, dims int, "
          "vectors binary, members array<binary>, slots array<binary>")


def build_index(df: DataFrame, vec_id: str, vec: str, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: one row per shard, flat arrays."""
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).alias("vec")).filter(
        usable("vec") & F.col("id").isNotNull())
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dims = common.d if common else 0
    nodes = checkpointed(_distinct(rows.filter(F.size("vec") == dims), k))
    shards = max(1, -(-nodes.count() // shard_rows))

    def run(batches):
        batches = list(batches)
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        shard = table.column("shard").to_numpy()
        for s in np.unique(shard):
            part = table.filter(pa.array(shard == s)).combine_chunks().sort_by("least")
            least = part.column("least").to_numpy()
            x = np.array(part.column("vec").combine_chunks().flatten(), np.float64).reshape(len(least), dims)
            g = Graph.build(x.astype(np.float32), least)
            yield pa.RecordBatch.from_pylist([{
                "shard": int(s), "least": least.tolist(), "ids": part.column("ids").to_pylist(),
                "copies": part.column("copies").to_pylist(), "dims": dims, "vectors": x.tobytes(),
                "members": [m.astype(np.int32).tobytes() for m in g.members],
                "slots": [t.tobytes() for t in g.slots]}], schema=_arrow_schema())

    dealt = nodes.select("least", "ids", "copies", "vec",
                         F.pmod(F.xxhash64("least"), F.lit(shards)).cast("int").alias("shard"))
    return dealt.repartition(shards, "shard").mapInArrow(run, _GRAPH)


def _arrow_schema() -> pa.Schema:
    lists = pa.list_(pa.int64())
    return pa.schema([("shard", pa.int32()), ("least", lists), ("ids", pa.list_(lists)), ("copies", lists),
                      ("dims", pa.int32()), ("vectors", pa.binary()), ("members", pa.list_(pa.binary())),
                      ("slots", pa.list_(pa.binary()))])


def nearest(df: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = 20,
            beam: int = BEAM, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest of each query row, its own id left out."""
    index = checkpointed(build_index(df, vec_id, vec, k, shard_rows))
    asked = queries.select(F.col(vec_id).cast("long").alias("id"),
                           F.col(vec).cast("array<double>").alias("vec")).filter(
        usable("vec") & F.col("id").isNotNull()).distinct()
    blocks = max(1, -(-asked.count() // BLOCK))
    dealt = (asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
                  .groupBy("block").agg(F.collect_list(F.struct("id", "vec")).alias("queries")))
    shards = index.agg(F.max("shard")).first()[0]
    visits = (dealt.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(0 if shards is None else shards))))
                   .join(index, "shard"))
    beam = max(beam, k + 1)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from _search(row, beam, k)

    found = visits.mapInArrow(run, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def _search(row: dict, beam: int, k: int):
    dims = row["dims"]
    asked = [q for q in row["queries"] if len(q["vec"]) == dims]
    if not asked:
        return
    x = np.frombuffer(row["vectors"], np.float64).reshape(-1, dims)
    members = [np.frombuffer(m, np.int32).astype(np.int64) for m in row["members"]]
    slots = [np.frombuffer(t, np.int32).reshape(len(m), -1) for t, m in zip(row["slots"], members)]
    g = Graph(_padded(x.astype(np.float32)), members, slots)
    q = np.array([a["vec"] for a in asked], np.float64)
    node = g.search(q.astype(np.float32), min(beam, len(x)))
    who, what = np.nonzero(node >= 0)
    hit = node[who, what]
    score = np.einsum("ij,ij->i", q[who], x[hit])
    made = ([], [], [])
    taken = np.zeros(len(asked), np.int64)
    order = np.lexsort((-score, who))
    for w, h, s in zip(who[order].tolist(), hit[order].tolist(), score[order].tolist()):
        if taken[w] > k:
            continue
        own = asked[w]["id"]
        ids = [i for i in row["ids"][h] if i != own]
        taken[w] += len(ids)
        made[0].extend([own] * len(ids))
        made[1].extend(ids)
        made[2].extend([s] * len(ids))
    yield pa.RecordBatch.from_arrays([pa.array(made[0], pa.int64()), pa.array(made[1], pa.int64()),
                                      pa.array(made[2], pa.float64())],
                                     names=["query_id", "vec_id", "score"])
