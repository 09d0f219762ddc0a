"""Exact top-k inner products: elimination by a table of pivot distances.

Vectors are made integer, ``floor(scale * x)``. With ``d`` the Euclidean
distance, ``2 q.x = |q|^2 + |x|^2 - d(q, x)^2``, and for every pivot ``p``
``|d(q, p) - d(x, p)| <= d(q, x)``. The largest of these over all pivots is a
lower bound of the distance and so gives an upper bound of the score. The
candidates of a block are evaluated in order of this bound, and the block ends
when the bound falls below the queries' k-th best scores.

1. ``PIVOTS`` vectors that lie far from each other are taken from a bounded
   sample (the ``SAMPLE`` rows of least hash). Any pivots give exact results.
2. Every vector's distances to all pivots are computed once and written. A query
   is scored against the sample, which gives it a first k-th score, its floor.
3. Candidates and queries are sorted together by ranges of (nearest pivot, its
   distance, row), so copies and hot pivots are split by the row number. A task
   packs its rows into blocks of ``BLOCK`` candidates; the queries that fall into
   a block are scored against all of it, which may raise their floors.
4. Blocks of queries meet all blocks of candidates by equality on a shard
   number. A candidate block's ranges of pivot distances rule out the queries it
   cannot help. The others are searched ``TOGETHER`` at a time: candidates in
   order of their best bound, those that no query's floor admits left out; floors
   rise on the way. Only results that reach the floor leave the task.
5. A window per query keeps the best k of them.

Results: null vectors and vectors with null or non-finite components take no
part, rows without an id neither; empty vectors are zero. Shorter vectors count
as filled up with zeros. Scores are exact as long as they fit 64 bits; a
component beyond that range ends the job with an error. A query's candidates are
the rows with other ids than its own; repeated ids count once, at their best
score; a query id that stands for several vectors gets one answer, the best scores
of any of them. Ties go to the smaller id. Empty
tables give empty results; with fewer than k candidates all are returned. Other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import materialize

PIVOTS = 32
SAMPLE = 4096
BLOCK = 4096            # candidates of a block
QUERIES = 512           # queries of a block, at most
SHARD_BLOCKS = 4        # candidate blocks of a shard
TOGETHER = 64           # queries of a block that are searched together
FIRST = 256             # candidates evaluated before the bounds are looked at again
_EXACT = float(1 << 53)


def _integers(df: DataFrame, vec_id: str, vec: str, scale: int) -> DataFrame:
    """``(id, v)``: the rows that take part, as integers."""
    x = F.col(vec)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    return (df.filter(x.isNotNull() & F.col(vec_id).isNotNull() & ~F.coalesce(bad, F.lit(True)))
              .select(F.col(vec_id).cast("long").alias("id"),
                      F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v")))


def choose_pivots(rows: DataFrame, count: int = PIVOTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Far-apart vectors of a bounded sample, ``count`` at most; the sample's ids and vectors."""
    taken = rows.orderBy(F.xxhash64("v", "id"), "id").limit(SAMPLE).select("id", "v").toArrow()
    sample = _matrix(taken.column(1).combine_chunks(), None)
    x = sample.astype(np.float64)
    chosen, far = [0] if len(x) else [], np.full(len(x), np.inf)
    while chosen and len(chosen) < min(count, len(x)):
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
        if far.max() == 0:
            break
        chosen.append(int(far.argmax()))
    return sample[chosen], taken.column(0).to_numpy(), sample


def _matrix(column: pa.Array, dims: int | None) -> np.ndarray:
    """A list column as a matrix, short rows filled up with zeros."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    dims = max(int(size.max(initial=0)), dims or 0)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == dims).all():
        return flat.reshape(len(size), dims)
    out = np.zeros((len(size), dims), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _wide(x: np.ndarray, dims: int) -> np.ndarray:
    return x if x.shape[1] >= dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products: by floating point where every sum stays below 2^53."""
    dims = max(q.shape[1], x.shape[1])
    q, x = _wide(q, dims), _wide(x, dims)
    if not len(q) or not len(x) or not dims:
        return np.zeros((len(q), len(x)), np.int64)
    top = float(np.abs(q.astype(np.float64)).max()) * float(np.abs(x.astype(np.float64)).max()) * dims
    if top < _EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    dims = max(x.shape[1], pivots.shape[1])
    x, p = _wide(x, dims).astype(np.float64), _wide(pivots, dims).astype(np.float64)
    out = np.empty((len(x), len(p)))
    for i in range(len(p)):
        out[:, i] = np.sqrt(((x - p[i]) ** 2).sum(1))
    return out


def top_k(df: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", k: int = 20,
          scale: int = 64, count: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest scores of every query row."""
    spark = df.sparkSession
    rows = _integers(df, vec_id, vec, scale).distinct()
    asked = _integers(queries, vec_id, vec, scale).distinct()
    both = rows.withColumn("asks", F.lit(False)).unionByName(asked.withColumn("asks", F.lit(True)))
    known = spark.sparkContext.broadcast(choose_pivots(rows, count))    # ``SAMPLE`` vectors, whatever the table
    table = materialize(both.mapInArrow(_with_distances(known, k), _TABLE), "pivots")
    dealt = (table.withColumn("row", F.xxhash64("id", "v"))
                  .repartitionByRange("near", "far", "row").sortWithinPartitions("near", "far", "row"))
    packed = materialize(dealt.mapInArrow(_packer(k, block), _PACKED), "blocks")
    candidates, asking = packed.filter("not asks"), packed.filter("asks")
    shards = max(1, -(-candidates.count() // SHARD_BLOCKS))
    meet = (asking.select(F.col("ids").alias("q_ids"), F.col("dims").alias("q_dims"), F.col("vectors").alias("q"),
                          F.col("distances").alias("q_d"), F.col("floors").alias("q_floors"),
                          F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
                  .join(candidates.select("ids", "dims", "vectors", "distances", F.pmod("block", F.lit(shards))
                                          .cast("int").alias("shard")).hint("shuffle_hash"), "shard"))
    found = meet.drop("shard").mapInArrow(_searcher(k), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


_TABLE = "id long, v array<long>, asks boolean, near int, far double, d array<double>, floor long"
_PACKED = ("asks boolean, block long, ids binary, dims int, vectors binary, distances binary, floors binary")


def _with_distances(known, k: int):
    def run(batches):
        p, sample_ids, sample = known.value
        for batch in batches:
            column = batch.column(1)
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column(1), p.shape[1])
                d = _distances(x, p)
                asks = part.column(2).to_numpy(zero_copy_only=False)
                floor = np.full(len(x), NONE)
                floor[asks] = _floors(x[asks], part.column(0).to_numpy()[asks], sample, sample_ids, k)
                near = d.argmin(1) if d.shape[1] else np.zeros(len(d), np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(2), pa.array(near.astype(np.int32)),
                    pa.array(d[np.arange(len(d)), near] if d.shape[1] else np.zeros(len(d))),
                    pa.ListArray.from_arrays(np.arange(len(d) + 1, dtype=np.int32) * d.shape[1], d.ravel()),
                    pa.array(floor)], names=["id", "v", "asks", "near", "far", "d", "floor"])
    return run


def _packer(k: int, block: int):
    def run(batches):
        base = TaskContext.get().partitionId() << 33
        number, held, size = 0, [], 0

        def pack(held):
            nonlocal number
            t = pa.Table.from_batches(held).combine_chunks()
            asks = t.column("asks").combine_chunks().to_numpy(zero_copy_only=False)
            ids, floor = t.column("id").to_numpy(), t.column("floor").to_numpy()
            x = _matrix(_array(t, "v"), None)
            d = _matrix_of(_array(t, "d"), len(ids))
            own, want = np.flatnonzero(~asks), np.flatnonzero(asks)
            out = []
            if len(own):
                out.append((False, own, np.zeros(0, np.int64)))
            for at in range(0, len(want), QUERIES):
                q = want[at:at + QUERIES]
                out.append((True, q, np.maximum(floor[q], _floors(x[q], ids[q], x[own], ids[own], k))))
            rows = []
            for asking, part, floors in out:
                number += 1
                rows.append({"asks": asking, "block": base + number, "ids": ids[part].tobytes(), "dims": x.shape[1],
                             "vectors": np.ascontiguousarray(x[part]).tobytes(),
                             "distances": np.ascontiguousarray(d[part]).tobytes(), "floors": floors.tobytes()})
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("asks", pa.bool_()), ("block", pa.int64()), ("ids", pa.binary()), ("dims", pa.int32()),
                ("vectors", pa.binary()), ("distances", pa.binary()), ("floors", pa.binary())]))

        for batch in batches:
            while batch.num_rows:
                take = batch.slice(0, block - size)
                batch = batch.slice(take.num_rows)
                held.append(take)
                size += take.num_rows
                if size >= block:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)
    return run


def _array(t: pa.Table, name: str) -> pa.Array:
    column = t.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _matrix_of(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


NONE = -(1 << 63)


def _floors(q, q_ids, x, x_ids, k) -> np.ndarray:
    """Each query's k-th best score over distinct other ids of a block; ``NONE`` where there are fewer."""
    if not len(q):
        return np.zeros(0, np.int64)
    _, first = np.unique(x_ids, return_index=True)      # one row per id is enough for a floor
    x, x_ids = x[first], x_ids[first]
    if len(x_ids) <= k:
        return np.full(len(q), NONE)
    scores = _products(q, x)
    scores[q_ids[:, None] == x_ids[None, :]] = NONE
    return np.partition(scores, len(x_ids) - k, axis=1)[:, len(x_ids) - k]


def _searcher(k: int):
    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                yield from _search(row, k)
    return run


def _search(row: dict, k: int):
    """One block of queries against one block of candidates, some queries at a time."""
    q_ids, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
    q = np.frombuffer(row["q"], np.int64).reshape(len(q_ids), row["q_dims"])
    x = np.frombuffer(row["vectors"], np.int64).reshape(len(ids), row["dims"])
    dims = max(q.shape[1], x.shape[1])
    q, x = _wide(q, dims), _wide(x, dims)
    q_d = np.frombuffer(row["q_d"], np.float64).reshape(len(q_ids), -1)
    x_d = np.frombuffer(row["distances"], np.float64).reshape(len(ids), -1)
    floors = np.frombuffer(row["q_floors"], np.int64)
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    qq, xx = (qf ** 2).sum(1), (xf ** 2).sum(1)
    exact = np.abs(qf).max(initial=0) * np.abs(xf).max(initial=0) * dims < _EXACT
    slack = 1e-6 * (qq + xx.max()) + 1.0        # far above the rounding of single-precision distances
    # the whole block first: the gap between a query's distance and the block's range
    gap = np.maximum(x_d.min(0) - q_d, q_d - x_d.max(0)).max(1, initial=0.0)
    hopeful = np.flatnonzero((qq + xx.max() - np.maximum(gap, 0) ** 2) / 2 + slack >= floors)
    columns = np.ascontiguousarray(x_d.T.astype(np.float32))
    once = np.zeros(len(ids), bool)             # one row per id is enough for a floor
    once[np.unique(ids, return_index=True)[1]] = True
    for at in range(0, len(hopeful), TOGETHER):
        some = hopeful[at:at + TOGETHER]
        bound = _bounds(q_d[some].astype(np.float32), columns)
        np.multiply(bound, bound, out=bound)
        bound = (qq[some, None] + xx - bound) / 2 + slack[some, None]
        yield _best(qf[some] if exact else q[some], xf if exact else x, bound, floors[some].copy(), q_ids[some], ids,
                    once, k)


def _bounds(q_d: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Largest difference of distances over all pivots, a lower bound of every distance."""
    out = np.zeros((len(q_d), columns.shape[1]), np.float32)
    one = np.empty_like(out)
    for p in range(len(columns)):
        np.subtract(columns[p], q_d[:, p, None], out=one)
        np.abs(one, out=one)
        np.maximum(out, one, out=out)
    return out


def _best(q, x, bound, floors, q_ids, ids, once, k) -> pa.RecordBatch:
    """Candidates in order of their best bound until no bound reaches a floor; floors rise on the way."""
    order = np.argsort(-bound.max(0), kind="stable")
    who, what, scores = [], [], []
    held = np.full((len(q), 0), NONE)           # best scores of distinct ids so far
    at, step = 0, FIRST
    while at < len(order):
        take = order[at:at + step]
        at, step = at + step, step * 2
        open_ = bound[:, take] >= floors[:, None]
        live = open_.any(0)
        take, open_ = take[live], open_[:, live]
        if not len(take):
            continue
        got = (q @ x[take].T).astype(np.int64)
        open_ &= q_ids[:, None] != ids[take]
        held = np.concatenate([held, np.where(open_ & once[take], got, NONE)], axis=1)
        if held.shape[1] > k:
            held = np.partition(held, held.shape[1] - k, axis=1)[:, -k:]
        if held.shape[1] == k:
            floors = np.maximum(floors, held.min(1))
        row, col = np.nonzero(open_ & (got >= floors[:, None]))
        who.append(row)
        what.append(ids[take[col]])
        scores.append(got[row, col])
    who, what, scores = (np.concatenate(a) if a else np.zeros(0, np.int64) for a in (who, what, scores))
    order = np.lexsort((-scores, what, who))    # an id once, at its best
    who, what, scores = who[order], what[order], scores[order]
    first = np.ones(len(who), bool)
    first[1:] = (who[1:] != who[:-1]) | (what[1:] != what[:-1])
    who, what, scores = who[first], what[first], scores[first]
    order = np.lexsort((what, -scores, who))
    who, what, scores = who[order], what[order], scores[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    keep = place < k
    return pa.RecordBatch.from_arrays([pa.array(q_ids[who[keep]]), pa.array(what[keep]), pa.array(scores[keep])],
                                      names=["query_id", "vec_id", "score"])
