"""Near-duplicate documents by b-bit MinHash.

A document is its set of word shingles. ``HASHES`` permutation minima are taken
per set; bands of ``ROWS`` minima give candidates, and the lowest ``BITS`` bits
of every minimum are packed into a signature. For a candidate pair the share of
equal lanes, counted with bit operations and corrected for the chance ``2**-b``
that unequal minima share their low bits, estimates the similarity; only pairs
whose estimate lies within seven standard deviations of the threshold or above
go on to the full sets, which confirm every link.

Equal sets are one node (a group of copies costs one row). No pairs of a band
bucket are enumerated: every member is compared with the bucket's least node,
and the confirmed links are closed into components. Buckets that share members
form clusters; in a cluster that still holds several components, members outside
its largest one are compared with the members of other components, in pairs of
bounded blocks whose tasks emit nothing but links. A link inside one component
adds nothing to it, so no link between different classes is lost. The work is
quadratic only in a cluster's documents that lie near each other without being
linked. With 32 bands of 4 rows a pair at similarity 0.8 shares no band with
probability 5e-8.

Results: null and empty texts (no words) have an empty set, link with nothing
and are their own component. Texts with fewer words than a shingle have their
whole sequence as the only shingle. Repeated rows share a component. Rows
without an id take the component of their copies (null if none has an id) and
are kept. An id on several different texts: each row takes the component of its
own text, and texts whose least id is the same count as one. Very long texts are shingled whole; an empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import materialize
from .common import BASE_A, Rolling, among, checkpointed, mix, ranges, row_key, signed, text_chunks, words
from .components import components

HASHES = 128
BITS = 2
ROWS = 4
BLOCK = 50_000          # shingles in a block of the final comparison
_LANES = 64 // BITS
_LOW = 0x5555555555555555       # the lowest bit of every lane of two


def _shingles(data, offsets, size: int):
    """Sorted shingle hashes per text with the first of equals marked: ``(h, new, start)``."""
    doc, _, _, h = words(data, offsets, lower=True)
    docs = len(offsets) - 1
    first = np.searchsorted(doc, np.arange(docs + 1))
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    at = ranges(first[:-1], count)
    end = np.minimum(at + size, np.repeat(first[1:], count))
    out = mix(Rolling(h, BASE_A).slices(at, end) + (end - at).astype(np.uint64), 41)
    start = np.concatenate([[0], np.cumsum(count)])
    for a, b in zip(start[:-1].tolist(), start[1:].tolist()):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[start[:-1][count > 0]] = True
    return out, new, start


def _minima(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Minima of every permutation (rows) for the non-empty segments starting at ``begin``."""
    rng = np.random.default_rng(20240229)
    factor = rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shift = rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
    x = (h >> np.uint64(32)).astype(np.uint32)
    out = np.empty((HASHES, len(begin)), np.uint32)
    for j in range(HASHES):
        np.minimum.reduceat(x * factor[j] + shift[j], begin, out=out[j])
    return out


def _packed(minima: np.ndarray) -> np.ndarray:
    """The low bits of all minima as ``HASHES * BITS / 64`` words per document."""
    low = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64)
    out = np.zeros((HASHES // _LANES, minima.shape[1]), np.uint64)
    for j in range(HASHES):
        out[j // _LANES] |= low[j] << np.uint64(BITS * (j % _LANES))
    return out


def _bands(minima: np.ndarray) -> np.ndarray:
    out = np.empty((HASHES // ROWS, minima.shape[1]), np.uint64)
    for band in range(len(out)):
        key = np.full(minima.shape[1], band, np.uint64)
        for r in range(ROWS):
            key = mix(key ^ minima[band * ROWS + r].astype(np.uint64), 51)
        out[band] = key
    return out


def _lists(values: np.ndarray, filled: np.ndarray, n: int) -> pa.Array:
    """One list per document; empty sets have an empty list."""
    width = values.shape[0]
    offsets = np.zeros(n + 1, np.int32)
    offsets[1:] = np.cumsum(np.where(filled, width, 0))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(values.T.copy().reshape(-1))))


def signatures(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``(id, n, s1, s2, bits, bands)``: set size, 128-bit set key, packed signature, band keys."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                h, new, start = _shingles(data, offsets, size)
                docs_n = hi - lo
                filled = np.diff(start) > 0
                begin = start[:-1][filled]
                n, s1, s2 = (np.zeros(docs_n, np.uint64) for _ in range(3))
                minima = np.zeros((HASHES, 0), np.uint32)
                if len(begin):
                    n[filled] = np.add.reduceat(new.astype(np.uint64), begin)
                    for s, salt in ((s1, 61), (s2, 62)):
                        s[filled] = np.add.reduceat(np.where(new, mix(h, salt), np.uint64(0)), begin)
                    minima = _minima(h, begin)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, docs_n), pa.array(signed(n)), pa.array(signed(s1)), pa.array(signed(s2)),
                     _lists(_packed(minima), filled, docs_n), _lists(_bands(minima), filled, docs_n)],
                    names=["id", "n", "s1", "s2", "bits", "bands"])

    return docs.select(F.col(doc_id).cast("long"), text).mapInArrow(
        run, "id long, n long, s1 long, s2 long, bits array<long>, bands array<long>")


def _sets(docs: DataFrame, doc_id: str, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """Full sets ``(node, set)`` of the wanted nodes."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                h, new, start = _shingles(data, offsets, size)
                sizes = np.concatenate([[0], np.cumsum(new)])[start]
                lists = pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32)), pa.array(signed(h[new])))
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), lists], names=["node", "set"])

    wanted = checkpointed(wanted)
    rows = docs.select(F.col(doc_id).cast("long").alias("node"), text).filter(among(wanted, F.col("node")))
    return (rows.join(wanted, "node", "left_semi").mapInArrow(run, "node long, set array<long>")
                .filter(F.size("set") > 0))


def unequal_lanes(x: str, y: str) -> Column:
    """Lanes in which two packed signatures differ."""
    total = F.lit(0)
    for i in range(HASHES // _LANES):
        d = F.col(x)[i].bitwiseXOR(F.col(y)[i])
        total = total + F.bit_count((d.bitwiseOR(F.shiftrightunsigned(d, 1))).bitwiseAND(F.lit(_LOW)))
    return total


def estimate(x: str, y: str) -> Column:
    """Similarity estimated from two packed signatures, corrected for chance agreement."""
    chance = 2.0 ** -BITS
    return (1 - unequal_lanes(x, y) / HASHES - chance) / (1 - chance)


def estimate_floor(similarity: float) -> float:
    """Lowest estimate that a pair at the similarity shows, up to seven standard deviations."""
    chance = 2.0 ** -BITS
    p = similarity * (1 - chance) + chance
    return ((p - 7 * (p * (1 - p) / HASHES) ** 0.5) - chance) / (1 - chance)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets reach the similarity."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    other = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(other, "b")
                 .filter(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
                 .select("a", "b").distinct())


def _across(clusters: DataFrame, grouped: DataFrame, facts: DataFrame, sets: DataFrame, percent: int,
            floor: float) -> DataFrame:
    """Links ``(a, b)`` between different components of one cluster.

    Members outside a cluster's largest component meet all members of other
    components, in blocks of about ``BLOCK`` shingles: a row is two blocks, and
    only links leave the task, one per node and component met.
    """
    member = (clusters.join(grouped, "node", "left")
                      .select("cluster", "node", F.coalesce("component", "node").alias("component")))
    per = member.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("c"))
    main = (per.groupBy("cluster").agg(F.count(F.lit(1)).alias("parts"),
                                       F.max(F.struct("c", "component")).alias("m"))
               .filter("parts > 1").select("cluster", F.col("m.component").alias("main")))
    member = (member.join(main, "cluster").join(facts, "node")
                    .withColumn("minor", F.col("component") != F.col("main")))
    totals = member.groupBy("cluster", "minor").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    placed = (member.join(totals, ["cluster", "minor"]).join(sets, "node")
                    .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    blocks = checkpointed(placed.groupBy("cluster", "minor", "block").agg(
        F.collect_list(F.struct("node", "component", "bits", "set")).alias("members")))
    minors = blocks.filter("minor").select("cluster", F.col("block").alias("i"), F.col("members").alias("x"))
    others = totals.select("cluster", "minor", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    meets = (minors.select("cluster", "i").join(others, "cluster")
                   .filter(~F.col("minor") | (F.col("block") >= F.col("i"))))
    rows = (meets.join(blocks.withColumnRenamed("members", "y"), ["cluster", "minor", "block"])
                 .join(minors, ["cluster", "i"]))

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                a, b = _meet(batch.column(0)[at].values, batch.column(1)[at].values, percent, floor)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    found = rows.select("x", "y").mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _meet(x: pa.StructArray, y: pa.StructArray, percent: int, floor: float):
    """Confirmed links between two blocks: for every node of ``x``, one per component of ``y``."""
    (na, ca, ba, sa), (nb, cb, bb, sb) = ([f for f in s.flatten()] for s in (x, y))
    na, ca, nb, cb = (v.to_numpy() for v in (na, ca, nb, cb))
    ba, bb = (np.asarray(v.flatten()).view(np.uint64).reshape(len(v), -1) for v in (ba, bb))
    unequal = np.zeros((len(ba), len(bb)), np.int16)
    for i in range(ba.shape[1]):
        d = ba[:, None, i] ^ bb[None, :, i]
        unequal += np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(_LOW)).astype(np.int16)
    chance = 2.0 ** -BITS
    likely = ((1 - unequal / HASHES - chance) / (1 - chance) >= floor) & (ca[:, None] != cb[None, :])
    rows, cols = np.flatnonzero(likely.any(axis=1)), np.flatnonzero(likely.any(axis=0))
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size_a, size_b = (np.asarray(s.value_lengths()).astype(np.int64) for s in (sa, sb))
    both = _shared(sa.take(pa.array(rows)), sb.take(pa.array(cols)))
    union = size_a[rows][:, None] + size_b[cols][None, :] - both
    linked = (100 * both >= percent * union) & likely[np.ix_(rows, cols)]
    i, j = np.nonzero(linked)
    _, one = np.unique(np.stack([na[rows[i]], cb[cols[j]]], axis=1), axis=0, return_index=True)
    return na[rows[i[one]]], nb[cols[j[one]]]


def _shared(sa: pa.ListArray, sb: pa.ListArray) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by products of 0/1 matrices."""
    va, vb = np.asarray(sa.flatten()), np.asarray(sb.flatten())
    ra, rb = (np.repeat(np.arange(len(s)), np.asarray(s.value_lengths())) for s in (sa, sb))
    vocabulary = np.intersect1d(va, vb)
    out = np.zeros((len(sa), len(sb)), np.int64)
    ka, kb = np.isin(va, vocabulary), np.isin(vb, vocabulary)
    pa_, pb_ = np.searchsorted(vocabulary, va[ka]), np.searchsorted(vocabulary, vb[kb])
    ra, rb = ra[ka], rb[kb]
    for lo in range(0, len(vocabulary), 4096):
        ma, mb = (np.zeros((len(s), 4096), np.float32) for s in (sa, sb))
        for m, r, p in ((ma, ra, pa_), (mb, rb, pb_)):
            of = (p >= lo) & (p < lo + 4096)
            m[r[of], p[of] - lo] = 1
        out += (ma @ mb.T).astype(np.int64)
    return out


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` per row: links at ``percent`` or more of set similarity.

    A component is named after its least id; that document is kept.
    """
    floor = estimate_floor(percent / 100)
    docs = df.select(doc_id, text)
    sigs = checkpointed(signatures(docs, doc_id, text, size))
    nodes = checkpointed(
        sigs.filter("n > 0 and id is not null").groupBy("s1", "s2")
            .agg(F.min("id").alias("node"), F.first("n").alias("n"),
                 F.first("bits").alias("bits"), F.first("bands").alias("bands")))
    facts = nodes.select("node", "n", "bits")
    rows = nodes.select("node", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).filter("hub < top")
    shared = checkpointed(rows.join(buckets.select("key", "hub"), "key"))

    sides = [facts.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("bits").alias(f"x{s}"))
             for s in "ab"]
    likely = ((F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
              & (estimate("xa", "xb") >= floor))
    stars = checkpointed(shared.filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
                               .distinct().join(sides[0], "a").join(sides[1], "b").filter(likely)
                               .select("a", "b"))
    sets = checkpointed(_sets(docs, doc_id, text, size, shared.select("node").distinct()).distinct())
    links = checkpointed(_confirm(stars, sets, percent))
    grouped = components(links)

    # clusters of band buckets that still hold several components
    clusters = components(shared.filter("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
                                .distinct()).withColumnRenamed("component", "cluster")
    late = checkpointed(_across(clusters, grouped, facts, sets, percent, floor))
    if not late.isEmpty():
        ties = grouped.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
        grouped = components(ties.unionByName(late))

    named = (nodes.select("s1", "s2", "node").join(grouped, "node", "left")
                  .select("s1", "s2", F.coalesce("component", "node").alias("component")))
    return (sigs.join(named, ["s1", "s2"], "left")
                .withColumn("component", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")))
                .select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"),
                        (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept")))


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                         percent: int = 80) -> DataFrame:
    """The input without all but the least id of each component.

    Fully equal rows become one; rows without an id stay.
    """
    found = materialize(near_duplicates(df, doc_id, text, size, percent).filter(F.col(doc_id).isNotNull())
                        .select(F.col(doc_id).alias("_id"), "kept"), "near-duplicates")
    # ids that go and ids on several rows; all other rows stay where they are
    apart = (found.groupBy("_id").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
                  .filter("not kept or n > 1").select(F.col("_id").cast("long").alias("_id")))
    maybe = among(apart, F.col(doc_id).cast("long"))
    kept = found.filter("kept").select("_id").distinct()
    named = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    rows = df.filter(maybe).select(*[F.col(c).alias(n) for c, n in named.items()], *row_key(df, *df.columns))
    some = (rows.join(kept.hint("shuffle_hash"), rows[named[doc_id]] == kept["_id"])
                .dropDuplicates(["_id", "r1", "r2"]).select(*[F.col(n).alias(c) for c, n in named.items()]))
    return (df.filter(F.col(doc_id).isNotNull() & ~maybe).unionByName(some)
              .unionByName(df.filter(F.col(doc_id).isNull())))
