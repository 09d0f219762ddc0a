"""Prefix trie of conversations, aggregated over subtrees by an Euler tour.

A node is a distinct sequence of first turns (role, text). It is named by
(smallest member, depth): the nodes of one smallest member form one path down,
so the name is unique and the first child in order of members goes on the path.

1. Rows are shuffled by ranges of (conversation, turn), numbered there, and the
   numbers of earlier ranges are added from one row per (conversation, range).
2. A node's key is the exclusive or of 128 bits of SHA-256 of (depth, turn) over
   its prefix: a window per (conversation, range) and a prefix over the ranges.
   Nodes are a partial aggregate over (depth, key).
3. Every node has an enter and an exit arc. The arc after entering is the first
   child's enter or the own exit; after leaving, the next sibling's enter or the
   parent's exit. Arcs that follow each other down or up a path form one element
   of a linked list (at most ``RUN`` arcs), found by windows over (path, slice).
4. The list is ranked: while it is longer than ``JUMPED`` elements, random elements
   take in the next one, a quarter of the list each round, so all rounds together
   handle a few times the list; the rest by pointer jumping; then, round by round
   back, what was taken in. Rounds are written tables; the one before is removed.
5. Arc positions follow by arithmetic. Prefix sums over positions (slices of
   ``SLICE`` positions and a prefix over slices) give, between the enter and the
   exit of a node, the leaves and savings of its subtree.

Digests of members that end at a node are made of pieces: member ids are sorted
by ranges, joined to strings of up to ``PIECE`` ids per task, and only these
strings stream through one task per node, since SHA-256 is sequential.

Results: null roles and texts are empty, null turns come first, turns of equal
number are ordered by role and text. Rows without a conversation id form none
and are left out. A conversation without turns is a member of the root. Repeated
rows are turns of their own. Very long texts are shuffled once and then stand as
digests. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import discard, materialize

RUN = 4096
SLICE = 1 << 16
PIECE = 8192
JUMPED = 200_000        # list elements that pointer jumping ranks


def numbered_turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text") -> DataFrame:
    """``(c, g, pos, digest, bytes)``: each conversation's turns numbered from 1; ``g`` names the range."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = df.select(F.col(conv_id).cast("long").alias("c"), F.col(turn).cast("long").alias("t"),
                     empty(role).alias("r"), empty(text).alias("x")).filter(F.col("c").isNotNull())
    tie = F.concat("r", F.lit("\x00"), "x")
    said = F.concat(F.length("r").cast("string"), F.lit(":"), "r", "x").cast("binary")
    dealt = (rows.repartitionByRange(F.col("c"), F.col("t"), F.left(tie, F.lit(64)))
                 .sortWithinPartitions(F.col("c"), F.col("t"), tie)
                 .select("c", F.monotonically_increasing_id().alias("at"), F.unhex(F.sha2(said, 256)).alias("digest"),
                         F.octet_length("x").cast("long").alias("bytes")))
    turns = materialize(dealt, "turns").withColumn("g", F.shiftright("at", 33))
    runs = turns.groupBy("c", "g").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("c").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("c", "g", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return turns.join(before, ["c", "g"]).select(
        "c", "g", (F.col("before") + F.col("at") - F.col("first") + 1).alias("pos"), "digest", "bytes")


def rebuilt_turns(turns: DataFrame, ids: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Test conversations with shared beginnings: the first h turns of ``c - c % group``, then the
    own ones after the first h, h being a checksum of the id modulo ``most``.

    Gives the turns ``(c, g, depth, digest, bytes, length)`` and ``(c, length)`` of every id.
    """
    size = turns.groupBy("c").agg(F.max("pos").alias("n"))
    head = F.col("c") - F.col("c") % group
    plan = (ids.join(size, "c", "left").select(
        "c", F.coalesce("n", F.lit(0)).alias("n"), head.alias("head"),
        (F.crc32(F.col("c").cast("string").cast("binary")) % most).alias("h"))
        .join(size.select(F.col("c").alias("head"), F.col("n").alias("m")), "head", "left")
        .select("c", "head", "h", F.least("h", F.coalesce("m", F.lit(0))).alias("taken"), "n"))
    plan = plan.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    rest = ["digest", "bytes", "length"]
    own = (turns.join(plan, "c").filter("pos > h")
                .select("c", "g", (F.col("taken") + F.col("pos") - F.col("h")).alias("depth"), *rest))
    lent = (turns.filter((F.col("pos") < most) & (F.col("c") % group == 0)).withColumnRenamed("c", "head")
                 .join(plan, "head").filter("pos <= h")
                 .select("c", F.lit(-1).cast("long").alias("g"), F.col("pos").alias("depth"), *rest))
    return own.unionByName(lent), plan.select("c", "length")


def _half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("long")


def _nodes(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes ``(c, depth, parent, n_convs, bytes)`` and their members that end there ``(c, depth, member)``."""
    salted = F.sha2(F.concat(F.col("depth").cast("string").cast("binary"), F.lit(":").cast("binary"), "digest"), 256)
    keyed = turns.select("c", "g", "depth", "bytes", "length", salted.alias("_s")).select(
        "c", "g", "depth", "bytes", "length", _half(F.col("_s"), 1).alias("h1"), _half(F.col("_s"), 17).alias("h2"))
    upto = Window.partitionBy("c", "g").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("c").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    slices = keyed.groupBy("c", "g").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    slices = slices.select("c", "g", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(x) for x in ("x1", "x2")])
    rows = keyed.join(slices, ["c", "g"])
    rows = rows.select("c", "depth", "bytes", (F.col("depth") == F.col("length")).alias("ends"), "h1", "h2",
                       F.bit_xor("h1").over(upto).bitwiseXOR(F.col("x1")).alias("k1"),
                       F.bit_xor("h2").over(upto).bitwiseXOR(F.col("x2")).alias("k2"))
    zero = F.lit(0).cast("long")
    root = lengths.select("c", zero.alias("depth"), zero.alias("bytes"), (F.col("length") == 0).alias("ends"),
                          zero.alias("h1"), zero.alias("h2"), zero.alias("k1"), zero.alias("k2"))
    rows = materialize(rows.unionByName(root), "prefixes")
    found = materialize(rows.groupBy("depth", "k1", "k2").agg(
        F.min("c").alias("c"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"),
        F.min("h1").alias("h1"), F.min("h2").alias("h2")), "found")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                         F.col("c").alias("parent"))
    nodes = (found.withColumns({"p1": F.col("k1").bitwiseXOR(F.col("h1")), "p2": F.col("k2").bitwiseXOR(F.col("h2"))})
                  .join(above, ["depth", "p1", "p2"], "left")
                  .select("c", "depth", "parent", "n_convs", "bytes"))
    ends = (rows.filter("ends").select(F.col("c").alias("member"), "depth", "k1", "k2")
                .join(found.select("depth", "k1", "k2", "c"), ["depth", "k1", "k2"])
                .select("c", "depth", "member"))
    return nodes, ends


def _with_relatives(nodes: DataFrame) -> DataFrame:
    """Nodes with ``n_children``, the first child's name ``child`` and the next sibling's ``sibling``."""
    children = (nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("c"), F.col("depth") - 1)
                     .agg(F.count(F.lit(1)).alias("n_children"), F.min("c").alias("child"))
                     .withColumnRenamed("(depth - 1)", "depth"))
    # siblings in ranges: the next one inside the range, else the first of the next range
    dealt = materialize(nodes.repartitionByRange(F.col("parent"), F.col("depth"), F.col("c"))
                             .withColumn("g", F.spark_partition_id()), "siblings")
    inside = Window.partitionBy("parent", "depth", "g").orderBy("c")
    across = Window.partitionBy("parent", "depth").orderBy("g")
    begins = dealt.groupBy("parent", "depth", "g").agg(F.min("c").alias("b"), F.max("c").alias("c"))
    begins = (begins.withColumn("across", F.lead("b").over(across)).filter("across is not null")
                    .select("depth", "c", "across"))
    near = dealt.withColumn("near", F.lead("c").over(inside)).drop("g")
    return (near.join(children, ["c", "depth"], "left").join(begins, ["c", "depth"], "left")
                .select("c", "depth", "parent", "n_convs", "bytes",
                        F.coalesce("n_children", F.lit(0)).alias("n_children"), "child",
                        F.coalesce("near", "across").alias("sibling")))


def _tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes with the elements that hold their arcs, and the list ``(x, y, sx, sy, dist)``.

    An element is named by its path and twice the depth of its first arc, plus
    one for exits. ``sx, sy`` is the element after it, ``dist`` its number of arcs.
    """
    run = Window.partitionBy("c", F.floor(F.col("depth") / RUN)).orderBy("depth")
    goes_on = F.coalesce(F.col("child") == F.col("c"), F.lit(False))
    below = F.lead(F.col("sibling").isNotNull()).over(run)
    begins = (F.col("depth") % RUN == 0) | F.coalesce(F.col("parent") != F.col("c"), F.lit(True))
    leaves = ~goes_on | F.coalesce(below, F.lit(True)) | ((F.col("depth") + 1) % RUN == 0)
    marked = nodes.withColumns({"_b": begins, "_l": leaves})
    marked = marked.withColumns({
        "enter": F.max(F.when(F.col("_b"), F.col("depth"))).over(run.rowsBetween(Window.unboundedPreceding, 0)),
        "exit": F.min(F.when(F.col("_l"), F.col("depth"))).over(run.rowsBetween(0, Window.unboundedFollowing)),
    }).drop("_b", "_l")
    marked = materialize(marked, "arcs")
    down = marked.groupBy("c", "enter").agg(
        F.count(F.lit(1)).alias("dist"), F.max("depth").alias("d"), F.max_by("child", "depth").alias("child"))
    down = down.select(
        F.col("c").alias("x"), (F.col("enter") * 2).alias("y"), F.coalesce("child", "c").alias("sx"),
        F.when(F.col("child").isNull(), F.col("d") * 2 + 1).otherwise(F.col("d") * 2 + 2).alias("sy"), "dist")
    up = marked.groupBy("c", "exit").agg(
        F.count(F.lit(1)).alias("dist"), F.min("depth").alias("d"), F.min_by("sibling", "depth").alias("sibling"),
        F.min_by("parent", "depth").alias("parent"))
    up = up.select(
        F.col("c").alias("x"), (F.col("exit") * 2 + 1).alias("y"), F.coalesce("sibling", "parent").alias("sx"),
        F.when(F.col("sibling").isNotNull(), F.col("d") * 2)
         .when(F.col("parent").isNotNull(), F.col("d") * 2 - 1).alias("sy"), "dist")
    return marked, down.unionByName(up)


def _ranked(links: DataFrame) -> DataFrame:
    """``(x, y, dist)``: arcs from the beginning of each element to the end of the tour."""
    now, taken = materialize(links, "ranks"), []
    while now.count() > JUMPED:
        now, gone = _contracted(now, len(taken))
        taken.append(gone)
    now = _jumped(now).select("x", "y", "dist")
    for gone in reversed(taken):        # what was taken in lies behind the one that took it
        found = gone.join(now.select(F.col("x").alias("ox"), F.col("y").alias("oy"), "dist"), ["ox", "oy"])
        now = materialize(now.unionByName(found.select("x", "y", (F.col("dist") - F.col("behind")).alias("dist"))),
                          "ranks")
        discard(gone)
    return now


def _contracted(now: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """A list shorter by a quarter: by coins of a hash, heads take in the tails that follow them.

    Also the elements taken in: ``(x, y, ox, oy, behind)``, their taker and how far behind its beginning.
    """
    coin = F.pmod(F.xxhash64("x", "y", F.lit(number)), F.lit(2)) == 1
    heads, tails = now.filter(coin), now.filter(~coin)
    after = tails.select(F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("sx").alias("nx"),
                         F.col("sy").alias("ny"), F.col("dist").alias("more"))
    met = materialize(heads.join(after, ["sx", "sy"], "left"), "met")
    took = F.col("more").isNotNull()
    gone = materialize(met.filter(took).select(F.col("sx").alias("x"), F.col("sy").alias("y"), F.col("x").alias("ox"),
                                               F.col("y").alias("oy"), F.col("dist").alias("behind")), "taken")
    longer = met.select("x", "y", F.when(took, F.col("nx")).otherwise(F.col("sx")).alias("sx"),
                        F.when(took, F.col("ny")).otherwise(F.col("sy")).alias("sy"),
                        (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"))
    later = materialize(longer.unionByName(tails.join(gone.select("x", "y"), ["x", "y"], "left_anti")
                                           .select(*longer.columns)), "ranks")
    discard(met)
    discard(now)
    return later, gone


def _jumped(now: DataFrame) -> DataFrame:
    """Pointer jumping: every round each element points twice as far."""
    while not now.filter("sx is not null").isEmpty():
        ahead = now.select(F.col("x").alias("sx"), F.col("y").alias("sy"), F.col("sx").alias("nx"),
                           F.col("sy").alias("ny"), F.col("dist").alias("more"))
        moved = (now.filter("sx is not null").join(ahead, ["sx", "sy"])
                    .select("x", "y", F.col("nx").alias("sx"), F.col("ny").alias("sy"),
                            (F.col("dist") + F.col("more")).alias("dist")))
        later = materialize(moved.unionByName(now.filter("sx is null")), "ranks")
        discard(now)
        now = later
    return now


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the conversations given by ``turns`` (c, g, depth, digest, bytes, length)
    and ``lengths`` (c, length); see the module."""
    nodes, ends = _nodes(turns, lengths)
    nodes, links = _tour(_with_relatives(nodes))
    ranks = materialize(_ranked(links), "tour")
    total = nodes.count() * 2
    at = lambda name: ranks.select(
        F.col("x").alias("c"), F.col("y").alias(name), F.col("dist").alias(f"{name}_dist"))
    placed = (nodes.withColumns({"en": F.col("enter") * 2, "ex": F.col("exit") * 2 + 1})
                   .join(at("en"), ["c", "en"]).join(at("ex"), ["c", "ex"]))
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    arcs = placed.select("c", "depth", F.explode(F.array(
        F.struct((F.lit(total) - F.col("en_dist") + F.col("depth") - F.col("enter")).alias("pos"),
                 F.lit(False).alias("out"), leaf.alias("leaf"), saved.alias("saved")),
        F.struct((F.lit(total) - F.col("ex_dist") + F.col("exit") - F.col("depth")).alias("pos"),
                 F.lit(True).alias("out"), F.lit(0).cast("long").alias("leaf"),
                 F.lit(0).cast("long").alias("saved")))).alias("a")).select("c", "depth", "a.*")
    arcs = arcs.withColumn("g", F.floor(F.col("pos") / SLICE))
    upto = Window.partitionBy("g").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)    # one row per SLICE arcs
    slices = arcs.groupBy("g").agg(F.sum("leaf").alias("l0"), F.sum("saved").alias("s0")).select(
        "g", *[F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(x) for x in ("l0", "s0")])
    sums = arcs.withColumns({"ls": F.sum("leaf").over(upto), "ss": F.sum("saved").over(upto)}).join(slices, "g")

    def between(own, inside, before):       # after the exit less before the enter
        s = F.col(inside) + F.col(before)
        return F.sum(F.when(F.col("out"), s).otherwise(F.col(own) - s)).cast("long")

    whole = sums.groupBy("c", "depth").agg(between("leaf", "ls", "l0").alias("n_leaves"),
                                           between("saved", "ss", "s0").alias("saved_tokens"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return (nodes.join(whole, ["c", "depth"]).join(_ends(ends), ["c", "depth"], "left")
                 .select(F.col("c").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
                         "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none)
                         .alias("ends_sha256")))


# ---- members that end at a node -----------------------------------------------------
def _ends(ends: DataFrame) -> DataFrame:
    pieces = (ends.repartitionByRange("c", "depth", "member").sortWithinPartitions("c", "depth", "member")
                  .mapInArrow(_pieces, "c long, depth long, first long, piece string"))
    return (pieces.repartition("c", "depth").sortWithinPartitions("c", "depth", "first")
                  .mapInArrow(_digests, "c long, depth long, ends_sha256 string"))


def _pieces(batches):
    node, members, made = None, [], []

    def close():
        if members:
            made.append((*node, members[0], ",".join(map(str, members))))

    def batch():
        c, depth, first, piece = zip(*made)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(depth, pa.int64()),
                                           pa.array(first, pa.int64()), pa.array(piece, pa.string())],
                                          names=["c", "depth", "first", "piece"])

    for part in batches:
        for c, depth, member in zip(*(part.column(n).to_pylist() for n in ("c", "depth", "member"))):
            if (c, depth) != node or len(members) >= PIECE:
                close()
                node, members = (c, depth), []
            members.append(member)
        if len(made) >= 1000:
            yield batch()
            made.clear()
    close()
    if made:
        yield batch()


def _digests(batches):
    node, digest = None, None

    def batch(made):
        return pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.int64()),
                                           pa.array([m[1] for m in made], pa.int64()),
                                           pa.array([m[2] for m in made], pa.string())],
                                          names=["c", "depth", "ends_sha256"])

    for part in batches:
        made = []
        for c, depth, piece in zip(*(part.column(n).to_pylist() for n in ("c", "depth", "piece"))):
            if (c, depth) != node:
                if node is not None:
                    made.append((*node, digest.hexdigest()))
                node, digest = (c, depth), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        yield batch(made)
    if node is not None:
        yield batch([(*node, digest.hexdigest())])
