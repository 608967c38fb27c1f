"""The trie of conversation prefixes, with subtree totals by a rollup over depth bands.

A node is a distinct sequence of first turns. Its key is the XOR of two 64-bit hashes of (depth, role, text) per turn, so a
key is a running value along a conversation, a parent's key is the node's without its last turn, and texts are read once.
Conversations are ordered by a prefix scan over pieces: one with a third of all turns is cut like any other range.

Depths are cut into bands of BAND. Every (conversation, band) is one row with its at most BAND nodes. A node counts in the
path of its smallest member only, and in such a path these nodes come last, so each ancestor inside the band gets a suffix
sum: totals are added up inside the row and shuffled once per path node. That gives each node the total of its subtree inside
its band. The first nodes of the bands form a trie of their own, BAND times less deep, which is rolled up in the same way, and
their finished totals are then handed to their ancestors in the band above. A trie of depth D takes 2 log_BAND(D) rounds, and
no node explodes to more than BAND ancestors in any of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agoralake.operators.scan import in_pieces, running
from agoralake.session import stored

BAND = 16
HEAD = 5          # turns a conversation can take from its base: its checksum modulo 6
GROUP = 100       # conversations that share a base
NODE = ["depth", "k1", "k2"]


def _hash(seed: int, *columns) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def taken_turns(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, t1, t2, chars, idx, _piece): turns as hashes, numbered from 1; of equal turn numbers the lesser hash is first."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), _hash(1, role, text).alias("t1"),
        _hash(2, role, text).alias("t2"), F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("tie"))
    order = ["turn", "t1", "t2", "tie"]
    rows = in_pieces(turns, ["conv_id"], order, name="turns")
    return running(rows, ["conv_id"], order, {"idx": ("number", None)}).select("conv_id", "t1", "t2", "chars", "idx", "_piece")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """A row (conv_id, depth, k1, k2, p1, p2, chars, ends) per node on the way of each rebuilt conversation, the root included;
    ``p`` is the parent's key, and ``ends`` says that the conversation has no more turns."""
    turns = stored(ordered_turns(conversations), "ordered-turns")
    heads = turns.where(F.col("idx") <= HEAD).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("idx", "t1", "t2", "chars"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.max("idx").alias("n")).withColumn("h", taken_turns(F.col("conv_id"))).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % GROUP)
    convs = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", "n", "h", F.slice(F.coalesce("head", F.array().cast(heads.schema["head"].dataType)), F.lit(1), F.col("h")).alias("head"))
    convs = convs.withColumn("m", F.size("head").cast("long")).withColumn("n_turns", F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    z = lambda seed, t, depth: _hash(seed, depth, t)
    keyed = lambda seed, t: F.aggregate("head", F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(z(seed, x[t], x["idx"])))
    convs = stored(convs.withColumn("b1", keyed(3, "t1")).withColumn("b2", keyed(4, "t2")), "conversations")
    # The shared first turns: prefixes of the head.
    first = convs.select("conv_id", "n_turns", F.explode(F.expr(
        "transform(head, (x, i) -> struct(slice(head, 1, i + 1) as upto, x.idx as depth, x.t1 as t1, x.t2 as t2, x.chars as chars))")).alias("x"))
    prefix = lambda seed, t: F.aggregate("x.upto", F.lit(0).cast("long"), lambda a, y: a.bitwiseXOR(z(seed, y[t], y["idx"])))
    first = first.select("conv_id", "n_turns", F.col("x.depth").alias("depth"), prefix(3, "t1").alias("k1"), prefix(4, "t2").alias("k2"),
                         z(3, F.col("x.t1"), F.col("x.depth")).alias("z1"), z(4, F.col("x.t2"), F.col("x.depth")).alias("z2"), F.col("x.chars").alias("chars"))
    # Own turns after the first h: depths are known per conversation, then the keys run on along the pieces.
    own = running(turns, ["conv_id"], ["idx"], {"_n": ("number", None)}, per_key=convs.select("conv_id", "h", "m")).where(F.col("idx") > F.col("h"))
    own = own.withColumn("depth", F.col("idx") - F.col("h") + F.col("m"))
    own = own.select("conv_id", "depth", "chars", "_piece", z(3, F.col("t1"), F.col("depth")).alias("z1"), z(4, F.col("t2"), F.col("depth")).alias("z2"))
    own = running(own, ["conv_id"], ["depth"], {"o1": ("bit_xor", "z1"), "o2": ("bit_xor", "z2")},
                  per_key=convs.select("conv_id", "n_turns", "b1", "b2"))
    own = own.select("conv_id", "n_turns", "depth", F.col("o1").bitwiseXOR(F.col("b1")).alias("k1"), F.col("o2").bitwiseXOR(F.col("b2")).alias("k2"), "z1", "z2", "chars")
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", "n_turns", *[zero.alias(c) for c in ("depth", "k1", "k2", "z1", "z2", "chars")])
    return root.unionByName(first).unionByName(own).select(
        "conv_id", *NODE, F.col("k1").bitwiseXOR(F.col("z1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("z2")).alias("p2"), "chars",
        (F.col("depth") == F.col("n_turns")).alias("ends"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, k1, k2, conv_id) in order: per node the SHA-256 of its ids, which pass through one by one."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in node], pa.array([state.hexdigest()])], names=[*NODE, "ends_sha256"])

    for batch in batches:
        done = []
        for key in zip(*[batch.column(i).to_pylist() for i in range(4)]):
            if key[:3] == node:
                state.update(f",{key[3]}".encode())
                continue
            if node is not None:
                done.append(row())
            node, state = key[:3], hashlib.sha256(str(key[3]).encode())
        yield from done
    if node is not None:
        yield row()


def paths_of(rows: DataFrame, band: int) -> DataFrame:
    """One row per (conversation, band) with its nodes by depth; at most ``band`` of them."""
    return rows.groupBy("conv_id", F.floor(F.col("depth") / band).alias("band")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "k1", "k2"))).alias("path"))


def subtree_sums(rows: DataFrame, weights: DataFrame, columns: list[str], band: int = BAND) -> DataFrame:
    """NODE and the sums of ``columns`` over each node's subtree, the node included.

    ``rows`` are (conv_id, depth, k1, k2), all nodes on each conversation's way; ``weights`` has a row per node with
    ``conv_id``, its smallest member. Depths count the steps of this trie.
    """
    paths = stored(paths_of(rows, band), "trie-paths")
    deepest = rows.agg(F.max("depth")).first()[0]
    own = weights.groupBy("conv_id", F.floor(F.col("depth") / band).alias("band")).agg(
        F.collect_list(F.struct("depth", *columns)).alias("own"))
    total = lambda a, c: F.aggregate(F.filter("own", lambda x: x["depth"] >= a["depth"]), F.lit(0).cast("long"), lambda s, x: s + x[c])
    inside = stored(paths.join(own, ["conv_id", "band"]).select(F.explode(F.transform("path", lambda a: F.struct(
        a["depth"].alias("depth"), a["k1"].alias("k1"), a["k2"].alias("k2"), *[total(a, c).alias(c) for c in columns]))).alias("x")).select(
            "x.*").groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in columns]), "band-totals")
    if deepest is None or deepest < band:
        return inside
    # The first nodes of the bands, one step deep per band: their finished totals, then handed on to the band above.
    steps = lambda df: df.where(F.col("depth") % band == 0).withColumn("depth", F.floor(F.col("depth") / band))
    firsts = steps(weights.select("conv_id", *NODE).join(inside, NODE))
    done = subtree_sums(steps(rows), firsts, columns, band)
    below = firsts.select("conv_id", *NODE).where("depth > 0").join(done, NODE).select(
        "conv_id", (F.col("depth") - 1).alias("band"), *columns)
    handed = paths.join(below, ["conv_id", "band"]).select(F.explode("path").alias("x"), *columns).select(
        "x.depth", "x.k1", "x.k2", *columns)
    return stored(inside.unionByName(handed).groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in columns]), "subtree-totals")


def prefix_trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns come by number (null first; equal numbers in the order of a hash of role and text, the same at every run), null
    roles and texts are empty, repeated rows are turns of their own. Rows without a conv_id belong to no conversation. A
    conversation without turns is a member of the root alone. An empty table gives no rows; other columns are not read.
    The ids that end at one node pass in order through the task that makes their digest, with constant memory.
    """
    rows = stored(rebuilt(conversations), "trie-rows")
    nodes = rows.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                    F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("chars").alias("chars"))
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    weights = stored(nodes.join(children, NODE, "left").select(
        "conv_id", *NODE, "n_convs", "p1", "p2", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), "trie-weights")
    sums = subtree_sums(rows.select("conv_id", *NODE), weights.select("conv_id", *NODE, "n_leaves", "saved_tokens"), ["n_leaves", "saved_tokens"], band)
    digests = rows.where("ends").select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id").mapInArrow(_digests, "depth long, k1 long, k2 long, ends_sha256 string")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    return weights.drop("n_leaves", "saved_tokens").join(sums, NODE).join(digests, NODE, "left").join(
        parents, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
