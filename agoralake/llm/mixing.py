"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are put in the order of a hash: a permuted stream of words, cut into equally long blocks. A
source's target becomes an exact number of blocks (its quota; beyond one pass the stream starts again). A binary tree
deals all drawn blocks to the output shards: a node's blocks are put in random order and the first half goes left, so the
numbers per source are a multivariate-hypergeometric draw and the quotas add up exactly at every level. The dealt blocks
decide what is taken: a document's words count where a block that some shard drew covers them, and each copy of a document
stands in the shard that drew it. Inside a shard copies are ordered by a hash.

Running sums are made in two levels (per hash bucket of a source, then inside the bucket), so a source that holds a third
of all rows is spread over thousands of groups. Tables of sources and of drawn blocks depend on the number of sources
only. All steps are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from agoralake.llm.common import broadcast_if_small, packed, unpacked
from agoralake.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5      # words of the mix over words of all sources
MAX_PASSES = 2   # a target stops at so many times its source's words
BLOCKS = 512     # blocks of each source's stream
LEVELS = 5       # the tree has 2 ** LEVELS shards
BUCKET_DIGITS = 3  # hex digits of the order hash: 4096 buckets a source
SLICE_DIGITS = 3   # hex digits of the place: 4096 slices a shard when copies are brought in order


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = MAX_PASSES) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row per source, null included.

    Sources in code point order, null last, take the weights in turn. A target over the cap is cut and the excess goes to
    the others by weight: the level at which caps and shares fill the total is found from running sums over the sources
    in the order in which they reach their caps.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1)
    cap = F.col("source_size") * float(passes)
    ranked = sizes.withColumn("w", w).withColumn("cap", cap).withColumn("at", F.col("cap") / F.col("w"))
    order = W.orderBy("at", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    every = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum("source_size").over(every) * float(share)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    leveled = ranked.withColumn("level", level).withColumn("n", F.row_number().over(order))
    fits = F.when(F.col("level") <= F.col("at"), F.struct("n", "level"))
    return leveled.withColumn("level", F.min(fits).over(every)["level"]).select(
        "source", "source_size",
        F.coalesce(F.least("cap", F.col("w") * F.col("level")), F.col("cap")).alias("target"))


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = 7) -> DataFrame:
    """(source, draw, shard): every drawn block (source, quota) dealt to a leaf of the splitting tree.

    ``draw`` numbers a source's drawn blocks from 0. Shards hold equal numbers of blocks, give or take one per level.
    """
    units = quotas.filter("quota > 0").select(
        "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("draw")).withColumn("shard", F.lit(0))
    for level in range(levels):
        name = F.concat(F.lit(f"{seed}:{level}:"), "draw", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
        order = W.partitionBy("shard").orderBy(F.md5(name), "source", "draw")
        half = F.ceil(F.count(F.lit(1)).over(W.partitionBy("shard")) / 2)
        units = units.withColumn("shard", F.col("shard") * 2 + (F.row_number().over(order) > half).cast("int"))
    return units


def mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, passes: int = MAX_PASSES, blocks: int = BLOCKS,
        levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, row_hash, size, source_size, target, taken, source, copies, draws.

    row_hash tells rows apart that share a doc_id. draws: (draw, shard, words, place) for every dealt block that covers words
    of the document, in the order of ``draw`` (from ``blocks`` on a second pass), place being the order inside the shard.
    taken: the words of all draws, a second pass counted again; a source's sum is its target rounded to blocks. copies: times
    the document is emitted when documents are kept whole. A null or empty text has size 0 and no draws; rows that repeat
    each other are mixed each; an empty table gives no rows; other columns are not read.
    """
    thin = stored(documents.select(
        "doc_id", F.xxhash64("text").alias("row_hash"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h")), "mix-sizes")
    thin = thin.withColumn("bucket", F.substring("h", 1, BUCKET_DIGITS))
    sums = stored(thin.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    goals = stored(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, passes).withColumn(
        "quota", F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * blocks)).otherwise(0).cast("long")),
        "mix-targets")
    dealt = stored(split_quotas(goals.select("source", "quota"), levels).groupBy("source").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("draw", "shard"))), lambda x: x["shard"]).alias("shards")).select(
        F.col("source").alias("d_source"), "shards"), "mix-dealt")  # shards by draw, at most passes * blocks of them
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("first", F.coalesce(F.sum("words").over(earlier), F.lit(0))).alias("s").join(
        goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        F.col("s.source").alias("b_source"), F.col("bucket").alias("b_bucket"), "first", "source_size", "target", "quota")
    starts = stored(starts, "mix-starts")
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = thin.withColumn("run", F.sum("size").over(inside) - F.col("size")).join(
        starts, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    # The block of a word w is the last one that starts at or before it; block b starts at b * source_size div blocks.
    held = placed.withColumn("at", F.col("first") + F.col("run")).join(
        broadcast_if_small(dealt, 4 * passes * blocks), F.col("source").eqNullSafe(F.col("d_source")), "left")
    covered = F.when(F.col("size") > 0, F.expr(
        f"sequence(((at + 1) * {blocks} - 1) div source_size, ((at + size) * {blocks} - 1) div source_size)"))
    covered = F.coalesce(covered, F.array().cast("array<long>"))
    start = lambda b: F.call_function("div", b * F.col("source_size"), F.lit(blocks))
    words = lambda b: F.least(F.col("at") + F.col("size"), start(b + 1)) - F.greatest("at", start(b))
    draw = lambda b, p: F.struct(
        (b + p * blocks).alias("draw"), F.get("shards", (b + p * blocks).cast("int")).alias("shard"), words(b).alias("words"),
        F.md5(F.concat(F.lit("place"), "h", (b + p * blocks).cast("string"))).alias("place"))
    of_pass = lambda p: F.transform("covered", lambda b: draw(b, p))  # a second parameter would be the index
    draws = F.flatten(F.array(*[of_pass(p) for p in range(passes)]))
    out = held.withColumn("covered", covered).withColumn("draws", F.filter(draws, lambda x: x["shard"].isNotNull() & (x["words"] > 0)))
    out = out.withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda n, x: n + x["words"]))
    return out.select(
        "doc_id", "row_hash", "size", "source_size", "target", "taken", "source",
        F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias("copies"), "draws")


def copies_of(mixed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(doc_id, row_hash, copy, shard, place): where the whole copies of documents stand, from the rows of ``mix``.

    Every pass that takes words of a document offers the draw with most of them; the passes with most words give the copies.
    """
    of_pass = lambda p: F.filter("draws", lambda x: F.call_function("div", x["draw"], F.lit(blocks)) == p)
    offer = lambda p: F.struct(
        (-F.aggregate(of_pass(p), F.lit(0).cast("long"), lambda n, x: n + x["words"])).alias("less"), p.alias("copy"),
        F.array_min(F.transform(of_pass(p), lambda x: F.struct((-x["words"]).alias("less"), x["draw"], x["shard"], x["place"]))).alias("at"))
    passes = F.array_distinct(F.transform("draws", lambda x: F.call_function("div", x["draw"], F.lit(blocks))))
    some = mixed.filter("copies > 0").withColumn("offers", F.slice(F.array_sort(F.transform(passes, offer)), F.lit(1), F.col("copies")))
    return some.select("doc_id", "row_hash", F.explode("offers").alias("x")).select(
        "doc_id", "row_hash", F.col("x.copy").cast("int").alias("copy"), F.col("x.at.shard").alias("shard"), F.col("x.at.place").alias("place"))


def mixed_documents(documents: DataFrame, blocks: int = BLOCKS, **settings) -> DataFrame:
    """The rows of ``documents``, each whole and as often as the mix takes it, all columns kept, brought together by slices of
    the output shards and in a shard's order within them.

    Rows without words are left out. Rows that repeat each other whole are taken equally often. An empty table gives no rows,
    null texts and sources are as in ``mix``, and columns may have any name.
    """
    # Rows that repeat each other whole meet the draws of the one that is taken most often.
    copies = copies_of(mix(documents, blocks=blocks, **settings), blocks)
    picks = copies.groupBy(F.col("doc_id").alias("_doc"), F.col("row_hash").alias("_row"), "copy").agg(
        F.min(F.struct("shard", "place")).alias("_at")).groupBy("_doc", "_row").agg(F.collect_list("_at").alias("_at"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("row.text") == F.col("_row"))
    taken = packed(documents).join(broadcast_if_small(stored(picks, "mix-picks"), 120), same)
    placed = taken.select("row", F.explode("_at").alias("at"))
    ordered = placed.repartition("at.shard", F.substring("at.place", 1, SLICE_DIGITS)).sortWithinPartitions("at.shard", "at.place")
    return unpacked(ordered, documents.columns)
