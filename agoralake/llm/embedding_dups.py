"""Near-duplicate vectors with a forest of random-projection trees.

Vectors are unit length. Every tree splits them again and again near the median of a random direction; a node takes one of FAN
directions of its tree and level. Split values come from a bounded sample: a label with enough sampled vectors has trees of
its own, the others share those of all. Where a node's sample ends, the medians of its last sampled ancestor over all
deeper directions serve. Vectors within MARGIN of the split go to both sides, so close pairs are seldom parted. How often
a pair at the threshold is parted all the same is estimated per level from the sample, and there are as many trees as make
it miss all leaves in MISS of all cases. All vectors are indexed. How deep a vector goes follows from the size of its
label; labels of up to LEAF vectors are compared whole, in one leaf.

Vectors meet in leaves of one label and are compared by their cosine. A pair that shares several leaves is counted in the
first of them only: each vector carries the list of its leaves. A leaf gives for each vector its number of links and one
link to its group, never pairs, and leaves beyond PART vectors are cut into parts compared two by two in tasks of their
own. Equal vectors of a label are one node with a weight.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import ceil, erf, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from agoralake.llm.common import components
from agoralake.session import stored

COSINE = 0.93
MISS = 1e-4       # share of pairs at the threshold that may meet in no leaf, by which the number of trees follows
LEAF = 256
MARGIN = 0.25     # in standard deviations of the projected difference of two vectors at the threshold
SAMPLE = 20_000   # vectors of one length the split values are fitted to, at any size of the input
NODE_SAMPLE = 64  # nodes with fewer of them on a side use their ancestor's medians
FAN = 4           # directions a level of a tree has
PART = 4096
SEED = 11


def spread(dim: int, cosine: float) -> float:
    """Standard deviation of the projected difference of two vectors at the threshold."""
    return sqrt((2 - 2 * cosine) / dim)


def directions(tree: int, depth: int, dim: int) -> np.ndarray:
    """Unit columns: FAN directions for each level of a tree."""
    r = np.random.default_rng((SEED, tree, dim)).standard_normal((max(depth, 1) * FAN, dim))
    return (r / np.linalg.norm(r, axis=1, keepdims=True)).T


def _direction_of(node: np.ndarray, level: int) -> np.ndarray:
    """Which direction a node takes, by its heap number."""
    return FAN * level + ((node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % FAN


def _split_value(at: np.ndarray, near: float) -> float:
    """Of a few quantiles next to the median the one with the fewest values near it."""
    at = np.sort(at)
    tried = np.quantile(at, [0.5, 0.475, 0.525, 0.45, 0.55])
    return float(tried[np.argmin(np.searchsorted(at, tried + near) - np.searchsorted(at, tried - near))])


def _fit_tree(at: np.ndarray, depth: int, near: float, wide: float) -> tuple[dict, dict, np.ndarray]:
    """For projections of a sample on a tree's directions: split values by node, medians by node where the sample ends,
    and per level how many values lie within half of ``wide`` on either side of the split."""
    values, ends, dense = {}, {}, np.zeros((depth, 2))
    nodes = {1: np.arange(len(at))}
    for level in range(depth):
        below = {}
        for node, rows in nodes.items():
            if len(rows) < 2 * NODE_SAMPLE:
                ends[node] = np.median(at[rows], axis=0) if len(rows) else np.zeros(at.shape[1])
                continue
            x = at[rows, int(_direction_of(np.array([node]), level)[0])]
            values[node] = value = _split_value(x, near)
            dense[level] += np.count_nonzero(np.abs(x - value) < wide / 2), len(x)
            for child, own in ((2 * node, rows[x < value]), (2 * node + 1, rows[x >= value])):
                below[child] = own if len(own) >= NODE_SAMPLE // 4 else rows
        nodes = below
    return values, ends, dense


def _met(dense: np.ndarray, depth: int) -> float:
    """Estimated share of pairs at the threshold that stay together in one tree of this depth."""
    z = 2 * MARGIN  # a pair is parted if its two vectors lie farther apart than both margins
    over = 2 * (exp(-z * z / 2) / sqrt(2 * pi) - z * (1 - erf(z / sqrt(2))) / 2)
    share, met = 0.0, 1.0
    for level in range(depth):
        if level < len(dense) and dense[level, 1]:
            share = dense[level, 0] / dense[level, 1]
        met *= max(1 - over * share, 0.01)
    return met


def trees_for(dense: np.ndarray, depth: int, miss: float) -> int:
    """Trees with which a pair at the threshold meets nowhere in ``miss`` of all cases. Labels of one leaf need one."""
    return 1 if depth == 0 else max(2, ceil(log(miss) / log(max(1 - _met(dense, depth), 1e-9))))


def fit_forest(sample: np.ndarray, depth: int, cosine: float, miss: float = MISS) -> dict:
    """Trees of split values over a sample of unit vectors, for labels up to ``depth`` levels deep."""
    dim = sample.shape[1]
    wide = spread(dim, cosine)

    def tree(t: int) -> tuple[dict, dict, np.ndarray]:
        return _fit_tree(sample @ directions(t, depth, dim), depth, MARGIN * wide, wide)

    fitted = [tree(0)]
    dense = fitted[0][2]
    fitted += [tree(t) for t in range(1, trees_for(dense, depth, miss))]
    arrays = []
    for values, ends, _ in fitted:
        split, end = sorted(values), sorted(ends)
        arrays.append((np.array(split, dtype=np.int64), np.array([values[n] for n in split]), np.array(end, dtype=np.int64),
                       np.array([ends[n] for n in end], dtype=np.float32).reshape(len(end), max(depth, 1) * FAN)))
    return {"trees": arrays, "dense": dense, "depth": depth, "near": MARGIN * wide, "dim": dim, "miss": miss}


def fit_forests(sample: np.ndarray, labels: list, depth: int, cosine: float, miss: float) -> dict:
    """A forest for each label that two nodes' samples come from (so a bounded number), and one of all under None."""
    forests = {None: fit_forest(sample, depth, cosine, miss)}
    rows: dict[object, list[int]] = {}
    for i, label in enumerate(labels):
        rows.setdefault(label, []).append(i)
    for label, own in rows.items():
        if len(own) >= 2 * NODE_SAMPLE and len(own) < len(labels):
            forests[label] = fit_forest(sample[own], depth, cosine, miss)
    return forests


def _row_of(sorted_nodes: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Where each node stands among sorted ones, -1 if it does not."""
    if not len(sorted_nodes):
        return np.full(len(node), -1)
    i = np.minimum(np.searchsorted(sorted_nodes, node), len(sorted_nodes) - 1)
    return np.where(sorted_nodes[i] == node, i, -1)


def leaves_of(forest: dict, x: np.ndarray, depth: int) -> list[list[int]]:
    """The leaves of unit vectors of one label that is ``depth`` levels deep, as tree and heap number in one integer, in order."""
    out = [[] for _ in range(len(x))]
    for t in range(trees_for(forest["dense"], depth, forest["miss"])):
        split, value, end, median = forest["trees"][t]
        row, node, last = np.arange(len(x)), np.ones(len(x), dtype=np.int64), np.full(len(x), -1)
        at = x @ directions(t, forest["depth"], forest["dim"]) if depth else None
        for level in range(depth):
            ended = _row_of(end, node)
            last = np.where(ended >= 0, ended, last)  # below the sample: the ancestor where it ended
            way = _direction_of(node, level)
            own = _row_of(split, node)
            cut = np.zeros(len(node))
            cut[own >= 0] = value[own[own >= 0]]
            cut[own < 0] = median[last[own < 0], way[own < 0]]
            p = at[row, way]
            left, right = p < cut + forest["near"], p >= cut - forest["near"]
            row, last = np.concatenate((row[left], row[right])), np.concatenate((last[left], last[right]))
            node = np.concatenate((2 * node[left], 2 * node[right] + 1))
        for r, n in zip(row.tolist(), node.tolist()):
            out[r].append((t << 48) | n)
    return [sorted(v) for v in out]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _indexed(forests: dict[int, dict]):
    """forests: per vector length those of labels, and the shared one under None."""
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, labels, depths = batch.column(2).to_numpy(), batch.column(1).to_pylist(), batch.column(5).to_numpy()
            rows: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(dims.tolist(), labels, depths.tolist())):
                rows.setdefault(key, []).append(i)
            for (dim, label, depth), own in rows.items():
                part = batch.take(pa.array(own))
                x = unit(np.array(part.column(4).to_pylist(), dtype=np.float64))
                own_forests = forests[dim]
                leaves = leaves_of(own_forests.get(label) or own_forests[None], x, depth) if depth else [[1]] * len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), part.column(3),
                     pa.array([v.tobytes() for v in x], pa.binary()), pa.array(leaves, pa.list_(pa.int64()))],
                    names=["rep", "label", "dim", "copies", "unit", "leaves"])
    return indexed


def compare_cell(rep: np.ndarray, copies: np.ndarray, part: np.ndarray, x: np.ndarray, leaves: list, leaf: int, crossed: bool,
                 cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of a cell: links that no earlier leaf counts, and the row of the first vector of its group."""
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    if crossed:
        near &= part[:, None] != part[None, :]
    common = Counter(v for own in leaves for v in own if v < leaf)
    code = {v: i for i, v in enumerate(sorted(v for v, n in common.items() if n > 1))}
    counted = near
    if code:
        has = np.zeros((len(rep), len(code)), dtype=np.float32)
        for i, own in enumerate(leaves):
            has[i, [code[v] for v in own if v in code]] = 1
        counted = near & ~(has @ has.T > 0)
    group = np.arange(len(rep))
    while True:
        low = np.minimum(group, np.where(near, group[None, :], len(rep)).min(axis=1, initial=len(rep)))
        low = low[low]
        if (low == group).all():
            return counted @ copies, group
        group = low


def _compared(cosine: float):
    def compared(table: pa.Table) -> pa.Table:
        rep, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
        x = np.stack([np.frombuffer(v, dtype=np.float64) for v in table["unit"].to_pylist()])
        n, group = compare_cell(rep, copies, table["p"].to_numpy(), x, table["leaves"].to_pylist(), table["leaf"][0].as_py(),
                                table["lo"][0].as_py() != table["hi"][0].as_py(), cosine)
        some = (n > 0) | (group != np.arange(len(rep)))
        return pa.table({"rep": rep[some], "n": n[some].astype(np.int64), "root": rep[group[some]]})
    return compared


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & ok & F.exists(vector, lambda v: v != 0), F.lit(False))


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, miss: float = MISS, leaf: int = LEAF, part: int = PART) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings`` (vec_id, embedding, label).

    Vectors without a label, null, empty or zero ones and those with null or non-finite entries link with nothing, nor do
    vectors of different lengths. Equal vectors and repeated rows link with each other; rows that share a vec_id but not
    their vector share their links. An empty table gives no rows; other columns are not read.
    """
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", "label", v.alias("v")).withColumn("ok", F.col("label").isNotNull() & usable(F.col("v")))
    hashed = rows.select("vec_id", F.when(F.col("ok"), F.xxhash64("label", "v")).alias("h1"),
                         F.when(F.col("ok"), F.xxhash64("v", F.lit(SEED), "label")).alias("h2"), "label", "v", "ok")
    nodes = stored(hashed.filter("ok").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").cast("string").alias("label"),
        F.first("v").alias("v")).withColumn("dim", F.size("v")), "distinct-vectors")
    sizes = stored(nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "depth", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / leaf))).cast("int")), "label-sizes")
    forests = {}
    for r in sizes.groupBy("dim").agg(F.sum("n").alias("n"), F.max("depth").alias("depth")).collect():  # one row per vector length
        forests[r["dim"]] = {}
        if r["depth"] == 0:
            continue
        share = min(1.0, SAMPLE / r["n"])
        picked = nodes.filter((F.col("dim") == r["dim"]) & (F.pmod(F.xxhash64("h1"), F.lit(1 << 20)) <= share * (1 << 20)))
        rows = picked.select("label", "v").limit(SAMPLE).collect()
        sample = unit(np.array([x["v"] for x in rows], dtype=np.float64).reshape(-1, r["dim"]))
        forests[r["dim"]] = fit_forests(sample, [x["label"] for x in rows], r["depth"], cosine, miss)
    indexed = stored(nodes.join(sizes.select("label", "dim", "depth"), ["label", "dim"]).select(
        "rep", "label", "dim", "copies", "v", "depth").mapInArrow(
        _indexed(forests), "rep long, label string, dim int, copies long, unit binary, leaves array<long>"), "forest-index")
    key = ["label", "dim", "leaf"]
    large = stored(indexed.select("label", "dim", F.explode("leaves").alias("leaf")).groupBy(key).agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).withColumn("k", F.ceil(F.col("n") / part).cast("int")), "leaf-sizes")
    at = indexed.withColumn("leaf", F.explode("leaves")).join(large, key).withColumn(
        "p", F.pmod(F.xxhash64("rep"), F.col("k")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    cells = at.withColumn("lo", F.least("p", "j")).withColumn("hi", F.greatest("p", "j"))
    found = stored(cells.groupBy(*key, "lo", "hi").applyInArrow(_compared(cosine), "rep long, n long, root long"), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    groups = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), "vector-components")
    named = nodes.select("h1", "h2", "rep", "copies").join(counts, "rep", "left").join(
        groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rep").alias("c"))
    named = stored(named, "vector-classes")
    component = F.coalesce("c", "vec_id")
    return hashed.select("vec_id", "h1", "h2").join(named, ["h1", "h2"], "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
