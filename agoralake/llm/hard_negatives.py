"""Hard negatives by exact integer scores from subset-sum tables.

Components become integers floor(256 x) in two's complement. A candidate is stored as bit planes: for every plane and group of
eight dimensions one byte. An anchor has for every group a table of the 256 subset sums of its eight components, so a byte
is the index of what eight dimensions add to the plane's sum, and planes are shifted and added (the sign plane is taken away)
to the whole inner product. No multiplication is made per pair and no score is estimated.

Candidates are packed into blocks and anchors into slabs, both of a fixed number of rows sorted by label as they are read.
Every slab meets every block as a cell of a grid: blocks are dealt to groups of GROUP blocks, a slab is sent once to each
group. Positives need only blocks that hold a label of the slab; a cell then compares the parts of equal label. The least
score that may matter is known before negatives are looked for, so a block answers with at most WANTED rows for each anchor
and positive, and the first WANTED over all blocks are taken by a window whose limit applies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from agoralake.session import stored

EVERY = 100        # rows whose id is divisible by it are anchors
WANTED = 5         # positives of an anchor, and negatives of a positive
BLOCK = 8192       # candidates packed together
SLAB = 256         # anchors packed together
GROUP = 8          # blocks that share one copy of a slab
STRIP = 1024       # candidates scored at a time, so that sums stay in the processor's cache
LOW, HIGH = -(1 << 63), (1 << 63) - 1
PACKED = "dim int, key long, rows int, planes int, labels array<long>, ids binary, own binary, label binary, data binary"


def usable(vector: Column) -> Column:
    v = vector.cast("array<double>")
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of every component; beyond a long its ends."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(256.0) * x).cast("long"))


def bit_planes(x: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of two's complement integers (rows, dims); bit i of a byte is dimension i of its group."""
    rows, dim = x.shape
    reach = max(int(x.max(initial=0)), -int(x.min(initial=0)) - 1, 0)
    planes, groups = reach.bit_length() + 1, -(-dim // 8)
    wide = np.zeros((rows, 8 * groups), dtype=np.int64)
    wide[:, :dim] = x
    out = np.empty((planes, groups, rows), dtype=np.uint8)
    for p in range(planes):
        out[p] = np.packbits(((wide >> min(p, 63)) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def subset_sums(anchors: np.ndarray, kind) -> np.ndarray:
    """(groups, 256, anchors): for every byte the sum of the components whose bits it has."""
    n, dim = anchors.shape
    groups = -(-dim // 8)
    wide = np.zeros((n, 8 * groups), dtype=kind)
    wide[:, :dim] = anchors.astype(kind)
    tables = np.zeros((groups, 256, n), dtype=kind)
    for g in range(groups):
        for i in range(8):
            tables[g, 1 << i:2 << i] = tables[g, :1 << i] + wide[:, 8 * g + i]
    return tables


class Scorer:
    """Scores of a slab of anchors against packed candidates; number types are as narrow as the anchors allow, and whole
    numbers of any size where 64 bits might not do (such scores are cut to the ends of a long)."""

    def __init__(self, anchors: np.ndarray):
        self.most = max((sum(abs(int(v)) for v in row) for row in anchors), default=0)
        kind = np.int16 if self.most < 1 << 15 else np.int32 if self.most < 1 << 31 else np.int64 if self.most < 1 << 62 else object
        self.tables = subset_sums(anchors, kind)

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """(rows, anchors) inner products."""
        n_planes, groups, rows = planes.shape
        reach = self.most << (n_planes - 1)
        kind = np.int32 if reach < 1 << 31 else np.int64 if reach < 1 << 62 else object
        out = np.zeros((rows, self.tables.shape[2]), dtype=kind)
        for lo in range(0, rows, STRIP):
            own = out[lo:lo + STRIP]
            for p in range(n_planes):
                total = np.zeros(own.shape, dtype=self.tables.dtype)
                for g in range(groups):
                    total += self.tables[g].take(planes[p, g, lo:lo + STRIP], axis=0)
                step = total.astype(kind)
                step = step * (1 << p) if kind is object else np.left_shift(step, p, out=step)
                if p == n_planes - 1:
                    own -= step
                else:
                    own += step
        return np.clip(out, LOW, HIGH).astype(np.int64) if kind is object else out


def _packed(size: int, plane: bool):
    """Rows (dim, label, vec_id, key, x) sorted by the first two, as rows PACKED of at most ``size``; bit planes or plain."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0

        def row() -> pa.RecordBatch:
            nonlocal number
            dim, label, ids, own = held[0][0], *(np.array([r[k] for r in held], dtype=np.int64) for k in (1, 2, 3))
            x = np.array([r[4] for r in held], dtype=np.int64).reshape(len(held), dim)
            data = bit_planes(x) if plane else x
            key = (TaskContext.get().partitionId() << 32) | number
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([key]), pa.array([len(held)], pa.int32()), pa.array([len(data) if plane else 0], pa.int32()),
                 pa.array([np.unique(label).tolist()], pa.list_(pa.int64())), *[pa.array([v.tobytes()], pa.binary()) for v in (ids, own, label, data)]],
                names=["dim", "key", "rows", "planes", "labels", "ids", "own", "label", "data"])

        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                if held and (len(held) == size or r[0] != held[0][0]):
                    yield row()
                    held = []
                held.append(r)
        if held:
            yield row()
    return packed


def _slab(row: dict, side: str) -> tuple:
    numbers = lambda name: np.frombuffer(row[f"{side}_{name}"], dtype=np.int64)
    return numbers("ids"), numbers("own"), numbers("label")


def _anchor_scorer(row: dict, held: dict) -> Scorer:
    """Cells of one slab tend to follow each other; its tables are made once."""
    if held.get("key") != row["a_key"]:
        x = np.frombuffer(row["a_data"], dtype=np.int64).reshape(row["a_rows"], row["dim"])
        held.update(key=row["a_key"], all=Scorer(x), x=x, parts={}, squares=[min(HIGH, sum(v * v for v in own)) for own in x.tolist()])
    return held["all"]


def _planes(row: dict) -> np.ndarray:
    return np.frombuffer(row["b_data"], dtype=np.uint8).reshape(row["b_planes"], -(-row["dim"] // 8), row["b_rows"])


def _best_of_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell and anchor the first WANTED + 1 candidates of the anchor's label; ``same`` are those that may be itself."""
    held: dict = {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            _anchor_scorer(row, held)
            (names, own, label), (ids, _, other), planes = _slab(row, "a"), _slab(row, "b"), _planes(row)
            out = [[], [], [], []]
            for value in np.intersect1d(label, other):
                a, b, c, d = (int(np.searchsorted(v, value, s)) for v in (label, other) for s in ("left", "right"))
                if value not in held["parts"]:
                    held["parts"][value] = Scorer(held["x"][a:b])
                score = held["parts"][value].scores(planes[:, :, c:d]).T.astype(np.int64)
                for k, line in enumerate(score):
                    first = np.arange(d - c)
                    if d - c > WANTED + 1:
                        least = np.partition(line, d - c - WANTED - 1)[d - c - WANTED - 1]
                        first = np.flatnonzero(line >= least)
                    first = first[np.lexsort((ids[c + first], ~line[first]))][:WANTED + 1]
                    out[0] += [int(own[a + k])] * len(first)
                    out[1] += ids[c + first].tolist()
                    out[2] += line[first].tolist()
                    out[3] += ((ids[c + first] == names[a + k]) & (line[first] == held["squares"][a + k])).tolist()
            yield pa.RecordBatch.from_arrays([*[pa.array(v, pa.int64()) for v in out[:3]], pa.array(out[3], pa.bool_())],
                                             names=["own", "vec_id", "score", "same"])


def _best_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell, anchor and positive the first WANTED candidates of other labels that score 80 to 100 % of the positive."""
    held: dict = {}
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            score = _anchor_scorer(row, held).scores(_planes(row)).T
            (_, own, label), (ids, _, other) = _slab(row, "a"), _slab(row, "b")
            asked = {}
            for p in row["asked"]:
                asked.setdefault(p["own"], []).append((p["nth"], p["score"]))
            out = [[], [], [], []]
            for k, anchor in enumerate(own.tolist()):
                windows = [(nth, -(-4 * p // 5), p) for nth, p in asked.get(anchor, []) if p >= 0]  # none lies between 0.8 p and p < 0
                if not windows:
                    continue
                line = score[k]
                some = np.flatnonzero((line >= min(w[1] for w in windows)) & (line <= max(w[2] for w in windows)) & (other != label[k]))
                if not len(some):
                    continue
                line = line[some].astype(np.int64)
                order = np.lexsort((ids[some], ~line))
                line, names = line[order], ids[some[order]]
                for nth, low, high in windows:
                    at = int(np.searchsorted(~line, ~high))
                    take = line[at:at + WANTED]
                    take = take[take >= low]
                    out[0] += [anchor] * len(take)
                    out[1] += [nth] * len(take)
                    out[2] += names[at:at + len(take)].tolist()
                    out[3] += take.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names=["own", "nth", "vec_id", "score"])


def _first(df: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    window = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def hard_negatives(embeddings: DataFrame, every: int = EVERY, block: int = BLOCK, slab: int = SLAB, label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor, its first WANTED positives
    and the first WANTED negatives of each.

    Rows without vec_id, label or vector and those with a null or non-finite component take no part; vectors of different
    lengths do not meet, and vectors without components score 0. Repeated rows are rows of their own: a copy of an anchor
    is one of its candidates, and of rows that tie in score and id any may stand for the others. An anchor without positives,
    or a positive without negatives, gives no rows; an empty table gives none. Other columns are not read.
    """
    vector = F.col("embedding")
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable(vector)).select(
        F.size(vector).alias("dim"), (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col("vec_id").cast("long").alias("vec_id"), whole_numbers(vector).alias("x")).where("label is not null")
    # Blocks are made where rows are read; anchors, one row of a hundred, are dealt to full slabs first.
    blocks = stored(rows.select("dim", "label", "vec_id", F.lit(0).cast("long").alias("own"), "x").sortWithinPartitions("dim", "label").mapInArrow(
        _packed(block, True), PACKED), "plane-blocks")
    chosen = stored(rows.where(F.col("vec_id") % every == 0).select("dim", "label", "vec_id", F.monotonically_increasing_id().alias("own"), "x"), "anchors")
    n_anchors, n_blocks = chosen.count(), blocks.count()
    slabs = stored(chosen.repartitionByRange(max(1, -(-n_anchors // (4 * slab))), "dim", "label", "own").sortWithinPartitions("dim", "label").mapInArrow(
        _packed(slab, False), PACKED), "anchor-slabs")
    groups = max(1, -(-n_blocks // GROUP))
    named = lambda df, side, extra=(): df.select("dim", *[F.col(c).alias(f"{side}_{c}") for c in ("key", "rows", "planes", "ids", "own", "label", "data")], *extra)
    own_group = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("grp")
    held = named(blocks, "b", [own_group, F.col("labels").alias("b_labels")])
    spread = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")

    alike = named(slabs, "a", [spread, F.col("labels").alias("a_labels")]).join(held, ["dim", "grp"]).where(
        F.arrays_overlap("a_labels", "b_labels")).drop("a_labels", "b_labels")
    near = stored(_first(alike.mapInArrow(_best_of_label, "own long, vec_id long, score long, same boolean"), ["own"], WANTED + 1, "place"), "near-rows")
    # The anchor itself is left out: once where it is among its first rows, else the row beyond the wanted ones.
    itself = near.where("same").groupBy("own").agg(F.min("place").alias("skip"))
    positives = near.join(itself, "own", "left").withColumn("skip", F.coalesce("skip", F.lit(WANTED + 1))).where("place <> skip").select(
        "own", F.when(F.col("place") > F.col("skip"), F.col("place") - 1).otherwise(F.col("place")).alias("nth"), "vec_id", "score")
    positives = stored(positives.join(chosen.select("own", F.col("vec_id").alias("anchor_id")), "own"), "positives")

    # Each slab takes along what is asked of it: at most WANTED scores an anchor.
    asked = _owners(slabs).join(positives, "own").groupBy("key").agg(F.collect_list(F.struct("own", "nth", "score")).alias("asked"))
    cells = named(slabs.join(asked, "key"), "a", ["asked", spread]).join(held.drop("b_labels"), ["dim", "grp"])
    found = _first(cells.mapInArrow(_best_below, "own long, nth long, vec_id long, score long"), ["own", "nth"], WANTED, "rank")
    return found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
        positives.withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"}), ["own", "nth"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _owners(slabs: DataFrame) -> DataFrame:
    """(key, own) of every anchor of every slab."""
    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(own, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), key)), pa.array(own)], names=["key", "own"])
    return slabs.select("key", "own").mapInArrow(owners, "key long, own long")
