"""SimHash near-duplicates by anchor-point covering.

Fingerprints of 64 bits link at BITS = 4 or fewer differing bits. Of two linked fingerprints one half (32 bits) differs in
at most 2 bits, so each half is searched with threshold 2. In a half, 31 bits are covered by the codewords of the perfect
[31, 26] Hamming code, whose covering radius is 1: the anchors. Two words at distance 2 or less have a word between them
that is at most 1 from both, and that word is at most 1 from some anchor; so both are within radius 1 plus half the
threshold of one anchor, and each fingerprint is replicated to its 16 anchors at that reach (1 if it is itself an anchor)
instead of the 156 at radius plus the whole threshold. Every link is found: no candidate is dropped.

Equal fingerprints are one node, so copies cost nothing. A bucket (anchor) is compared with all 64 bits, and gives the
links of a spanning forest, never all pairs; a bucket beyond BUCKET_LIMIT is cut into parts compared two by two in tasks
of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from agoralake.llm.common import broadcast_if_small, components, packed, unpacked
from agoralake.session import stored

SHINGLE = 4
SEED = 42
BITS = 4
BUCKET_LIMIT = 20_000
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of every shingle of SHINGLE words (A-Z lower-cased, split at white space); all words if there are fewer."""
    ws = text.lower().split()
    if len(ws) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(ws), SEED)] if ws else [], dtype=np.uint64)
    line = b" ".join(ws)
    ends = np.cumsum(np.fromiter(map(len, ws), dtype=np.int64, count=len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(ws) - SHINGLE + 1].tolist()
    digest, view = xxhash.xxh64_intdigest, line
    return np.fromiter((digest(view[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:].tolist())), dtype=np.uint64, count=len(starts))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes, as a signed integer; 0 for none."""
    n, total = len(hashes), np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 1 << 16):
        part = hashes[lo:lo + (1 << 16)]
        part = np.concatenate((part, np.zeros(-len(part) % 255, dtype=np.uint64))).reshape(-1, 255)
        for bit in range(8):
            lanes = ((part >> np.uint64(bit)) & LANES).sum(axis=1)  # eight counters of a byte each; 255 rows fit
            total[bit::8] += lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    value = int(sum(1 << int(i) for i in np.flatnonzero(total * 2 > n)))
    return value - (1 << 64) if value >> 63 else value


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        prints = [majority(shingle_hashes(t.as_py() or b"")) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints, pa.int64())], names=["doc_id", "row_hash", "fp"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, row_hash, fp): the SimHash of the whole text as a signed long; row_hash tells texts of one doc_id apart.

    Null and empty texts have fingerprint 0.
    """
    return documents.select("doc_id", "text", F.xxhash64("text").alias("row_hash")).mapInArrow(
        _fingerprints, "doc_id long, row_hash long, fp long")


def anchors(prints: DataFrame) -> DataFrame:
    """(anchor, fp, rep): each fingerprint once for every anchor in reach, in both halves."""
    masks = [sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1) for k in range(5)]
    syndrome = " | ".join(f"shiftleft(cast(bit_count(w & {m}L) as int) & 1, {k})" for k, m in enumerate(masks))
    halves = prints.select("fp", "rep", F.posexplode(F.expr("array(fp & 2147483647L, shiftrightunsigned(fp, 32) & 2147483647L)")).alias("half", "w"))
    bit = lambda p: f"shiftright(shiftleft(1L, {p}), 1)"  # place 0 is no bit
    return halves.withColumn("s", F.expr(f"cast({syndrome} as int)")).select(
        "fp", "rep", F.explode(F.expr(
            "transform(filter(sequence(0, 31), i -> i < (i ^ s) or (s = 0 and i = 0)), "
            f"i -> shiftleft(cast(half as bigint), 32) | (w ^ {bit('i')} ^ {bit('i ^ s')}))")).alias("anchor"))


def _forest(fp: np.ndarray, rep: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that connect whatever the links of one bucket connect."""
    root, out = np.arange(len(fp)), []
    for i in range(1, len(fp)):
        near = np.flatnonzero(np.bitwise_count(fp[:i] ^ fp[i]) <= most)
        roots, first = np.unique(root[near], return_index=True)
        for r, j in zip(roots, near[first]):
            out.append((int(rep[i]), int(rep[j])))
        if len(roots):
            root[i] = roots[0]
            if len(roots) > 1:
                root[: i][np.isin(root[:i], roots[1:])] = roots[0]
    return out


def bucket_links(most: int):
    """A function for mapInArrow over rows (anchor, cell, fp, rep) sorted by anchor and cell."""
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, dtype=np.int64)] * 4

        def compared(cols: list[np.ndarray]) -> pa.RecordBatch:
            key, cell, fp, rep = cols[0], cols[1], cols[2].view(np.uint64), cols[3]
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1]))))
            size = np.diff(np.concatenate((first, [len(key)])))
            group = np.repeat(np.arange(len(first)), size)
            a, b = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
            small = (size > 1) & (size <= 32)
            keep = small[group]
            g, f, r = group[keep], fp[keep], rep[keep]
            for step in range(1, int(size[small].max()) if small.any() else 1):
                hit = np.flatnonzero((g[step:] == g[:-step]) & (np.bitwise_count(f[step:] ^ f[:-step]) <= most))
                a.append(r[hit])
                b.append(r[hit + step])
            for k in np.flatnonzero(size > 32):
                found = _forest(fp[first[k]:first[k] + size[k]], rep[first[k]:first[k] + size[k]], most)
                a.append(np.array([x for x, _ in found], dtype=np.int64))
                b.append(np.array([y for _, y in found], dtype=np.int64))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

        for batch in batches:
            cols = [np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held)]
            if not len(cols[0]):
                continue
            last = int(np.flatnonzero((cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]))[0])  # may go on in the next batch
            held = [c[last:].copy() for c in cols]
            if last:
                yield compared([c[:last] for c in cols])
        if len(held[0]):
            yield compared(held)
    return links


def links(prints: DataFrame, most: int = BITS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a, b): reps of linked fingerprints, enough of them to connect all that are linked, from stored (fp, rep)."""
    spread = anchors(prints)
    hot = stored(spread.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit), "hot-anchors")
    cells = spread.withColumn("cell", F.lit(0).cast("long"))
    if not hot.isEmpty():
        parts = spread.join(hot, "anchor", "left").withColumn("k", F.coalesce(F.ceil(F.col("n") / limit), F.lit(1)).cast("int")).withColumn(
            "p", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
        cells = parts.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumn(
            "cell", (F.least("p", "j").cast("long") * F.col("k") + F.greatest("p", "j")))
    keyed = cells.select("anchor", "cell", "fp", "rep").repartition("anchor", "cell").sortWithinPartitions("anchor", "cell")
    return keyed.mapInArrow(bucket_links(most), "a long, b long")


def grouped(documents: DataFrame, most: int = BITS) -> DataFrame:
    """(doc_id, row_hash, fp, component_id) for every row of ``documents``."""
    prints = stored(fingerprints(documents), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "distinct-fingerprints")
    groups = components(links(reps.filter("rep is not null"), most), "simhash-components")
    named = stored(reps.join(groups, reps["rep"] == groups["node"], "left").select(
        "fp", F.coalesce("component", "rep").alias("component_id")), "fingerprint-components")
    return prints.join(named, "fp")


def near_duplicates(documents: DataFrame, most: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: fingerprint as 16 hex digits, component_id the smallest doc_id
    reachable over links, the row's own included.

    Null, empty and white-space texts have fingerprint zero and link like any other. Equal texts, repeated rows and ties
    share a fingerprint and a component; a text of any length is read whole; an empty table gives no rows; other columns
    are not read.
    """
    return grouped(documents, most).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame, most: int = BITS) -> DataFrame:
    """One row of each component of ``documents``, one with the smallest doc_id, all columns kept, whatever their names.

    If rows share that doc_id, one of them stays. Rows without a doc_id stay unless they are like a row that has one.
    """
    rows = stored(grouped(documents, most), "grouped")
    key = (F.col("row.doc_id").eqNullSafe(F.col("_doc"))) & (F.xxhash64("row.text") == F.col("_hash"))
    out = rows.filter("not (doc_id <=> component_id)").select(F.col("doc_id").alias("_doc"), F.col("row_hash").alias("_hash")).distinct()
    kept = packed(documents).join(broadcast_if_small(stored(out, "near-duplicates"), 32), key, "left_anti")
    shared = rows.filter("doc_id <=> component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(shared.select(F.col("doc_id").alias("_doc")), "shared-ids")
    if shared.isEmpty():
        return unpacked(kept, documents.columns)
    same = F.col("row.doc_id").eqNullSafe(F.col("_doc"))
    apart, alike = (unpacked(kept.join(shared, same, how), documents.columns) for how in ("left_anti", "left_semi"))
    return apart.unionByName(alike.dropDuplicates(["doc_id"]))
