"""Repeated byte strings by column-wise construction of the suffixes of many short documents.

Every 50-byte string has a minimizer, the least hash of its 20-byte parts. Strings that follow each other with one
minimizer form a segment of 50 to 80 bytes. Equal strings have equal minimizers, so all that can match meets in the bucket
of its minimizer, and a bucket is a collection of short documents whose suffixes can be sorted on their own.

In a bucket the collection's Burrows-Wheeler transform is built column by column: round j inserts, for every segment, the
suffix that is one symbol longer than the one of the round before. The new order is a stable distribution of the old
transform by symbol, read and rewritten from front to back; common prefixes (up to 50) change only beside new suffixes,
where they are 1 plus the least common prefix between two equal symbols. At most 80 rounds are needed, and a collection is
cut at minimizer borders to about PIECE bytes, so the transform stays in memory and no local files are written.

Only segments whose minimizer two documents share are sent, and equal segments are sent once a block. Of these the
transform is built over the stretches whose windows have a hash that occurs twice, equal stretches once: a string that stands in
always different surroundings costs its own length and not theirs. Work moves between tasks
as packed arrays: texts are kept in stored blocks, a block sends each bucket its distinct minimizers (so a passage that a
third of all documents hold arrives once a block), gets back which of them repeat, sends the segments that may match, and
gets back the least doc_id of every window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from agoralake.session import stored

WINDOW = 50
PART = 20                       # bytes hashed for the minimizer
SPAN = WINDOW - PART + 1        # parts in a window; also the most windows in a segment
BLOCK_BYTES = 2 << 20           # texts packed into one row
BUCKET_BYTES = 4 << 20          # text for which one bucket is made
STRIP = 1 << 16                 # windows hashed at a time
PIECE = 1 << 20                 # bytes of segments looked at together
END = 255                       # no byte of UTF-8: stands before a segment's first byte
NONE = np.iinfo(np.int64).max


def _pack(a: np.ndarray, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(a.tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=kind)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) packed into rows (block, bytes, docs, sizes, data)."""
    docs, texts, held, number = [], [], 0, 0

    def row() -> pa.RecordBatch:
        data = b"".join(texts)
        block = (TaskContext.get().partitionId() << 32) | number
        return pa.RecordBatch.from_arrays(
            [pa.array([block]), pa.array([len(data)]), pa.array([_pack(np.array(docs, dtype=np.int64))], pa.binary()),
             pa.array([_pack(np.array([len(t) for t in texts], dtype=np.int64))], pa.binary()),
             pa.array([_pack(np.frombuffer(data, dtype=np.uint8), 6)], pa.binary())], names=["block", "bytes", "docs", "sizes", "data"])

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            docs.append(doc)
            texts.append(text.as_py() or b"")
            held += len(texts[-1])
            if held >= BLOCK_BYTES:
                yield row()
                docs, texts, held, number = [], [], 0, number + 1
    if docs:
        yield row()


def _minimizers(data: np.ndarray) -> np.ndarray:
    """The minimizer of the window at every place of the bytes."""
    n = max(0, len(data) - WINDOW + 1)
    out, padded = np.empty(n, dtype=np.uint64), np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    for lo in range(0, n, STRIP):
        k = min(STRIP, n - lo) + SPAN - 1  # parts of this strip's windows
        at = np.ndarray(k + 12, dtype=np.uint64, buffer=padded, offset=lo, strides=(1,)).copy()  # eight bytes from every place
        h = at[:k] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h += at[8:8 + k] * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h += at[12:12 + k] * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        for step in (1, 2, 4, 8):
            h = np.minimum(h[:-step], h[step:])  # least of 2, 4, 8 and 16 parts
        m = k - SPAN + 1
        np.minimum(h[:m], h[SPAN - 16:SPAN - 16 + m], out=out[lo:lo + m])
    return out


def _segments(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, first window, windows, document's number) of the segments of a block."""
    ends, least = np.cumsum(sizes), _minimizers(data)
    inside = np.ones(len(least), dtype=bool)  # windows that do not cross the end of a document
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        inside[max(a, b - WINDOW + 1):b] = False
    if not inside.any():
        return np.empty(0, dtype=np.uint64), *[np.empty(0, dtype=np.int64)] * 3
    other = least[1:] != least[:-1]
    first = np.flatnonzero(inside & np.concatenate(([True], other | ~inside[:-1])))
    length = np.flatnonzero(inside & np.concatenate((other | ~inside[1:], [True]))) - first + 1
    pieces = -(-length // SPAN)  # one minimizer may hold for long where a text repeats itself
    again = np.repeat(np.arange(len(first)), pieces)
    nth = np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = first[again] + nth * SPAN
    return least[start], start, np.minimum(length[again] - nth * SPAN, SPAN), np.searchsorted(ends, start, side="right")


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return _unpack(row["docs"], np.int64), _unpack(row["sizes"], np.int64), _unpack(row["data"], np.uint8)


def _codes(minimizer: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 31 bits of the minimizer. A bucket has a fixed share of text, so few minimizers share their 31 bits, and
    those that do only send segments in vain."""
    return (((minimizer >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (minimizer & np.uint64(0xFFFFFFFE))


def _by_bucket(codes: np.ndarray, doc_ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Per bucket the distinct codes of a block in order, the last bit set if two documents of the block share one."""
    order = np.lexsort((doc_ids, codes))
    code, ids = codes[order], doc_ids[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    last = np.concatenate((first[1:], [len(code)])) - 1
    shared = code[first] | (ids[first] != ids[last]).astype(np.uint64)
    own = (shared >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(own[a]), shared[a:b]


def _announced(buckets: int):
    def announced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                docs, sizes, data = _read(row)
                m, _, _, doc = _segments(data, sizes)
                found = list(_by_bucket(_codes(m, buckets), docs[doc])) if len(m) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(found), pa.int64()), pa.array([b for b, _ in found], pa.int64()),
                     pa.array([k.astype(np.uint32).tobytes() for _, k in found], pa.binary())], names=["block", "bucket", "keys"])
    return announced


def _repeated(table: pa.Table) -> pa.Table:
    """For the codes that blocks sent to one bucket: bits that say which of them two documents share."""
    sent = [np.frombuffer(k, dtype=np.uint32) for k in table["keys"].to_pylist()]
    every = np.concatenate(sent)
    _, where, count = np.unique(every >> np.uint32(1), return_inverse=True, return_counts=True)
    yes = count > 1
    yes[where[(every & np.uint32(1)) == 1]] = True
    parts = np.split(yes[where], np.cumsum([len(k) for k in sent])[:-1])
    return pa.table({"block": table["block"], "bucket": table["bucket"], "bits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())})


class Marked:
    """The distinct segments of a block that may match, in the order of their buckets, and where they stand."""

    def __init__(self, row: dict, buckets: int):
        self.docs, self.sizes, self.data = _read(row)
        m, start, windows, doc = _segments(self.data, self.sizes)
        codes, bits, shared = _codes(m, buckets), {x["bucket"]: x["bits"] for x in row["found"] or []}, [np.empty(0, dtype=np.uint64)]
        for b, own in _by_bucket(codes, self.docs[doc]) if len(m) else ():
            yes = np.unpackbits(np.frombuffer(bits[b], dtype=np.uint8), count=len(own)).astype(bool)
            shared.append(own[yes] & ~np.uint64(1))
        shared = np.concatenate(shared)  # in order, as buckets lead the codes
        at = np.minimum(np.searchsorted(shared, codes), max(len(shared) - 1, 0))
        some = np.flatnonzero(shared[at] == codes) if len(shared) else np.empty(0, dtype=np.int64)
        some = some[np.argsort(codes[some], kind="stable")]
        self.start, self.windows, owner = start[some], windows[some], self.docs[doc[some]]
        text, seen, least, number, code = self.data.tobytes(), {}, [], np.empty(len(some), dtype=np.int64), []
        for k, (s, w, d, c) in enumerate(zip(self.start.tolist(), self.windows.tolist(), owner.tolist(), codes[some].tolist())):
            j = seen.setdefault(text[s:s + w + WINDOW - 1], len(least))
            if j == len(least):
                least.append(d)
                code.append(c)
            elif d < least[j]:
                least[j] = d
            number[k] = j
        self.segments, self.number, self.least, self.code = list(seen), number, np.array(least, dtype=np.int64), np.array(code, dtype=np.uint64)


def _sent(buckets: int):
    """Per block and bucket the distinct segments that may match."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                got = Marked(row, buckets)
                size = np.array([len(x) for x in got.segments], dtype=np.uint8)
                bucket = (got.code >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))).tolist() if len(bucket) else [0]
                out = [(int(bucket[a]), _pack(got.code[a:b].astype(np.uint32)), _pack(size[a:b]), _pack(got.least[a:b]),
                        zstandard.ZstdCompressor(level=3).compress(b"".join(got.segments[a:b]))) for a, b in zip(cuts[:-1], cuts[1:])]
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(out), pa.int64()), pa.array(columns[0], pa.int64()),
                     *[pa.array(c, pa.binary()) for c in columns[1:]]], names=["block", "bucket", "a", "b", "c", "d"])
    return sent


def window_minima(segments: list[bytes], least: np.ndarray) -> np.ndarray:
    """For every window of every segment the least of ``least`` over all segments that contain it, in order.

    The transform holds the symbol before each suffix, in the order of the suffixes; empty suffixes come first.
    """
    count = len(segments)
    size = np.array([len(s) for s in segments], dtype=np.int64)
    base = np.cumsum(size) - size
    text = np.frombuffer(b"".join(segments), dtype=np.uint8)
    transform = text[base + size - 1].copy()
    kind = np.int32 if count < 1 << 24 else np.int64
    suffix = np.arange(count, dtype=kind) << 7          # segment and length of each suffix
    common = np.zeros(count + 1, dtype=np.uint8)        # with the suffix before it; one more for ranges that end last
    new = np.ones(count, dtype=bool)                    # put in by the round before
    for _ in range(int(size.max())):
        order = np.argsort(transform, kind="stable")
        order = order[: len(order) - int(np.count_nonzero(transform == END))]
        fresh = new[order]
        longer = suffix[order[fresh]] + 1
        segment, length = longer >> 7, longer & 127
        before = np.full(len(longer), END, dtype=np.uint8)
        more = length < size[segment]
        before[more] = text[base[segment[more]] + size[segment[more]] - 1 - length[more]]
        n = count + len(order)
        mask = np.zeros(n, dtype=bool)
        mask[count:] = fresh
        kept = ~mask
        kept[:count] = False
        moved, moved_suffix, moved_common = np.empty(n, dtype=np.uint8), np.empty(n, dtype=kind), np.zeros(n + 1, dtype=np.uint8)
        moved[:count], moved[kept], moved[mask] = transform[:count], transform[count:], before
        moved_suffix[:count], moved_suffix[kept], moved_suffix[mask] = suffix[:count], suffix[count:], longer
        moved_common[:n][kept] = common[count:-1]
        beside = fresh.copy()
        beside[1:] |= fresh[:-1]
        at = np.flatnonzero(beside)
        alike = at[(at > 0) & (transform[order[at]] == transform[order[at - 1]])]
        moved_common[count + at] = 0
        if len(alike):
            alike = alike[np.argsort(-order[alike - 1])]  # ranges from the back, so that none spans two of them
            ranges = np.empty(2 * len(alike), dtype=np.int64)
            ranges[::2], ranges[1::2] = order[alike - 1] + 1, order[alike] + 1
            moved_common[count + alike] = np.minimum(np.minimum.reduceat(common, ranges)[::2], WINDOW - 1) + 1
        transform, suffix, common, new = moved, moved_suffix, moved_common, mask
    length = suffix & 127
    first = np.flatnonzero(common[:-1] < WINDOW)
    long = length >= WINDOW
    doc = np.where(long, least[suffix >> 7], NONE)
    lowest = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.concatenate((first, [len(doc)]))))
    windows = size - WINDOW + 1
    out = np.empty(int(windows.sum()), dtype=np.int64)
    segment = suffix[long] >> 7
    out[(np.cumsum(windows) - windows)[segment] + size[segment] - length[long]] = lowest[long]
    return out


def _shared_runs(text: bytes, windows: np.ndarray) -> np.ndarray:
    """(first window, windows) of the runs of windows whose hash occurs twice, in segments that follow each other in ``text``.

    A window whose hash no other has is like no other, so its least document is its segment's; the transform decides on the rest.
    """
    n = int(windows.sum())
    places = _ranges(np.cumsum(windows + WINDOW - 1) - windows - WINDOW + 1, windows)
    factor = np.full(len(text) + 1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    factor[:1] = 1
    power = np.cumprod(factor)
    back = np.full(len(text) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), dtype=np.uint64)
    back[:1] = 1
    back = np.cumprod(back)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)) * power[:-1])))
    h = (sums[places + WINDOW] - sums[places]) * back[places]
    order = np.argsort(h ^ (h >> np.uint64(32)), kind="stable")
    alike = np.zeros(n + 1, dtype=bool)
    alike[1:n] = h[order][1:] == h[order][:-1]
    shared = np.empty(n, dtype=bool)
    shared[order] = alike[:n] | alike[1:]
    begins = np.zeros(n, dtype=bool)
    begins[(np.cumsum(windows) - windows)] = True
    first = np.flatnonzero(shared & (begins | np.concatenate(([True], ~shared[:-1]))))
    last = np.flatnonzero(shared & np.concatenate((begins[1:] | ~shared[1:], [True])))
    return np.stack((first, last - first + 1), axis=1)


def _least_of_windows(segments: list[bytes], least: np.ndarray) -> np.ndarray:
    """As ``window_minima``, which is asked only about stretches that may repeat, equal ones once."""
    windows = np.array([len(s) for s in segments], dtype=np.int64) - WINDOW + 1
    text, result = b"".join(segments), np.repeat(least, windows)
    runs = _shared_runs(text, windows)
    if not len(runs):
        return result
    owner = np.searchsorted(np.cumsum(windows), runs[:, 0], side="right")
    start = runs[:, 0] + owner * (WINDOW - 1)  # in bytes: each segment has so many more of them than windows
    parts, lowest, number = {}, [], np.empty(len(runs), dtype=np.int64)
    for k, (s, n, d) in enumerate(zip(start.tolist(), runs[:, 1].tolist(), least[owner].tolist())):
        j = number[k] = parts.setdefault(text[s:s + n + WINDOW - 1], len(lowest))
        if j == len(lowest):
            lowest.append(d)
        elif d < lowest[j]:
            lowest[j] = d
    count = np.array([len(p) for p in parts], dtype=np.int64) - WINDOW + 1
    found = window_minima(list(parts), np.array(lowest, dtype=np.int64))
    result[_ranges(runs[:, 0], runs[:, 1])] = found[_ranges((np.cumsum(count) - count)[number], runs[:, 1])]
    return result


def _sorted_bucket(table: pa.Table) -> pa.Table:
    """All segments sent to a bucket: for each block, the least doc_id of every window of its segments."""
    merged: dict[bytes, int] = {}
    minimizer, least, sent = [], [], []
    for row in table.to_pylist():
        m, size, docs = _unpack(row["a"], np.uint32), _unpack(row["b"], np.uint8).astype(np.int64), _unpack(row["c"], np.int64)
        text, ends, own = zstandard.ZstdDecompressor().decompress(row["d"]), np.cumsum(size), []
        for a, b, d, v in zip((ends - size).tolist(), ends.tolist(), docs.tolist(), m.tolist()):
            j = merged.setdefault(text[a:b], len(least))
            if j == len(least):
                least.append(d)
                minimizer.append(v)
            elif d < least[j]:
                least[j] = d
            own.append(j)
        sent.append(np.array(own))
    segments, least, minimizer = list(merged), np.array(least, dtype=np.int64), np.array(minimizer, dtype=np.uint32)
    size = np.array([len(s) for s in segments], dtype=np.int64)
    windows = size - WINDOW + 1
    result, base = np.empty(int(windows.sum()), dtype=np.int64), np.cumsum(windows) - windows
    order = np.argsort(minimizer, kind="stable")
    total, lo = np.cumsum(size[order]), 0
    while lo < len(order):
        hi = int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PIECE, side="right"))
        hi = max(hi, lo + 1)
        while hi < len(order) and minimizer[order[hi]] == minimizer[order[hi - 1]]:
            hi += 1
        mine = order[lo:hi]
        result[_ranges(base[mine], windows[mine])] = _least_of_windows([segments[k] for k in mine.tolist()], least[mine])
        lo = hi
    return pa.table({
        "block": table["block"], "bucket": table["bucket"],
        "minima": pa.array([_pack(result[_ranges(base[own], windows[own])]) for own in sent], pa.binary())})


def _ranges(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of the ranges that begin at ``first``, one after another."""
    total = np.cumsum(length)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(first - (total - length), length)


def _cut(buckets: int):
    """A block, which of its codes repeat, and its windows' least documents: the removed bytes of every document."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield _report(Marked(row, buckets), [x["minima"] for x in sorted(row["found"] or [], key=lambda x: x["bucket"]) if x["minima"]])
    return cut


def _report(got: Marked, minima: list[bytes]) -> pa.RecordBatch:
    docs, sizes, data = got.docs, got.sizes, got.data
    hit = np.zeros(len(data) + 1, dtype=np.int32)
    if minima:
        windows = np.array([len(x) for x in got.segments], dtype=np.int64) - WINDOW + 1
        lowest, base = np.concatenate([_unpack(m, np.int64) for m in minima]), np.cumsum(windows) - windows
        places = _ranges(got.start, got.windows)
        own = docs[np.searchsorted(np.cumsum(sizes), places, side="right")]
        hit[places[lowest[_ranges(base[got.number], got.windows)] < own]] = 1
    seen = np.cumsum(hit[:-1])
    covered = seen.copy()
    covered[WINDOW:] -= seen[:-WINDOW]
    gone = covered > 0
    text, ends = data.tobytes(), np.cumsum(sizes)
    removed, spans, digests, kept = [], [], [], []
    for a, b in zip((ends - sizes).tolist(), ends.tolist()):
        mine = gone[a:b]
        n = int(np.count_nonzero(mine))
        removed.append(n)
        spans.append(int(np.count_nonzero(mine[1:] & ~mine[:-1]) + mine[0]) if n else 0)
        left = data[a:b][~mine].tobytes() if n else text[a:b]
        digests.append(hashlib.sha256(left).hexdigest())
        kept.append(left)
    return pa.RecordBatch.from_arrays(
        [pa.array(docs), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests),
         pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(documents: DataFrame) -> DataFrame:
    """REPORT rows, one per row of ``documents``: the bytes that 50-byte strings of documents with a smaller doc_id cover are
    removed, ``kept`` holds the rest.

    Null and empty texts have no bytes, and texts below 50 bytes lose none. Rows that share a doc_id do not count against
    each other. Rows without a doc_id have no order: they are returned as they are and take nothing from others. An empty
    table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    known = documents.filter("doc_id is not null").select("doc_id", "text")
    blocks = stored(known.mapInArrow(_blocks, "block long, bytes long, docs binary, sizes binary, data binary"), "blocks")
    total = blocks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_BYTES))
    bits = stored(blocks.mapInArrow(_announced(buckets), "block long, bucket long, keys binary").groupBy("bucket").applyInArrow(
        _repeated, "block long, bucket long, bits binary"), "repeated-minimizers")
    asked = bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("found"))
    minima = stored(blocks.join(asked, "block").mapInArrow(
        _sent(buckets), "block long, bucket long, a binary, b binary, c binary, d binary").groupBy("bucket").applyInArrow(
        _sorted_bucket, "block long, bucket long, minima binary"), "window-minima")
    found = bits.join(minima, ["block", "bucket"], "left").groupBy("block").agg(
        F.collect_list(F.struct("bucket", "bits", "minima")).alias("found"))
    unknown = documents.filter("doc_id is null").select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(text, 256).alias("kept_sha256"), text.alias("kept"))
    return blocks.join(found, "block", "left").mapInArrow(_cut(buckets), REPORT).unionByName(unknown)
