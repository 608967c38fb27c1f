"""Repeated passages of words by relative Lempel-Ziv parsing.

A document is parsed against reference texts: from its front it takes again and again the longest factor that the reference
holds, found in the reference's suffix array. A factor of WINDOW words or more is a duplicate span as a whole; a window that
lies across the border of two factors is looked up by itself, as greedy factors may cut through it.

Parsing every document against every reference block would compare all pairs of blocks, so references are chosen first.
Texts are packed in blocks. Each block announces the minimizers of its 50-word windows (least hash of their 25-word parts, some
8 % of the words) to buckets, which answer with a bit: do two documents have it? Windows without such a minimizer are done.
For the rest the hash of the window goes to another bucket, which answers with the least doc_id that has it. Every window thus
knows its reference: the first document that has it. Documents then send the stretches that others refer to, once each, and blocks
send their stretches to the reference they need; equal stretches of a block are sent once. A reference that very many blocks
need is copied for shares of them (SHARE), so no task parses for all. The words themselves decide: hashes only route.

One hot passage costs one stretch a block, and work between tasks is packed arrays; nothing but numbers of rows goes to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from agoralake.llm.common import parts_for, stored_by
from agoralake.llm.suffix_dedup import _blocks, _by_bucket, _pack, _ranges, _read, _repeated, _unpack
from agoralake.session import stored

WINDOW = 50
PART = 25                        # words hashed for the minimizer
SPAN = WINDOW - PART + 1
BUCKET_BYTES = 4 << 20           # text for which one bucket is made
SHARE = 256                      # blocks that share one copy of a reference
NONE = np.iinfo(np.int64).max
BASE, TURN, SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F  # odd factors of the hashes
SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _sums(values: np.ndarray, base: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of values[first:last] for each pair, whatever place it stands at."""
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values * _powers(base, len(values)))))
    back = _powers(pow(base, -1, 1 << 64), len(values) + 1)
    return _mixed((total[last] - total[first]) * back[first])


class Words:
    """The words of a block: where they are, whose they are, and the places of its windows."""

    def __init__(self, row: dict):
        self.docs, self.sizes, self.data = _read(row)
        ends = np.cumsum(self.sizes)
        ink = ~SPACES[self.data]
        before = np.concatenate(([False], ink[:-1])) if len(ink) else ink
        begins = (ends - self.sizes)[self.sizes > 0]
        before[begins] = False
        self.start = np.flatnonzero(ink & ~before)
        after = np.concatenate((ink[1:], [False])) if len(ink) else ink
        after[begins[1:] - 1] = False
        self.end = np.flatnonzero(ink & ~after) + 1
        self.owner = np.searchsorted(ends, self.start, side="right")  # number of the document
        self.words = _sums(self.data.astype(np.uint64) + np.uint64(1), BASE, self.start, self.end) if len(self.data) else np.empty(0, dtype=np.uint64)
        n = max(0, len(self.start) - WINDOW + 1)
        self.inside = self.owner[:n] == self.owner[WINDOW - 1:WINDOW - 1 + n]  # windows within one document

    def minimizers(self) -> np.ndarray:
        n = len(self.inside)
        if not n:
            return np.empty(0, dtype=np.uint64)
        at = np.arange(len(self.words) - PART + 1)
        h = _sums(self.words, TURN, at, at + PART)
        for step in (1, 2, 4, 8):
            h = np.minimum(h[:-step], h[step:])  # least of 2, 4, 8 and 16 parts
        return np.minimum(h[:n], h[SPAN - 16:SPAN - 16 + n])

    def codes(self, buckets: int) -> np.ndarray:
        m = self.minimizers()
        return (((m >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (m & np.uint64(0xFFFFFFFE))

    def announced(self, buckets: int) -> list[tuple[int, np.ndarray]]:
        codes = self.codes(buckets)
        new = np.flatnonzero(self.inside & np.concatenate((
            [True], (codes[1:] != codes[:-1]) | (self.owner[1:len(codes)] != self.owner[:len(codes) - 1]) | ~self.inside[:-1]))) if len(codes) else []
        return list(_by_bucket(codes[new], self.docs[self.owner[new]])) if len(new) else []

    def candidates(self, buckets: int, found: list[dict]) -> np.ndarray:
        """Windows whose minimizer two documents share."""
        shared, bits = [np.empty(0, dtype=np.uint64)], {x["bucket"]: x["bits"] for x in found}
        for b, own in self.announced(buckets):
            yes = np.unpackbits(np.frombuffer(bits[b], dtype=np.uint8), count=len(own)).astype(bool)
            shared.append(own[yes] & ~np.uint64(1))
        shared = np.concatenate(shared)
        if not len(shared):
            return np.empty(0, dtype=np.int64)
        codes = self.codes(buckets)
        return np.flatnonzero(self.inside & (shared[np.minimum(np.searchsorted(shared, codes), len(shared) - 1)] == codes))

    def hashes(self, windows: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, hash) of windows; the two are independent, so together they are longer than 64 bits."""
        return ((_sums(self.words, SECOND, windows, windows + WINDOW) % np.uint64(buckets)).astype(np.int64),
                _sums(self.words, TURN, windows, windows + WINDOW))


class Asked:
    """The distinct windows of a block that are sent to buckets, by bucket."""

    def __init__(self, row: dict, buckets: int):
        self.words = Words(row)
        self.windows = self.words.candidates(buckets, row["found"] or [])
        bucket, h = self.words.hashes(self.windows, buckets)
        doc = self.words.docs[self.words.owner[self.windows]]
        order = np.lexsort((doc, h, bucket))
        h, bucket, doc = h[order], bucket[order], doc[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (bucket[1:] != bucket[:-1]))) if len(h) else np.empty(0, dtype=bool)
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(h)])).astype(np.int64) - 1 if len(h) else first
        self.number = np.empty(len(h), dtype=np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.hash, self.bucket, self.least, self.several = h[first], bucket[first], doc[first], doc[first] != doc[last]

    def by_bucket(self) -> Iterator[tuple[int, int, int]]:
        cuts = np.flatnonzero(np.concatenate(([True], self.bucket[1:] != self.bucket[:-1], [True]))).tolist() if len(self.bucket) else [0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(self.bucket[a]), a, b

    def references(self, answers: list[dict]) -> np.ndarray:
        """For every candidate window the first document that has it, NONE where only its own has."""
        got = [_unpack(x["firsts"], np.int64) for x in sorted(answers, key=lambda x: x["bucket"])]
        return (np.concatenate(got) if got else np.empty(0, dtype=np.int64))[self.number]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _announce(buckets: int):
    def announce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = Words(row).announced(buckets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(found), pa.int64()), pa.array([b for b, _ in found], pa.int64()),
                 pa.array([k.astype(np.uint32).tobytes() for _, k in found], pa.binary())], names=["block", "bucket", "keys"])
    return announce


def _ask(buckets: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            got = Asked(row, buckets)
            out = [(b, got.hash[lo:hi].tobytes(), _pack(got.least[lo:hi]), np.packbits(got.several[lo:hi]).tobytes()) for b, lo, hi in got.by_bucket()]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(out), pa.int64()), pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                names=["block", "bucket", "hashes", "docs", "several"])
    return ask


def _firsts(table: pa.Table) -> pa.Table:
    """For the windows that blocks sent to a bucket the least doc_id that has them, NONE where one document alone does."""
    sent = [np.frombuffer(h, dtype=np.uint64) for h in table["hashes"].to_pylist()]
    docs = np.concatenate([_unpack(d, np.int64) for d in table["docs"].to_pylist()])
    several = np.concatenate([np.unpackbits(np.frombuffer(s, dtype=np.uint8), count=len(h)) for s, h in zip(table["several"].to_pylist(), sent)]).astype(bool)
    every = np.concatenate(sent)
    order = np.lexsort((docs, every))
    new = np.concatenate(([True], every[order][1:] != every[order][:-1]))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(order)])) - 1
    low, high = docs[order[first]], docs[order[last]]
    low = np.where((low != high) | np.logical_or.reduceat(several[order], first), low, NONE)
    result = np.empty(len(order), dtype=np.int64)
    result[order] = low[np.cumsum(new) - 1]
    parts = np.split(result, np.cumsum([len(h) for h in sent])[:-1])
    return pa.table({"block": table["block"], "bucket": table["bucket"], "firsts": pa.array([_pack(p) for p in parts], pa.binary())})


class Stretches:
    """Stretches of a block: runs of windows with one reference, as (reference, first word, words); and distinct texts of them."""

    def __init__(self, row: dict, buckets: int):
        got = Asked(row, buckets)
        self.words = w = got.words
        refs = got.references(row["answers"] or [])
        own = w.docs[w.owner[got.windows]] if len(got.windows) else np.empty(0, dtype=np.int64)
        self.referred = self._runs(got.windows[refs == own], refs[refs == own])
        self.sought = self._runs(got.windows[refs < own], refs[refs < own])

    def _runs(self, windows: np.ndarray, refs: np.ndarray) -> list[tuple[int, int, int]]:
        if not len(windows):
            return []
        owner = self.words.owner[windows]
        new = np.flatnonzero(np.concatenate(([True], (windows[1:] != windows[:-1] + 1) | (refs[1:] != refs[:-1]) | (owner[1:] != owner[:-1]))))
        length = np.diff(np.concatenate((new, [len(windows)]))) + WINDOW - 1
        return list(zip(refs[new].tolist(), windows[new].tolist(), length.tolist()))

    def text(self, first: int, count: int) -> bytes:
        return self.words.data[self.words.start[first]:self.words.end[first + count - 1]].tobytes()

    def by_reference(self, runs: list[tuple[int, int, int]]) -> dict[int, dict[bytes, list[int]]]:
        """reference -> text of a stretch -> first words of the places where it stands."""
        out: dict[int, dict[bytes, list[int]]] = {}
        for ref, first, count in runs:
            out.setdefault(ref, {}).setdefault(self.text(first, count), []).append(first)
        return out


def _stretch_rows(buckets: int):
    """Rows (block, ref, target, texts, places): what a block refers others to, and what it seeks in a reference, with the first
    words of the places where each text stands."""
    def stretch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            got, out = Stretches(row, buckets), []
            for target, runs in ((False, got.referred), (True, got.sought)):
                out += [(ref, target, list(texts), list(texts.values()) if target else None) for ref, texts in got.by_reference(runs).items()]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(out), pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()),
                 pa.array(columns[2], pa.list_(pa.binary())), pa.array(columns[3], pa.list_(pa.list_(pa.int64())))],
                names=["block", "ref", "target", "texts", "places"])
    return stretch_rows


# --- the parse --------------------------------------------------------------------------------------------------------

def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Places of ``codes`` in the order of what follows, by doubling the length that is told apart."""
    n, k = len(codes), 1
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.full(n, -1, dtype=np.int64)
        second[:max(0, n - k)] = rank[k:]
        order = np.lexsort((second, rank))
        new = np.ones(n, dtype=np.int64)
        new[1:] = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new) - 1
        k *= 2
        if k >= n or new.all():
            return order


def _common(a: np.ndarray, i: int, b: np.ndarray, j: int) -> int:
    """Length of the common prefix of a[i:] and b[j:]."""
    n, at, step = min(len(a) - i, len(b) - j), 0, 16
    while at < n:
        m = min(step, n - at)
        other = np.flatnonzero(a[i + at:i + at + m] != b[j + at:j + at + m])
        if len(other):
            return at + int(other[0])
        at, step = at + m, step * 4
    return n


class Reference:
    """An indexed reference: distinct numbers for its words, and the suffix array of its stretches."""

    def __init__(self, texts: list[bytes]):
        self.code: dict[bytes, int] = {}
        line: list[int] = []
        for i, text in enumerate(texts):
            line += [self.code.setdefault(w, len(self.code)) for w in text.split()]
            line.append(-1 - i)  # between stretches: like no word, and no other border
        self.line = np.array(line, dtype=np.int64)
        self.order = suffix_array(self.line)

    def numbers(self, text: bytes) -> np.ndarray:
        return np.array([self.code.get(w, NONE) for w in text.split()], dtype=np.int64)

    def longest(self, words: np.ndarray, i: int) -> int:
        """Words from ``i`` on that stand somewhere in the reference."""
        lo, hi, best = 0, len(self.order), 0
        while lo < hi:
            mid = (lo + hi) // 2
            at = int(self.order[mid])
            n = _common(words, i, self.line, at)
            best = max(best, n)
            if i + n < len(words) and at + n < len(self.line) and self.line[at + n] < words[i + n]:
                lo = mid + 1
            else:
                hi = mid
        return best

    def factors(self, words: np.ndarray) -> list[tuple[int, int]]:
        """The greedy parse: (first word, words) of each factor; a word that the reference lacks is one of length 1."""
        out, i = [], 0
        while i < len(words):
            n = max(1, self.longest(words, i))
            out.append((i, n))
            i += n
        return out

    def spans(self, text: bytes, window: int = WINDOW) -> list[tuple[int, int]]:
        """Word ranges of ``text`` that windows of the reference cover."""
        words, covered = self.numbers(text), []
        for i, n in self.factors(words):
            if i:  # windows across the border at i: those that begin before it
                covered += [(s, s + window) for s in range(max(0, i - window + 1), min(i, len(words) - window + 1)) if self.longest(words, s) >= window]
            if n >= window:
                covered.append((i, i + n))
        return sorted(set(covered))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, ref, digest, sought, places, held): word ranges of the block that ``held`` covers, joined where they touch."""
    last, reference = None, None
    for row in _rows(batches):
        if (row["ref"], row["digest"]) != last:
            last, reference = (row["ref"], row["digest"]), Reference(row["held"])
        found: list[list[int]] = []
        for text, places in zip(row["sought"], row["places"]):
            spans = reference.spans(text)
            found += [[first + lo, first + hi] for first in places for lo, hi in spans]
        flat: list[int] = []
        for lo, hi in sorted(found):
            if flat and lo <= flat[-1]:
                flat[-1] = max(flat[-1], hi)
            else:
                flat += [lo, hi]
        yield pa.RecordBatch.from_arrays([pa.array([row["block"]]), pa.array([np.array(flat, dtype=np.int64).tobytes()], pa.binary())],
                                         names=["block", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in _rows(batches):
        words = Words(row)
        change = np.zeros(len(words.start) + 1, dtype=np.int64)
        for spans in row["parsed"] or []:
            np.add.at(change, np.frombuffer(spans, dtype=np.int64)[::2], 1)
            np.add.at(change, np.frombuffer(spans, dtype=np.int64)[1::2], -1)
        yield _report(words, np.cumsum(change[:-1]) > 0)


def _report(words: Words, gone: np.ndarray) -> pa.RecordBatch:
    text = words.data.tobytes()
    ends = np.cumsum(words.sizes)
    border = np.searchsorted(words.owner, np.arange(len(words.docs) + 1)).tolist()
    total, removed, digests, kept = [], [], [], []
    for k, (a, b) in enumerate(zip((ends - words.sizes).tolist(), ends.tolist())):
        mine = gone[border[k]:border[k + 1]]
        n = int(np.count_nonzero(mine))
        own = text[a:b].split()
        left = b" ".join(own if not n else [w for w, g in zip(own, mine.tolist()) if not g])
        total.append(len(own))
        removed.append(n)
        digests.append(hashlib.sha256(left).hexdigest())
        kept.append(left)
    return pa.RecordBatch.from_arrays(
        [pa.array(words.docs), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests), pa.array(kept, pa.binary())],
        names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


REPORT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary"


def remove_passages(documents: DataFrame, share: int = SHARE, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """REPORT rows, one per row of ``documents``: words covered by a 50-word window that a document with a smaller doc_id
    has too are removed; ``kept`` holds the others joined by single spaces.

    Words are split at ASCII white space and compared as bytes. Null and empty texts have no words, and texts below 50
    words lose none. Rows that share a doc_id do not count against each other. Rows without a doc_id have no order: they lose
    nothing and take nothing from others. An empty table gives no rows; other columns are not read.
    """
    known = documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = documents.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    buckets = max(1, -(-size // bucket_bytes))
    blocks = stored_by(known.mapInArrow(_blocks, "block long, bytes long, docs binary, sizes binary, data binary"), "passage-blocks", "block",
                       parts_for(documents.sparkSession, size, 64 << 20))
    bits = blocks.mapInArrow(_announce(buckets), "block long, bucket long, keys binary").groupBy("bucket").applyInArrow(
        _repeated, "block long, bucket long, bits binary")
    asked = stored(bits.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("found")), "shared-minimizers")
    firsts = blocks.join(asked, "block").mapInArrow(
        _ask(buckets), "block long, bucket long, hashes binary, docs binary, several binary").groupBy("bucket").applyInArrow(
        _firsts, "block long, bucket long, firsts binary")
    answers = firsts.groupBy("block").agg(F.collect_list(F.struct("bucket", "firsts")).alias("answers"))
    stretches = stored(blocks.join(asked, "block").join(answers, "block").mapInArrow(
        _stretch_rows(buckets), "block long, ref long, target boolean, texts array<binary>, places array<array<bigint>>"), "stretches")
    # One copy of a reference for every ``share`` blocks that need it.
    needs = stretches.where("target").groupBy("ref").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("copies"))
    held = stretches.where("not target").select("ref", F.xxhash64("texts").alias("digest"), F.col("texts").alias("held")).distinct()
    held = held.join(needs, "ref").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    sought = stretches.where("target").select("block", "ref", F.col("texts").alias("sought"), "places").join(needs, "ref").withColumn(
        "copy", F.pmod(F.xxhash64("block"), F.col("copies")).cast("int")).drop("copies")
    spans = sought.join(held, ["ref", "copy"]).select("block", "ref", "digest", "sought", "places", "held").mapInArrow(
        _parse, "block long, spans binary")
    parsed = stored(spans.groupBy("block").agg(F.collect_list("spans").alias("parsed")), "duplicate-spans")
    done = blocks.join(parsed, "block", "left").mapInArrow(_cut, REPORT)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    unknown = documents.where("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.size(own).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.sha2(F.array_join(own, " "), 256).alias("kept_sha256"), F.array_join(own, " ").cast("binary").alias("kept"))
    return done.unionByName(unknown)
