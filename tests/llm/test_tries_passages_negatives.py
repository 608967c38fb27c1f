"""Operators 11 to 13 against plain versions on awkward rows, and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from agoralake.llm import hard_negatives, prefix_trie, substring_dedup, suffix_dedup
from corpus_cases import awkward, documents, prose

# --- 11: prefix trie

TURNS = "conv_id long, turn long, role string, text string, depth long, k1 string, _piece string, n_convs string"


def plain_trie(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v, key=lambda y: y[:2])] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members, children, leaves, saved = (defaultdict(x) for x in (list, int, int, int))
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    ends = {p: ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(p)))) for p, m in members.items()}
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(ends[p].encode()).hexdigest()) for p, m in members.items())


def turns_of(spark, rows):
    return spark.createDataFrame([(*x, 7, "k", "p", "n") for x in rows], TURNS).repartition(4)


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_against_plain_prefixes(spark, band):
    r = random.Random(band)
    rows = []
    for c in [*range(0, 12), *range(100, 109), 250, 301, -5, -100, -101, 400, 401]:
        n = r.choice([1, 2, 3, 7, 20])
        texts = [r.choice(["hi", "é", "", None, "more words here"]) for _ in range(n)]
        rows += [(c, None if i == 0 and c % 3 == 0 else i, r.choice(["user", None, "assistant"]) if c % 2 else "user", t) for i, t in enumerate(texts)]
    same = [("user", "a"), ("assistant", "b"), ("user", "c")] * 12
    for c in (500, 501, 502, 503, 504, 505, 506):  # one deep path with branches near its end
        rows += [(c, i, *t) for i, t in enumerate(same[:36 - c % 4])] + [(c, 40, "user", str(c % 3))]
    rows += [(None, 1, "user", "x"), (600, 1, "user", "x" * 5000), (601, None, None, None)]
    got = sorted((tuple(x) for x in prefix_trie.prefix_trie(turns_of(spark, rows), band).collect()), key=str)
    assert got == sorted(plain_trie(rows), key=str)


def test_ties_and_repeated_turns_are_stable(spark):
    rows = [(700, 1, "user", t) for t in ("b", "a", "a", "c")] + [(701, 1, "user", t) for t in ("a", "c", "b", "a")]
    first = sorted(map(tuple, prefix_trie.prefix_trie(turns_of(spark, rows)).collect()), key=str)
    again = sorted(map(tuple, prefix_trie.prefix_trie(turns_of(spark, rows[::-1])).collect()), key=str)
    assert first == again and max(x[1] for x in first) == 4
    assert prefix_trie.prefix_trie(turns_of(spark, rows).limit(0)).count() == 0


# --- 12: passages

def plain_passages(rows, n=50):
    docs = [(d, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for d, t, *_ in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - n + 1) if d is not None else ():
            key = tuple(w[i:i + n])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - n + 1) if d is not None else ():
            if first[tuple(w[i:i + n])] < d:
                gone[i:i + n] = [True] * n
        out.append((d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block,share", [(2 << 20, 256), (1500, 1)])
def test_passages_against_all_windows(spark, monkeypatch, block, share):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    r = random.Random(8)
    passage, rows = prose(r, 130).split(" "), awkward()
    for i in range(40):  # parts of one passage in always different surroundings, and spaced in other ways
        a = r.randint(0, 70)
        part = passage[a:a + r.randint(45, 130)]
        rows.append((400 + r.randint(0, 200), prose(r, r.randint(0, 30)) + "\n" + r.choice([" ", "\n\n", "\t"]).join(part) + "  " + prose(r, r.randint(0, 9)), "", "", 0, ""))
    line = prose(r, 30)
    rows += [(700 + i, prose(r, 40) + " " + line + " " + prose(r, 40), "", "", 0, "") for i in range(30)]  # shared, but no window is
    rows += [(800, "a b " * 300, "", "", 0, ""), (801, "b a " * 60, "", "", 0, ""), (799, "a b c " + "a b " * 40, "", "", 0, ""), (803, " ".join(passage[::-1]) + " a b" * 30, "", "", 0, ""), (802, " ".join(passage), "", "", 0, "")]
    rows += [(804, " ".join(passage[:60] + passage[20:90] + passage[70:]), "", "", 0, "")]
    key = lambda x: tuple(str(v) for v in x)
    got = substring_dedup.remove_passages(documents(spark, rows), share=share, bucket_bytes=6000).collect()
    assert sorted((tuple(x)[:4] for x in got), key=key) == sorted(plain_passages(rows), key=key)
    assert all(hashlib.sha256(x["kept"]).hexdigest() == x["kept_sha256"] for x in got)
    assert substring_dedup.remove_passages(documents(spark, [])).count() == 0


def test_parse_against_all_windows_of_a_reference():
    r = random.Random(3)
    for words, window in (("ab", 4), ("abcd", 3), ("a", 5)):
        for _ in range(150):
            texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 25))).encode() for _ in range(r.randint(1, 4))]
            text = " ".join(r.choice(words + "z") for _ in range(r.randint(1, 30))).encode()
            reference, own = substring_dedup.Reference(texts), text.split()
            known = {tuple(w[i:i + window]) for w in (t.split() for t in texts) for i in range(len(w) - window + 1)}
            want = {p for i in range(len(own) - window + 1) if tuple(own[i:i + window]) in known for p in range(i, i + window)}
            assert {p for a, b in reference.spans(text, window) for p in range(a, b)} == want
            factors = reference.factors(reference.numbers(text))
            assert [a for a, _ in factors[1:]] == [a + n for a, n in factors[:-1]] and sum(n for _, n in factors) == len(own)


# --- 13: hard negatives

def plain_negatives(rows, every=100):
    use = [(i, l, [int(np.floor(256 * float(x))) for x in v]) for i, v, l in rows
           if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for k, (i, l, v) in enumerate(use):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for n, (j, m, w) in enumerate(use) if n != k and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == l][:5]:
            inside = [(j, t) for t, j, m in scored if m != l and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, p, r + 1, j, -s, -t) for r, (j, t) in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("block,slab", [(8192, 256), (7, 2), (40, 3)])
def test_negatives_against_all_scores(spark, block, slab):
    r = np.random.default_rng(4)
    center = r.standard_normal((4, 11))
    rows = [(i, (center[i % 4] + 0.8 * r.standard_normal(11)).tolist(), int(r.integers(0, 3))) for i in range(0, 900, 4)]
    rows += [(1000 + i, v, 1) for i, v in enumerate([None, [float("nan")] * 11, [float("inf")] + [1.0] * 10, [], [1.0, None], [1.0, 2.0], [0.0] * 11])]
    rows += [(1100, [1.0, 3.0], 0), (1101, [1.0, 2.5], 1), (1102, [0.9, 2.9], 0), (1200, rows[0][1], None), (None, rows[0][1], 1), (1300, [0.0] * 11, 2), (1400, [], 1), (1401, [], 2), (1402, [], 1)]
    rows += [rows[0], rows[0], (rows[50][0], rows[50][1], rows[50][2]), (1500, rows[0][1], rows[0][2]), (1501, rows[0][1], (rows[0][2] + 1) % 3)]
    df = spark.createDataFrame([(*x, 1, "s") for x in rows], "vec_id long, embedding array<double>, label int, own long, score string").repartition(3)
    got = sorted(tuple(x) for x in hard_negatives.hard_negatives(df, block=block, slab=slab).collect())
    assert got == plain_negatives(rows) and len(got) > 100
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_scores_of_any_size():
    r = np.random.default_rng(5)
    for reach in (1, 200, 1 << 20, 1 << 40, (1 << 63) - 1):
        for dim in (1, 8, 13):
            a, b = (r.integers(-reach, reach, (n, dim), dtype=np.int64, endpoint=True) for n in (5, 30))
            got = hard_negatives.Scorer(a).scores(hard_negatives.bit_planes(b))
            want = [[min(hard_negatives.HIGH, max(hard_negatives.LOW, sum(int(x) * int(y) for x, y in zip(v, w)))) for v in a] for w in b]
            assert got.tolist() == want
