"""Leaf sizes and recall of the random-projection forest on large labels, and forests of labels with few sampled vectors."""

from collections import Counter

import numpy as np
import pytest

from agoralake.llm import embedding_dups

DIM, PLANTED = 64, 2000


def vectors_with_pairs(n, mean_cosine, cosine, seed):
    """n unit vectors around one center and, for the first PLANTED of them, one at the given cosine each."""
    r = np.random.default_rng(seed)
    center = embedding_dups.unit(r.standard_normal((1, DIM)))
    x = embedding_dups.unit(np.sqrt(mean_cosine) * center + np.sqrt(1 - mean_cosine) * embedding_dups.unit(r.standard_normal((n, DIM))))
    aside = r.standard_normal((PLANTED, DIM))
    aside = embedding_dups.unit(aside - (aside * x[:PLANTED]).sum(axis=1, keepdims=True) * x[:PLANTED])
    x = np.vstack((x, cosine * x[:PLANTED] + np.sqrt(1 - cosine ** 2) * aside))
    return x, x[r.permutation(len(x))[:embedding_dups.SAMPLE]]


def met(leaves, n):
    return sum(bool(set(leaves[i]) & set(leaves[n + i])) for i in range(PLANTED)) / PLANTED


@pytest.mark.parametrize("n,depth,mean_cosine", [(100_000, 9, 0.0), (20_000, 6, 0.5), (20_000, 6, 0.8)])
def test_leaves_are_even_and_close_pairs_meet(n, depth, mean_cosine):
    x, sample = vectors_with_pairs(n, mean_cosine, 0.931, 3)
    forest = embedding_dups.fit_forest(sample, depth, 0.93)
    leaves = embedding_dups.leaves_of(forest, x, depth)
    assert met(leaves, n) >= 0.999
    sizes = np.array(list(Counter(v for own in leaves for v in own).values()))
    trees = len(forest["trees"])
    assert len(sizes) == trees << depth  # no leaf is empty
    assert sizes.max() <= 3 * np.median(sizes)
    assert all(len({v >> 48 for v in own}) == trees for own in leaves[:100])


def test_shallow_labels_in_the_shared_forest():
    """Labels with few sampled vectors follow the forest of all, with as many trees as their own depth needs."""
    x, sample = vectors_with_pairs(4_000, 0.0, 0.931, 5)
    labels = ["large"] * (len(sample) - 40) + ["small"] * 40
    forests = embedding_dups.fit_forests(sample, labels, 8, 0.93, embedding_dups.MISS)
    assert set(forests) == {None, "large"}
    shared = forests[None]
    counts = [embedding_dups.trees_for(shared["dense"], d, embedding_dups.MISS) for d in range(9)]
    assert counts[0] == 1 and counts == sorted(counts) and counts[8] == len(shared["trees"])
    leaves = embedding_dups.leaves_of(shared, x, 3)
    assert met(leaves, 4_000) >= 0.999 and {v >> 48 for v in leaves[0]} == set(range(counts[3]))


def test_a_sample_without_rows_or_spread_still_splits():
    same = np.repeat(embedding_dups.unit(np.ones((1, DIM))), 300, axis=0)
    for sample in (same[:0], same):
        forest = embedding_dups.fit_forest(sample, 3, 0.93)
        leaves = embedding_dups.leaves_of(forest, same, 3)
        assert all(own == leaves[0] and own for own in leaves)
