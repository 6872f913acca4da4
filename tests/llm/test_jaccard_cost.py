"""The Jaccard join makes each set once where it can, with the same results."""

import re

import numpy as np

from orderlens.llm import jaccard
from orderlens.llm.hashing import Powers


def test_distinct_equals_unique():
    rng = np.random.default_rng(1)
    for size in (0, 1, 2, 1000):
        x = rng.integers(0, 300, size).astype(np.uint64)
        assert np.array_equal(jaccard.distinct(x), np.unique(x))


def test_rarest_tokens_are_the_first_of_the_order():
    rng = np.random.default_rng(2)
    for size in (0, 1, 5, 200):
        u = jaccard.distinct(rng.integers(0, 1 << 62, size).astype(np.uint64))
        spread = jaccard.mix(u)
        for share in (0.0, 0.5, 0.95, 1.0):
            place = np.where(rng.random(len(u)) < share, rng.integers(16, 40, len(u)), 0)
            for k in {0, min(3, len(u)), len(u) // 2, len(u)}:
                expected = u[np.lexsort((spread, place))[:k]]
                assert set(jaccard.rarest(u, place, spread, k).tolist()) == set(expected.tolist())


def test_words_end_at_every_blank_and_fold_only_ascii():
    texts = ["A b\tc\x0bD", "a\x0cB\rc\nd", "a b c\x08d", "Ä b c d", "ä b c d", "a\x0eb c d", ""]
    sets = jaccard.gram_sets(texts, 2, Powers())
    words = [[w for w in re.split("[\x20\x09-\x0d]+", t.translate({c: c + 32 for c in range(65, 91)})) if w] for t in texts]
    grams = [{tuple(w[i : i + 2]) for i in range(len(w) - 1)} for w in words]
    for i in range(len(texts)):
        assert len(sets[i]) == len(grams[i])
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(grams[i] & grams[j])


def test_a_text_of_several_pairs_is_cut_once(monkeypatch):
    made = []
    monkeypatch.setattr(jaccard, "gram_sets", lambda texts, *a, of=jaccard.gram_sets: made.extend(texts) or of(texts, *a))
    words = [f"w{i}" for i in range(60)]
    leader, near, far = " ".join(words), " ".join([*words, "end"]), " ".join(words[:40])
    pairs = [(leader, near), (leader, far), (leader, leader), (near, far)]
    assert list(jaccard.similar(pairs, 3, 90, Powers())) == [True, False, True, False]
    assert sorted(made) == sorted([leader, near, far])
