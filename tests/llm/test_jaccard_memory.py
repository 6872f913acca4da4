"""Tasks of the Jaccard join hold a slice of a batch's texts and one block's sets, not those of the whole batch."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from orderlens.llm import jaccard
from orderlens.llm.hashing import Powers

N, PERCENT = 3, 90


def texts(count, words=400):
    rng = np.random.default_rng(3)
    return [" ".join(map(str, rng.integers(0, 10**6, words))) for _ in range(count)]


def peak(work):
    work()
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_slices_cover_all_rows_and_keep_to_the_limit():
    column = pa.array(["a" * k for k in (5, 5, 5, 40, 0, 1)] + [None])
    assert list(jaccard.text_slices([column], 10)) == [(0, 2), (2, 3), (3, 4), (4, 7)]
    assert list(jaccard.text_slices([column, column], 10)) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 7)]
    assert list(jaccard.text_slices([column.slice(0, 0)], 10)) == []


def test_pairs_of_a_batch_are_strings_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE_CHARS", 1 << 14)
    few = texts(4)
    some = few + [few[0].rsplit(" ", 3)[0], None]
    left, right = pa.array([few[0]] * 3000), pa.array(some * 500)
    powers = Powers()
    got, most = peak(lambda: list(jaccard.similar_rows(left, right, N, PERCENT, powers)))
    assert got == [True, False, False, False, True, False] * 500
    assert most < right.nbytes / 4


def test_sets_of_a_column_are_made_a_slice_at_a_time(monkeypatch):
    monkeypatch.setattr(jaccard, "SLICE_CHARS", 1 << 14)
    some = texts(800) + [None]
    column = pa.chunked_array([some[:300], some[300:]])
    powers = Powers()
    sizes, most = peak(lambda: [len(u) for u in jaccard.sets_of(column, N, powers)])
    assert sizes == [len(u) for u in jaccard.gram_sets([t or "" for t in some], N, Powers())]
    assert most < column.nbytes / 4


def test_counts_of_a_batch_are_made_block_by_block(monkeypatch):
    held = []
    monkeypatch.setattr(jaccard, "token_counts", lambda texts, *a, of=jaccard.token_counts: held.append(len(texts)) or of(texts, *a))
    blks = pa.array([0] * 30 + [1] * 20 + [2] * 10)
    batch = pa.RecordBatch.from_arrays([pa.array(texts(30, 40) * 2), blks], ["text", "blk"])
    out = list(jaccard.dealt([batch], N, 4))
    assert held == [30, 20, 10]
    rows = [r for b in out for r in b.to_pylist()]
    for blk, count in ((0, 30), (1, 20), (2, 10)):
        own = [np.frombuffer(r["tokens"], np.uint64) for r in rows if r["blk"] == blk]
        sets = list(jaccard.sets_of(batch.column("text").filter(pc.equal(blks, blk)), N, Powers()))
        assert np.array_equal(np.sort(np.concatenate(own)), np.unique(np.concatenate(sets))) and len(sets) == count
