"""Top-k search and hard-negative mining against all scores, odd rows included."""

import math
import random

import numpy as np
import pytest

from orderlens.llm import hard_negatives, impact_index, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, v string, part int, rank int, score double, block int"
INF, NAN = math.inf, math.nan


def table(spark, rows):
    return spark.createDataFrame([(*r, "v", 7, 7, 0.5, 7) for r in rows], SCHEMA)


def made(count, seed, dims=6):
    """Vectors with few distinct components, so many scores tie, and rows that cannot take part."""
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-8, 8) / 16 + 0.001 for _ in range(dims)], rng.randrange(4)) for i in range(count)]
    same = rows[3][1]
    rows += [(count + i, same, rng.randrange(4)) for i in range(count // 3)]  # one very common vector
    rows += [rows[20], rows[20], rows[0]]  # copies count once
    rows += [(400_000, None, 1), (400_020, [1.0, None], 1), (400_040, [NAN], 2), (400_060, [INF, 1.0], 2), (None, [1.0], 1), (None, None, None)]
    rows += [(500_000, [0.5, -0.25], 1), (500_100, [], 2), (500_101, [], 2), (500_102, [0.25], None), (-300, [-0.5] * dims, 0), (500_200, [0.0] * dims, 3)]
    return rows


def usable(rows, scale, labelled):
    """{(id, label, components)} as the contract takes them, filled with zeros."""
    good = [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and (not labelled or r[2] is not None)]
    dims = max((len(r[1]) for r in good), default=0)
    out = set()
    for i, x, label in good:
        whole = [math.floor(scale * float(np.float32(c))) for c in x]
        out.add((i, label if labelled else None, (*whole, *[0] * (dims - len(whole)))))
    return sorted(out, key=str)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("part_rows", [8, 32, 4096])
def test_top_k_equals_all_scores(spark, part_rows):
    rows = made(150, part_rows)
    good = usable(rows, 64, False)
    want = []
    for i, _, q in good:
        if i % 20 == 0:
            scores = sorted((-dot(q, v), j) for j, _, v in good if j != i)[:5]
            want += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    found = impact_index.exact_top_k(table(spark, rows), every=20, k=5, scale=64, part_rows=part_rows)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_index_quantises_wide_components_and_stops_early():
    rng = np.random.default_rng(1)
    v = rng.integers(-50_000, 50_000, (3000, 5))
    ids = rng.permutation(3000)
    index = impact_index.ImpactIndex(ids, v)
    assert index.step.min() > 1
    for q in (v[0], -v[1], v[2] * np.array([1, 0, 0, 0, 0]), np.zeros(5, np.int64)):
        exact = v @ q
        order = np.lexsort((ids, -exact))
        order = order[ids[order] != ids[9]][:10]
        for least in (None, int(exact[order[6]])):
            found, score = index.top(q, 10, ids[9], least)
            keep = order if least is None else order[exact[order] >= least]
            assert found.tolist() == ids[keep].tolist() and score.tolist() == exact[keep].tolist()


def test_rows_that_share_an_id_are_apart(spark):
    rows = [(0, [1.0], 1), (0, [2.0], 1), (1, [1.0], 1), (2, [3.0], 1)]
    found = impact_index.exact_top_k(table(spark, rows), every=20, k=2, scale=1)
    assert sorted(tuple(r) for r in found.collect()) == [(0, 1, 2, 3), (0, 1, 2, 6), (0, 2, 1, 1), (0, 2, 1, 2)]


@pytest.mark.parametrize("empty", [[], [(None, [1.0], 1), (20, None, 1), (40, [NAN], None)]])
def test_empty_tables(spark, empty):
    df = table(spark, empty)
    assert impact_index.exact_top_k(df, every=20, k=3, scale=64).collect() == []
    assert hard_negatives.hard_negative_digest(df).collect() == []


def test_components_that_do_not_fit_end_the_job(spark):
    with pytest.raises(Exception, match="components are too large"):
        impact_index.exact_top_k(table(spark, [(0, [1e30], 1), (1, [1e30], 1)]), every=20, k=3, scale=64).collect()


@pytest.mark.parametrize("dims, bound", [(64, 70_000), (3, 1 << 50), (5000, 1 << 40), (1, 3)])
def test_residue_products_are_exact(dims, bound):
    rng = np.random.default_rng(dims)
    top = max(1, math.isqrt(bound // dims))
    a, b = (rng.integers(-top, top + 1, (20, dims)) for _ in range(2))
    a[0], b[0], b[1] = top, top, -top
    moduli = hard_negatives.primes(dims, bound)
    assert all((p // 2) ** 2 * min(dims, hard_negatives.CHUNK) <= hard_negatives.EXACT for p in moduli) and math.prod(moduli) > 2 * bound
    assert len(set(moduli)) == len(moduli) and all(p > 1 and all(p % d for d in range(2, p)) for p in moduli)
    got = hard_negatives.ResidueMatrix(a, moduli).scores(hard_negatives.ResidueMatrix(b, moduli), slice(0, 20))
    assert (got == a @ b.T).all()


@pytest.mark.parametrize("part_rows", [8, 4096])
def test_hard_negatives_equal_all_scores(spark, part_rows):
    rows = made(220, part_rows)
    good = usable(rows, 16, True)
    want = []
    for i, label, a in good:
        if i % 10:
            continue
        others = sorted((-dot(a, v), j, other) for j, other, v in good if j != i)
        for s, j, _ in [o for o in others if o[2] == label][:3]:
            within = [(n, x) for n, x, other in others if other != label and 30 * -s <= 100 * -n <= 90 * -s][:4]
            want += [(i, j, rank, x, -s, -n) for rank, (n, x) in enumerate(within, 1)]
    found = hard_negatives.hard_negatives(table(spark, rows), 10, 3, 4, 30, 90, 16, part_rows=part_rows)
    assert len(want) > 100 and sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_digest_moves_every_seventh_label(spark):
    rows = [(0, [1.0], 9), (1, [1.0], 0), (2, [0.5], 0), (3, [0.5], 9), (7, [0.6], 0)]
    # Labels become 0, 0, 0, 9, 1; the positives of 0 are 1 (65536) and 2 (32768).
    found = sorted(tuple(r) for r in hard_negatives.hard_negative_digest(table(spark, rows)).collect())
    assert found == [(0, 1, 1, 7, 65536, 39168), (0, 1, 2, 3, 65536, 32768)]


def test_rounds_cover_all_parts():
    for parts in (0, 1, 2, 8, 9, 70, 600):
        seen = [p for first, last in vectors.rounds(parts) for p in range(first, last + 1)]
        assert seen == list(range(parts))
