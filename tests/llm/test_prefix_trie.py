"""The prefix trie against a plain one, odd conversations included."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from orderlens.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, d1 int, part double, leaves string"


def brute(rows):
    """Nodes of the rebuilt conversations, by the contract's own words; turn numbers do not tie."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = [*convs.get(c - c % 20, [])[:h], *own[h:]]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, inside in members.items():
        below = [u for u in members if u[: len(node)] == node]
        leaves = [u for u in below if not any(len(w) == len(u) + 1 and w[:-1] == u for w in below)]
        saved = sum((len(members[u]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", u[-1][1] if u else "")) for u in below)
        listed = ",".join(map(str, sorted(ends.get(node, []))))
        children = sum(len(u) == len(node) + 1 for u in below)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(inside), len(node), parent, len(inside), children, len(leaves), saved, hashlib.sha256(listed.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, 0.5, "y") for r in rows], SCHEMA)
    found = prefix_trie.prefix_trie(df, **options)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert all(kind == "bigint" for name, kind in found.dtypes if name != "ends_sha256")
    return sorted((tuple(r) for r in found.collect()), key=str)


def made(seed, convs, words):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        n = rng.choice([1, 1, 2, 3, 3, 5, 9])
        turns = [*range(n - 1), rng.choice([None, n])]
        rows += [(c, t, rng.choice(["user", None]), rng.choice(words)) for t in turns]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [1, 40, 1 << 18])
def test_trie_equals_a_plain_one(spark, shard_turns):
    rows = made(shard_turns, [*range(0, 130), 200, 205, 215, 405], ["a b", "a  b\tc", "", None, "é"])
    rows += [(None, 0, "user", "a b"), (None, None, None, None)]
    rows += [(600, t, "user", f"turn {t} of one") for t in range(70)]
    rows += [(c, t, "user", f"many {t}") for c in range(700, 800) for t in range(5)]  # a family of copies
    assert trie(spark, rows, shard_turns=shard_turns) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "x")], [(3, 1, "user", "x")], [(5, None, None, None)], [(41, 0, "u", "a"), (43, 0, "u", "b"), (44, 1, "u", "c")]])
def test_small_tables(spark, rows):
    assert trie(spark, rows) == (brute(rows) if any(r[0] is not None for r in rows) else [])


def test_a_conversation_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(20, t, "user", f"{t * t % 7}") for t in range(400)] + [(c, 0, "user", "hi") for c in range(21, 30)]
        df = spark.createDataFrame([(*r, "x", 1, 0.5, "y") for r in rows], SCHEMA)
        assert prefix_trie.turn_sums(df).where("conv_id = 20").select("part").distinct().count() > 4
        assert trie(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repeated_rows_are_turns_of_their_own(spark):
    found = trie(spark, [(20, 1, "user", "same")] * 3)
    assert [r[:4] for r in found] == [(20, 0, None, 1), (20, 1, 20, 1), (20, 2, 20, 1), (20, 3, 20, 1)]


def test_every_digest_has_a_slot_and_no_other_is_found():
    rng = np.random.default_rng(3)
    d1, d2 = (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(2))
    table = prefix_trie.SlotTable(d1[:4000], d2[:4000])
    assert sorted(table.slots) == list(range(4000)) and (table.find(d1[:4000], d2[:4000]) == table.slots).all()
    assert (table.find(d1[4000:], d2[4000:]) == -1).all() and (table.find(d1[:4000], d2[1:4001]) == -1).all()
    with pytest.raises(ValueError, match="not distinct"):
        prefix_trie.SlotTable(d1[[0, 0]], d2[[0, 0]])


def test_powers_have_either_sign():
    for which in (0, 1):
        up, down = prefix_trie.powers(np.arange(6), which), prefix_trie.powers(-np.arange(6), which)
        assert up[3] == np.uint64(pow(prefix_trie.BASES[which], 3, 1 << 64)) and (up * down == 1).all()
