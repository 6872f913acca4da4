"""Prefix trie of rebuilt conversations as a minimal-perfect-hash node table.

A node is a distinct sequence of first turns; its digest is a pair of polynomials over turn hashes,
so prefix digests are running sums: a conversation of any length is spread over range partitions,
which are summed apart and joined by offsets. Digests are enumerated by a grouped count that
combines before the shuffle, so a hot node is one row.

Nodes of one conversation have closed forms. The shared ones are dealt to shards, whole subtrees at a
time: the node nearest the root whose members have at most ``SHARD_TURNS`` turns in all stays whole
with everything below it, and the few nodes above such subtrees, the root included, are the last shard. In a
shard every distinct digest gets a slot from a minimal perfect hash, and the digest kept in the slot
verifies each look-up. Counts are scattered into flat arrays by slot, and sums go up through the array
of parent slots in order of depth.

Defined results: null role or text is empty; rows without conv_id are left out; turns that share a
number, and repeated rows, are turns of their own, in the order of a hash of role and text; a
conversation id is divided as Spark divides (remainders take the sign of the id); an empty table has
no nodes; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.hashing import mix
from orderlens.llm.tables import drop_stored, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Turns that a rebuilt conversation takes from its base, fewer than this; bases are every 20th id.
HEAD, FAMILY = 4, 20
#: Member turns of a subtree that a shard takes whole.
SHARD_TURNS = 1 << 18
#: Conversations whose ids one row of the list of ends holds, at most.
ENDS = 4096
#: The odd bases of the two polynomials, and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)
#: Slots tried per key at each level of the hash.
ROOM = 1.5

NODE = "d1 long, d2 long, p1 long, p2 long, conv_id long, depth long, n_convs long, words long, n_ends long"


def powers(exponents: np.ndarray, which: int) -> np.ndarray:
    """Powers of a base modulo 2**64 for whole exponents of either sign."""
    out = np.ones(len(exponents), np.uint64)
    for base, left in ((BASES[which], np.maximum(exponents, 0)), (INVERSES[which], np.maximum(-exponents, 0))):
        while left.any():
            out = np.where(left & 1, out * np.uint64(base), out)
            base = base * base % (1 << 64)
            left = left >> 1
    return out


def unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, np.ndarray]) -> pa.RecordBatch:
    arrays = [batch.column(c) for c in keep] + [pa.array(x.view(np.int64) if x.dtype == np.uint64 else x) for x in new.values()]
    return pa.RecordBatch.from_arrays(arrays, [*keep, *new])


def turn_sums(rows: DataFrame) -> DataFrame:
    """(part, conv_id, i, t1, t2, s1, s2, words): turns in order, numbered and summed within a range partition."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(2), text, role).alias("t2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")
    )

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, count, total = None, 0, [np.uint64(0), np.uint64(0)]
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            starts = np.flatnonzero(np.concatenate([[ids[0] != conv], ids[1:] != ids[:-1]]))
            first = np.zeros(len(ids), np.int64)  # where a row's conversation begins, before this batch too
            first[starts] = starts
            first = np.maximum.accumulate(first)
            carried = int(starts[0]) if len(starts) else len(ids)  # rows of the last batch's conversation
            i = np.arange(len(ids)) - first + 1
            i[:carried] += count
            new = {"part": np.full(len(ids), part, np.int32), "i": i}
            for k in (0, 1):
                run = np.cumsum(unsigned(batch, f"t{k + 1}") * powers(i, k))
                before = np.concatenate([np.zeros(1, np.uint64), run])[first]
                before[:carried] = np.uint64(0) - total[k]
                new[f"s{k + 1}"] = run - before
                total[k] = new[f"s{k + 1}"][-1]
            conv, count = ids[-1], int(i[-1])
            yield with_columns(batch, ["conv_id", "t1", "t2", "words"], new)

    order = ["conv_id", F.asc_nulls_first("turn"), "t1", "t2"]
    schema = "conv_id long, t1 long, t2 long, words long, part int, i long, s1 long, s2 long"
    return stored(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(sums, schema))


def placed_turns(pieces: DataFrame) -> DataFrame:
    """Turns with pos, their place in the whole conversation, and s1, s2 summed from its start."""
    ends = pieces.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("m"), F.max_by(F.struct("s1", "s2"), "i").alias("s"))
    # A conversation lies in several parts only where it crosses their borders: fewer than there are parts.
    crossing = ends.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "m", "s.s1", "s.s2"))).alias("parts")).where(F.size("parts") > 1)

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, parts in zip(batch.column("conv_id").to_pylist(), batch.column("parts").to_pylist(), strict=True):
                before, sums = 0, [0, 0]
                for p in parts:
                    out.append((conv, p["part"], before, *(s - (s >> 63 << 64) for s in sums)))
                    sums = [(s + pow(b, before, 1 << 64) * p[c]) % (1 << 64) for s, b, c in zip(sums, BASES, ("s1", "s2"), strict=True)]
                    before += p["m"]
            kinds = {"conv_id": pa.int64(), "part": pa.int32(), "before": pa.int64(), "b1": pa.int64(), "b2": pa.int64()}
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=True)], list(kinds))

    found = stored(crossing.mapInArrow(offsets, "conv_id long, part int, before long, b1 long, b2 long"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = batch.column("before").to_numpy(zero_copy_only=False)
            new = {"pos": batch.column("i").to_numpy() + before}
            new |= {f"s{k + 1}": unsigned(batch, f"b{k + 1}") + powers(before, k) * unsigned(batch, f"s{k + 1}") for k in (0, 1)}
            yield with_columns(batch, ["conv_id", "t1", "t2", "words"], new)

    joined = pieces.join(found, ["conv_id", "part"], "left").fillna(0, ["before", "b1", "b2"])
    placed = stored(joined.mapInArrow(place, "conv_id long, t1 long, t2 long, words long, pos long, s1 long, s2 long"))
    drop_stored(found)
    drop_stored(pieces)
    return placed


def rebuilt(placed: DataFrame) -> DataFrame:
    """A row per conversation: k turns come from its base, then its own after the first h; length in all.

    b1, b2, bw: digests and words of the base's first turns; o1, o2: the own sums that are left out.
    """
    pick = lambda c: F.array(*[F.max(F.when(F.col("pos") == j, F.col(c))) for j in range(1, HEAD)])
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("n"), *[pick(c).alias(name) for c, name in (("s1", "f1"), ("s2", "f2"), ("words", "fw"))])
    base = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"), F.col("f1").alias("b1"), F.col("f2").alias("b2"), F.col("fw").alias("bw"))
    convs = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": F.crc32(F.col("conv_id").cast("string")) % HEAD})
    own = F.least("h", "n")
    both = convs.join(base, "base", "left").withColumn("k", F.least("h", F.coalesce("n_base", F.lit(0))))
    at = lambda sums, j: F.when(j > 0, F.element_at(sums, F.greatest(j, F.lit(1)).cast("int"))).otherwise(F.lit(0))
    return both.select(
        "conv_id", "h", "k", "b1", "b2", "bw", *[at(f"f{c}", own).alias(f"o{c}") for c in (1, 2)], *[at(f"b{c}", F.col("k")).alias(f"e{c}") for c in (1, 2)], (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")
    )


def member_turns(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, len, words, d1, d2, p1, p2): every prefix of every rebuilt conversation and its parent."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, k, pos = (batch.column(c).to_numpy() for c in ("h", "k", "pos"))
            depth = pos + k - h
            new = {"depth": depth}
            for c in (1, 2):
                moved = (unsigned(batch, f"s{c}") - unsigned(batch, f"o{c}")) * powers(k - h, c - 1)
                new[f"d{c}"] = unsigned(batch, f"e{c}") + moved
            for c in (1, 2):
                new[f"p{c}"] = new[f"d{c}"] - unsigned(batch, f"t{c}") * powers(depth, c - 1)
            yield with_columns(batch, ["conv_id", "len", "words"], new)

    about = convs.select("conv_id", "h", "k", "o1", "o2", "e1", "e2", "len")
    schema = "conv_id long, len long, words long, depth long, d1 long, d2 long, p1 long, p2 long"
    own = placed.join(about, "conv_id").where("pos > h").mapInArrow(digests, schema)
    head = convs.where("k > 0").select("conv_id", "len", "b1", "b2", "bw", F.explode(F.sequence(F.lit(1).cast("long"), "k")).alias("depth"))
    at = lambda c, j: F.element_at(c, j.cast("int"))
    before = lambda c: F.when(F.col("depth") > 1, at(c, F.greatest(F.col("depth") - 1, F.lit(1)))).otherwise(F.lit(0))
    here = F.col("depth")
    head = head.select("conv_id", "len", at("bw", here).alias("words"), "depth", at("b1", here).alias("d1"), at("b2", here).alias("d2"), before("b1").alias("p1"), before("b2").alias("p2"))
    return head.union(own.select(head.columns))


class SlotTable:
    """Distinct digests with a slot each: levels of bits, each key at the first level where it is alone."""

    def __init__(self, d1: np.ndarray, d2: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []
        left, slots, used = np.arange(len(d1)), np.zeros(len(d1), np.int64), 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("digests are not distinct")
            size = int(len(left) * ROOM) + 1
            at = self.place(d1[left], d2[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            rank = np.where(alone, used + np.cumsum(alone) - 1, -1)
            self.levels.append((size, rank))
            slots[left] = rank[at]
            used += int(alone.sum())
            left = left[rank[at] < 0]
        self.slots = slots
        self.d1, self.d2 = np.empty_like(d1), np.empty_like(d2)
        self.d1[slots], self.d2[slots] = d1, d2

    @staticmethod
    def place(d1: np.ndarray, d2: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(d1 ^ mix(d2 + np.uint64(level))) % np.uint64(size)).astype(np.int64)

    def find(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Slots of digests; -1 for those that the table does not hold."""
        found, left = np.full(len(d1), -1), np.arange(len(d1))
        for level, (size, rank) in enumerate(self.levels):
            slot = rank[self.place(d1[left], d2[left], level, size)]
            hit = slot >= 0
            at, here = slot[hit], left[hit]
            same = (self.d1[at] == d1[here]) & (self.d2[at] == d2[here])
            found[here[same]] = at[same]
            left = left[~hit]
        return found


def accumulate(nodes: pa.Table) -> pa.Table:
    """Children, leaves and saved tokens of the nodes of one shard, and their parent's conv_id if it is here.

    ``children``, ``leaves``, ``saved`` of the input come from subtrees outside the shard.
    """
    column = lambda c: nodes.column(c).to_numpy().astype(np.int64)
    digest = lambda c: column(c).view(np.uint64)
    table = SlotTable(digest("d1"), digest("d2"))
    slot = table.slots
    flat = {}
    for c in ("conv_id", "depth", "n_convs", "words", "children", "leaves", "saved"):
        flat[c] = np.empty(len(slot), np.int64)
        flat[c][slot] = column(c)
    parent = np.empty(len(slot), np.int64)
    parent[slot] = table.find(digest("p1"), digest("p2"))
    parent[flat["depth"] == 0] = -1  # the root's own digest stands in for its parent
    inner = parent >= 0
    flat["children"] += np.bincount(parent[inner], minlength=len(slot))
    flat["leaves"] += flat["children"] == 0
    flat["saved"] += (flat["n_convs"] - 1) * flat["words"]
    order = np.argsort(-flat["depth"], kind="stable")
    order = order[inner[order]]
    edges = np.flatnonzero(np.diff(flat["depth"][order])) + 1
    for level in np.split(order, edges):  # the deepest first
        for c in ("leaves", "saved"):
            np.add.at(flat[c], parent[level], flat[c][level])
    out = {c: nodes.column(c) for c in ("d1", "d2", "p1", "p2", "conv_id", "depth", "n_convs", "n_ends")}
    out |= {c: pa.array(flat[c][slot]) for c in ("children", "leaves", "saved")}
    above = np.where(inner, flat["conv_id"][np.maximum(parent, 0)], 0)
    out["parent_conv_id"] = pa.array(above[slot], mask=~inner[slot])
    return pa.table(out)


SUMMED = "d1 long, d2 long, p1 long, p2 long, conv_id long, depth long, n_convs long, n_ends long, children long, leaves long, saved long, parent_conv_id long"


def sent_up(rows: DataFrame) -> DataFrame:
    """(d1, d2, children, leaves, saved) for the parents of rows with p1, p2, leaves and saved."""
    return rows.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def shared_nodes(members: DataFrame, nodes: DataFrame, root: DataFrame, twigs: DataFrame, shard_turns: int) -> DataFrame:
    """Nodes of several conversations and the root, as ``SUMMED`` has them."""
    shared = nodes.where("n_convs > 1")
    heavy = stored(shared.where(F.col("turns") > shard_turns).select("d1", "d2"))
    # How far down each conversation's path is heavy; one step below begins the subtree that stays whole.
    reach = members.join(heavy, ["d1", "d2"]).groupBy("conv_id").agg(F.max("depth").alias("reach"))
    anchors = members.join(reach, "conv_id", "left").where(F.col("depth") == F.coalesce("reach", F.lit(0)) + 1).select("conv_id", F.col("d1").alias("anchor"))
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    shards = max(1, -(-total // shard_turns))
    light = shared.where(F.col("turns") <= shard_turns).join(anchors, "conv_id").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    node = [c.split()[0] for c in NODE.split(", ")]
    sums = ["children", "leaves", "saved"]
    light = light.select("shard", *node).join(sent_up(twigs), ["d1", "d2"], "left").fillna(0, sums)
    below = stored(light.groupBy("shard").applyInArrow(lambda t: accumulate(t), SUMMED))

    top = shared.where(F.col("turns") > shard_turns).select(node).union(root.select(node))
    outside = below.where("parent_conv_id is null").select("p1", "p2", "leaves", "saved").union(twigs.select("p1", "p2", "leaves", "saved"))
    top = top.join(sent_up(outside), ["d1", "d2"], "left").fillna(0, sums).withColumn("shard", F.lit(0))
    return stored(below.union(top.groupBy("shard").applyInArrow(lambda t: accumulate(t), SUMMED)))


def ends_hashes(ends: DataFrame, wanted: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256) of the ``wanted`` nodes: ids in order, a row of at most ``ENDS`` ids at a time."""
    chunk = F.floor(F.col("conv_id") / F.lit(ENDS)).alias("chunk")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    rows = ends.groupBy("d1", "d2", chunk).agg(ids.alias("ids")).join(wanted, ["d1", "d2"], "left_semi")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        done: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], ["d1", "d2", "ends_sha256"])

        for batch in batches:
            for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids")), strict=True):
                if (d1, d2) != key:
                    if key:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (d1, d2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield batch_of(done)
            done = []
        if key:
            yield batch_of([(*key, digest.hexdigest())])

    ordered = rows.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "chunk")
    return ordered.select("d1", "d2", "ids").mapInArrow(hashed, "d1 long, d2 long, ends_sha256 string")


def prefix_trie(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), a row per node."""
    placed = placed_turns(turn_sums(rows))
    convs = stored(rebuilt(placed))
    members = stored(member_turns(placed, convs))
    drop_stored(placed)
    count, smallest, turnless = convs.agg(F.count(F.lit(1)), F.min("conv_id"), F.count_if(F.col("len") == 0)).first()
    same = {c: F.min(c).alias(c) for c in ("p1", "p2", "depth", "words", "conv_id")}
    nodes = members.groupBy("d1", "d2").agg(*same.values(), F.count(F.lit(1)).alias("n_convs"), F.count_if(F.col("depth") == F.col("len")).alias("n_ends"), F.sum("len").alias("turns"))
    nodes = stored(nodes)
    zero = F.lit(0).cast("long")
    root = convs.where(F.col("conv_id") == F.lit(smallest)).select(
        *[zero.alias(c) for c in ("d1", "d2", "p1", "p2")], "conv_id", zero.alias("depth"), F.lit(count).cast("long").alias("n_convs"), zero.alias("words"), F.lit(turnless).cast("long").alias("n_ends")
    )
    # Where a conversation leaves the last node that it shares; from there on it is alone.
    alone = nodes.where("n_convs = 1")
    twigs = alone.groupBy("conv_id").agg(F.min_by(F.struct("p1", "p2"), "depth").alias("p"), F.min("depth").alias("depth"))
    twigs = stored(twigs.select("conv_id", "depth", "p.p1", "p.p2", F.lit(1).cast("long").alias("leaves"), zero.alias("saved")))
    shared = shared_nodes(members, nodes, root, twigs, shard_turns)

    ends = members.where("depth = len").select("d1", "d2", "conv_id").union(convs.where("len = 0").select(zero, zero, "conv_id"))
    hashes = stored(ends_hashes(ends, shared.where("n_ends > 0").select("d1", "d2")))
    nothing = F.sha2(F.lit(""), 256)
    named = shared.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("above"))

    def under(df: DataFrame) -> Column:
        """The parent's conv_id after a join with ``named``; all of the many nodes under the root know theirs."""
        return F.when(F.col("depth") == 1, F.lit(smallest)).otherwise(F.col("above")).cast("long").alias("parent_conv_id")

    not_root = lambda df: df.withColumns({c: F.when(F.col("depth") > 1, F.col(c)) for c in ("p1", "p2")}).join(named, ["p1", "p2"], "left")
    figures = ["conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens")]
    inside = shared.where("parent_conv_id is not null or depth = 0")
    borders = not_root(shared.where("parent_conv_id is null and depth > 0").drop("parent_conv_id"))
    borders = borders.withColumn("parent_conv_id", under(borders)).select(inside.columns)
    several = inside.union(borders).join(hashes, ["d1", "d2"], "left").select(*figures, F.coalesce("ends_sha256", nothing).alias("ends_sha256"))

    above_twigs = not_root(twigs)
    first = above_twigs.select("conv_id", F.col("depth").alias("leaves_at"), under(above_twigs).alias("from"))
    single = alone.join(first, "conv_id").select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("leaves_at"), F.col("from")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        (1 - F.col("n_ends")).alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.when(F.col("n_ends") > 0, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(nothing).alias("ends_sha256"),
    )
    return several.union(single)
