"""Exact self-join of word n-gram sets by Jaccard similarity, with a token-group matrix.

Equal sets are one. The distinct sets are partitioned into groups of similar ones, the matrix keeps
the union of the (prefix) tokens of every group, and the overlap of a set with a group's union bounds
its overlap with each member, so only groups that reach the bound are opened. In a fixed order of all
tokens two similar sets share ``SHARED`` tokens within their prefixes (prefix filter), so the matrix
holds prefixes only. The order goes by the number of rows that have a token, counted over all rows, so a
passage of many documents is last and stays out of their prefixes.

1. Sets that share a rare token with the smallest id that has it are tested against such an id; what
   is linked forms the groups (connected components of the tested links).
2. Set x qualifies for another group if its prefix meets the group's union often enough.
3. Opened groups compare x with their members, in blocks, through parity sketches, whose
   Hamming distance never exceeds the symmetric difference; the few pairs left are counted exactly.

No link between different sets is lost: it is within a group, or qualifies in step 2 and passes the
sketch bound in step 3. Links within a group need no test, as only components are asked for.

Defined results: null or wordless text has an empty set and is its own component; fewer words than
``n`` form one n-gram; repeated rows with one doc_id are linked by the id; rows without doc_id are
single; an empty table gives no rows; columns besides doc_id and text are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.components import components
from orderlens.llm.hashing import Powers, mix, window_hashes
from orderlens.llm.tables import drop_stored, in_slices, stored

#: Rows that have a token, from which on it is ordered by their number; rarer ones go first, by hash.
COMMON_FROM = 16
#: Characters of a block of rows, and of the texts for each group of tokens that is counted at once.
BLOCK_CHARS, BUCKET_CHARS = 1 << 23, 1 << 23
#: Prefix tokens that a set must share with a group's union.
SHARED = 3
#: Members of a group, and queries to it, that one task compares; a hash deals them, so about as many.
BLOCK = 4096
SKETCH_BITS = 512

#: Characters whose shingles are made at once: their arrays stay in the processor's cache.
SLICE_CHARS = 1 << 19

FOLD = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a plain sort is much faster here than ``np.unique``."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def gram_sets(texts: list[str], n: int, powers: Powers) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text, n-grams of words in lower case (A-Z)."""
    coded = [t.encode() for t in texts]
    raw = np.frombuffer(b" ".join([*coded, b""]).translate(FOLD), np.uint8)
    # 0x09 to 0x0D in one comparison, as smaller bytes wrap around.
    blank = (raw - np.uint8(9) < 5) | (raw == 0x20)
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    starts, ends = edges[::2], edges[1::2]
    words = window_hashes(raw, starts, ends, powers)
    bounds = np.cumsum([0, *(len(c) + 1 for c in coded)])
    first = np.searchsorted(starts, bounds)
    out = []
    grams = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n if len(grams) else 0):
        grams = mix(grams ^ words[k : k + len(grams)]) + np.uint64(k + 1)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            out.append(distinct(grams[a : b - n + 1]))
        elif b > a:
            few = np.full(1, b - a, np.uint64)
            for word in words[a:b]:
                few = mix(few ^ word) * np.uint64(3)
            out.append(few)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def text_slices(columns: list[pa.Array], most_chars: int) -> Iterator[tuple[int, int]]:
    """``in_slices`` by the rows' characters in all columns of texts, before any of them is a Python string."""
    sizes = sum(pc.fill_null(pc.utf8_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends, low = np.cumsum(sizes), 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most_chars, "right")))
        yield low, high
        low = high


def sets_of(texts: pa.Array | pa.ChunkedArray, n: int, powers: Powers) -> Iterator[np.ndarray]:
    """The n-gram set of each text, made a slice of texts at a time; only that slice is Python strings."""
    for low, high in text_slices([texts], SLICE_CHARS):
        yield from gram_sets([t or "" for t in texts.slice(low, high - low).to_pylist()], n, powers)


def prefix_size(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + SHARED)


def rarest(u: np.ndarray, place: np.ndarray, spread: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` tokens by place, those of one place by spread, in no order of their own."""
    first = np.flatnonzero(place == 0)
    if k < len(first):
        return u[first[np.argpartition(spread[first], k)[:k]]]
    return u[np.lexsort((spread, place))[:k]]


def blocks(docs: DataFrame) -> DataFrame:
    """(blk, doc_id, text), stored: rows of about ``BLOCK_CHARS`` characters share a block number."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blk = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).cumsum()
            own = blk + (sizes - 1) // BLOCK_CHARS
            blk = int(own[-1]) + 1 if len(own) else blk
            yield pa.RecordBatch.from_arrays([pa.array(own), batch.column("doc_id"), batch.column("text")], ["blk", "doc_id", "text"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(numbered, "blk long, doc_id long, text string"))


def unpacked(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def token_counts(texts: pa.Array, n: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, rows that have each) of the texts."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *sets_of(texts, n, powers)]), return_counts=True)


def dealt(batches: Iterator[pa.RecordBatch], n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """The tokens of each block in packed lists, by the bucket that counts them; the sets of one block are made at a time."""
    powers = Powers()
    for batch in batches:
        texts, blks = batch.column("text"), batch.column("blk").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(blks)) + 1), len(blks)]
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            token, held = token_counts(texts.slice(a, b - a), n, powers)
            if not len(token):
                continue
            bucket = (mix(token) % np.uint64(buckets)).astype(np.int64)
            # Two bytes are sorted by counting, much faster than eight.
            order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
            here, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:], len(order)]
            rows += [(bucket, blks[a], token[order[i:j]].tobytes(), held[order[i:j]].astype(np.uint16 if held.max() < 1 << 16 else np.int64).tobytes()) for bucket, i, j in zip(here, starts, ends, strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "blk", "tokens", "counts"])


def common_tokens(texts: DataFrame, n: int) -> DataFrame:
    """(blk, tokens, counts): for every block its tokens that at least ``COMMON_FROM`` rows have, and in how many.

    Exact counts over all rows. Tokens go to the counting tasks in packed lists, summed within a batch, and
    only common ones come back, to the blocks that have them.
    """
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))

    def count(lists: pa.Table) -> pa.Table:
        tokens = unpacked(lists.column("tokens"))
        counts = [np.frombuffer(x, np.uint16 if len(x) == 2 * len(t) else np.int64) for x, t in zip(lists.column("counts").to_pylist(), tokens, strict=True)]
        _, at = np.unique(np.concatenate(tokens), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts)).astype(np.int64)[at]
        out: list[list] = [[], [], []]
        ends = np.cumsum([len(t) for t in tokens])
        for blk, token, own in zip(lists.column("blk").to_pylist(), tokens, np.split(n, ends[:-1]), strict=True):
            common = own >= COMMON_FROM
            if common.any():
                for part, values in zip(out, (blk, token[common].tobytes(), own[common].tobytes()), strict=True):
                    part.append(values)
        return pa.table({"blk": pa.array(out[0], pa.int64()), "tokens": pa.array(out[1], pa.binary()), "counts": pa.array(out[2], pa.binary())})

    lists = texts.select("blk", "text").mapInArrow(lambda batches: dealt(batches, n, buckets), "bucket long, blk long, tokens binary, counts binary")
    return lists.groupBy("bucket").applyInArrow(count, "blk long, tokens binary, counts binary")


def document_features(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, size, set_hash, sketch, prefix) per row, stored; 128 bits of hash tell sets apart, the prefix holds a set's rarest tokens."""
    texts = blocks(docs)
    common = stored(common_tokens(texts, n))

    def features(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.zeros(0, np.uint64), *unpacked(right.column("tokens"))])
        counts = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in right.column("counts").to_pylist())])
        tokens, first = np.unique(tokens, return_index=True)
        counts = counts[first]
        sizes, hashes, prefixes, sketches = [], [], [], []
        for u in sets_of(left.column("text"), n, Powers()):
            spread = mix(u)
            two = (np.bitwise_xor.reduce(spread) if len(u) else 0, np.add.reduce(mix(spread ^ np.uint64(7))) if len(u) else 0)
            hashes.append(np.array(two, np.uint64).tobytes())
            place = np.zeros(len(u), np.int64)
            if len(tokens):
                at = np.minimum(np.searchsorted(tokens, u), len(tokens) - 1)
                place = np.where(tokens[at] == u, counts[at], 0)
            prefixes.append(rarest(u, place, spread, prefix_size(len(u), percent)).view(np.int64))
            sizes.append(len(u))
            sketches.append(sketch(u))
        columns = [left.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(hashes, pa.binary()), pa.array(sketches, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
        return pa.Table.from_arrays(columns, ["doc_id", "size", "set_hash", "sketch", "prefix"])

    schema = "doc_id long, size long, set_hash binary, sketch binary, prefix array<long>"
    found = stored(texts.groupBy("blk").cogroup(common.groupBy("blk")).applyInArrow(features, schema))
    drop_stored(common)
    drop_stored(texts)
    return found


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens per hash class; twice as many classes for each doubling of a large set."""
    size = max(SKETCH_BITS, 1 << max(0, (len(tokens) // 2)).bit_length())
    bits = np.bincount((mix(tokens ^ np.uint64(99)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one per row) with fewer classes: halves are added up modulo two."""
    while sketches.shape[-1] > words:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def may_link(difference: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with this least symmetric difference and sum of sizes can be similar enough."""
    return (total - difference) * (100 + percent) >= 2 * percent * total


def sketch_filter(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, size_a, size_b, sketch_a, sketch_b) whose sketches allow a link, as (a, b)."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            difference = np.zeros(batch.num_rows, np.int64)
            for i, both in enumerate(zip(batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist(), strict=True)):
                x, y = (np.frombuffer(z, np.uint64) for z in both)
                words = min(len(x), len(y))
                difference[i] = np.bitwise_count(folded(x, words) ^ folded(y, words)).sum()
            yield batch.select(["a", "b"]).filter(pa.array(may_link(difference, total, percent)))

    return pairs.mapInArrow(keep, "a long, b long")


def similar(pairs: list[tuple[str, str]], n: int, percent: int, powers: Powers) -> Iterator[bool]:
    """Whether the sets of each pair of texts are similar enough; a text of several near pairs is cut into shingles once."""
    for low, high in in_slices([x + y for x, y in pairs], SLICE_CHARS):
        texts = list(dict.fromkeys(t for pair in pairs[low:high] for t in pair))
        sets = dict(zip(texts, gram_sets(texts, n, powers), strict=True))
        for x, y in ((sets[a], sets[b]) for a, b in pairs[low:high]):
            both = len(np.intersect1d(x, y, assume_unique=True))
            yield 100 * both >= percent * (len(x) + len(y) - both)


def similar_rows(left: pa.Array, right: pa.Array, n: int, percent: int, powers: Powers) -> Iterator[bool]:
    """``similar`` of the pairs of texts in two columns; only a slice of them is Python strings."""
    for low, high in text_slices([left, right], SLICE_CHARS):
        first, second = ([t or "" for t in c.slice(low, high - low).to_pylist()] for c in (left, right))
        yield from similar(list(zip(first, second, strict=True)), n, percent, powers)


def similar_pairs(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of document ids whose sets are similar enough, counted exactly."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()

    # Rows that repeat a doc_id are linked by it already; each of their texts stands for the id here.
    needed = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(stored(ids).withColumnRenamed("doc_id", "id"), "id", "left_semi")
    texts = stored(needed)
    left, right = (texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            keep = list(similar_rows(batch.column("text_a"), batch.column("text_b"), n, percent, powers))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # Few pairs share their second set, many their first one: it is joined last and never multiplied.
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(count, "a long, b long")


def open_groups(queries: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a query and a member of its group that sketches and sizes allow.

    ``queries`` has (grp, id, size, component, sketch), ``members`` also ``blocks``, the blocks of the
    group. Members of the query's own component need no link and are left out.
    A task holds one block of members and one block of queries, and compares in slices.
    """

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        def classes(t: pa.Table):
            """(ids, sizes, components, sketches) per length of sketch."""
            sketches = t.column("sketch").to_pylist()
            lengths = np.array([len(x) for x in sketches])
            ids, sizes, parts = (t.column(c).to_numpy() for c in ("id", "size", "component"))
            for n in np.unique(lengths):
                own = np.flatnonzero(lengths == n)
                yield ids[own], sizes[own], parts[own], np.frombuffer(b"".join(sketches[i] for i in own), np.uint64).reshape(len(own), -1)

        found = []
        members = list(classes(right))
        for a, size_a, part_a, sketch_a in classes(left):
            for b, size_b, part_b, sketch_b in members:
                words = min(sketch_a.shape[1], sketch_b.shape[1])
                x, y = folded(sketch_a, words), folded(sketch_b, words)
                step = max(1, (1 << 22) // (words * len(b)))
                for i in range(0, len(a), step):
                    difference = np.bitwise_count(x[i : i + step, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                    apart = part_a[i : i + step, None] != part_b[None, :]
                    p, q = np.nonzero(apart & may_link(difference, size_a[i : i + step, None] + size_b[None, :], percent))
                    found.append((a[i + p], b[q]))
        columns = [np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1)]
        return pa.table({"a": columns[0], "b": columns[1]})

    counts = members.select("grp", "blocks").distinct()
    counts = queries.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("slices")).join(counts, "grp")
    dealt_to = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    about = ["grp", "id", "size", "component", "sketch"]
    spread = queries.join(counts, "grp").select(*about, dealt_to("slices").alias("slice"), every("blocks").alias("block"))
    dealt = members.drop("blocks").join(counts, "grp").select(*about, every("slices").alias("slice"), dealt_to("blocks").alias("block"))
    by = ["grp", "slice", "block"]
    return spread.groupBy(*by).cogroup(dealt.groupBy(*by)).applyInArrow(compare, "a long, b long")


def group_parts(grouped: DataFrame) -> DataFrame:
    """(grp, blocks, main, apart): blocks of members, largest component, whether there are others."""
    sizes = grouped.groupBy("grp", "component").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy("grp").agg(
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"),
        F.max_by("component", F.struct("n", -F.col("component"))).alias("main"),
        (F.count(F.lit(1)) > 1).alias("apart"),
    )


def own_queries(grouped: DataFrame, parts: DataFrame) -> DataFrame:
    """Members that their own group is opened for: those outside its largest component.

    A link that is missing within a group joins two components, so one end of it is among them.
    """
    return grouped.join(parts.where("apart").select("grp", "main"), "grp").where("component <> main")


def document_components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id): links join sets with ``100 * both >= percent * any``."""
    features = document_features(docs, n, percent)
    some = features.where("size > 0 and doc_id is not null")
    sets = some.groupBy("set_hash").agg(
        F.min("doc_id").alias("id"), F.min_by("size", "doc_id").alias("size"), F.min_by("sketch", "doc_id").alias("sketch"), F.min_by("prefix", "doc_id").alias("prefix")
    )
    sets = stored(sets.drop("set_hash"))
    rows = sets.select("id", F.explode("prefix").alias("token"))
    leaders = rows.groupBy("token").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Only tokens of several sets can make candidates; most prefix tokens are of one set.
    shared = stored(rows.join(leaders, "token"))
    stars = shared.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    side = [sets.select(F.col("id").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "ab"]
    tested = sketch_filter(stars.join(side[0], "a").join(side[1], "b"), percent)
    # One test per set is enough to form groups; what it leaves apart is found by steps 2 and 3.
    tested = tested.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    first_links = stored(similar_pairs(stored(tested), docs, n, percent))
    linked = components(first_links)

    # Groups of similar sets: each set goes with the leader it shares most rare tokens with, and a
    # leader's own leader takes both in, so that a family of near copies is one group.
    ties = shared.groupBy("id", "leader").agg(F.count(F.lit(1)).alias("ties")).where((F.col("ties") >= SHARED) & (F.col("id") != F.col("leader")))
    nearest = ties.groupBy("id").agg(F.max_by("leader", F.struct("ties", -F.col("leader"))).alias("leader"))
    nearest = components(nearest.select(F.col("id").alias("a"), F.col("leader").alias("b"))).withColumnRenamed("component", "grp")
    grouped = sets.drop("prefix").join(linked, "id", "left").join(nearest, "id", "left")
    grouped = stored(grouped.withColumns({c: F.coalesce(c, "id") for c in ("component", "grp")}))
    # Token-group matrix: the union of the members' prefixes, a row per (token, group).
    tokens = stored(shared.select("id", "token").join(grouped.select("id", "grp"), "id"))
    matrix = tokens.select("token", F.col("grp").alias("other")).distinct()
    meets = tokens.join(matrix, "token").where("grp <> other")
    overlap = meets.groupBy("id", F.col("other").alias("grp")).agg(F.count(F.lit(1)).alias("overlap"))
    need = F.least(F.lit(SHARED), F.ceil(F.col("size") * percent / 100))
    about = ["grp", "id", "size", "component", "sketch"]
    others = overlap.join(grouped.drop("grp"), "id").where(F.col("overlap") >= need).select(about)
    parts = group_parts(grouped)
    queries = stored(others.union(own_queries(grouped, parts).select(about)))
    members = grouped.join(parts.select("grp", "blocks"), "grp").join(queries.select("grp").distinct(), "grp", "left_semi").select(*about, "blocks")
    opened = open_groups(queries, members, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stored(first_links.union(similar_pairs(stored(opened), docs, n, percent)))
    merged = components(links)

    # Back to documents: set -> component, then documents of one id in several sets.
    of_set = sets.select("id").join(merged, "id", "left").select("id", F.coalesce("component", "id").alias("component_id")).distinct()
    firsts = some.groupBy("set_hash").agg(F.min("doc_id").alias("id")).join(of_set, "id").select("set_hash", "component_id")
    return features.join(firsts, "set_hash", "left").select(
        "doc_id", F.col("size").alias("n_shingles"), F.when((F.col("size") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )
