"""Removal of repeated byte strings: suffix arrays of shards by external induced sorting.

A byte goes if some string of ``length`` bytes over it also starts elsewhere. Sorting every suffix of a
corpus is not needed to know that. Each window of ``length`` bytes has an anchor, the least hash of its
strings of ``ANCHOR`` bytes, so equal windows have equal anchors at the same place. Windows in a row
with one anchor form a segment, about 80 windows. Three cases follow, and together they are exact:

1. an anchor that occurs once: none of its windows is repeated;
2. a segment that occurs as a whole elsewhere: all of its windows are repeated;
3. an anchor in different segments: those that share the left or right half of a window with another
   one, each content once, go to a shard by their anchor. The shard is suffix-sorted
   (``induced_sort``), and neighbours in the suffix array that share ``length`` bytes are repeated
   windows. Equal windows have equal anchors, so they meet in one shard.

Contents are told apart by 128 bits of hash in steps 1 and 2, by their bytes in step 3.

Defined results: a null text is empty and keeps nothing and loses nothing; repeated rows count as
occurrences; rows without doc_id are handled like others; overlaps count; an empty table gives no
rows; columns besides doc_id and text are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.hashing import Powers, hashes_between, hashes_of_width, mix, running_sums
from orderlens.llm.induced_sort import suffix_order
from orderlens.llm.tables import drop_stored, in_slices, stored

LENGTH = 200
ANCHOR = 24
#: Bytes before the anchor that make the left half of a window; the right half is the rest.
LEFT = 88
#: Characters of texts that are cut at once, one text at least: many short texts cost one round of array operations.
CUT_CHARS = 1 << 16
#: Bytes of segments that one suffix array is built over.
SHARD_BYTES = 4 << 20


def sliding_minimum(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: block minima from the left and from the right."""
    n = len(key) - width + 1
    padded = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, anchor hash, two hashes, hashes of the halves) of each run of windows with one anchor.

    A window over the anchor holds the ``LEFT`` bytes before it or the rest of ``length`` from it on.
    Each half is told by 32 bits, 0 where no window of the run holds it. The texts lie end to end here, and
    no window runs over an end; hashes do not depend on the place.
    """
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    begins = np.concatenate([[0], ends[:-1]])
    if len(raw) < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, *4 * [np.uint64]))
    sums = running_sums(raw, powers)
    anchors = hashes_of_width(sums, ANCHOR, powers)
    # Order by 32 bits of hash, then by place: the same in equal windows wherever they stand.
    key = (anchors & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(anchors), dtype=np.uint64)
    place = (sliding_minimum(key, length - ANCHOR + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.ones(len(place), bool)
    for begin, end in zip(begins.tolist(), ends.tolist(), strict=True):
        inside[max(begin, end - length + 1) : end] = False
    windows = np.flatnonzero(inside)
    if not len(windows):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, *4 * [np.uint64]))
    place = place[windows]
    # A text's windows are in a row, and those of another text have other anchors.
    start = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    first, last = windows[start], windows[np.append(start[1:], len(place)) - 1]
    middle, right = place[start], length - LEFT
    before, after = middle - first >= LEFT, last + length - middle >= right
    one = np.uint64(1)
    left_hash = hashes_between(sums, np.where(before, middle - LEFT, 0), np.where(before, middle, 0), powers) >> np.uint64(32)
    right_hash = hashes_between(sums, np.where(after, middle, 0), np.where(after, middle + right, 0), powers) >> np.uint64(32)
    halves = (np.where(before, left_hash | one, np.uint64(0)) << np.uint64(32)) | np.where(after, right_hash | one, np.uint64(0))
    content = hashes_between(sums, first, last + length, powers)
    other = hashes_between(running_sums(raw ^ np.uint8(0x5A), powers), first, last + length, powers)
    text = np.searchsorted(begins, first, side="right") - 1
    return text, first - begins[text], last - begins[text], anchors[middle], content, other, halves


def segment_rows(docs: DataFrame, length: int) -> DataFrame:
    """(row, anchor, content1, content2, halves, first, last) of every segment of every text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            rows, texts = batch.column("row").to_numpy(), [t or "" for t in batch.column("text").to_pylist()]
            for low, high in in_slices(texts, CUT_CHARS):
                text, first, last, anchor, content, other, halves = segments([t.encode() for t in texts[low:high]], length, powers)
                if len(first):
                    columns = [pa.array(rows[low:high][text]), *(pa.array(mix(x).view(np.int64)) for x in (anchor, content, other)), pa.array(halves.view(np.int64))]
                    columns += [pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "anchor", "content1", "content2", "halves", "first", "last"])

    return docs.mapInArrow(cut, "row long, anchor long, content1 long, content2 long, halves long, first int, last int")


def segment_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (row, anchor, n, first, last) with the bytes of each segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, parts in zip(*(batch.column(c).to_pylist() for c in ("row", "text", "parts")), strict=True):
                raw = text.encode()
                columns = [pa.array([row] * len(parts), pa.int64()), pa.array([p["anchor"] for p in parts], pa.int64())]
                columns += [pa.array([p[c] for p in parts], pa.int64()) for c in ("n", "first", "last")]
                columns.append(pa.array([raw[p["first"] : p["last"] + length] for p in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["row", "anchor", "n", "first", "last", "bytes"])

    # The segments of one text: as many as its length allows.
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("anchor", "n", "first", "last")).alias("parts"))
    return docs.join(lists, "row").select("row", "text", "parts").mapInArrow(cut, "row long, anchor long, n long, first long, last long, bytes binary")


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """Starts of the windows of each part that also start elsewhere in the parts."""
    sizes = np.array([len(p) for p in parts], np.int64)
    text = np.frombuffer(b"\0".join(parts) + b"\0\0", np.uint8).astype(np.int16)
    text += 2
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text[starts[1:] - 1] = 1  # between parts: no window runs over it
    text[-2], text[-1] = 1, 0
    # Dense symbols, a byte each if there are at most 256 of them, as in every UTF-8 text.
    used = np.bincount(text) > 0
    text = (np.cumsum(used) - 1).astype(np.uint8 if used.sum() <= 256 else np.int16)[text]
    order, shared = suffix_order(text, length)
    hit = np.flatnonzero(shared >= length)
    found = np.unique(np.concatenate([order[hit], order[hit - 1]]))
    owner = np.searchsorted(starts, found, side="right") - 1
    inside = found + length <= starts[owner] + sizes[owner]
    found, owner = found[inside], owner[inside]
    bounds = np.searchsorted(owner, np.arange(len(parts) + 1))
    return [found[a:b] - s for a, b, s in zip(bounds[:-1], bounds[1:], starts, strict=True)]


def runs(places: np.ndarray) -> Iterator[tuple[int, int]]:
    """(first, last) of each run of consecutive numbers."""
    if len(places):
        cut = np.flatnonzero(np.diff(places) > 1)
        yield from zip(places[np.append(0, cut + 1)].tolist(), places[np.append(cut, len(places) - 1)].tolist(), strict=True)


def mixed_windows(parts: DataFrame, length: int, shards: int) -> DataFrame:
    """(row, first, last): runs of repeated windows of segments whose content occurs once."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, shard = [], 0, None

        def flush() -> pa.RecordBatch:
            out = []
            for (row, n, first), places in zip([h[:3] for h in held], repeated_windows([h[3] for h in held], length), strict=True):
                if n == 1:
                    out += [(row, first + a, first + b) for a, b in runs(places)]
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(3)], ["row", "first", "last"])

        for batch in batches:
            for one, row, n, first, raw in zip(*(batch.column(c).to_pylist() for c in ("anchor", "row", "n", "first", "bytes")), strict=True):
                # Rows come by anchor: a shard may end between two anchors, never within one.
                if one != shard and size >= SHARD_BYTES:
                    yield flush()
                    held, size = [], 0
                shard, size = one, size + len(raw)
                held.append((row, n, first, raw))
        if held:
            yield flush()

    dealt = parts.repartition(shards, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(sort, "row long, first long, last long")


def sharing_a_half(mixed: DataFrame) -> DataFrame:
    """The segments that have half a window in common with another one of their anchor; others repeat nothing."""
    left, right = F.shiftrightunsigned("halves", 32), F.col("halves").bitwiseAND(F.lit(0xFFFFFFFF))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), left.alias("half")), F.struct(F.lit(1).alias("side"), right.alias("half")))).alias("part")
    halves = mixed.select("row", "first", "anchor", sides).select("row", "first", "anchor", "part.*").where("half <> 0")
    common = halves.groupBy("anchor", "side", "half").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    kept = halves.join(common, ["anchor", "side", "half"]).select("row", "first").distinct()
    return mixed.join(kept, ["row", "first"]).drop("halves")


def repeats(docs: DataFrame, length: int) -> DataFrame:
    """(row, spans): ascending runs (first, last) of repeated windows of each text that has some."""
    found = stored(segment_rows(docs, length))
    by_content = found.groupBy("anchor", "content1", "content2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "first", "last", "halves")).alias("one"))
    contents = stored(by_content)
    anchors = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
    mixed = stored(contents.join(anchors.select("anchor"), "anchor").select("anchor", "n", "one.*"))
    parts = stored(segment_bytes(docs, sharing_a_half(mixed), length))
    # A segment is a third longer than ``length`` on average.
    shards = 1 + parts.count() * length * 4 // 3 // (4 * SHARD_BYTES)
    odd = mixed_windows(parts, length, shards)
    whole = contents.where("n > 1").select("anchor", "content1", "content2")
    even = found.join(whole, ["anchor", "content1", "content2"]).select("row", F.col("first").cast("long"), F.col("last").cast("long"))
    spans = stored(even.union(odd).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans")))
    for table in (found, contents, mixed, parts):
        drop_stored(table)
    return spans


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each text's bytes without those that repeat."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("row", F.xxhash64("doc_id", "text", F.lit(length)))
    spans = repeats(rows, length)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw = (text or "").encode()
                merged: list[list[int]] = []
                for part in parts or []:
                    if merged and part["first"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], part["last"] + length)
                    else:
                        merged.append([part["first"], part["last"] + length])
                edges = [0, *(e for pair in merged for e in pair), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(raw), len(raw) - len(kept), len(merged), kept))
            columns = [batch.column("doc_id"), *(pa.array([o[k] for o in out], pa.int64()) for k in range(3)), pa.array([o[3] for o in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(spans, "row", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def suffix_digest(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
