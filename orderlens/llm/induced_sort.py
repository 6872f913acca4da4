"""Suffix order and common-prefix lengths of one shard by induced sorting with disk-backed queues.

Suffixes are sorted from few: those that begin a leftmost smaller-type run (LMS). Substrings between
two of them are sorted by induction and named, and the string of names is solved recursively (by doubling once buckets are small). From the
sorted LMS suffixes all larger-type suffixes follow in one ascending scan of the buckets (one per first
symbol), all smaller-type ones in one descending scan. Each queue of a bucket receives suffixes in
their final order as tuples (position, prefix shared with the one before it); a scan takes whole
batches, so the work per suffix is a few array operations.

A suffix that is induced shares one symbol more with the one induced before it into the same queue
than the least prefix shared between their two sources in scan order. These minima are carried along
per symbol, so common prefixes come out of the induction itself, cut off at ``most``. Only where the
larger-type part of a bucket meets the smaller-type part are the two suffixes compared directly, and
so are neighbours among the sorted LMS suffixes.

Queues beyond ``MEMORY`` bytes go to temporary files of the task, which vanish with it, like the spill
files of a shuffle. The text of a shard and its final order stay in memory.
"""

import tempfile
from collections.abc import Iterator

import numpy as np

#: Bytes that the queues of one scan keep in memory before they go to disk.
MEMORY = 64 << 20
#: Suffixes in one batch of a scan.
BATCH = 1 << 18
#: Names beyond this leave few suffixes to a bucket; they are ordered by doubling instead of a scan.
MOST_BUCKETS = 1024


class Store:
    """Memory that the queues of one scan share."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.used = memory, 0


class Queue:
    """First in, first out, of (position, prefix) arrays; the oldest parts may lie in a file."""

    def __init__(self, store: Store):
        self.store, self.file, self.on_disk, self.parts = store, None, [], []

    def push(self, position: np.ndarray, prefix: np.ndarray) -> None:
        self.parts.append((position, prefix))
        self.store.used += position.nbytes + prefix.nbytes
        if self.store.used > self.store.memory:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for position, prefix in self.parts:
            self.store.used -= position.nbytes + prefix.nbytes
            self.file.write(position.tobytes() + prefix.tobytes())
            self.on_disk.append(len(position))
        self.parts = []

    def batches(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All parts so far, oldest first, in batches; what is pushed meanwhile is for the next call."""
        file, on_disk, parts = self.file, self.on_disk, self.parts
        self.file, self.on_disk, self.parts = None, [], []
        self.store.used -= sum(a.nbytes + b.nbytes for a, b in parts)
        if file is not None:
            file.seek(0)
            for n in on_disk:
                yield np.frombuffer(file.read(8 * n), np.int64), np.frombuffer(file.read(4 * n), np.int32)
            file.close()
        if parts:
            position, prefix = (np.concatenate(x) for x in zip(*parts, strict=True))
            for at in range(0, len(position), BATCH):
                yield position[at : at + BATCH], prefix[at : at + BATCH]


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low:high]) for each pair, low < high, by a table of minima over powers of two."""
    size = high - low
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(low), values.dtype)
    table, width = values, 1
    for k in range(int(level.max()) + 1 if len(level) else 0):
        own = level == k
        out[own] = np.minimum(table[low[own]], table[high[own] - width])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


class Induction:
    """One scan: sources in order, pushed into the queue of the symbol before them."""

    def __init__(self, text: np.ndarray, symbols: int, most: int, store: Store):
        self.text, self.most = text, most
        self.queues = [Queue(store) for _ in range(symbols)]
        # Least shared prefix among the sources since the last one that went to each symbol.
        self.least = np.full(symbols, -1, np.int64)

    def induce(self, position: np.ndarray, prefix: np.ndarray, wanted: np.ndarray) -> None:
        """Push the predecessors of sources (in scan order) that are ``wanted``, by their symbol."""
        if not len(position):
            return
        whole = int(prefix.min())
        carried = self.least
        self.least = np.where(carried >= 0, np.minimum(carried, whole), carried)
        take = np.flatnonzero(wanted)
        if not len(take):
            return
        before = position[take] - 1
        symbol = self.text[before]
        order = np.argsort(symbol, kind="stable")
        take, before, symbol = take[order], before[order], symbol[order].astype(np.int64)
        first = np.concatenate([[True], symbol[1:] != symbol[:-1]])
        starts = np.flatnonzero(first)
        stops = np.append(starts[1:], len(symbol))
        if not self.most:
            # Only the order is asked for.
            for a, b in zip(starts, stops, strict=True):
                self.queues[symbol[a]].push(before[a:b], np.zeros(b - a, np.int32))
            return
        # Between two sources of one symbol: the prefixes after the former, up to the latter.
        low = np.where(first, 0, np.concatenate([[0], take[:-1] + 1]))
        shared = range_minima(prefix, low, take + 1).astype(np.int64)
        # The first one of a symbol also counts what was scanned in earlier batches; -1: it is the first of all.
        shared = np.where(first, np.minimum(shared, carried[symbol]), shared)
        shared = np.minimum(shared + 1, self.most).astype(np.int32)
        ends = take[stops - 1]
        tail = np.full(len(ends), self.most, np.int64)
        more = ends + 1 < len(prefix)
        if more.any():
            tail[more] = range_minima(prefix, ends[more] + 1, np.full(int(more.sum()), len(prefix)))
        self.least[symbol[starts]] = tail
        for a, b in zip(starts, stops, strict=True):
            self.queues[symbol[a]].push(before[a:b], shared[a:b])


def packed(text: np.ndarray) -> tuple[np.ndarray, int]:
    """(numbers, symbols in each): eight symbols from each position on, or one if they need over a byte."""
    if text.max() > 255:
        return text.astype(np.uint64), 1
    padded = np.concatenate([text.astype(np.uint8), np.zeros(7, np.uint8)])
    return np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view("<u8").ravel(), 8


def compare(packed_text: tuple[np.ndarray, int], a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, at most ``most``, several symbols at a time.

    Suffixes differ before the end of the text, as its last symbol is unique.
    """
    words, width = packed_text
    shared = np.full(len(a), most, np.int32)
    alive = np.arange(len(a))
    for k in range(0, most, width):
        x, y = a[alive] + k, b[alive] + k
        differ = words[np.minimum(x, len(words) - 1)] ^ words[np.minimum(y, len(words) - 1)]
        ends = np.flatnonzero(differ)
        # Bits below the lowest differing one, in whole symbols.
        low = np.bitwise_count((differ[ends] & (~differ[ends] + np.uint64(1))) - np.uint64(1)) // 8 if width == 8 else 0
        shared[alive[ends]] = np.minimum(k + low, most)
        alive = alive[differ == 0]
        if not len(alive):
            break
    return shared


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last symbol is the unique least."""
    rises, differs = (np.append(x, True) for x in (text[1:] > text[:-1], text[1:] != text[:-1]))
    kind = np.int32 if len(text) < 1 << 31 else np.int64
    place = np.where(differs, np.arange(len(text), dtype=kind), kind(len(text) - 1))
    smaller = rises[np.minimum.accumulate(place[::-1])[::-1]]
    smaller[-1] = True
    return smaller


def scan(text: np.ndarray, words: tuple[np.ndarray, int], symbols: int, smaller: np.ndarray, seeds: np.ndarray, shared: np.ndarray, most: int):
    """All suffixes from the sorted LMS suffixes: (positions, prefixes shared with the one before)."""
    n = len(text)
    store = Store()
    up = Induction(text, symbols, most, store)
    heads = text[seeds]
    bounds = np.searchsorted(heads, np.arange(symbols + 1))
    larger_parts: list[Queue] = [Queue(store) for _ in range(symbols)]

    def after_break(prefix: np.ndarray, broken: bool) -> np.ndarray:
        """The first suffix of a bucket shares nothing with the one scanned before it."""
        if broken:
            prefix = prefix.copy()
            prefix[0] = 0
        return prefix

    for c in range(symbols):
        # Larger-type suffixes of this bucket, in order, until no run of c adds more.
        fresh, any_before, latest = True, False, None
        while fresh:
            fresh = False
            for position, prefix in up.queues[c].batches():
                fresh, latest = True, position[-1:]
                larger_parts[c].push(position, prefix)
                prefix, any_before = after_break(prefix, not any_before), True
                up.induce(position, prefix, (position > 0) & (text[position - 1] >= c) & ~smaller[position - 1])
        a, b = bounds[c], bounds[c + 1]
        for at in range(a, b, BATCH):
            position, prefix = seeds[at : min(b, at + BATCH)], shared[at : min(b, at + BATCH)].copy()
            if at == a:
                prefix[0] = 0 if latest is None else compare(words, latest, position[:1], most)[0]
            up.induce(position, prefix, (position > 0) & (text[position - 1] > c))
    # Descending: the queue of a bucket holds its suffixes from the greatest down, each with the
    # prefix it shares with the next greater one.
    down = Induction(text, symbols, most, store)
    down.queues[0].push(np.array([n - 1]), np.zeros(1, np.int32))
    ordered: list[tuple[np.ndarray, np.ndarray]] = []
    for c in range(symbols - 1, -1, -1):
        greater: list[tuple[np.ndarray, np.ndarray]] = []
        fresh, any_before = True, False
        while fresh:
            fresh = False
            for position, prefix in down.queues[c].batches():
                fresh = True
                greater.append((position, prefix))
                prefix, any_before = after_break(prefix, not any_before), True
                down.induce(position, prefix, (position > 0) & (text[position - 1] <= c) & smaller[position - 1])
        lower = [*larger_parts[c].batches()]
        low_position, low_prefix = (np.concatenate(x) for x in zip(*lower, strict=True)) if lower else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        high_position, high_prefix = (np.concatenate(x) for x in zip(*greater, strict=True)) if greater else (np.zeros(0, np.int64), np.zeros(0, np.int32))
        if len(low_position):
            # Going down, a suffix shares with the one above what that one shares with it going up.
            shared_down = np.append(low_prefix[1:], np.int32(0))[::-1].copy()
            if len(high_position):
                shared_down[0] = compare(words, low_position[-1:], high_position[-1:], most)[0]
            position = low_position[::-1]
            down.induce(position, shared_down, (position > 0) & (text[position - 1] < c))
        # Final order of the bucket: larger types, then smaller types from the least up.
        up_position, up_prefix = high_position[::-1], np.append(high_prefix[:0], high_prefix[1:][::-1])
        if len(up_position):
            up_prefix = np.append(np.int32(0), up_prefix)
        if len(low_position) and len(up_position):
            up_prefix[0] = compare(words, low_position[-1:], up_position[:1], most)[0]
        position = np.concatenate([low_position, up_position])
        prefix = np.concatenate([low_prefix, up_prefix]).astype(np.int32)
        if len(prefix):
            prefix[0] = 0
        ordered.append((position, prefix))
    ordered.reverse()
    position, prefix = (np.concatenate(x) for x in zip(*ordered, strict=True))
    assert len(position) == n
    return position, prefix


def suffix_order(text: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each with the one before, at most ``most``).

    ``text`` holds numbers from 0; its last one, 0, must occur nowhere else.
    """
    symbols = int(text.max()) + 1
    smaller, words = smaller_types(text), packed(text)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(text) == 1:
        return np.zeros(1, np.int64), np.zeros(1, np.int32)
    lms = lms.astype(np.int64)
    # Sort LMS substrings by an induction from LMS positions in order of their first symbols.
    seeds = lms[np.argsort(text[lms], kind="stable")]
    rough, _ = scan(text, words, symbols, smaller, seeds, np.zeros(len(seeds), np.int32), 0)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    sorted_lms = rough[is_lms[rough]]
    del rough, is_lms, seeds
    number = np.full(len(text), -1, np.int32 if len(text) < 1 << 31 else np.int64)
    number[lms] = np.arange(len(lms))
    length = np.append(np.diff(lms), 0) + 1  # with the next LMS symbol
    ranks = number[sorted_lms]
    del number
    same = equal_parts(text, sorted_lms, length[ranks])
    name = np.empty(len(lms), np.int64)
    name[ranks] = np.cumsum(~same) - 1
    names = int(name.max()) + 1
    if names == len(lms):
        order = lms[np.argsort(name)]
    else:
        order = lms[suffix_order(name, 0)[0] if names <= MOST_BUCKETS else doubled_order(name)]
    shared = np.zeros(len(order), np.int32)
    if most:
        shared[1:] = compare(words, order[:-1], order[1:], most)
    return scan(text, words, symbols, smaller, order, shared, most)


def doubled_order(name: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string over many names, by ranks of ever longer prefixes."""
    rank, width = name, 1
    while True:
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-width] = rank[width:] + 1
        key = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(key, kind="stable")
        fresh = np.empty(len(rank), np.int64)
        fresh[order] = np.cumsum(np.append(False, key[order][1:] != key[order][:-1]))
        rank, width = fresh, 2 * width
        if rank.max() + 1 == len(rank) or width >= len(rank):
            return order


def equal_parts(text: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether each part text[start : start + length] equals the one before it in the list."""
    same = np.append(False, length[1:] == length[:-1])
    alive = np.flatnonzero(same)
    k = 0
    while len(alive):
        alive = alive[length[alive] > k]
        differ = text[starts[alive] + k] != text[starts[alive - 1] + k]
        same[alive[differ]] = False
        alive = alive[~differ]
        k += 1
    return same
