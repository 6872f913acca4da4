"""Document fingerprints by a randomised embedding of edit distance into Hamming distance.

All texts are walked with shared random bits: at step j the walk writes the character under its
pointer and moves on if the bit of (j, character) is one (Chakraborty, Goldenberg, Koucky 2016). Texts
that differ by few edits fall back into step soon after each, so their walks agree nearly everywhere.
A fingerprint samples bits of the walk: level l holds ``LEVEL_BITS`` sampled steps between 2**l and
2**(l+1), down to the end of the text, a word of 16 hex digits each. Likeness is the share of agreeing
bits, each level weighted by the steps it covers, scaled so that chance agreement is 0.

Random bits have period ``PERIOD`` in j, so the number of steps a character takes is one look-up of
(phase, character), and texts are walked side by side, one character of each at a time.

Near copies are found by bands: words of sampled bits that must agree in full, rare ones only through
their smallest document, and verified by likeness.

Defined results: a null text is empty and has an empty fingerprint; two empty fingerprints are alike
(1), an empty and another one are not (0); equal texts have equal fingerprints; the next document of
a single one is itself; rows with equal doc_id are ordered by text; a null doc_id comes last; an empty
table gives no rows; columns besides doc_id and text are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.hashing import mix
from orderlens.llm.tables import stored

PERIOD = 256
LEVEL_BITS = 64
LEVELS = 40
CLASSES = 256
#: Characters of the texts that are walked side by side.
WALK_CHARS = 1 << 22

_RANDOM = np.random.Generator(np.random.PCG64(7))
_BITS = _RANDOM.integers(0, 2, (PERIOD, CLASSES)).astype(bool)
_BITS[0] = True  # every character moves on within one period
#: Steps that a character takes from a phase on: up to and with the first bit that is one.
STAY = np.empty((PERIOD, CLASSES), np.int64)
_next = np.zeros(CLASSES, np.int64)
for _phase in range(2 * PERIOD - 1, -1, -1):
    _next = np.where(_BITS[_phase % PERIOD], 1, _next + 1)
    STAY[_phase % PERIOD] = _next
STAY = STAY.ravel()


def _sample_steps() -> np.ndarray:
    """Sampled steps, ``LEVEL_BITS`` per level; a level with fewer steps repeats them."""
    rows = []
    for level in range(LEVELS):
        low, count = 1 << level, min(1 << level, LEVEL_BITS)
        # One step in each of equal parts of the level.
        part = (low << 8) // count
        jitter = (_RANDOM.integers(0, 256, count) * part) >> 8
        rows.append(np.resize(low + ((np.arange(count) * part + jitter) >> 8), LEVEL_BITS))
    return np.concatenate(rows)


SAMPLES = _sample_steps()
SALTED = SAMPLES.astype(np.uint64) * np.uint64(CLASSES + 1)


def classes(text: str) -> np.ndarray:
    """Characters as numbers below ``CLASSES``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return (mix(points) & np.uint64(CLASSES - 1)).astype(np.uint8)


def walk(parts: list[np.ndarray], starts: list[int]) -> list[np.ndarray]:
    """Steps at which each character of each part begins, and the step after the last."""
    order = np.argsort([-len(p) for p in parts], kind="stable")
    sizes = np.array([len(parts[i]) for i in order], np.int64)
    flat = np.concatenate([parts[i] for i in order]) if len(parts) else np.zeros(0, np.uint8)
    at = np.cumsum(sizes) - sizes
    times = np.empty(len(flat) + 1, np.int64)
    time = np.array([starts[i] for i in order], np.int64)
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")
    ends = time.copy()
    last = len(sizes)
    for k in range(longest):
        n = int(active[k])
        if n < last:
            ends[n:last], time, at, last = time[n:], time[:n], at[:n], n
        place = at + k
        times[place] = time
        time = time + STAY[(time & (PERIOD - 1)) * CLASSES + flat[place]]
    ends[:last] = time
    out: list = [None] * len(parts)
    begin = 0
    for rank, i in enumerate(order):
        out[i] = np.append(times[begin : begin + sizes[rank]], ends[rank])
        begin += sizes[rank]
    return out


def sampled(chars: np.ndarray, times: np.ndarray) -> str:
    """The fingerprint: a random bit of (step, character) at each sampled step of the walk."""
    if not len(chars):
        return ""
    end = int(times[-1])
    count = end.bit_length() * LEVEL_BITS
    steps = SAMPLES[:count]
    under = np.searchsorted(times, steps, side="right") - 1
    # Past the end the walk writes a padding character.
    symbol = np.where(steps < end, chars[np.minimum(under, len(chars) - 1)], CLASSES).astype(np.uint64)
    return np.packbits((mix(SALTED[:count] + symbol) & np.uint64(1)).astype(np.uint8)).tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Weighted agreement of two fingerprints, 0 (chance) to 1 (equal)."""
    if not a or not b:
        return float(a == b)
    n = max(len(a), len(b)) // 16
    x, y = (np.frombuffer(bytes.fromhex(s.ljust(16 * n, "0")), ">u8") for s in (a, b))
    same = LEVEL_BITS - np.bitwise_count(x ^ y).astype(float)
    same[min(len(a), len(b)) // 16 :] = LEVEL_BITS / 2  # one text has ended: chance
    weight = np.exp2(np.arange(n))
    return float(max(0.0, 2 * (same * weight).sum() / (LEVEL_BITS * weight.sum()) - 1))


def fingerprint(text: str) -> str:
    chars = classes(text)
    return sampled(chars, walk([chars], [0])[0])


def edited(text: str, following: str) -> tuple[str, str]:
    """(kept part, new part): the last half replaced by the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half], following[:half]


def print_pairs(pairs: list[tuple[str, str]]) -> list[tuple]:
    """(fingerprint, fingerprint of the edited text, of the following text) for (text, following)."""
    texts = [t for t, _ in pairs]
    chars = [classes(t) for t in texts]
    times = walk(chars, [0] * len(chars))
    # The walk of the edited text is the text's own up to the cut.
    halves = [edited(t, f) for t, f in pairs]
    tails = [classes(new) for _, new in halves]
    tail_times = walk(tails, [int(w[len(kept)]) for w, (kept, _) in zip(times, halves, strict=True)])
    out = []
    for c, w, (kept, new), tail, more in zip(chars, times, halves, tails, tail_times, strict=True):
        n = len(kept)
        full, steps = np.concatenate([c[:n], tail]), np.concatenate([w[:n], more])
        out.append((sampled(c, w), sampled(full, steps), hashlib.sha256((kept + new).encode()).hexdigest()))
    return out


def in_sequence(docs: DataFrame) -> DataFrame:
    """Rows by ranges of descending doc_id with the first row of the next range behind each range.

    Columns: part, extra (true for a row borrowed from the next range), doc_id, text. Range limits are
    doc_id quantiles, as many as shuffle partitions; only those limits and one id each reach the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = rows.select("doc_id").where("doc_id is not null")
    limits = sorted(set(known.stat.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    limits = [int(x) for x in limits]
    listed = ", ".join(f"{x}L" for x in limits)
    # Part 0 has the largest ids; rows without an id come behind all others.
    below = f"size(filter(array({listed}), x -> x > doc_id))" if limits else "0"
    rows = rows.withColumn("part", F.expr(f"coalesce({below}, {len(limits)})").cast("int"))
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("head")).orderBy("part").collect()
    # The first row of each range also ends the range before it; the very first one ends the last.
    order = [(r["part"], r["head"]) for r in heads]
    moves = [f"WHEN part = {p} AND doc_id <=> {'NULL' if h is None else f'{h}L'} THEN {order[k - 1][0]}" for k, (p, h) in enumerate(order)]
    borrowed = f"CASE {' '.join(moves)} END" if moves else "CAST(NULL AS int)"
    copies = F.expr(f"filter(array(struct(part AS part, false AS extra), struct({borrowed} AS part, true AS extra)), c -> c.part IS NOT NULL)")
    rows = rows.select("doc_id", "text", F.explode(copies).alias("copy")).select("copy.part", "copy.extra", "doc_id", "text")
    return rows.repartition(parts, "part").sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), "text")


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with likeness to those and to the next text's."""

    def flush(pairs: list[tuple]) -> pa.RecordBatch:
        prints = print_pairs([(text, following) for _, text, following in pairs])
        columns = list(zip(*prints, strict=True))
        following = print_pairs([(f, "") for *_, f in pairs[-1:]])[0][0]
        # Pairs follow one another, except where a range ends: then the next text was not walked here.
        nexts = [p[0] for p in prints[1:]] + [following]
        for k in range(len(pairs) - 1):
            if pairs[k][2] is not pairs[k + 1][1]:
                nexts[k] = fingerprint(pairs[k][2])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0] for p in pairs], pa.int64()),
                pa.array([len(p[1]) for p in pairs], pa.int64()),
                pa.array(columns[2], pa.string()),
                pa.array(columns[0], pa.string()),
                pa.array(columns[1], pa.string()),
                pa.array([likeness(a, b) for a, b in zip(columns[0], columns[1], strict=True)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(columns[0], nexts, strict=True)], pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, pairs, chars = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "extra", "doc_id", "text"))
            for part, extra, doc_id, text in zip(*columns, strict=True):
                if held and held[0] == part:
                    pairs.append((held[1], held[2], text))
                    chars += len(held[2])
                    if chars >= WALK_CHARS:
                        yield flush(pairs)
                        pairs, chars = [], 0
                # A borrowed row ends its range; further rows of the same id are not its successors.
                held = None if extra else (part, doc_id, text)
        if pairs:
            yield flush(pairs)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_sequence(docs).mapInArrow(run, schema)


def near_copies(prints: DataFrame, least: float = 0.8, band_levels: int = 2) -> DataFrame:
    """(a, b, likeness) of fingerprints (doc_id, fingerprint) that share a band and are alike enough.

    A band is ``band_levels`` neighbouring levels of one fingerprint in full. Equal bands are linked
    through their smallest document, so a band of any size makes as many pairs as it has documents.
    """
    levels = (F.length("fingerprint") / 16).cast("int")
    spans = F.transform(
        F.sequence(F.lit(0), F.greatest(levels - band_levels, F.lit(0))),
        lambda k: F.concat_ws(":", k.cast("string"), F.substring(F.col("fingerprint"), k * 16 + 1, F.lit(16 * band_levels))),
    )
    # Levels under 2**6 have fewer than 64 bits; bands begin above them where the text is long enough.
    rows = stored(prints.where("fingerprint <> ''").select("doc_id", "fingerprint", F.explode(F.slice(spans, F.least(F.lit(6), F.size(spans)), F.size(spans))).alias("band")))
    first = rows.groupBy("band").agg(F.min_by(F.struct("doc_id", "fingerprint"), "doc_id").alias("first"))
    pairs = rows.join(first, "band").where("doc_id <> first.doc_id").select("first.doc_id", F.col("first.fingerprint").alias("left"), F.col("doc_id").alias("b"), F.col("fingerprint").alias("right"))
    pairs = pairs.withColumnRenamed("doc_id", "a").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = [likeness(x, y) for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(value, pa.float64())], ["a", "b", "likeness"])

    return pairs.mapInArrow(verify, "a long, b long, likeness double").where(F.col("likeness") >= least)
