"""Benchmark decontamination: item-sized windows, SimHash blocks, exact weighted similarity.

A document is a sequence of hashed shingles (five words in lower case). For every benchmark item the
windows with as many shingles as the item are fingerprinted: a 64-bit SimHash, each shingle weighted
by its count. Fingerprints are cut into ``RADIUS`` + 1 blocks and meet the items' blocks of the same
window size; by the pigeonhole principle this finds every pair within the radius. Candidates are
verified exactly: sum of the smaller over sum of the larger shingle weights, at least 0.8.

Only windows that can pass are made. A window that passes shares more than 0.8 of an item's
shingles, so one of them stands within the first fifth of the window; windows are made around shared
shingles alone. Two sequences at similarity 0.8 differ in 9.7 of 64 bits on average (deviation 2.9);
the radius lies more than three deviations above.

All of it is DataFrame work. Shingles of the benchmark are literals of the scan, in blocks of at most
``SHINGLE_BLOCK``: a larger benchmark takes more scans, and no side is broadcast on faith.

Defined results: null or wordless text and items match nothing; an item with fewer words than a
shingle is one shingle of all its words; a document shorter than an item is one window; repeated
documents give one row per (doc_id, item_id); an empty table gives no rows; documents without doc_id
keep null; columns besides doc_id, text, item_id are ignored.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.tables import stored

SHINGLE_WORDS = 5
PERCENT = 80
BITS = 64
RADIUS = 19
#: Benchmark shingles of one scan.
SHINGLE_BLOCK = 50_000
#: Counters of 32 bits in a 64-bit number; bits k and k + 32 share the k-th.
LANES = 0x0000000100000001


def word_hashes(text: Column) -> Column:
    """Hashes of the runs of letters and digits, in lower case."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.coalesce(F.transform(words, lambda w: F.xxhash64(w)), F.array().cast("array<long>"))


def shingles(words: str, width: int) -> str:
    """SQL for the shingle hashes of a column of word hashes."""
    return f"""IF(size({words}) < {width}, CAST(array() AS array<bigint>),
        transform(sequence(1, size({words}) - {width - 1}), i -> xxhash64(slice({words}, i, {width}))))"""


def once(value: Column, name: str) -> Column:
    """``value`` as a generated column: it is computed once per row and never inlined elsewhere."""
    return F.explode(F.array(value)).alias(name)


def simhash(window: str, size: Column) -> Column:
    """A bit is set where more than half of the window's shingles have it."""
    out = F.lit(0).cast("long")
    for bit in range(32):
        lanes = F.expr(f"aggregate({window}, 0L, (a, x) -> a + (shiftrightunsigned(x, {bit}) & {LANES}L))")
        low = (F.shiftrightunsigned(F.shiftleft(lanes, 32), 32) * 2 > size).cast("long")
        high = (F.shiftrightunsigned(lanes, 32) * 2 > size).cast("long")
        out = out.bitwiseOR(F.shiftleft(low, bit)).bitwiseOR(F.shiftleft(high, bit + 32))
    return out


def blocks(fingerprint: str, radius: int) -> Column:
    """(number, value) of the radius + 1 blocks of a fingerprint."""
    edges = [BITS * k // (radius + 1) for k in range(radius + 2)]
    parts = [f"struct({k} AS block, shiftrightunsigned({fingerprint}, {a}) & {(1 << (b - a)) - 1}L AS part)" for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
    return F.expr(f"inline(array({', '.join(parts)}))")


def benchmark_shingles(items: DataFrame, width: int) -> DataFrame:
    """(item_id, step, shingles, size): ``step`` is the words per shingle, fewer for short items only."""
    rows = items.where("text is not null").select("item_id", word_hashes(F.col("text")).alias("words")).where("size(words) > 0")
    steps = [F.when(F.least(F.size("words"), F.lit(width)) == k, F.expr(shingles("words", k))) for k in range(1, width + 1)]
    rows = rows.select("item_id", F.least(F.size("words"), F.lit(width)).alias("step"), F.coalesce(*steps).alias("shingles"))
    return rows.withColumn("size", F.size("shingles"))


def scan(docs: DataFrame, items: DataFrame, step: int, percent: int, radius: int) -> DataFrame:
    """(doc_id, item_id, similarity) for items with ``step`` words per shingle, in one scan of ``docs``."""
    spread = stored(items.select("item_id", "size", F.explode("shingles").alias("shingle")))
    asked = ", ".join(f"{row[0]}L" for row in spread.select("shingle").distinct().collect())
    rows = docs.select(F.col("doc_id").cast("long"), once(word_hashes(F.col("text")), "words"))
    rows = rows.select("doc_id", once(F.expr(shingles("words", step)), "shingles"))
    hits = f"filter(transform(shingles, (x, i) -> struct(i AS place, x AS shingle)), h -> h.shingle IN ({asked}))"
    rows = rows.select("doc_id", "shingles", once(F.expr(hits), "hits")).where("size(hits) > 0")
    found = stored(rows.withColumn("row", F.monotonically_increasing_id()))

    # Windows: as long as the item, or the whole document; its first fifth holds a shared shingle.
    starts = found.select("row", F.size("shingles").alias("length"), F.expr("inline(hits)")).join(
        spread.select("shingle", "size").distinct(), "shingle"
    )
    slack = F.ceil(F.col("size") * (100 - percent) / 100).cast("int")
    last = F.greatest(F.col("length") - F.col("size"), F.lit(0))
    low = F.least(F.greatest(F.col("place") - slack, F.lit(0)), last)
    starts = starts.select("row", "size", F.explode(F.sequence(low, F.least("place", last))).alias("start")).distinct()
    cut = F.expr("slice(shingles, start + 1, size)")
    windows = starts.join(found.select("row", "shingles"), "row").select("row", "size", "start", once(cut, "window"))
    prints = windows.select("row", "size", "start", F.size("window").alias("taken"), simhash("window", F.size("window")).alias("fingerprint"))
    of_items = items.select("item_id", "size", simhash("shingles", F.col("size")).alias("item_print"))
    left = prints.select("*", blocks("fingerprint", radius))
    right = of_items.select("*", blocks("item_print", radius))
    near = left.join(stored(right), ["size", "block", "part"]).where(F.expr(f"bit_count(fingerprint ^ item_print) <= {radius}"))
    near = near.select("row", "size", "start", "taken", "item_id").distinct()

    own = near.join(found.select("row", "shingles"), "row").select("row", "start", "size", "taken", "item_id", F.explode(cut).alias("shingle"))
    own = own.groupBy("row", "start", "size", "taken", "item_id", "shingle").agg(F.count(F.lit(1)).alias("n"))
    other = spread.groupBy("item_id", "shingle").agg(F.count(F.lit(1)).alias("m"))
    both = own.join(other, ["item_id", "shingle"]).groupBy("row", "start", "size", "taken", "item_id").agg(F.sum(F.least("n", "m")).alias("both"))
    total = F.col("size") + F.col("taken")
    passed = both.where(100 * F.col("both") >= percent * (total - F.col("both")))
    best = passed.groupBy("row", "item_id").agg(F.max(F.col("both") / (total - F.col("both"))).alias("similarity"))
    return found.select("row", "doc_id").join(best, "row").select("doc_id", "item_id", "similarity")


def contaminated(docs: DataFrame, items: DataFrame, width: int = SHINGLE_WORDS, percent: int = PERCENT, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity): the best window of each document for each item it contains."""
    table = stored(benchmark_shingles(items, width))
    sizes = {r["step"]: r["n"] for r in table.groupBy("step").agg(F.sum("size").alias("n")).collect()}
    parts = []
    for step, total in sorted(sizes.items()):
        scans = -(-total // SHINGLE_BLOCK)
        for k in range(scans):
            block = table.where((F.col("step") == step) & (F.pmod(F.xxhash64("item_id"), F.lit(scans)) == k))
            parts.append(scan(docs, block, step, percent, radius))
    if not parts:
        return docs.select(F.col("doc_id").cast("long")).limit(0).selectExpr("doc_id", "CAST(NULL AS bigint) AS item_id", "CAST(NULL AS double) AS similarity")
    return reduce(DataFrame.union, parts).groupBy("doc_id", "item_id").agg(F.round(F.max("similarity"), 6).alias("similarity"))
