"""Language ID by prediction by partial matching (PPM) over bytes.

Each language has a context tree of up to three bytes with frozen counts. A symbol seen in its
longest known context costs -log2 n/(N+d) bits (method C: N symbols, d distinct ones); otherwise an
escape, d/(N+d), leads to the next shorter context, where the symbols of the longer one are
excluded and the rest is scaled to one. Below order 0 all 256 bytes are alike. The probabilities of
a context add up to one, so the sums are exact code lengths; the shortest one names the language.

A tree is kept whole, as sorted arrays: the bits of each seen (context, byte), and what an escape
from each context costs. Texts are scored language by language on their distinct four-byte strings.
Training takes at most ``TRAIN_DOCS`` different labelled rows per language, those of the least hash;
scoring covers all rows. The trees are broadcast: their size is bounded by these rows.

Defined results: null text, or text without a letter: ``und`` with score 0; so is all text when no
row is labelled. Rows without doc_id are learnt from like others; repeated rows count once in the
sample and are scored each. Equal code lengths go to the first language by name. An empty table
gives no rows; columns besides doc_id, text and lang are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.tables import in_slices

#: Different labelled rows per language to learn from.
TRAIN_DOCS = 400
#: Bytes of a longest context.
ORDER = 3

UNKNOWN = "und"


def held_out(doc_id):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, most: int = TRAIN_DOCS) -> DataFrame:
    """(lang, text): a bounded sample by hash of the labelled rows that are not held out.

    The number of different rows of a language, by a sketch, gives the share of hashes that holds
    about twice ``most`` of them; copies among these collapse in their tasks, and the least ``most``
    hashes stay. So a window sees about ``2 * most`` rows of a language, however common it is.
    """
    labelled = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out("doc_id"))
    lang, text = F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    rows = labelled.select(lang, text, F.xxhash64("doc_id", "text").alias("hash"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("hash", 0.03).alias("different"))
    # One row per language, far smaller than the trees that go to every task anyway.
    share = F.pmod("hash", F.lit(1 << 40)).cast("double") * F.col("different") < F.lit(float(2 * most << 40))
    picked = rows.join(F.broadcast(sizes), "lang").where(share)
    picked = picked.groupBy("lang", "hash").agg(F.max("text").alias("text"))
    first = Window.partitionBy("lang").orderBy(F.pmod("hash", F.lit(1 << 40)), "hash")
    return picked.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).select("lang", "text")


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n): strings of four bytes as integers; a text begins with three zero bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                gram, n = np.unique(grams_of(np.frombuffer(b"\0\0\0" + text.encode(), np.uint8)), return_counts=True)
                columns = [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def grams_of(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(np.uint32)
    return (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]


class Tree:
    """Code lengths of one language: arrays of each order, sorted by key.

    A string of k + 1 bytes is a pair of a context of k bytes and the byte behind it.
    """

    def __init__(self, gram: np.ndarray, n: np.ndarray):
        self.pairs, self.bits, self.contexts, self.escapes = [], [], [], []
        shorter = None
        for order in range(ORDER + 1):
            pair, at = np.unique(gram & ((1 << 8 * (order + 1)) - 1), return_inverse=True)
            c = np.bincount(at, n, len(pair))
            context, at = np.unique(pair >> 8, return_inverse=True)
            seen, distinct = np.bincount(at, c, len(context)), np.bincount(at, minlength=len(context))
            p = c / (seen + distinct)[at]
            # Whatever follows a context also follows the shorter one that ends it.
            below = np.full(len(pair), 1 / 256) if order == 0 else shorter[np.searchsorted(self.pairs[-1], pair & ((1 << 8 * order) - 1))]
            left = np.maximum(1 - np.bincount(at, below, len(context)), 1e-9)
            self.pairs.append(pair.astype(np.uint32))
            self.bits.append(-np.log2(p).astype(np.float32))
            self.contexts.append(context.astype(np.uint32))
            self.escapes.append(-np.log2(distinct / (seen + distinct) / left).astype(np.float32))
            shorter = p

    def code(self, gram: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each of the sorted, distinct strings ``gram`` behind its first three."""
        total = np.zeros(len(gram), np.float32)
        open_ = np.arange(len(gram))
        for order in range(ORDER, -1, -1):
            pair = gram[open_] & np.uint32((1 << 8 * (order + 1)) - 1)
            at, found = look_up(self.pairs[order], pair)
            total[open_[found]] += self.bits[order][at[found]]
            open_, pair = open_[~found], pair[~found]
            at, found = look_up(self.contexts[order], pair >> np.uint32(8))
            total[open_[found]] += self.escapes[order][at[found]]
        total[open_] += 8
        return total


def look_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, is there) of values in sorted keys."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class ContextModel:
    """The trees of all languages, in the order of their names."""

    def __init__(self, trees: dict[str, Tree]):
        self.languages = sorted(trees)
        self.trees = [trees[lang] for lang in self.languages]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language; texts are not empty."""
        grams, at = np.unique(grams_of(np.frombuffer(b"\0\0\0" + b"\0\0\0".join(texts), np.uint8)), return_inverse=True)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes + 3) - (sizes + 3)
        # The three zeros before the next text belong to no text.
        bounds = np.stack([starts, starts + sizes], axis=1).ravel()
        found = np.empty((len(texts), len(self.trees)))
        for k, tree in enumerate(self.trees):
            bits = np.append(tree.code(grams)[at], np.float32(0))
            found[:, k] = np.add.reduceat(bits, bounds, dtype=np.float64)[::2]
        return found


def trained(counts: DataFrame) -> ContextModel:
    """The model of (lang, gram, n). One row per language is gathered, with the strings of its sample."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        gram, n = (frame[c].to_numpy(np.int64).tobytes() for c in ("gram", "n"))
        return pd.DataFrame({"lang": [frame["lang"].iloc[0]], "gram": [gram], "n": [n]})

    packed = counts.groupBy("lang").applyInPandas(pack, "lang string, gram binary, n binary")
    return ContextModel({r["lang"]: Tree(*(np.frombuffer(r[c], np.int64) for c in ("gram", "n"))) for r in packed.toLocalIterator()})


def predict(docs: DataFrame, model: ContextModel | None = None) -> DataFrame:
    """(doc_id, lang_pred, score): the posterior of the best language with equal priors."""
    model = model or trained(gram_counts(training_rows(docs)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names, scores = [], []
            for low, high in in_slices(texts, 1 << 20):
                part = texts[low:high]
                some = [bool(model.languages) and any(map(str.isalpha, t)) for t in part]
                best = iter(())
                if any(some):
                    bits = model.code_lengths([t.encode() for t, ok in zip(part, some, strict=True) if ok])
                    pick = bits.argmin(axis=1)
                    share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
                    best = zip(pick, share, strict=True)
                for ok in some:
                    k, value = next(best) if ok else (None, 0.0)
                    names.append(model.languages[k] if ok else UNKNOWN)
                    scores.append(float(value))
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    schema = "doc_id long, lang_pred string, score double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, schema)


def language_digest(docs: DataFrame) -> DataFrame:
    return predict(docs).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
