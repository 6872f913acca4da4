"""PPM by hand, many languages, and rows without or with repeated doc_id."""

import random
import zlib
from collections import Counter
from math import log2

import numpy as np
import pytest

from orderlens.llm import language


def bits_by_hand(samples, text):
    """Code length of ``text`` by method C with exclusion, from counts of the samples."""
    counts = {}
    for sample in samples:
        padded = b"\0\0\0" + sample
        for i in range(3, len(padded)):
            for order in range(4):
                counts.setdefault(padded[i - order : i], Counter())[padded[i]] += 1

    def chance(context, byte):
        seen = counts.get(context)
        shorter = (lambda b: chance(context[1:], b)) if context else (lambda b: 1 / 256)
        if not seen:
            return shorter(byte)
        whole = sum(seen.values()) + len(seen)
        if byte in seen:
            return seen[byte] / whole
        return len(seen) / whole * shorter(byte) / (1 - sum(shorter(b) for b in seen))

    padded = b"\0\0\0" + text
    return -sum(log2(chance(padded[i - 3 : i], padded[i])) for i in range(3, len(padded)))


def test_code_lengths_equal_those_by_hand():
    rng = random.Random(3)
    for letters in (b"ab", b"abcdefgh", bytes(range(0, 256, 5))):
        samples = [bytes(rng.choices(letters, k=rng.randrange(1, 60))) for _ in range(5)]
        grams = np.concatenate([language.grams_of(np.frombuffer(b"\0\0\0" + s, np.uint8)) for s in samples]).astype(np.int64)
        model = language.ContextModel({"x": language.Tree(grams, np.ones(len(grams), np.int64))})
        texts = [bytes(rng.choices(letters + b"zy", k=rng.randrange(1, 40))) for _ in range(6)] + [samples[0]]
        assert model.code_lengths(texts)[:, 0] == pytest.approx([bits_by_hand(samples, t) for t in texts], rel=1e-5)


def invented(spark, languages, rows, doc_id="id"):
    rng = random.Random(9)
    data = []
    for k in range(languages):
        own = random.Random(k)
        words = ["".join(own.choices("abcdefghijklmnopqrstuvwxyz", k=own.randrange(3, 9))) for _ in range(300)]
        data += [(f"l{k:03d}", " ".join(rng.choices(words, k=40))) for _ in range(rows)]
    frame = spark.createDataFrame(data, "lang string, text string").repartition(8)
    return frame.selectExpr(f"CAST({doc_id} AS long) AS doc_id" if doc_id != "id" else "monotonically_increasing_id() AS doc_id", "lang", "text")


def test_no_language_is_left_out(spark):
    docs = invented(spark, 100, 12)
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert len(set(found.values())) == 100
    assert sum(found[i] == truth[i] for i in truth) >= 0.98 * len(truth)


@pytest.mark.parametrize("doc_id", ["NULL", "7"])
def test_rows_without_and_with_one_doc_id_are_learnt(spark, doc_id):
    docs = invented(spark, 3, 30, doc_id)
    got = language.predict(docs).groupBy("lang_pred").count().collect()
    assert {r["lang_pred"]: r["count"] for r in got} == {"l000": 30, "l001": 30, "l002": 30}


def test_the_sample_is_bounded_and_skips_copies(spark):
    many = spark.range(5000).selectExpr("CAST(NULL AS long) AS doc_id", "'a' AS lang", "CASE WHEN id % 3 = 0 THEN 'same' ELSE concat('t', id) END AS text")
    few = spark.range(20).selectExpr("id AS doc_id", "'b' AS lang", "'x' AS text")
    picked = language.training_rows(many.union(few), 50).groupBy("lang", "text").count().collect()
    assert sum(r["lang"] == "a" for r in picked) == 50 and all(r["count"] == 1 for r in picked if r["lang"] == "a")
    held = sum(1 for i in range(20) if zlib.crc32(str(i).encode()) % 3 == 1)
    assert [r["count"] for r in picked if r["lang"] == "b"] == [20 - held]
