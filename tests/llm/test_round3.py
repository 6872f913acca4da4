"""Cases of the third review, each against the rule it broke."""

import random

from orderlens.llm import jaccard, pii


def test_a_common_passage_stays_out_of_prefixes(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(102))
    rows = [(i, passage + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(40))) for i in range(3000)]
    rows += [(3000 + i, passage) for i in range(40)]  # nothing rare in these
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    features = jaccard.document_features(df, 3, 90).where("doc_id < 3000")
    most = features.selectExpr("explode(prefix) AS token").groupBy("token").count().agg({"count": "max"}).first()[0]
    assert most < jaccard.COMMON_FROM
    found = {r["doc_id"]: r["component_id"] for r in jaccard.document_components(df, 3, 90).collect()}
    assert all(found[i] == i for i in range(3000)) and all(found[3000 + i] == 3000 for i in range(40))


def test_counts_of_common_tokens_are_exact(spark):
    rows = [(i, " ".join(f"t{j}" for j in range(i % 40 + 1))) for i in range(200)]
    texts = jaccard.blocks(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    # Token j is in the rows with i % 40 >= j, five for each remainder.
    want = sorted(n for n in (5 * (40 - j) for j in range(40)) if n >= jaccard.COMMON_FROM)
    found = {}
    for r in jaccard.common_tokens(texts, 1).collect():
        for token, n in zip(jaccard.np.frombuffer(r["tokens"], "u8"), jaccard.np.frombuffer(r["counts"], "i8"), strict=True):
            assert found.setdefault(token, n) == n
    assert sorted(found.values()) == want


def test_numbers_of_any_length_are_no_addresses(spark):
    texts = ["1.2.3." + "0" * 5000, "1.2.3." + "0" * 5000 + "7", "9" * 6000 + ".1.1.1", "1.2.3.256", "001.2.3.4"]
    kinds = [[k for k, _, _ in pii.base_spans(t)].count(1) for t in texts]
    assert kinds == [1, 1, 0, 0, 1]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_ip"] for r in pii.pii_digest(df).collect()} == dict(enumerate(kinds))


def test_loose_spans_touch_no_base_span():
    rng = random.Random(2)
    pieces = ["call 555-123-4567 ", "a@b.co ", "joe at mail dot com ", "123-45-6789 ", "+1 555 123 4567 ", "10.0.0.1 ", "x ", "4111 1111 1111 1111 "]
    for _ in range(200):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        base = pii.base_spans(text)
        all_loose = pii.loose_spans(text, [])
        assert pii.loose_spans(text, base) == [s for s in all_loose if not any(a < s[2] and s[1] < b for _, a, b in base)]
