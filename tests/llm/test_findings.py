"""Cases of the second review, each against the rule it broke."""

import random
import zlib

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
from test_operators import SMALL
from tokenizers import Tokenizer

from orderlens.llm import jaccard, queries, token_files, tokens
from orderlens.llm.tables import table


def test_special_tokens_have_their_ids_in_the_queries(spark, tmp_path):
    encode = Tokenizer.from_file(tokens.VOCABULARY).encode
    rng = random.Random(5)
    signs = ["a", " ", "  ", "\n", "é", "'s", "<|endoftext|>", "<|endoftext|", "|>", "."]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "plain", "", *("".join(rng.choice(signs) for _ in range(rng.randrange(9))) for _ in range(400))]
    ids = [encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [64, 220, 50256, 275]
    flat, count = tokens.WordTokenizer(cached_words=50, special_ids=True).encode(texts)
    assert (flat.tolist(), count.tolist()) == ([i for one in ids for i in one], [len(one) for one in ids])
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    crc = lambda one: zlib.crc32(np.array(one, "<u4").tobytes())
    packed = {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in queries.queries()["op1_packing"](spark, str(tmp_path)).collect()}
    assert packed == {i: (len(one) + 1, crc([*one, 0])) for i, one in enumerate(ids)}
    start, want = 0, []
    for i, one in enumerate(ids):
        want.append((i, start, len(one) + 1, crc([*one, 2])))
        start += len(one) + 1
    assert sorted(tuple(r) for r in queries.queries()["op3_token_files"](spark, str(tmp_path)).collect()) == want


def test_stages_decide_by_row_not_by_doc_id(spark):
    schema = "doc_id long, text string, lang string"
    kept = lambda stage, rows: sorted(map(str, dict(corpus_pipeline.STAGES)[stage](spark, spark.createDataFrame([(*r, "en") for r in rows], schema), SMALL).drop("lang").collect()))
    want = lambda rows: sorted(f"Row(doc_id={i}, text={t!r})" for i, t in rows)
    clean = ["the old mill stands by the river and the children play", "a long road leads over the hills to the quiet sea"]
    good = [(1, clean[0]), (None, clean[1]), (3, clean[1])]
    assert kept("language", [*good, (1, "12 34 !!"), (None, None), (None, "77")]) == want(good)
    rows = [(7, clean[0]), (7, clean[0]), (None, clean[0]), (None, clean[1]), (None, clean[1]), (7, "another text that shares its number with a copy")]
    assert kept("near_copies", rows) == want([rows[0], rows[3], rows[5]])
    item = table(spark, SMALL, "benchmark").where("item_id = 0").first()["text"]
    assert kept("decontamination", [*good, (1, f"so {item} it is"), (None, item), (5, item)]) == want(good)


def test_group_tasks_hold_a_block_of_queries(spark, monkeypatch):
    rng = np.random.default_rng(3)
    sketches = [jaccard.sketch(rng.integers(0, 1 << 60, 40).astype(np.uint64)) for _ in range(200)]
    # One family of 199 linked members and a stray one that is equal to the last of them.
    rows = [(0, i, 40, 0 if i < 199 else 199, sketches[min(i, 198)]) for i in range(200)]
    members, asked = (spark.createDataFrame(rows, "grp long, id long, size long, component long, sketch binary") for _ in range(2))
    test = jaccard.may_link

    def watched(difference, total, percent):
        if max(difference.shape) > 40:
            raise AssertionError(difference.shape)
        return test(difference, total, percent)

    monkeypatch.setattr(jaccard, "BLOCK", 10)
    monkeypatch.setattr(jaccard, "may_link", watched)
    opened = jaccard.open_groups(asked, members.selectExpr("*", "20 AS blocks"), 90)
    assert sorted({tuple(sorted(r)) for r in opened.collect()}) == [(198, 199)]
    parts = jaccard.group_parts(members)
    assert [tuple(r) for r in parts.collect()] == [(0, 20, 0, True)]
    assert [r["id"] for r in jaccard.own_queries(members, parts).collect()] == [199]


def test_shard_files_are_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(400)], "doc_id long, text string")
    # Ranges are not merged, so later ones, which have longer texts, make larger files.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(docs, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "shards").glob("part-*.parquet"))
    assert [i for f in files for ids in pq.read_table(f)["doc_ids"].to_pylist() for i in ids] == list(range(400))
