"""Work tables and shards of the training-data operators stay small."""

import tracemalloc

import numpy as np

from orderlens.llm import suffix_dedup, token_files, tokens


def test_blocks_keep_two_bytes_an_id_and_a_worker_its_tokenizer(spark):
    docs = spark.createDataFrame([(1, "plain words, twice: plain words"), (2, None)], "doc_id long, text string")
    for row in token_files.token_blocks(docs).collect():
        assert len(row["ids"]) == 2 * sum(row["counts"])
    assert token_files.id_type(1 << 16) == "<u2" and token_files.id_type((1 << 16) + 1) == "<u4"
    assert tokens.word_tokenizer() is tokens.word_tokenizer()


def test_memory_of_a_shard(spark):
    rng = np.random.default_rng(0)
    words = [bytes(rng.integers(97, 123, rng.integers(2, 9)).astype(np.uint8)) for _ in range(3000)]
    parts = [b" ".join(words[i] for i in rng.integers(0, 3000, 45)) for _ in range(4000)]
    parts += [parts[7], parts[8][:220]]
    tracemalloc.start()
    found = suffix_dedup.repeated_windows(parts, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found[7]) == len(found[4000]) == len(parts[7]) - 199 and len(found[4001]) == len(parts[4001]) - 199
    assert peak < MOST * sum(map(len, parts))


#: Bytes of memory for each byte of a shard.
MOST = 65
