"""Tokenizing looks words up in bulk and keeps what comes again; suffix dedup cuts many texts at once."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from orderlens.llm import suffix_dedup, token_files, tokens
from orderlens.llm.hashing import Powers


def ids_of(texts):
    encode = Tokenizer.from_file(tokens.VOCABULARY).encode
    return [encode(t, add_special_tokens=False).ids for t in texts]


def test_plain_texts_of_one_look_up_equal_the_library():
    rng = random.Random(7)
    signs = ["a", "Bé", " ", "\n", "\n'll", "é", "1", "'s", "$", "Ġ", "日本", "😀", ".", "\0", " Word", "ɏ!?", "́"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 14))) for _ in range(6000)]
    texts = [t for t in texts if tokens.is_plain(t)] + ["", "x", "", "x\nx x\nX.\nx"]
    assert len(texts) > 500
    tokenizer = tokens.WordTokenizer(cached_words=300)
    for low in range(0, len(texts), 100):
        flat, count = tokenizer.encode(texts[low : low + 100])
        want = ids_of(texts[low : low + 100])
        assert (flat.tolist(), count.tolist()) == ([i for one in want for i in one], [len(one) for one in want])
    assert [a.tolist() for a in tokenizer.encode(["", ""])] == [[], [0, 0]] and [a.tolist() for a in tokenizer.encode([])] == [[], []]


def test_words_that_come_again_are_learnt_once(monkeypatch):
    learnt = Counter()
    learn = tokens.WordTokenizer.learn
    monkeypatch.setattr(tokens.WordTokenizer, "learn", lambda self, words: learnt.update(words) or learn(self, words))
    tokenizer = tokens.WordTokenizer(cached_words=100)
    for n in range(30):
        texts = [f"start common words here and once{n}x{i} more words" for i in range(20)]
        flat, _ = tokenizer.encode(texts)
        assert flat.tolist() == [i for one in ids_of(texts) for i in one]
        assert len(tokenizer.known) <= 100 + 26
    assert learnt["common"] == learnt["words"] == learnt["here"] == 1


def test_a_word_behind_a_line_feed_is_a_word_of_its_own():
    learnt = [w for t in ("one two.\nThree four", "five\nThree") for w in tokens.words_of(t)]
    assert Counter(learnt)["\nThree"] == 2 and len(learnt) == 6


def test_ranks_of_every_length_come_back():
    rng = np.random.default_rng(0)
    for top in (1, 1 << 8, 1 << 16, 1 << 24, 1 << 32):
        for n in (0, 1, 5, 1000):
            ranks = rng.integers(0, top, n).astype(np.uint32)
            control, data = token_files.encode_ranks(ranks)
            assert len(data) == int((1 + (ranks > 0xFF).astype(int) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).sum()) and len(control) == -(-n // 4)
            assert token_files.decode_ranks(control, data, n).tolist() == ranks.tolist()


def test_texts_are_cut_into_segments_together(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdé ") for _ in range(700))
    texts = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 1, 30, 199, 200, 201, 260, 900]))) for _ in range(300)]
    texts += [passage, None, "", passage[100:500], "x" * 900, "", passage + texts[7], "end"]

    class Docs:
        def mapInArrow(self, cut, schema):
            return cut

    cut = suffix_dedup.segment_rows(Docs(), 200)
    batch = lambda low, some: pa.RecordBatch.from_arrays([pa.array(range(low, low + len(some)), pa.int64()), pa.array(some, pa.string())], ["row", "text"])
    together = list(cut(iter([batch(0, texts)])))
    alone = [b for i, t in enumerate(texts) for b in cut(iter([batch(i, [t])]))]
    assert pa.Table.from_batches(together).to_pylist() == pa.Table.from_batches(alone).to_pylist()
    assert len(together) <= 4 < len(alone)
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        found = [r for r in pa.Table.from_batches(together).to_pylist() if r["row"] == i] if i % 25 == 0 or i > 299 else None
        if found is not None:
            # Every window of a text stands in one segment of it.
            assert [w for r in found for w in range(r["first"], r["last"] + 1)] == list(range(max(0, len(raw) - 199)))
    assert [len(x) for x in suffix_dedup.segments([b"", b"short"], 200, Powers())] == 7 * [0]
