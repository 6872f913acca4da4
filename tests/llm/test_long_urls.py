"""URLs longer than a chunk, very long ones, and repeated rows."""

from math import log

import pytest

from orderlens.llm import urls


def test_strings_of_a_long_url_are_whole(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(3 * urls.CHUNK + 5)) + "é😀"
    df = spark.createDataFrame([(1, text), (2, "a"), (3, "")], "k int, url string")
    rows = urls.url_grams(df).collect()
    padded = "\x02\x02\x02" + text
    assert sorted(r["gram"] for r in rows if r["k"] == 1) == sorted(padded[i : i + 4] for i in range(len(text)))
    assert [r["gram"] for r in rows if r["k"] == 2] == ["\x02\x02\x02a"]
    assert not [r for r in rows if r["k"] == 3]


def test_long_and_repeated_urls(spark):
    long = [f"http://site{i}.test/" + "abcdefghij"[i:] * 10_000 for i in range(8)]
    given = ["http://a.net/x", "http://b.org/fr/y", "http://b.org/fr/z", "http://c.net/q", *long, *long[:3]]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judge(df).collect()}
    assert len(got) == len(given)
    assert [got[12 + i]["score"] for i in range(3)] == [got[4 + i]["score"] for i in range(3)]
    assert all(got[4 + i]["path"] == "/" + "abcdefghij"[i:] * 10_000 for i in range(8))


def test_a_repeated_string_counts_each_time(spark):
    data = [("a", "allow", False), ("b", "block", False), ("aaaaaaaa", None, False)]
    got = {r["url"]: r["score"] for r in urls.scores(spark.createDataFrame(data, "url string, verdict string, calibrates boolean")).collect()}
    # Only the string at the start was seen in its context; later ones fall back to order 0.
    p, q = (1 + 1 / urls.ALPHABET) / 2, (1 / urls.ALPHABET) / 2
    low = log(p) - log(q)
    for _ in range(3):
        p, q = (1 + p) / 2, q / 2
    assert got["aaaaaaaa"] == pytest.approx((log(p) - log(q) + 7 * low) / 8, abs=1e-8)
