"""Each operator against brute force on small documents, odd cases included."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from orderlens.llm import decontamination, edit_fingerprints, induced_sort, jaccard, language, packing, pii, secrets, suffix_dedup, token_files, tokens, urls

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "1 2 3", "a", "a", "é 日本 😀", "x" * 5000, "word " * 3000, "Tab\tand  two blanks", "<|endoftext|> \x1c \u3000"]
SCHEMA = "lang string, doc_id long, text string, spans string, part int, source string, n_chars long"


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, one row twice, columns whose names the operators use inside."""
    rows = [("en", i, t, "s", 1, "src", 3) for i, t in enumerate(ODD)] + [("en", 5, "a", "s", 1, "src", 3)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def encoder():
    tokenizer = Tokenizer.from_file(tokens.VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_tokenizer_equals_the_library():
    rng = random.Random(3)
    signs = ["a", "B", " ", "  ", "\n", "é", "1", "'s", "$", "\t", "\x1c", "\u3000", "日本", "😀", ".", "<|endoftext|>", "\0"]
    some = ["".join(rng.choice(signs) for _ in range(rng.randrange(14))) for _ in range(3000)] + [t or "" for t in ODD]
    flat, count = tokens.WordTokenizer(cached_words=50).encode(some)
    encode, at = encoder(), 0
    for text, n in zip(some, count, strict=True):
        assert flat[at : at + n].tolist() == encode(text)
        at += n


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(4)
    lengths = sorted((rng.randint(1, 64) for _ in range(400)), reverse=True)
    numbers, offsets = packing.best_fit(lengths, 64)
    free: list[int] = []
    for length, number, offset in zip(lengths, numbers, offsets, strict=True):
        fits = [f for f in free if f >= length]
        assert number == len(free) if not fits else free[number] == min(fits)
        if number == len(free):
            free.append(64)
        assert offset == 64 - free[number]
        free[number] -= length


def test_packing_places_every_id_once(docs, odd, texts):
    encode = encoder()
    for df, source in ((docs, texts), (odd, {i: t or "" for i, t in enumerate(ODD)})):
        rows = packing.packing_digest(df).collect()
        pieces, windows = {}, {}
        for r in rows:
            pieces.setdefault((r["doc_id"], r["start"]), r)
            windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for doc_id, text in source.items():
            ids = encode(text) + [0]
            mine = sorted(s for d, s in pieces if d == doc_id)
            assert mine == list(range(0, len(ids), 1024))
            for s in mine:
                r = pieces[doc_id, s]
                assert r["ids_crc32"] == crc(ids[s : s + r["length"]]) and r["doc_tokens"] == len(ids)
        for parts in windows.values():
            ends = list(itertools.accumulate(n for _, n in sorted(parts)))
            assert [a for a, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024
    total = sum(r["length"] for r in rows)
    assert len(windows) <= total // 1024 + 2


def test_control_bytes_round_trip():
    rng = np.random.default_rng(5)
    for n in (0, 1, 3, 4, 1001):
        ranks = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert token_files.decode_ranks(control, data, n).tolist() == ranks.tolist()


def test_token_files_read_back_in_order(docs, odd, texts):
    encode = encoder()
    for df, source in ((docs, list(texts.items())), (odd, [*enumerate(t or "" for t in ODD), (5, "a")])):
        rows = sorted(token_files.token_file_digest(df).collect(), key=lambda r: (r["start"], r["doc_id"]))
        want, start = [], 0
        for doc_id, text in sorted(source):
            ids = encode(text) + [2]
            want.append((doc_id, start, len(ids), crc(ids)))
            start += len(ids)
        assert [tuple(r) for r in rows] == want


BASE_RULES = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def test_secrets_equal_a_full_scan(spark, docs, texts):
    more = ["Password='abc123' api_key: x=1 TOKEN=\"a.b.c-d\"", "AKIA" + "Q" * 16 + " akia", "f" * 24 + "g" + "0" * 23, "ſecret=abcdefgh", "ghp_" + "a1" * 18, None]
    extra = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    source = texts | {10**6 + i: t or "" for i, t in enumerate(more)}
    for row in secrets.secret_digest(docs.select("doc_id", "text").union(extra)).collect():
        spans, text = [], source[row["doc_id"]]
        for order, (kind, (pattern, group, least)) in enumerate(BASE_RULES.items()):
            mine = [m.span() for m in pattern.finditer(text) if len(m[group]) >= least]
            assert row[f"n_{kind}"] == len(mine)
            spans += [(a, order, f"{kind}:{a}:{b}") for a, b in mine]
        joined = ",".join(s for _, _, s in sorted(spans))
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    found = {r["doc_id"]: r["spans"] for r in secrets.secret_digest(extra).collect()}
    assert "github:0:40" in found[10**6 + 4].split(",")


def test_trigram_queries_hold_for_matches():
    assert secrets.trigram_query(secrets.BASE[2]) is True
    for rule, text in ((secrets.BASE[0], "APIKEY=abcdef"), (secrets.BASE[1], "AKIAX"), (secrets.FORMATS[0], "-----BEGIN RSA PRIVATE KEY-----"), (secrets.FORMATS[2], "xoxb-123456789012")):
        assert re.search(rule.pattern, text, rule.flags)
        table, known = np.zeros(1 << 24, np.uint16), {}
        for t in sorted(secrets.trigrams_of(secrets.trigram_query(rule))):
            known[t.encode()] = len(known) + 1
            table[int.from_bytes(t.encode(), "big")] = known[t.encode()]
        segment = secrets.Segment([b"nothing here", text.encode()], table, known)
        assert segment.find(secrets.trigram_query(rule)).tolist() == [1]


def test_language_model_is_a_distribution_and_holds_out(docs, odd):
    model = language.trained(language.gram_counts(language.training_rows(docs)))
    for tree in model.trees:
        for context in [*tree.contexts[3][::500], 0, 0x616263, 0xFFFFFF]:
            p = np.exp2(-tree.code(np.arange(256, dtype=np.uint32) + (np.uint32(context) << np.uint32(8))).astype(float))
            assert p.sum() == pytest.approx(1, abs=1e-4)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = [r for r in language.language_digest(docs).collect() if r["held_out"] and r["lang_pred"] != "und"]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in rows)
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.language_digest(odd).collect()}
    assert [found[i] for i in range(5)] == [("und", 0.0)] * 5
    assert found[5][0] == "en"
    assert {r["lang_pred"] for r in language.language_digest(docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")).collect()} == {"und"}


def test_code_lengths_follow_escapes():
    grams = language.grams_of(np.frombuffer(b"\0\0\0abab", np.uint8)).astype(np.int64)
    model = language.ContextModel({"x": language.Tree(grams, np.ones(len(grams), np.int64))})
    # After "aba" only b was seen, once: N = d = 1, so b costs one bit there.
    assert model.code_lengths([b"abab"])[0, 0] - model.code_lengths([b"aba"])[0, 0] == pytest.approx(1.0)


def pii_by_hand(text):
    out = []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def test_pii_base_spans_equal_the_expressions(docs, odd, texts):
    rng = random.Random(6)
    signs = ["a", "@", ".", "1", "255", "256", " ", "-", "+", "4111111111111111", "_", "(", ")", "7.7.7.7", "+1 (456) 555-2186", "b.co", "\n", "00"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(20)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == pii_by_hand(text)
    for row in pii.pii_digest(docs).collect():
        base = pii_by_hand(texts[row["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    assert pii.pii_digest(odd).count() == len(ODD) + 1


def test_pii_model_trusts_agreeing_labelers(spark):
    good = [f"call phone ({300 + i}) 555-{2000 + i} now, mail me{i}@mail.example.com" for i in range(60)]
    bad = [f"part no. x{100 + i}-555-{1000 + i}y in order" for i in range(60)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: {s["kind"] for s in r["spans"]} for r in pii.find_pii(df).collect()}
    assert sum("local_phone" in found[i] for i in range(60)) >= 55
    assert not any("local_phone" in found[i] for i in range(60, 120))
    masked = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert masked[0] == "call phone [LOCAL_PHONE] now, mail [EMAIL]"


def word_sets(text, n):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", text.translate(fold))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components_by_hand(sets, percent):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: root(i) for i in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_components_equal_brute_force(spark, n, percent):
    rng = random.Random(n)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    made = [None, "", "one", "one", "one two", "ONE two", "\t\n", "\u00c9 x y z"]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 120]))] + passage * rng.randint(0, 1)
        for _ in range(rng.choice([1, 3, 8])):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            made.append(" ".join(copy))
    df = spark.createDataFrame([(100 + i, t, "clash") for i, t in enumerate(made)], "doc_id long, text string, id string")
    sets = {100 + i: word_sets(t or "", n) for i, t in enumerate(made)}
    want = components_by_hand(sets, percent)
    rows = jaccard.document_components(df, n, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {i: (len(s), want[i]) for i, s in sets.items()}
    assert jaccard.document_components(df.limit(0), n, percent).count() == 0


def test_jaccard_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    made = []
    for _ in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        made.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    want = components_by_hand({i: word_sets(t, 3) for i, t in enumerate(made)}, 90)
    assert {r["doc_id"]: r["component_id"] for r in jaccard.document_components(df, 3, 90).collect()} == want


def leaks_by_hand(docs, items):
    def shingles(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])

    out = {}
    for i, item in items.items():
        b = Counter(shingles(item))
        m = sum(b.values())
        for d, text in docs.items():
            s = shingles(text) if len(shingles(item)[0]) == 5 else None
            if s is None or not set(s) & set(b):
                continue
            best = 0
            for k in range(max(1, len(s) - m + 1)):
                a = Counter(s[k : k + m])
                both = sum((a & b).values())
                best = max(best, both / (sum(a.values()) + m - both))
            if best >= 0.8:
                out[d, i] = round(best, 6)
    return out


def test_decontamination_equals_brute_force(spark, docs, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    long = items[0].split()
    edge = {10**6: " ".join(long[1:]), 10**6 + 1: items[1].upper().replace(" ", "  "), 10**6 + 2: " ".join(long[: len(long) // 2]), 10**6 + 3: None}
    more = spark.createDataFrame(list(edge.items()), "doc_id long, text string")
    found = decontamination.contaminated(docs.select("doc_id", "text").union(more), spark.read.parquet(f"{SMALL}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()} == leaks_by_hand(texts | edge, items)


def test_decontamination_of_short_and_empty_items(spark, odd, monkeypatch):
    monkeypatch.setattr(decontamination, "SHINGLE_BLOCK", 2)
    items = spark.createDataFrame([(1, "a"), (2, None), (3, ""), (4, "1 2 3"), (5, "Word word word word word word")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(odd, items).collect()}
    assert found == {(4, 4), (5, 1), (6, 1), (9, 5)}
    assert decontamination.contaminated(odd, items.limit(0)).count() == 0
    assert decontamination.contaminated(odd.limit(0), items).count() == 0


def test_blocks_find_all_prints_in_the_radius(spark):
    edges = [decontamination.BITS * k // 20 for k in range(21)]
    rng = random.Random(1)
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 19):
            b ^= 1 << k
        assert any((a >> x) & ((1 << (y - x)) - 1) == (b >> x) & ((1 << (y - x)) - 1) for x, y in itertools.pairwise(edges))


def test_edit_fingerprints(docs, odd, texts):
    for df, source in ((docs, texts), (odd.where("doc_id < 12").dropDuplicates(["doc_id"]), {i: t or "" for i, t in enumerate(ODD)})):
        order = sorted(source, reverse=True)
        rows = {r["doc_id"]: r for r in edit_fingerprints.fingerprint_digest(df).collect()}
        assert sorted(rows) == sorted(source)
        for k, i in enumerate(order):
            text, following = source[i], source[order[(k + 1) % len(order)]]
            kept, new = edit_fingerprints.edited(text, following)
            mine, other, nxt = map(edit_fingerprints.fingerprint, (text, kept + new, following))
            r = rows[i]
            assert (r["n_chars"], r["fingerprint"], r["edited_fingerprint"]) == (len(text), mine, other)
            assert r["edited_sha256"] == hashlib.sha256((kept + new).encode()).hexdigest()
            assert (r["near_edited"], r["near_next"]) == (edit_fingerprints.likeness(mine, other), edit_fingerprints.likeness(mine, nxt))


def test_edit_distance_and_likeness_go_together(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    near = list(text)
    for _ in range(3):
        del near[rng.randrange(1000, 1900)]
    far = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    prints = [edit_fingerprints.fingerprint(t) for t in (text, "".join(near), far)]
    assert edit_fingerprints.likeness(prints[0], prints[1]) > 0.7 > 0.3 > edit_fingerprints.likeness(prints[0], prints[2])
    rows = spark.createDataFrame([(i, p) for i, p in enumerate([*prints, prints[0], ""])], "doc_id long, fingerprint string")
    found = {(r["a"], r["b"]) for r in edit_fingerprints.near_copies(rows, 0.7).collect()}
    assert {(0, 1), (0, 3)} <= found and not any(2 in pair for pair in found)


def test_suffix_order_and_prefixes(monkeypatch):
    rng = random.Random(9)
    for round_ in range(200):
        monkeypatch.setattr(induced_sort, "MOST_BUCKETS", rng.choice([0, 2, 1000]))
        if round_ >= 100:
            monkeypatch.setattr(induced_sort, "BATCH", 3)
            monkeypatch.setattr(induced_sort.Store.__init__, "__defaults__", (50,))
        text = [rng.randint(1, rng.choice([1, 2, 5])) for _ in range(rng.randrange(40))] + [0]
        most = rng.choice([1, 3, 100])
        order = sorted(range(len(text)), key=lambda i: text[i:])
        shared = [0] + [min(most, next(k for k in range(len(text)) if text[a + k] != text[b + k])) for a, b in itertools.pairwise(order)]
        found = induced_sort.suffix_order(np.array(text), most)
        assert (found[0].tolist(), found[1].tolist()) == (order, shared)


def test_suffix_dedup_equals_brute_force(spark, docs, texts):
    repeat = "".join(random.Random(1).choice("abcdefghij ") for _ in range(260))
    more = {10**6: "x" * 1000, 10**6 + 1: "", 10**6 + 2: None, 10**6 + 3: "start " + repeat + " é " + repeat[:200], 10**6 + 4: repeat[30:229], 10**6 + 5: repeat[59:259] + "!"}
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(more.items()), "doc_id long, text string"))
    raw = {i: (t or "").encode() for i, t in (texts | more).items()}
    seen = Counter(b[p : p + 200] for b in raw.values() for p in range(len(b) - 199))
    rows = {r["doc_id"]: r for r in suffix_dedup.suffix_digest(df).collect()}
    assert len(rows) == len(raw)
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = True
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        runs = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(b), int(gone.sum()), runs)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def url_by_hand(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_urls_rules_and_model(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    more = [None, "", "no scheme", "HTTP://Sub.Example.NET/en/x?y#z", "ftp://example.com/de/", "http://net", "http://a.net?x/", "x://org/fr/", "http://notexample.net/en/", "http://É.org/fr/a"]
    frame = pages.select("page_id", "url").union(spark.createDataFrame([(10**6 + i, u) for i, u in enumerate(more)], "page_id long, url string"))
    given = {r["page_id"]: r["url"] for r in frame.collect()}
    rows = urls.judge(frame).collect()
    assert len(rows) == len(given)
    for r in rows:
        host, path, rule, verdict = url_by_hand(given[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") and verdict in (None, r["verdict"])
    assert {r["verdict"] for r in urls.judge(frame.where("page_id = 1000000")).collect()} == {"allow"}


def test_url_model_equals_brute_force(spark):
    from math import log

    data = [("aab", "allow"), ("abb", "allow"), ("bba", "block"), ("bbb", "block")]
    df = spark.createDataFrame([(u, v, False) for u, v in data] + [("abab", None, False), ("", None, False)], "url string, verdict string, calibrates boolean")
    got = {r["url"]: r["score"] for r in urls.scores(df).collect()}

    def grams(url):
        padded = "\x02\x02\x02" + url
        return [padded[i : i + 4] for i in range(len(url))]

    counts = {v: Counter(g for u, w in data if w == v for g in grams(u)) for v in ("allow", "block")}

    def chance(gram, v):
        p = 1 / urls.ALPHABET
        for order in range(4):
            key, context = gram[-order - 1 :], gram[-order - 1 : -1]
            own = Counter()
            for g, n in counts[v].items():
                if g[-order - 1 : -1] == context:
                    own[g[-1]] += n
            if own:
                p = (own[key[-1]] + len(own) * p) / (sum(own.values()) + len(own))
        return p

    want = [log(chance(g, "allow")) - log(chance(g, "block")) for g in grams("abab")]
    assert got["abab"] == pytest.approx(sum(want) / 4, abs=1e-8) and got[""] == 0.0
