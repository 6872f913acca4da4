"""Personal data by weak supervision.

Candidate spans are labelled by four weak labelers: a regex labeler (the strict form of the kind), a
gazetteer labeler (issuers, calling codes, top-level domains, reserved ranges), a context labeler
(cue words before the span) and an edge labeler (what touches the span). Each votes yes, no or
abstains. Counts of vote patterns over all rows are enough to fit the rest: expectation-maximisation
estimates how reliable every labeler is and how likely every pattern is to be true, and a logistic
span classifier is trained on those probabilities. Spans of the four base kinds always stay; the
classifier decides about the loose kinds (local phone numbers, spelled-out addresses, US numbers).

Defined results: a null text is empty and has no spans; repeated rows are scanned each; without
loose candidates nothing is added; an empty table gives no rows; other columns are kept only by
``redact``.
"""

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.secrets import joined_spans, kind_count

# Kinds, cue words and ranges.
BASE = ["email", "ip", "card", "phone"]
LOOSE = ["local_phone", "spelled_email", "us_ssn"]
KINDS = BASE + LOOSE
DOMAINS = {"com", "net", "org", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at"}
CALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91")
CUES = {
    "email": r"mail|contact|write",
    "ip": r"\bip\b|host|server|address",
    "card": r"card|visa|master|amex|credit|pay",
    "phone": r"phone|tel|call|fax|mobile|cell|contact",
    "local_phone": r"phone|tel|call|fax|mobile|cell|contact",
    "spelled_email": r"mail|contact|write|reach",
    "us_ssn": r"\bssn\b|social|security",
}
AGAINST = re.compile(r"version|isbn|order|invoice|part|serial|item|page|\bv\.?\Z|#\s?\Z", re.IGNORECASE)
CONTEXT_CHARS = 32

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
SPELLED = re.compile(r"\b[A-Za-z0-9._-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63})+", re.ASCII)
US_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
CUE = {kind: re.compile(words, re.IGNORECASE) for kind, words in CUES.items()}


def luhn(digits: str) -> bool:
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(int(c) for c in digits[-1::-2]) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from the @ outwards: linear in the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def whole(digits: str, most: int) -> int:
    """The value of digits of any number, if it is at most ``most``; else ``most`` + 1."""
    significant = digits.lstrip("0")
    return min(most + 1, int(significant or 0)) if len(significant) <= len(str(most)) else most + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the four base kinds by kind, then start."""
    spans = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(whole(p, 255) <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((3, *m.span()))
    return spans


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the loose kinds that touch no base span."""
    found = []
    # Where a candidate ends, the base spans that begin before it are a prefix of this list; the farthest of their ends decides.
    begins, reach = zip(*sorted((a, b) for _, a, b in base), strict=True) if base else ((), ())
    reach = list(accumulate(reach, max))
    for number, (expression, mark) in enumerate(((LOCAL_PHONE, None), (SPELLED, "at"), (US_SSN, "-")), len(BASE)):
        if mark is None or mark in text:
            for m in expression.finditer(text):
                before = bisect_left(begins, m.end())
                if not before or reach[before - 1] <= m.start():
                    found.append((number, *m.span()))
    return found


def strict(kind: str, value: str, digits: str) -> int:
    if kind in ("email", "spelled_email"):
        return 1 if re.search(r"[A-Za-z]{2,}\Z", value) and ".." not in value else -1
    if kind == "ip":
        return -1 if any(len(p) > 1 and p[0] == "0" for p in value.split(".")) else 1
    if kind == "card":
        return 1 if len(digits) in (15, 16) else 0
    if kind == "us_ssn":
        return 1
    return 1 if 10 <= len(digits) <= 15 and value.count("(") == value.count(")") else -1


def gazetteer(kind: str, value: str, digits: str) -> int:
    if kind in ("email", "spelled_email"):
        return 1 if re.split(r"[^A-Za-z]", value)[-1].lower() in DOMAINS else 0
    if kind == "ip":
        return -1 if whole(value.split(".")[0], 255) in (0, 127, *range(224, 256)) else 1
    if kind == "card":
        return 1 if digits[0] in "3456" or 2221 <= int(digits[:4]) <= 2720 else -1
    if kind == "phone":
        return 1 if digits.startswith(CALLING) else 0
    if kind == "us_ssn":
        return -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" else 1
    return -1 if digits[0] in "01" or digits[3] in "01" else 1


def pattern(text: str, kind: int, start: int, end: int) -> int:
    """Kind, votes and length of a span as one number: all that the model sees of it."""
    name, value = KINDS[kind], text[start:end]
    digits = "".join(c for c in value if "0" <= c <= "9")
    before = text[max(0, start - CONTEXT_CHARS) : start]
    context = 1 if CUE[name].search(before) else -1 if AGAINST.search(before) else 0
    touches = (start and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    edge = -1 if touches else 1 if not start or text[start - 1].isspace() else 0
    code = kind
    for vote in (strict(name, value, digits), gazetteer(name, value, digits), context, edge):
        code = code * 3 + vote + 1
    return code * 4 + min(3, (end - start) // 8)


def unpack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind, votes, length class) of pattern numbers."""
    length, rest = codes % 4, codes // 4
    votes = np.stack([rest // 3**k % 3 - 1 for k in (3, 2, 1, 0)], axis=1)
    return rest // 81, votes, length


def expectation_maximisation(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 50):
    """(probability that each pattern is true, P(vote | class) of each labeler)."""
    truth = 1 / (1 + np.exp(-votes.sum(axis=1).astype(float)))
    table = np.zeros((votes.shape[1], 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - truth) * n, truth * n])
        log = np.zeros((2, len(n)))
        for k in range(len(KINDS)):
            own = kind == k
            log[:, own] = np.log((weight[:, own].sum(axis=1) + 1) / (n[own].sum() + 2))[:, None]
        for labeler in range(votes.shape[1]):
            for y in (0, 1):
                # A labeler is taken to be better than chance: a few pseudo-counts say so.
                hits = np.bincount(votes[:, labeler] + 1, weight[y], 3) + (np.array([1, 1, 4]) if y else np.array([4, 1, 1]))
                table[labeler, y] = hits / hits.sum()
                log[y] += np.log(table[labeler, y])[votes[:, labeler] + 1]
        truth = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return truth, table


def features(kind: np.ndarray, votes: np.ndarray, length: np.ndarray) -> np.ndarray:
    columns = [kind[:, None] == np.arange(len(KINDS)), votes == 1, votes == -1, length[:, None] == np.arange(4)]
    return np.concatenate([c.astype(float) for c in columns], axis=1)


def train_classifier(x: np.ndarray, truth: np.ndarray, n: np.ndarray, rounds: int = 40) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - truth)) + w
        bend = (x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame) -> frozenset[int]:
    """Patterns of the loose kinds that the trained classifier accepts.

    Only counts per pattern reach the driver: 7 kinds x 81 votes x 4 lengths at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text:
                    base = base_spans(text)
                    for span in base + loose_spans(text, base):
                        code = pattern(text, *span)
                        seen[code] = seen.get(code, 0) + 1
        columns = [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["code", "n"])

    counts = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    counts = counts.sort_values("code")
    codes, n = counts["code"].to_numpy(np.int64), counts["n"].to_numpy(float)
    if not len(codes):
        return frozenset()
    kind, votes, length = unpack(codes)
    truth, _ = expectation_maximisation(kind, votes, n)
    x = features(kind, votes, length)
    accepted = (x @ train_classifier(x, truth, n) >= 0) & (kind >= len(BASE))
    return frozenset(codes[accepted].tolist())


def spans_of(text: str, accepted: frozenset[int]) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return base + [s for s in loose_spans(text, base) if pattern(text, *s) in accepted] if text else []


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans: array of (kind, start, end) in code points, by kind, then start."""
    accepted = learn(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans_of(t or "", accepted)]
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind string, start long, end long>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, schema)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Replace spans by their kind in brackets; overlapping spans become one."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all columns stay, null text stays null."""
    accepted = learn(docs)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t and mask(t, spans_of(t, accepted)) for t in batch.column("text").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(rewrite, docs.schema)


def pii_digest(docs: DataFrame) -> DataFrame:
    spans = F.col("spans")
    return find_pii(docs).select(
        "doc_id",
        *(kind_count(spans, kind) for kind in BASE),
        F.sha2(joined_spans(spans, BASE), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )
