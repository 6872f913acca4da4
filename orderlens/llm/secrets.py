"""Secret scans over a trigram index.

Every rule is a regular expression. Its syntax tree gives a Boolean query over trigrams that any
match must contain (Cox, "Regular Expression Matching with a Trigram Index", 2012). Documents are
indexed in segments, an Arrow batch each: a posting list per trigram that some rule asks for,
which bounds the index by the rules and not by the text. Queries intersect and unite posting
lists; only the candidates of a rule are scanned by its expression. A rule without mandatory
trigrams scans every text. Text and trigrams are folded to lower case (A-Z), which only widens
the candidates.

Defined results: a null text is empty and has no spans; repeated rows are scanned each; an empty
table gives no rows; other columns are ignored.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.tables import in_slices

BLANK = "\\x20"


@dataclass(frozen=True)
class Rule:
    """``least`` is the least length of ``group``; shorter matches are dropped without another try."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    flags: int = re.ASCII


# The three kinds that every scan reports, then well-known key formats.
BASE = [
    Rule("assign", rf"(password|passwd|secret|token|api_?key)[\"']?{BLANK}*[:=]{BLANK}*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, re.ASCII | re.IGNORECASE),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]
FORMATS = [
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]

# ---- trigram queries -------------------------------------------------------------------------
# A query is True (no condition), a trigram, or ("and" | "or", parts).

#: An exact set of strings larger than this is turned into a query of its trigrams.
MOST_STRINGS = 64


def both(op: str, parts: list):
    """Join queries; True drops out of an "and" and swallows an "or"."""
    if op == "or" and any(p is True for p in parts):
        return True
    parts = [*dict.fromkeys(p for p in parts if p is not True)]
    return True if not parts else parts[0] if len(parts) == 1 else (op, tuple(parts))


def of_strings(strings: set[str]):
    """Some of the strings occurs: its trigrams do."""
    return both("or", [both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def fold(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def class_strings(items: list) -> set[str] | None:
    """The characters of a class if they are few, else None."""
    found: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            found.add(fold(chr(value)))
        elif op is C.RANGE and value[1] - value[0] < 16:
            found |= {fold(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def walk(nodes) -> tuple[set[str] | None, object]:
    """(all strings the nodes match, if few; the query that any match meets)."""
    strings, queries = {""}, []

    def cut() -> None:
        nonlocal strings
        queries.append(of_strings(strings))
        strings = {""}

    exact = True
    for op, value in nodes:
        query = True
        if op is C.LITERAL:
            inner = {fold(chr(value))}
        elif op is C.IN:
            inner = class_strings(value)
        elif op is C.SUBPATTERN:
            inner, query = walk(value[3])
        elif op is C.BRANCH:
            branches = [walk(b) for b in value[1]]
            inner = set().union(*(s for s, _ in branches)) if all(s is not None for s, _ in branches) else None
            query = both("or", [q for _, q in branches])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, body = value
            inner, query = walk(body)
            if (low, high) == (0, 1) and inner is not None:
                inner, query = inner | {""}, True
            else:
                inner, query = (inner if low == high == 1 else None), (query if low else True)
        elif op is C.AT:
            continue
        else:
            inner = None
        queries.append(query)
        if inner is not None and len(strings) * len(inner) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in inner}
        else:
            cut()
            exact = False
            if inner is not None:
                strings = inner
    total = both("and", [*queries, of_strings(strings)])
    return (strings if exact else None), total


def trigram_query(rule: Rule):
    return walk(parser.parse(rule.pattern, rule.flags))[1]


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


# ---- segments --------------------------------------------------------------------------------


class Segment:
    """Posting lists (document numbers, ascending) of the asked trigrams over some texts."""

    def __init__(self, texts: list[bytes], table: np.ndarray, known: dict[bytes, int]):
        raw = np.frombuffer(b"\0\0\0".join(texts) + b"\0\0\0", np.uint8)
        raw = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint32)
        ends = np.cumsum([len(t) + 3 for t in texts])
        number = table[(raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]]
        at = np.flatnonzero(number)
        pairs = np.unique((number[at].astype(np.int64) << 32) | np.searchsorted(ends, at, side="right"))
        self.size, self.known = len(texts), known
        bounds = np.searchsorted(pairs >> 32, np.arange(len(known) + 2))
        self.postings = [pairs[a:b] & 0xFFFFFFFF for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def find(self, query) -> np.ndarray:
        if query is True:
            return np.arange(self.size)
        if isinstance(query, str):
            # A trigram with characters of several bytes: the byte trigrams of its spelling.
            code = query.encode()
            lists = [self.postings[self.known[code[i : i + 3]]] for i in range(len(code) - 2)]
            return intersect(lists)
        found = [self.find(q) for q in query[1]]
        return intersect(found) if query[0] == "and" else np.unique(np.concatenate(found))


def intersect(lists: list[np.ndarray]) -> np.ndarray:
    lists = sorted(lists, key=len)
    out = lists[0]
    for other in lists[1:]:
        if not len(out):
            break
        out = np.intersect1d(out, other, assume_unique=True)
    return out


def scan_secrets(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, spans: array of (kind, start, end) in code points, by start, then rule order."""
    rules = rules if rules is not None else BASE + FORMATS
    queries = [trigram_query(r) for r in rules]
    known = sorted({t.encode()[i : i + 3] for q in queries for t in trigrams_of(q) for i in range(len(t.encode()) - 2)})
    numbers = {t: i + 1 for i, t in enumerate(known)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 24, np.uint16)
        for code, number in numbers.items():
            table[int.from_bytes(code, "big")] = number
        compiled = [re.compile(r.pattern, r.flags) for r in rules]
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans: list[list[tuple]] = [[] for _ in texts]
            for low, high in in_slices(texts):
                segment = Segment([t.encode() for t in texts[low:high]], table, numbers)
                for order, (rule, query, find) in enumerate(zip(rules, queries, compiled, strict=True)):
                    for i in segment.find(query):
                        for m in find.finditer(texts[low + i]):
                            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                                spans[low + i].append((m.start(), order, m.end()))
            out = [[{"kind": rules[o].kind, "start": a, "end": b} for a, o, b in sorted(s)] for s in spans]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind string, start long, end long>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, schema)




def joined_spans(spans, kinds: list[str] | None = None):
    """Spans as ``kind:start:end``, comma-joined, of all kinds or of those named."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def kind_count(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def secret_digest(docs: DataFrame) -> DataFrame:
    spans, base = F.col("spans"), [r.kind for r in BASE]
    return scan_secrets(docs).select(
        "doc_id",
        *(kind_count(spans, kind) for kind in base),
        F.sha2(joined_spans(spans, base), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )
