"""Token ids of whole texts with a public byte-level BPE, one lookup per distinct word.

Byte-level BPE never merges across a single space or line feed between two non-blanks, so a text is
the sequence of its words, each with the space or line feed before it. A word of plain characters falls further
into runs of letters, digits or signs, which the vocabulary's own pattern never joins. Ids of
words and runs are looked up in tables that the task fills through the tokenizers library. Arrow
numbers the words of many texts at once, together with those that are known.

A special token that a text spells out ('<|endoftext|>') is its own id with ``special_ids``, as the
library has it by default, and plain text without.
"""

import itertools
import os
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Words kept per task before those that came once leave the lookup tables; bounds their memory.
CACHED_WORDS = 400_000

#: Every blank of Unicode besides the space and the line feed.
OTHER_BLANKS = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))

INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
RUN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]++|[0-9]++|(?<=[!-ɏ])\n(?=[!-ɏ])|[!-&(-/:-@\[-`{-~]++")
LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]++")
LETTERS_THEN_SIGNS = re.compile(r"(\n{0,2}+)([A-Za-zÀ-ÖØ-öø-ɏ]++)([!-&(-/:-@\[-`{-~]*+)")
PLAIN = re.compile(f"(?:{RUN.pattern})++")

#: Stands before the first word of a text, which has no space before it; no other word begins with it.
FIRST = "\n\n"


#: How the byte-level vocabulary writes bytes: printable ones as they are, others from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}


class Signs(dict):
    """How the vocabulary writes a character, kept per character."""

    def __missing__(self, character: str) -> str:
        self[character] = signs = character.encode().decode("latin-1").translate(BYTE_SIGNS)
        return signs


SIGNS = Signs()


def is_plain(text: str) -> bool:
    """Single spaces and line feeds between non-blanks are its only blanks."""
    if text[0] in " \n" or text[-1] in " \n" or any(b in text for b in OTHER_BLANKS):
        return False
    return not ("  " in text or " \n" in text or "\n " in text or "\n\n" in text)


def spaced(text: str) -> str:
    """A plain text whose words end at a space each: a line feed stays with the word behind it."""
    return FIRST + text.replace("\n", " \n")


def words_of(text: str) -> list[str]:
    """Cut at the blanks that stand between two non-blanks; the first word is marked."""
    if is_plain(text):
        return spaced(text).split(" ")
    words = INNER_SPACE.split(text)
    words[0] = FIRST + words[0]
    return words


def word_lists(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in one array, and the number of words of each text."""
    filled = [t for t in texts if t]
    if all(map(is_plain, filled)):
        lists = pc.split_pattern(pa.array(list(map(spaced, filled)), pa.string()), " ")
        words, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    else:
        cut = [words_of(t) for t in filled]
        words, sizes = pa.array(list(itertools.chain.from_iterable(cut)), pa.string()), [len(c) for c in cut]
    count = np.zeros(len(texts), np.int64)
    count[[i for i, t in enumerate(texts) if t]] = sizes
    return words, count


class WordTokenizer:
    """Ids of many texts as one flat array; equal to encoding each text by itself."""

    def __init__(self, path: str = VOCABULARY, cached_words: int = CACHED_WORDS, special_ids: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_ids
        added = self.tokenizer.get_added_tokens_decoder() if special_ids else {}
        if any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added.values()):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.special = {t.content: i for i, t in added.items()}
        # The longest of those that begin at one place counts.
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))))
        self.merges = self.tokenizer.model
        self.cached_words = cached_words
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.seen = np.zeros(0, np.int64)
        self.runs: dict[str, list[int]] = {}
        self.flat = np.zeros(1 << 20, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def make_room(self) -> None:
        """Forget the words that came once, or all if that leaves more than half of the room."""
        often = self.seen > 1
        if 2 * int(often.sum()) > self.cached_words:
            return self.clear()
        sizes = np.diff(self.starts)
        ids = self.flat[: self.starts[-1]][np.repeat(often, sizes)]
        self.known, starts = self.known.filter(pa.array(often)), np.cumsum(sizes[often])
        self.seen = np.zeros(len(self.known), np.int64)
        self.runs = {}
        self.flat = np.zeros(max(1 << 20, len(ids)), np.uint32)
        self.flat[: len(ids)] = ids
        self.starts = np.concatenate([np.zeros(1, np.int64), starts])

    def run_ids(self, run: str) -> list[int]:
        """Ids of one run of letters, digits or signs: nothing is left to cut before the merges."""
        if run.isascii():
            signs = run.replace(" ", "Ġ").replace("\n", "Ċ")
        else:
            signs = "".join([SIGNS[c] for c in run])
        return [t.id for t in self.merges.tokenize(signs)]

    def kept_run_ids(self, run: str) -> list[int]:
        if (ids := self.runs.get(run)) is None:
            ids = self.runs[run] = self.run_ids(run)
        return ids

    def word_ids(self, word: str) -> list[int]:
        if LETTERS.fullmatch(word):
            return self.run_ids(" " + word)
        text = word.removeprefix(FIRST) if word[:1] == "\n" else " " + word
        body = text.removeprefix(" ")
        if PLAIN.fullmatch(body):
            runs = RUN.findall(body)
            if body is not text:
                runs[0] = " " + runs[0]
            return [i for run in runs for i in (self.kept_run_ids(run) if len(run) < 3 else self.run_ids(run))]
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, words: list[str]) -> None:
        """Ids of new words, in the order of their numbers."""
        merge, letters_then_signs, line_feed = self.merges.tokenize, LETTERS_THEN_SIGNS.fullmatch, self.run_ids("\n")
        ids: list[int] = []
        ends: list[int] = []
        for word in words:
            if found := letters_then_signs(word):
                before, letters, signs = found.groups()
                if before == "\n":
                    ids += line_feed
                if not letters.isascii():
                    letters = "".join([SIGNS[c] for c in letters])
                ids += [t.id for t in merge(letters if before else "Ġ" + letters)]
                if signs:
                    ids += self.kept_run_ids(signs)
            else:
                ids += self.word_ids(word)
            ends.append(len(ids))
        first = int(self.starts[-1])
        while first + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[first : first + len(ids)] = ids
        self.starts = np.concatenate([self.starts, np.array(ends, np.int64) + first])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` in one array, and the number of ids of each text."""
        if not any(s in t for s in self.special for t in texts):
            return self.encode_parts(texts)
        # Parts between special tokens are texts of their own; each but a text's last ends with an id.
        parts = [self.cut.split(t) for t in texts]
        ends = [self.special[s] for t in texts for s in self.cut.findall(t)]
        flat, count = self.encode_parts([p for some in parts for p in some])
        size = np.array([len(some) for some in parts])
        first = np.cumsum(size) - size
        inner = np.ones(len(count), bool)
        inner[first + size - 1] = False
        return np.insert(flat, np.cumsum(count)[inner], ends), np.add.reduceat(count, first) + size - 1

    def encode_parts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` for texts without special tokens."""
        if len(self.known) > self.cached_words:
            self.make_room()
        words, count = word_lists(texts)
        # Known words come first, so they keep their numbers and new ones follow.
        found = pa.concat_arrays([self.known, words]).dictionary_encode()
        word = found.indices.to_numpy()[len(self.known) :]
        if new := found.dictionary[len(self.known) :].to_numpy(zero_copy_only=False).tolist():
            self.learn(new)
            self.known = found.dictionary
        self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)]) + np.bincount(word, minlength=len(self.known))
        size = (self.starts[1:] - self.starts[:-1])[word]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        place = np.repeat(self.starts[word] - (ends - size), size) + np.arange(total)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        return self.flat[place], np.diff(bounds)


@lru_cache(maxsize=2)
def word_tokenizer(path: str = VOCABULARY, special_ids: bool = False) -> WordTokenizer:
    """The tokenizer of this process: tasks that follow each other in a worker share its words."""
    return WordTokenizer(path, special_ids=special_ids)
