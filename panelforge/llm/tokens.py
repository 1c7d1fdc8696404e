"""Token ids by the tokenizers library, a word at a time.

The library spends most of its time on words it has met before.  Here Arrow splits
texts at white space, which no word holds, and finds the different chunks of some
texts together.  Each of these is brought into the vocabulary's normal form and cut
by its word pattern, words not met before go through the library together, and the
others come from memory.  Arrow then puts the chunks' ids in the texts' order.

Python and the library have Unicode tables of their own.  Only texts of plain
characters are cut here: those that all tables treat alike and that never change
beside others (see ``plain_characters``).  Any other text goes through the library
whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a task remembers, about 0.2 KB each.  Once half of them are new, those
#: not met since the last time that happened are forgotten.
REMEMBERED = 600_000

#: Bytes of text that are split together; a longer text is split alone.
TOGETHER = 4_000_000

#: White space to Arrow or Python that is none to word patterns.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def plain_characters() -> list[int]:
    """The plain characters, ASCII but ``SEPARATORS`` included, as code points.

    Plain beyond ASCII are letters, numbers, signs and blanks of the first plane
    that were assigned by Unicode 3.2 and have kept their category, are their own
    NFC form, have one lower-case character of the same kind, and do not combine
    with neighbours (no marks, no single Hangul jamo)."""
    old = unicodedata.ucd_3_2_0

    def steady(c):
        kind = unicodedata.category(c)
        return kind == old.category(c) and kind[0] in "LNPSZ" \
            and unicodedata.normalize("NFC", c) == c == unicodedata.normalize("NFC", c + "a")[0] \
            and not unicodedata.combining(c) and not 0x1100 <= ord(c) <= 0x11FF

    def plain(c):
        low = c.lower()
        return len(low) == 1 and steady(c) and steady(low) and low.lower() == low

    return [*(p for p in range(0x80) if chr(p) not in SEPARATORS),
            *(p for p in range(0x80, 0x10000) if plain(chr(p)))]


def char_class(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    at = np.array(points)
    first = np.flatnonzero(np.r_[True, np.diff(at) > 1])
    last = np.r_[first[1:], len(at)] - 1
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(at[first], at[last]))


def plain_pattern(pattern: str, plain: list[int]) -> str:
    """A word pattern for texts of plain characters, with its classes of letters,
    numbers and white space written out."""
    kind = {p: unicodedata.category(chr(p))[0] for p in plain}
    blank = {9, 10, 11, 12, 13, *(p for p in plain if kind[p] == "Z")}
    for name, some in ((r"\p{L}", [p for p in plain if kind[p] == "L"]),
                       (r"\p{N}", [p for p in plain if kind[p] == "N"]),
                       (r"\s", sorted(blank))):
        pattern = pattern.replace(name, char_class(some))
    return pattern


class WordTokenizer:
    """A vocabulary whose last token of a word is marked (``end_of_word_suffix``)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pre = (spec["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or not model["end_of_word_suffix"] \
                or pre["behavior"] != "Removed" or not pre["invert"]:
            raise ValueError(f"{path}: not a vocabulary of lower-case words")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = True  # words never hold them whole
        plain = plain_characters()
        self.words = re.compile(plain_pattern(pre["pattern"]["Regex"], plain))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        ends = model["end_of_word_suffix"]
        self.is_end = np.zeros(max(model["vocab"].values()) + 1 + len(self.special), bool)
        self.is_end[[i for t, i in model["vocab"].items() if t.endswith(ends)]] = True
        self.rare = re.compile(f"[^{char_class(plain)}]")
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _cut(self, chunks: list[str]) -> tuple[list[str], list[int]]:
        """Words of all chunks in turn, and where those of each chunk end."""
        # plain characters are in normal form; lower case goes one character at
        # a time: a final sigma is a sigma like any other
        low = "\n".join(chunks).replace("Σ", "σ").lower().split("\n") if chunks else []
        words, ends = [], []
        for c, x in zip(chunks, low):
            if x.isalpha():
                words.append(x)
            elif "<" in c and self.cut.search(c):  # specials are cut before lower case
                for p in self.cut.split(c):
                    words += [p] if p in self.special else self._cut([p])[0]
            else:
                words += self.words.findall(x)
            ends.append(len(words))
        return words, ends

    def _whole(self, text: str) -> np.ndarray:
        """The library's ids; one text a call, as its encodings are large."""
        return np.array(self.library.encode_batch_fast(
            [text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> None:
        """Through the library in lines of words; the marked tokens end words."""
        for line in (words[i:i + 500] for i in range(0, len(words), 500)):
            ids = self._whole(" ".join(line))
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(line):  # a word that the library cuts once more
                for w in line:
                    self.known[w] = self._whole(w).tobytes()
                continue
            raw, start = ids.tobytes(), 0
            for w, end in zip(line, (4 * ends).tolist()):
                self.known[w] = raw[start:end]
                start = end

    def _is_rare(self, text: str) -> bool:
        if text.isascii():
            return any(c in text for c in SEPARATORS)
        return self.rare.search(text) is not None

    def _is_rare(self, text: str) -> bool:
        if text.isascii():
            return any(c in text for c in SEPARATORS)
        return self.rare.search(text) is not None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        rare = [i for i, t in enumerate(texts) if self._is_rare(t)]
        if not rare:
            return self._by_chunks(texts)
        self.library.encode_special_tokens = False
        whole = {i: self._whole(texts[i]) for i in rare}
        self.library.encode_special_tokens = True
        out = iter(self._by_chunks([t for i, t in enumerate(texts) if i not in whole]))
        return [whole[i] if i in whole else next(out) for i in range(len(texts))]

    def _by_chunks(self, texts: list[str]) -> list[np.ndarray]:
        split = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
        chunks = split.flatten().dictionary_encode()
        words, ends = self._cut(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        raw = self._by_words(words)
        sizes = np.cumsum([0, *map(len, raw)]) // 4
        ids = pa.LargeListArray.from_arrays(sizes[[0, *ends]], np.frombuffer(b"".join(raw), "<u4"))
        ids = ids.take(chunks.indices)
        at = ids.offsets.to_numpy()[split.offsets.to_numpy()].tolist()
        flat = ids.values.to_numpy()
        return [flat[s:e] for s, e in zip(at[:-1], at[1:])]

    def _by_words(self, words: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED // 2:
            self.before, self.known = self.known, {}
        known, before, new = self.known, self.before, []
        for w in set(words).difference(known):
            if w in before:
                known[w] = before[w]
            elif w in self.special:
                known[w] = np.array([self.special[w]], "<u4").tobytes()
            else:
                new.append(w)
        if new:
            self._learn(sorted(new))
        return [known[w] for w in words]


def steps(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``TOGETHER`` bytes of text."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    starts = np.flatnonzero(np.diff(ends // TOGETHER, prepend=-1)).tolist()
    for s, e in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(s, e - s)


@functools.lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One copy a worker process, whose task has one core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordTokenizer(path)
