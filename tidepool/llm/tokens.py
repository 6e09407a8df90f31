"""Token ids of a public tokenizer, word by word.

The tokenizer never joins characters across white space, so a text's ids are
the ids of its blank-separated words, one after the other. Words repeat, and a
worker keeps the ids of those it has seen, up to a bound. New words of plain
Latin letters, digits and signs are cut into the tokenizer's own pieces here
and given to its merges many at a time; all others take its whole way.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Words that lower case and composition treat letter by letter, and the tokenizer's own split of a lower-cased one.
PLAIN = re.compile(r"[!-~\u00c0-\u024f]+")
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+|\n")
END = "</w>"

_OPEN: dict[str, "WordTokenizer"] = {}


def opened(path: str) -> "WordTokenizer":
    """This process's tokenizer for a file."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary; blanks and line ends stay."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return table | {10: "\n", 32: " "}


class WordTokenizer:
    def __init__(self, path: str, max_words: int = 600_000, together: int = 500):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.max_words, self.together = Tokenizer.from_file(path), max_words, together
        self.merges, self.letters = Tokenizer(self.tokenizer.model), byte_letters()
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(END)]] = True
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids, self.ends = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word): a piece ends with the id of an end-of-word token."""
        pieces = PIECE.findall("\n".join(words).lower())
        ends = np.array([p == "\n" for p in pieces])
        counts = np.diff(np.r_[-1, np.flatnonzero(ends), len(pieces)]) - 1
        text = " ".join(pieces).encode().decode("latin-1").translate(self.letters).split("\n")
        joined = [" ".join(text[i:i + self.together]) for i in range(0, len(text), self.together)]
        ids = np.concatenate([np.array(e.ids, dtype=np.int32) for e in self.merges.encode_batch_fast(joined, add_special_tokens=False)])
        at = np.r_[0, np.flatnonzero(self.is_end[ids]) + 1]
        return ids, np.diff(at[np.r_[0, np.cumsum(counts)]])

    def _learn(self, new: list[str]) -> None:
        plain = [w for w in new if PLAIN.fullmatch(w) and "<|" not in w]
        known = set(plain)
        other = [w for w in new if w not in known]
        ids, sizes = [], []
        if plain:
            got, size = self._plain(plain)
            ids.append(got)
            sizes.append(size)
        if other:
            got = [e.ids for e in self.tokenizer.encode_batch_fast(other, add_special_tokens=False)]
            ids.append(np.array([i for x in got for i in x], dtype=np.int32))
            sizes.append(np.array([len(x) for x in got], dtype=np.int64))
        self.slots.update(zip(plain + other, range(len(self.slots), len(self.slots) + len(new))))
        self.ids = np.concatenate([self.ids, *ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text among them)."""
        split = pc.ascii_split_whitespace(texts)
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.slots) > self.max_words:
            self._forget()
        if new := [w for w in distinct if w not in self.slots]:
            self._learn(new)
        slot = np.fromiter(map(self.slots.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        sizes = self.ends[slot + 1] - self.ends[slot]
        ends = np.r_[0, np.cumsum(sizes)]
        at = np.repeat(self.ends[slot] - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[at], ends[offsets[1:]]
