"""Token ids of whole texts with a public tokenizer file, distinct words encoded once.

A text is cut at white space; the tokenizer's pre-tokenizer never joins
characters across white space, so ids of the chunks, in order, are the ids of
the text.  Each distinct chunk of a batch is encoded once.  Chunks of plain
lower-case Latin letters skip the tokenizer's normaliser and pattern (they
leave such a chunk as it is) and go straight to its merge model; everything
else runs through the whole tokenizer.  For tokenizer files with other
pre-tokenizers, every text runs through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# The pre-tokenizer pattern for which cutting at white space is exact.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_PLAIN = re.compile(r"[a-zß-öø-ÿ]+")
_LATIN = re.compile(r"[\u0000-ÿ]*")
# Separators that str.split cuts at and the tokenizer doesn't, and the start of a special token.
_WHOLE = re.compile("[\x1c-\x1f]|<\\|")
# A closing mark that does not follow a letter, so that it may be part of a longer run of marks.
_RUN = re.compile(r"(?<![a-zß-öø-ÿ])[,.](?=[ \n])")


def _chunks(text: str) -> list[str]:
    """The chunks of a text between white space; in Latin-1 texts lower-cased, closing marks being chunks of their own.

    The tokenizer lower-cases as well, and splits marks from letters, so the ids
    are the same, but there are far fewer distinct chunks."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text.split()
    low = text.lower()
    if _RUN.search(low):
        return low.split()
    return low.replace(", ", " , ").replace(". ", " . ").replace(",\n", " ,\n").replace(".\n", " .\n").split()


class _Words(dict):
    """word -> row of the id table; an unknown word gets the next row."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word):
        self[word] = row = len(self)
        self.new.append(word)
        return row


class Encoder:
    """Ids of texts as flat arrays.  ``max_words`` bounds the word table (about 250 bytes a word)."""

    def __init__(self, path: str, max_words: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.max_words = path, max_words
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        steps = (said.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (steps[0].get("pattern") or {}).get("Regex") == WORD_PATTERN and \
            said["model"].get("end_of_word_suffix") == "</w>"
        if self.by_word:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            size = self.tokenizer.get_vocab_size()
            self.ends = np.zeros(size, bool)
            for token, at in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.ends[at] = token.endswith("</w>")
            self._clear()

    def _clear(self):
        self.words, self.stems = _Words(), _Words()
        self.ids = np.zeros(0, np.uint32)
        none = np.zeros(0, np.int64)
        self.stem_starts, self.stem_lengths = none, none
        self.starts, self.lengths, self.marks = none, none, none  # marks: the id of a closing mark, else -1
        self.mark_ids = {m: self.tokenizer.encode(m, add_special_tokens=False).ids[0] for m in ",."}

    def _learn_stems(self):
        new, self.stems.new = self.stems.new, []
        flat, lengths = [], []
        for at in range(0, len(new), 2000):
            part = new[at:at + 2000]
            ids = np.array(self.model.encode(" ".join(part), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):  # a word without its end token: not seen, but then word by word
                each = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in part]
                ids, ends = np.array([x for e in each for x in e], np.uint32), np.cumsum([len(e) for e in each])
            flat.append(ids)
            lengths.append(np.diff(ends, prepend=0))
        if flat:
            lengths = np.concatenate(lengths)
            self.stem_starts = np.concatenate((self.stem_starts, len(self.ids) + np.cumsum(lengths) - lengths))
            self.stem_lengths = np.concatenate((self.stem_lengths, lengths))
            self.ids = np.concatenate((self.ids, *flat))

    def _learn(self):
        """Encode the words that came up since the last call."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        stems, marks, rest = [], [], []
        for word in new:
            low, mark = word.lower(), -1
            if low[-1] in ",.":
                mark, low = self.mark_ids[low[-1]], low[:-1]
            if (low.isascii() and low.isalpha()) or (_PLAIN.fullmatch(low) and _LATIN.fullmatch(word)):
                stems.append(self.stems[low])
                marks.append(mark)
            else:
                stems.append(-1)
                marks.append(-1)
                rest.append(word)
        self._learn_stems()
        stems = np.array(stems, np.int64)
        plain = stems >= 0
        starts, lengths = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        starts[plain], lengths[plain] = self.stem_starts[stems[plain]], self.stem_lengths[stems[plain]]
        others = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        counts = np.array([len(e) for e in others], np.int64)
        starts[~plain], lengths[~plain] = len(self.ids) + np.cumsum(counts) - counts, counts
        self.ids = np.concatenate((self.ids, np.array([x for e in others for x in e], np.uint32)))
        self.starts = np.concatenate((self.starts, starts))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.marks = np.concatenate((self.marks, np.array(marks, np.int64)))

    def _rows(self, texts: list[str]) -> list[np.ndarray | None]:
        if len(self.words) > self.max_words:
            self._clear()
        row = self.words.__getitem__
        out = [None if _WHOLE.search(t) else np.array(list(map(row, _chunks(t))), np.int64) for t in texts]
        self._learn()
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, as uint32; none for a null text."""
        texts = ["" if t is None else t for t in texts]
        if not self.by_word:
            return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out = []
        for text, rows in zip(texts, self._rows(texts)):
            if rows is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            marks = self.marks[rows]
            lengths = self.lengths[rows] + (marks >= 0)
            ends = np.cumsum(lengths)
            # place of each id: the start of its word plus its place in the word
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[rows] - (ends - lengths), lengths)
            marked = ends[marks >= 0] - 1
            at[marked] = 0
            ids = self.ids[at]
            ids[marked] = marks[marks >= 0]
            out.append(ids)
        return out

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """The number of ids of each text."""
        if not self.by_word:
            return np.array([len(e) for e in self.encode(texts)], np.int64)
        texts = ["" if t is None else t for t in texts]
        return np.array([len(self.tokenizer.encode(t, add_special_tokens=False).ids) if r is None
                         else int((self.lengths[r] + (self.marks[r] >= 0)).sum()) for t, r in zip(texts, self._rows(texts))], np.int64)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker, so that its word table serves many tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
