"""Toxicity of texts after noisy-channel restoration of disguised words.

Writers hide words behind look-alike characters (1d10t), separators (i.d.i.o.t,
i d i o t, id-iot) and repetition (idiooot).  Stretches of text that may be
disguised become lattices: each position offers the character itself, the
letters it may stand for, or nothing; a separator also offers the edge of a
word.  Viterbi decoding finds the likeliest path under a character language
model counted over the whole corpus.  The same model tells which neighbouring
short words are one word that was cut.  Words of the text, of the restored
stretches and of the joins are then scored by features learned from labels.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from sensorloom.llm.common import held_out
from sensorloom.llm.language import _letters

# Letters that a look-alike character may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¢": "c", "*": "aeiou",
}
SYMBOLS = 64  # 0: no letter; 1-26: a-z; the rest: other letters by code point

BEGINNINGS = (4, 5, 6)  # letters of the beginnings of words that count as features
THRESHOLD = 0.7  # texts with this score or more are predicted toxic

# Costs in nats of the steps of the channel.
READ_AS = -1.0  # a look-alike stands for a letter
KEEP_MARK = -9.0  # a look-alike is no letter
KEEP_END = -1.0  # a look-alike that is punctuation behind a word
DROP_REPEAT = -0.5  # a repetition of the letter before
DROP_MARK = -0.5  # a separator between letters
EDGE = -2.5  # the commonest separator of a stretch is the edge of a word
EDGE_OTHER = -0.5  # another separator of the stretch is
# Gains in nats from which two neighbouring words are read as one.
JOIN = 2.0  # words with a blank between
JOIN_MARK = -3.0  # words with another separator between
JOIN_KNOWN = -3.0  # words with a blank between that together are a learned word
EDGE_KNOWN = -6.0  # an edge of a learned word among spaced letters
PIECE = 7  # letters of each of the words, at most
MEMO = 50_000  # short stretches whose restoration a worker remembers
PART = 1 << 18  # characters that are looked at at a time
BASE = 0x9E3779B97F4A7C15  # of the hashes of words, odd
CELLS = 19  # bits of the tables of hashed evidence

_MARKS = re.escape("".join(LOOKALIKES))
_LETTER = r"[^\W\d_]"
_PUNCTUATION = "!|(*"
_SEPARATORS = " .-_*~"
# A token with one or two look-alikes before a letter or up to four behind the
# last one, a letter three times in a row, or three or more single letters with
# separators between them.
_TOKEN = re.compile(rf"[{_MARKS}]{{0,2}}{_LETTER}+(?:[{_MARKS}]+{_LETTER}+)*(?:[{_MARKS}]{{1,4}}(?!\w))?")
_ODD = re.compile(rf"[{_MARKS}]{_LETTER}|{_LETTER}[{_MARKS}]|({_LETTER})\1\1")
_SPACED = re.compile(rf"(?<!\w)(?:(?:{_LETTER}|[{_MARKS}])(?:[ .\-_*~]{{1,2}})){{2,}}(?:{_LETTER}|[{_MARKS}])(?!\w)")
_SPACED_HINT = re.compile(rf"(?<!\w)(?:{_LETTER}|[{_MARKS}])[ .\-_*~]{{1,2}}(?:{_LETTER}|[{_MARKS}])[ .\-_*~]")
_UNIT = re.compile(r"[ .\-_~]+|.", re.DOTALL)
_WORD = re.compile(rf"{_LETTER}+")
_EDGE = re.compile(rf"(?!{_LETTER}|[{_MARKS}]).", re.DOTALL)
_SEPARATES = np.array([chr(i) in _SEPARATORS for i in range(129)])  # by code point; the last stands for all above


@lru_cache(4096)
def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % (SYMBOLS - 27) if c.isalpha() else 0


def _codes(text: str) -> np.ndarray:
    """The code points of a text, as bytes where they fit."""
    try:
        return np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


_TABLES: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Two numbers for each code point, built once per process: the symbol of a lower-case character, and
    its kind: 1 for a letter of _WORD, 2 for a look-alike, 0 for all else."""
    if not _TABLES:
        codes = np.arange(0x110000)
        symbols = np.where(_letters(), np.where((codes >= 97) & (codes <= 122), codes - 96, 27 + codes % (SYMBOLS - 27)), 0)
        kinds = np.fromiter((chr(i).isalnum() and not chr(i).isdecimal() for i in range(0x110000)), np.uint8, 0x110000)
        kinds[[ord(c) for c in LOOKALIKES]] = 2
        _TABLES[:] = [symbols.astype(np.uint8), kinds]
    return _TABLES


def _taken(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    if codes.dtype == np.uint8:
        return np.frombuffer(codes.tobytes().translate(table[:256].tobytes()), np.uint8)
    return table[codes]


def _symbols_of(codes: np.ndarray) -> np.ndarray:
    """The symbol of each code point of a lower-case text."""
    return _taken(_tables()[0], codes)


def _kinds_of(codes: np.ndarray) -> np.ndarray:
    return _taken(_tables()[1], codes)


def _symbols(text: str) -> np.ndarray:
    return _symbols_of(_codes(text.lower())).astype(np.int32)


_POWERS: list[np.ndarray] = []


class _Hashed:
    """Hashes of any stretches of a sequence of code points, from running sums of code x BASE^place."""

    def __init__(self, codes: np.ndarray):
        if not _POWERS or len(_POWERS[0]) <= len(codes):
            n = max(PART + 1024, len(codes) + 1)
            _POWERS[:] = [np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base, np.uint64))))
                          for base in (BASE, pow(BASE, -1, 1 << 64))]
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _POWERS[0][:len(codes)], out=self.sums[1:])

    def cells(self, at: np.ndarray, to: np.ndarray) -> np.ndarray:
        """The cell of each stretch in a table of 2^CELLS."""
        h = (self.sums[to] - self.sums[at]) * _POWERS[1][at]
        return (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - CELLS)


def _table_of(words: list[str]) -> np.ndarray:
    """The cells of some words."""
    table = np.zeros(1 << CELLS, bool)
    for w in words:
        table[_Hashed(_codes(w)).cells(np.array([0]), np.array([len(w)]))] = True
    return table


def _small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that only a part is ever held as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _joined(texts: list[str | None], most: int = 1_000_000) -> Iterator[str]:
    """Texts joined by blanks, up to about ``most`` characters at a time; a longer text comes alone."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t or "") > most:
            yield "  ".join(part)
            part, size = [], 0
        if t:
            part.append(t)
            size += len(t)
    if part:
        yield "  ".join(part)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): how often each run of three symbols occurs in all texts.

    Counts are added up in each task and then over the tasks; a gram is three
    symbols of 64, so the result has at most 262,144 rows however large the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in _small(batches):
            for text in _joined(batch.column(0).to_pylist()):
                s = _symbols(text)
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3) if len(s) > 2 else 0
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])

    return docs.select("text").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class CharacterModel:
    """log P(symbol | the two before), from trigram counts backed off to bigrams and single symbols."""

    logp: np.ndarray
    seen: dict[tuple[str, float], str] = field(default_factory=dict, repr=False)  # restored stretches, at most MEMO
    rows: list[list[list[float]]] = field(default_factory=list, repr=False)  # logp as plain numbers, for the decoder

    @classmethod
    def of(cls, grams: list[tuple[int, int]]) -> CharacterModel:
        n3 = np.zeros(SYMBOLS ** 3)
        for gram, n in grams:
            n3[gram] = n
        n3 = n3.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        n2, n1 = n3.sum(0), n3.sum((0, 1))
        p1 = (n1 + 1) / (n1 + 1).sum()
        p2 = (n2 + 50 * p1) / (n2.sum(1, keepdims=True) + 50)
        return cls(np.log((n3 + 20 * p2[None]) / (n3.sum(2, keepdims=True) + 20)).astype(np.float32))


def restore(stretch: str, model: CharacterModel, edge: float = EDGE) -> str:
    """The likeliest letters behind a stretch of text (lower case), by Viterbi decoding of its lattice.

    ``edge`` is the cost of reading the commonest separator of the stretch as the edge of a word.

    A state is the last two symbols; its entry is the best log-probability and
    the path of output characters."""
    if (stretch, edge) in model.seen:
        return model.seen[stretch, edge]
    if not model.rows:
        model.rows[:] = model.logp.tolist()
    logp = model.rows
    states: dict[tuple[int, int], tuple[float, tuple | None, str]] = {(0, 0): (0.0, None, "")}
    before = ""
    units = _UNIT.findall(stretch)
    gaps = Counter(u for u in units if u[0] in _SEPARATORS and u not in LOOKALIKES).most_common(1)
    end = max((i for i, u in enumerate(units) if u.isalpha()), default=-1)
    for i, c in enumerate(units):
        options: list[tuple[str, float]] = []
        if c in LOOKALIKES:
            options = [(x, READ_AS) for x in LOOKALIKES[c]] + [(c, KEEP_END if i > end and c in _PUNCTUATION else KEEP_MARK)]
        elif c.isalpha():
            options = [(c, 0.0)]
        else:
            options = [("", DROP_MARK), (" ", edge if gaps and c == gaps[0][0] else EDGE_OTHER)]
        steps: dict[tuple[int, int], tuple[float, tuple | None, str]] = {}
        for (a, b), entry in states.items():
            score, last, row = entry[0], entry[2], logp[a][b]
            choices = options
            if end >= 0 and i > end and c in LOOKALIKES and last and not last.isalpha():
                choices = [(c, KEEP_END)]  # behind the end of the word
            if c == before and last == c and c.isalpha():
                choices = [*options, ("", DROP_REPEAT)]
            for out, cost in choices:
                if out:
                    s = _symbol(out)
                    state, new = (b, s), (score + cost + row[s], entry, out)
                else:
                    state, new = (a, b), (score + cost, entry[1], entry[2])
                if state not in steps or new[0] > steps[state][0]:
                    steps[state] = new
        states, before = steps, c
    best, best_score = None, -math.inf
    for (a, b), entry in states.items():
        total = entry[0] + logp[a][b][0]
        if total > best_score:
            best, best_score = entry, total
    out = []
    while best is not None:
        out.append(best[2])
        best = best[1]
    restored = "".join(reversed(out))
    if len(stretch) <= 24:
        if len(model.seen) >= MEMO:
            model.seen.clear()
        model.seen[stretch, edge] = restored
    return restored


def disguised(text: str) -> list[tuple[int, int]]:
    """(from, to) of the stretches of a lower-case text that may hide words."""
    found = []
    if _SPACED_HINT.search(text):
        found += [m.span() for m in _SPACED.finditer(text)]
    for at, to in _parts(text):
        codes = _codes(text[at:to])
        kinds = _kinds_of(codes)
        letter = kinds == 1
        odd = np.zeros(len(codes) + 1, bool)
        odd[1:-1] = kinds[:-1] + kinds[1:] == 3  # a letter and a look-alike
        if len(codes) > 2:
            odd[2:-1] |= letter[2:] & (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2])
        places = np.flatnonzero(odd)
        if not len(places):
            continue
        # runs of letters and look-alikes with an odd place: tokens do not cross their ends
        others = np.concatenate(([-1], np.flatnonzero(kinds == 0), [len(codes)]))
        for k in np.unique(np.searchsorted(others, places)).tolist():
            end = at + int(others[k])
            for m in _TOKEN.finditer(text, at + int(others[k - 1]) + 1):
                if m.start() >= end:
                    break
                if _ODD.search(m.group()):
                    found.append(m.span())
    return found


def _parts(text: str) -> Iterator[tuple[int, int]]:
    """(from, to) of parts of about PART characters that end where neither a letter nor a look-alike follows."""
    at = 0
    while at < len(text):
        to = len(text)
        if to - at > PART:
            edge = _EDGE.search(text, at + PART)
            to = edge.start() if edge else to
        yield at, to
        at = to


def _join_places(part: str, model: CharacterModel) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where neighbouring short words of a part may be one word: the places without a letter (from -1 to the
    part's length), the numbers of those places at which words join, whether each is likely, and the symbols."""
    codes = _codes(part)
    x = np.zeros(len(codes) + 5, np.int32)
    x[2:-3] = _symbols_of(codes)
    gaps = np.flatnonzero(x[1:-2] == 0) - 1
    left, right = gaps[1:-1] - gaps[:-2] - 1, gaps[2:] - gaps[1:-1] - 1
    k = np.flatnonzero((left > 0) & (right > 0) & (left <= PIECE) & (right <= PIECE) & (left + right > 2))
    k = k[_SEPARATES[np.minimum(codes[gaps[k + 1]], len(_SEPARATES) - 1)]]
    place = gaps[k + 1] + 2
    a, b, c, d = x[place - 2], x[place - 1], x[place + 1], x[place + 2]
    p = model.logp.reshape(-1)
    ab, bc, cd = a * SYMBOLS + b, b * SYMBOLS + c, c * SYMBOLS + d
    gain = p[ab * SYMBOLS + c] + p[bc * SYMBOLS + d] - p[ab * SYMBOLS] - p[b * SYMBOLS ** 2 + c] - p[cd]
    blank = codes[place - 2] == 32
    likely = gain > np.where(blank, JOIN, JOIN_MARK)
    some = likely | (blank & (gain > JOIN_KNOWN))
    return gaps, k[some], likely[some], codes


def joins(text: str, model: CharacterModel, whole: np.ndarray | None = None, begins: np.ndarray | None = None) -> list[tuple[str, bool]]:
    """(word, likely) of two or three neighbouring short words of a lower-case text with one separator between them.

    The gain of a join is what the log-probability of the text changes by if
    the separator goes; joins below JOIN that are not worse than JOIN_KNOWN
    are not likely by themselves.  With tables of hashed words, and of their
    beginnings, only the joins that the tables hold are cut out of the text: a
    likely one by its word or beginning, another by its word."""
    out = []
    for at in range(0, len(text), PART):
        part = text[max(0, at - 4 * PIECE):at + PART]
        gaps, k, likely, codes = _join_places(part, model)
        if not len(k):
            continue
        # a join of three words follows on one of two at the gap before
        after = np.flatnonzero(k[1:] == k[:-1] + 1) + 1
        first = np.concatenate((k, k[after] - 1))
        last = np.concatenate((k + 2, k[after] + 2))
        sure = np.concatenate((likely, likely[after] & likely[after - 1]))
        if whole is not None:
            # without the other characters, the letters of a join are one stretch
            letters = np.ones(len(codes), bool)
            letters[gaps[1:-1]] = False
            hashed = _Hashed(codes[letters].astype(np.uint64))
            start, end = gaps[first] + 1 - first, gaps[last] - last + 1
            hit = whole[hashed.cells(start, end)]
            for n in BEGINNINGS:
                longer = np.flatnonzero(sure & ~hit & (end - start > n))
                hit[longer] = begins[hashed.cells(start[longer], start[longer] + n)]
            first, last, sure = first[hit], last[hit], sure[hit]
        for i, j, likely_ in zip(first.tolist(), last.tolist(), sure.tolist()):
            pieces = [part[int(gaps[g]) + 1:int(gaps[g + 1])] for g in range(i, j)]
            out.append(("".join(pieces), likely_))
    return out


def _spaced_words(letters: str, model: CharacterModel, known: dict[str, float]) -> list[str]:
    """The learned words of three letters or more among the letters of a spaced stretch, whose edges the model allows."""
    p, out = model.logp, []
    x = [0, 0, *(_symbol(c) for c in letters), 0, 0]
    gain = [0.0] * (len(letters) + 1)
    for k in range(1, len(letters)):
        a, b, c, d = x[k:k + 4]
        gain[k] = float(p[a, b, 0] + p[b, 0, c] + p[0, c, d] - p[a, b, c] - p[b, c, d])
    edges = [k for k, g in enumerate(gain) if g >= EDGE_KNOWN]
    for i in edges:
        out += [letters[i:k] for k in edges if 3 <= k - i <= 20 and letters[i:k] in known]
    return out


def _decoded(text: str, model: CharacterModel, known: dict[str, float]) -> tuple[list[str], str]:
    """Words behind the disguised stretches of a lower-case text, and the text with the stretches restored."""
    out, plain, end = [], [], 0
    for a, b in disguised(text):
        stretch = text[a:b]
        restored = restore(stretch, model)
        own = set(_WORD.findall(stretch))
        found = _WORD.findall(restored)
        if known and _SPACED.fullmatch(stretch):
            found += _spaced_words("".join(_WORD.findall(restore(stretch, model, math.inf))), model, known)
        out += [w for w in dict.fromkeys(found) if w not in own]
        if a >= end:  # stretches of both kinds may overlap
            plain += [text[end:a], restored]
            end = b
    plain.append(text[end:])
    return out, "".join(plain)


def restored_words(text: str, model: CharacterModel) -> list[str]:
    """Words behind the disguised stretches of a lower-case text."""
    return _decoded(text, model, {})[0]


def words_for_learning(text: str, model: CharacterModel) -> set[str]:
    """Words of a lower-case text, those behind its disguised stretches, and the likely joins."""
    restored, plain = _decoded(text, model, {})
    return {*_WORD.findall(text), *restored, *(w for w, likely in joins(plain, model) if likely)}


def word_features(word: str) -> list[str]:
    """The word and its beginnings of four to six letters (marked, so that they differ from words)."""
    return [word, *(word[:k] + "~" for k in BEGINNINGS if len(word) > k)]


@dataclass
class ToxicityModel:
    characters: CharacterModel
    evidence: dict[str, float] = field(default_factory=dict)  # feature -> lower bound of its share of toxic texts
    slope: float = 0.0
    bias: float = -3.0
    seen: dict[str, float] = field(default_factory=dict, repr=False)  # strongest evidence of words, at most 4 MEMO
    cells: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)  # hashed evidence

    def of_word(self, word: str) -> float:
        p = self.seen.get(word)
        if p is None:
            if len(self.seen) >= 4 * MEMO:
                self.seen.clear()
            p = self.seen[word] = max(self.evidence.get(f, 0.0) for f in word_features(word))
        return p

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """The cells of the words and of the beginnings for which there is evidence."""
        if self.cells is None:
            self.cells = (_table_of([f for f in self.evidence if not f.endswith("~")]),
                          _table_of([f[:-1] for f in self.evidence if f.endswith("~")]))
        return self.cells

    def telling(self, text: str) -> set[str]:
        """The words of a lower-case text for which there is evidence; only words whose hash has it are cut out."""
        whole, begins = self.tables()
        found: set[str] = set()
        for at, to in _parts(text):
            codes = _codes(text[at:to])
            edges = np.flatnonzero(np.diff(_kinds_of(codes) == 1, prepend=False, append=False))
            start, end = edges[::2], edges[1::2]
            hashed = _Hashed(codes.astype(np.uint64))
            hit = whole[hashed.cells(start, end)]
            for n in BEGINNINGS:
                longer = np.flatnonzero(~hit & (end - start > n))
                hit[longer] = begins[hashed.cells(start[longer], start[longer] + n)]
            found.update(text[at + a:at + b] for a, b in zip(start[hit].tolist(), end[hit].tolist()))
        return {w for w in found if self.of_word(w)}

    def strength(self, text: str | None) -> tuple[float, list[str]]:
        """Strongest evidence in a text, and the words that its restoration added (joins only if there is evidence for them)."""
        low = (text or "").lower()
        known = self.evidence
        restored, plain = _decoded(low, self.characters, known)
        words = {*restored, *(self.telling(low) if known else ())}
        most = max(map(self.of_word, words), default=0.0)
        for w, likely in joins(plain, self.characters, *self.tables()) if known else ():
            p = self.of_word(w) if likely else known.get(w, 0.0)
            if p and w not in words:
                restored.append(w)
                words.add(w)
                most = max(most, p)
        return most, restored

    def score(self, strength: float) -> float:
        return 1 / (1 + math.exp(-(self.slope * strength + self.bias)))


def _lower_bound(toxic: np.ndarray, all_: np.ndarray, z: float) -> np.ndarray:
    """Wilson's lower bound of a share."""
    share = toxic / all_
    return (share + z * z / (2 * all_) - z * np.sqrt(share * (1 - share) / all_ + z * z / (4 * all_ * all_))) / (1 + z * z / all_)


def fit(docs: DataFrame, labels: DataFrame, max_train_docs: int = 20_000, min_docs: int = 3, z: float = 2.0) -> ToxicityModel:
    """Learn the character model from all texts and the evidence from at most ``max_train_docs`` labelled rows.

    Labels of held-out rows are never read.  A feature counts if at least
    ``min_docs`` toxic texts have it and the lower bound of its share of toxic
    texts exceeds that of all; a one-dimensional logistic fit turns the
    strongest evidence of a text into its score."""
    model = ToxicityModel(CharacterModel.of([(r["gram"], r["n"]) for r in trigram_counts(docs).collect()]))
    learn = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_docs)
    # at most max_train_docs rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(learn), "doc_id").select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every, n_toxic, n = Counter(), Counter(), 0, 0
        for batch in _small(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                low = (text or "").lower()
                own = {f for w in words_for_learning(low, model.characters) for f in word_features(w)}
                every.update(own)
                n += 1
                if label:
                    toxic.update(own)
                    n_toxic += 1
        names = list(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*names, ""], pa.string()), pa.array([*(toxic[k] for k in names), n_toxic], pa.int64()),
             pa.array([*(every[k] for k in names), n], pa.int64())], names=["feature", "toxic", "n"])

    counts = rows.mapInArrow(count, "feature string, toxic long, n long")
    sums = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    found = sums.where((F.col("toxic") >= min_docs) & ((F.col("toxic") >= 0.3 * F.col("n")) | (F.col("feature") == ""))).collect()
    base = next(((r["toxic"], r["n"]) for r in found if r["feature"] == ""), (0, 0))
    found = sorted((r for r in found if r["feature"]), key=lambda r: r["feature"])
    if not found or not base[0]:
        return model
    bound = _lower_bound(np.array([r["toxic"] for r in found], float), np.array([r["n"] for r in found], float), z)
    model.evidence = {r["feature"]: float(p) for r, p in zip(found, bound) if p > base[0] / base[1]}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            labels_, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([bool(x) for x in labels_]), pa.array(
                [math.floor(100 * model.strength(t)[0]) for t in texts], pa.int32())], names=["toxic", "strength"])

    seen = rows.mapInArrow(measure, "toxic boolean, strength int").groupBy("toxic", "strength").count().collect()
    x = np.array([r["strength"] / 100 for r in seen])
    y = np.array([float(r["toxic"]) for r in seen])
    k = np.array([float(r["count"]) for r in seen])
    slope, bias = 0.0, 0.0
    for _ in range(50):  # Newton steps with a small ridge: two parameters
        p = 1 / (1 + np.exp(-np.clip(slope * x + bias, -30, 30)))
        g = np.array([(k * (y - p) * x).sum() - 0.05 * slope, (k * (y - p)).sum() - 0.05 * bias])
        h = k * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 0.05, (h * x).sum()], [(h * x).sum(), h.sum() + 0.05]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 5 / (abs(step).max() + 1e-12))
        slope, bias = slope + step[0], bias + step[1]
        if abs(step).max() < 1e-6:
            break
    model.slope, model.bias = float(slope), float(bias)
    return model


def score_texts(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of every row with __score and __restored, the words behind disguised stretches.

    Null and empty texts have no evidence.  Rows are treated one by one."""
    # the added columns get their names last, so that kept columns may have any name but these three
    rows = docs.select(*keep, F.col("text").alias("__text"))
    schema = StructType(rows.schema.fields[:-1]).add("__score", DoubleType()).add("__restored", ArrayType(StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            scores, restored = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                strength, words = model.strength(text)
                scores.append(model.score(strength))
                restored.append(words)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(restored, pa.list_(pa.string()))],
                names=[*batch.schema.names[:-1], "__score", "__restored"])

    return rows.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train_docs: int = 20_000) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score (0 to 1), predicted, restored.

    Labels, language, source and doc_id never enter a score.  Null doc_ids are
    not held out and never learned from; doubled labels of a doc_id count as
    toxic if one of them does; without any toxic label every score is low.  An
    empty table gives no rows.
    """
    out = score_texts(docs.select(F.col("doc_id").cast("long"), "text"), fit(docs, labels, max_train_docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                      (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"), F.col("__restored").alias("restored"))


def drop_toxic(docs: DataFrame, labels: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The documents that are not predicted toxic, with ``columns``."""
    return score_texts(docs, fit(docs, labels), columns).where(F.col("__score") < THRESHOLD).select(*columns)
