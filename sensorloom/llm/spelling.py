"""Spelling variants of words: near words by search schemes over FM-indexes of the delimited vocabulary.

Two words are near if one edit makes them equal.  The edit lies in one half of
the word, so the other half is found exactly: the first half, from its
delimiter on, in an index that is read from left to right, or the second half,
from its delimiter back, in one that is read from right to left.  The search
goes on across the other half and allows one error there.  A state of the
search is an interval of suffix ranks; all words of a shard are searched at
once, so a step is two sorted look-ups for many intervals.

The vocabulary is dealt to shards by direction, length and the part of the
exact half that all words which look there share; every shard has its own
index, and a word looks in the shards of the three lengths it may reach.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import small, stored

MIN_LENGTH, MIN_COUNT = 6, 5
RATIO = 5  # a form occurs so many times as often
DAMAGE = 199  # one of so many words of a document loses a letter
SHARD = 20_000  # words of an index
QUERIES = 20_000  # words searched at once
TABLE = 300_000  # words that a task counts before it hands the counts on

# A byte of Latin-1 text to its lower-case letter (A-Z only are changed) or a blank: letters are a-z and from U+00C0 on.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def damaged_words(doc_id: int | None, text: str | None) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, how often) of a document, after one of DAMAGE words has lost a letter.

    Characters beyond Latin-1 are no letters.  A null doc_id is empty in the hashed text."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for word, n in Counter((text or "").encode("latin-1", "replace").translate(_LETTERS).split()).items():
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        yield word, n


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of at least MIN_LENGTH letters with MIN_COUNT occurrences in all texts; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def packed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in damaged_words(doc_id, text):
                        if len(word) >= MIN_LENGTH:
                            counts[word] += n
                    if len(counts) > TABLE:
                        yield packed()
                        counts.clear()
        yield packed()

    words = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return stored(words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT), "words")


class DelimitedIndex:
    """FM-index of words, each read backwards between delimiters, so that a search goes through them forwards.

    Suffixes are compared up to their delimiter, then by the place of the word."""

    def __init__(self, words: list[bytes]):
        text = np.frombuffer(b"\0" + b"".join(w[::-1] + b"\0" for w in words), np.uint8).astype(np.int64)
        size = len(text)
        closing = text == 0
        self.delimiters = int(closing.sum())
        rank = np.where(closing, np.cumsum(closing) - 1, text + self.delimiters)
        reach = 1
        while True:  # ranks of prefixes of twice the length, until all differ
            following = np.concatenate((rank[reach:], np.zeros(min(reach, size), np.int64)))[:size]
            key = rank * (size + 256) + following
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            if rank[order[-1]] == size - 1:
                break
            reach *= 2
        self.size = size
        self.before = text[order - 1]  # the symbol before each suffix, in the order of suffixes
        # (symbol, row) in order: a look-up counts the smaller symbols and the equal ones above a row
        self.table = np.sort(self.before * size + np.arange(size))
        whole = np.flatnonzero(self.before == 0)
        self.whole = whole  # rows of suffixes that are whole words
        self.word_of = (np.cumsum(closing) - 1)[order[whole]]
        self.symbols = np.unique(text[~closing])

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The rank that ``row`` has among the suffixes with ``symbol`` before them."""
        return np.searchsorted(self.table, symbol * self.size + row)

    def words(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the arguments, word) of the words that end exactly at the intervals."""
        first, last = np.searchsorted(self.whole, low), np.searchsorted(self.whole, high)
        n = last - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return np.repeat(np.arange(len(low)), n), self.word_of[at]

    def continuations(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(place in the arguments, symbol, low, high) of all intervals one symbol further.

        Narrow intervals list their rows, wide ones try every symbol."""
        wide = high - low > len(self.symbols)
        w, n = np.flatnonzero(wide), np.where(wide, 0, high - low)
        at = np.repeat(np.arange(len(low)), n)
        rows = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        pairs = np.unique(at * 256 + self.before[rows])
        pairs = pairs[pairs & 255 > 0]
        at = np.concatenate((pairs >> 8, np.repeat(w, len(self.symbols))))
        symbol = np.concatenate((pairs & 255, np.tile(self.symbols, len(w))))
        lo, hi = self.step(symbol, low[at]), self.step(symbol, high[at])
        some = hi > lo
        return at[some], symbol[some], lo[some], hi[some]


def near_words(index: DelimitedIndex, queries: list[bytes], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of all words one edit away from a query that begin with its first ``halves`` letters.

    An inserted or deleted letter next to equal ones counts as the last of
    them, so each word is found once."""
    lengths = np.array([len(q) for q in queries], np.int64)
    text = np.zeros((len(queries), int(lengths.max(initial=0)) + 2), np.int64)
    for k, q in enumerate(queries):
        text[k, :len(q)] = np.frombuffer(q, np.uint8)
    query = np.arange(len(queries))
    low, high = np.zeros(len(queries), np.int64), np.full(len(queries), index.delimiters, np.int64)
    at = np.zeros(len(queries), np.int64)
    while True:  # the exact half
        more = np.flatnonzero((at < halves[query]) & (high > low))
        if not len(more):
            break
        symbol = text[query[more], at[more]]
        low[more], high[more] = index.step(symbol, low[more]), index.step(symbol, high[more])
        at[more] += 1
    some = high > low
    query, at, low, high = query[some], at[some], low[some], high[some]
    wrong: list[tuple[np.ndarray, ...]] = []
    while len(query):  # the other half, an error at each place
        here, following = text[query, at], text[query, at + 1]
        place, symbol, lo, hi = index.continuations(low, high)
        other = symbol != here[place]
        inside = at[place] < lengths[query[place]]
        p = place[other]
        wrong.append((query[p], at[p], lo[other], hi[other]))  # a letter more
        s = other & inside
        wrong.append((query[place[s]], at[place[s]] + 1, lo[s], hi[s]))  # another letter
        d = (at < lengths[query]) & (here != following)
        wrong.append((query[d], at[d] + 1, low[d], high[d]))  # a letter less
        on = inside & ~other
        query, at, low, high = query[place[on]], at[place[on]] + 1, lo[on], hi[on]
    if not wrong:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    query, at, low, high = (np.concatenate(c) for c in zip(*wrong))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while len(query):  # the rest without error
        done = at == lengths[query]
        k, word = index.words(low[done], high[done])
        found.append((query[done][k], word))
        query, at, low, high = query[~done], at[~done], low[~done], high[~done]
        symbol = text[query, at]
        low, high = index.step(symbol, low), index.step(symbol, high)
        some = high > low
        query, at, low, high = query[some], at[some] + 1, low[some], high[some]
    return tuple(np.concatenate(c) for c in zip(*found))


def _shard_part(length: Column) -> Column:
    """Letters of the exact half that every word which may look in a shard of words of ``length`` has."""
    return F.greatest(F.lit(MIN_LENGTH // 2), F.floor((length - 1) / 2)).cast("int")


def shards(words: DataFrame) -> DataFrame:
    """(forward, bucket, queried, word, n): the words of each index, and the words that look there.

    A shard of more than SHARD words is cut into blocks by a hash of the words;
    then each word looks in all of its blocks."""
    both = words.withColumn("forward", F.explode(F.array(F.lit(True), F.lit(False))))
    both = both.select("word", "n", "forward", F.when(F.col("forward"), F.col("word")).otherwise(F.reverse("word")).alias("read"),
                       F.char_length("word").alias("m"))
    indexed = both.withColumn("length", F.col("m"))
    queried = both.withColumn("length", F.explode(F.sequence(F.greatest(F.col("m") - 1, F.lit(MIN_LENGTH)), F.col("m") + 1)))
    part = F.substring("read", F.lit(1), _shard_part(F.col("length")))
    key = ["forward", "length", "part"]
    indexed, queried = indexed.withColumn("part", part), queried.withColumn("part", part)
    large = stored(indexed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / SHARD).cast("int").alias("blocks")).where("blocks > 1"), "large-shards")
    large = small(large)
    blocks = F.coalesce("blocks", F.lit(1))
    indexed = indexed.join(large, key, "left").withColumn("block", F.pmod(F.xxhash64("word"), blocks).cast("int")).withColumn("queried", F.lit(False))
    queried = queried.join(large, key, "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("queried", F.lit(True))
    buckets = max(1, -(-words.count() // SHARD))
    bucket = F.pmod(F.xxhash64(*key, "block"), F.lit(buckets)).alias("bucket")
    return indexed.select("forward", bucket, "queried", "word", "n").unionByName(queried.select("forward", bucket, "queried", "word", "n"))


def nearest(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): how many near words a word has, and the most frequent of them, the least of equal ones."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        forward = bool(key[0])
        held = rows[~rows["queried"]].sort_values("word")
        asked = rows[rows["queried"]].drop_duplicates("word").sort_values("word")
        out = pd.DataFrame({"word": pd.Series(dtype=str), "n_near": pd.Series(dtype="int64"),
                            "best_n": pd.Series(dtype="int64"), "best": pd.Series(dtype=str)})
        if held.empty or asked.empty:
            return out
        turn = 1 if forward else -1
        names = held["word"].to_numpy(object)
        texts = [w.encode("latin-1")[::turn] for w in names]
        index, counts = DelimitedIndex(texts), held["n"].to_numpy()
        parts = [out]
        for at in range(0, len(asked), QUERIES):
            words_ = asked["word"].to_numpy(object)[at:at + QUERIES]
            queries = [w.encode("latin-1")[::turn] for w in words_]
            m = np.array([len(q) for q in queries], np.int64)
            q, w = near_words(index, queries, m // 2 if forward else m - m // 2)
            if not forward:  # words that begin with the first half are found from there
                new = np.array([not names[j].startswith(words_[i][:len(words_[i]) // 2]) for i, j in zip(q, w)], bool)
                q, w = (q[new], w[new]) if len(q) else (q, w)
            order = np.lexsort((w, -counts[w], q))  # words are held in code-point order
            q, w = q[order], w[order]
            first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
            parts.append(pd.DataFrame({"word": words_[q[first]], "n_near": np.diff(np.append(first, len(q))),
                                       "best_n": counts[w[first]], "best": names[w[first]]}))
        return pd.concat(parts, ignore_index=True)

    found = shards(words).groupBy("forward", "bucket").applyInPandas(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) for rows (word, form): the last word that following forms leads to.

    Each form occurs RATIO times as often as its word, so ``most`` occurrences
    bound the number of steps; each round doubles the steps taken."""
    steps = max(1, math.floor(math.log(max(most, 2), RATIO)))
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        current = stored(current.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return current


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of at least six letters with five occurrences.

    Words are maximal runs of ``A-Z a-z U+00C0-U+00FF`` of whole texts, A-Z
    lower-cased; some lose a letter, see ``damaged_words``.  n_near counts the
    words one edit away.  ``form`` is the most frequent of them (of equal ones
    the least in code-point order) if it occurs at least five times as often;
    ``root`` is where following forms ends, the word itself without a form.

    Null and empty texts have no words; a null doc_id is empty in the hashed
    text.  Repeated rows count each time; other columns are ignored.  An empty
    table gives no rows.
    """
    words = vocabulary(docs)
    near = stored(nearest(words), "near")
    joined = words.join(near, "word", "left")
    has = F.col("best_n") >= RATIO * F.col("n")
    out = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    last = roots(out.where("form is not null"), most)
    return out.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
