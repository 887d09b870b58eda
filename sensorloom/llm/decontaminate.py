"""Benchmark decontamination over a stored, positional inverted index of the training tokens.

The index is cut by documents: each row is one shard of some hundred documents
with, for every term of the shard, the sorted positions where it occurs.  A
search looks up the terms of every benchmark window in a shard, drops windows
with a term that the shard lacks, takes the positions of the rarest term less
its offset as candidate starts, and intersects them with the offset-adjusted
positions of the next rarest terms until none or only matches are left.
Building and searching need no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import scratch_path

SHARD_TOKENS = 100_000

# Bytes of a word after lower-casing A-Z: digits, a-z and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64)]


def _powers(n: int) -> np.ndarray:
    if len(_POWERS[0]) < n:
        steps = np.full(max(n, 1 << 16), _BASE, np.uint64)
        steps[0] = 1
        _POWERS[0] = np.cumprod(steps)
    return _POWERS[0]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_terms(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit terms of all words of the texts in order, number of words of each text)."""
    parts = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    word = _WORD[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]  # a text ends with a line feed, so every word ends
    lengths = ends - starts
    # hash of a word: the sum of its bytes times powers of their places, for all words at once
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(firsts, lengths)
    values = (data[word].astype(np.uint64) + np.uint64(1)) * _powers(int(lengths.max(initial=0)) + 1)[place]
    sums = np.add.reduceat(values, firsts) if len(starts) else np.zeros(0, np.uint64)
    terms = _mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)
    bounds = np.cumsum([len(p) + 1 for p in parts])
    return terms, np.diff(np.searchsorted(starts, bounds), prepend=0) if len(parts) else np.zeros(0, np.int64)


INDEX_SCHEMA = ("shard long, doc_ids array<long>, row_keys array<long>, doc_words array<int>, terms binary, ends binary, positions binary")


def _shards(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SHARD_TOKENS words (by length), at least one text each."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text or "") > 6 * SHARD_TOKENS:
            yield start, at
            start, size = at, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


def build_index(docs: DataFrame, name: str = "postings") -> DataFrame:
    """Write the index of all words of all texts to the shared folder and return it.

    One row per shard: doc_ids, row_keys (hashes of the texts) and doc_words of its documents, then as packed
    little-endian arrays the sorted terms, where each one's positions end, and
    the sorted positions (counted in words over the shard) term after term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary()]
        names = ["shard", "doc_ids", "row_keys", "doc_words", "terms", "ends", "positions"]
        for batch in batches:
            ids, keys, texts = (c.to_pylist() for c in batch.columns)
            for a, b in _shards(texts):
                words, counts = word_terms(texts[a:b])
                order = np.argsort(words, kind="stable").astype("<i4")
                ordered = words[order]
                ends = np.flatnonzero(np.diff(ordered, append=ordered[-1:] ^ 1)) + 1 if len(ordered) else np.zeros(0, int)
                row = [[shard], [ids[a:b]], [keys[a:b]], [counts.astype(np.int32)], [ordered[ends - 1].astype("<i8").tobytes()],
                       [ends.astype("<i4").tobytes()], [order.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)
                shard += 1

    path = scratch_path(docs.sparkSession, name)
    index = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("row_key"), "text").mapInArrow(run, INDEX_SCHEMA)
    index.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


class Windows:
    """The windows of some benchmark items: ``size`` consecutive words, or all words of a shorter item."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int):
        terms, counts = word_terms([t for _, t in items])
        rows: dict[bytes, list[int]] = {}
        self.items = [i for i, _ in items]
        at = 0
        for k, n in enumerate(counts.tolist()):
            for start in range(at, at + max(1, n - size + 1) if n else at):
                rows.setdefault(terms[start:min(start + size, at + n)].tobytes(), []).append(k)
            at += n
        self.owners = [sorted(set(v)) for v in rows.values()]  # items that hold the window
        self.lengths = np.array([len(k) // 8 for k in rows], np.int64)
        self.terms = np.unique(terms)
        self.rows = np.full((len(rows), size), -1, np.int64)  # places in self.terms
        for i, key in enumerate(rows):
            window = np.frombuffer(key, np.int64)
            self.rows[i, :len(window)] = np.searchsorted(self.terms, window)

    def find(self, terms: np.ndarray, ends: np.ndarray, positions: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, start) of every occurrence in a shard."""
        none = np.zeros(0, np.int64)
        if not len(terms) or not len(self.rows):
            return none, none
        at = np.minimum(np.searchsorted(terms, self.terms), len(terms) - 1)
        begins = np.concatenate(([0], ends[:-1]))
        counts = np.where(terms[at] == self.terms, (ends - begins)[at], 0)
        # counts of each window's terms; the places beyond a short window never are the rarest
        table = np.where(self.rows >= 0, counts[self.rows], np.iinfo(np.int64).max)
        alive = np.flatnonzero(table.min(1) > 0)
        windows, starts = [none], [none]
        for w in alive.tolist():
            order = np.argsort(table[w, :self.lengths[w]], kind="stable").tolist()
            found = None
            for offset in order:
                t = at[self.rows[w, offset]]
                adjusted = positions[begins[t]:ends[t]] - offset
                if found is None:
                    found = adjusted
                elif slop:  # proximity: some posting within slop of its place
                    low, high = np.searchsorted(adjusted, found - slop), np.searchsorted(adjusted, found + slop, "right")
                    found = found[high > low]
                else:
                    place = np.minimum(np.searchsorted(adjusted, found), len(adjusted) - 1)
                    found = found[adjusted[place] == found]
                if not len(found):
                    break
            if len(found):
                windows.append(np.full(len(found), w))
                starts.append(found.astype(np.int64))
        return np.concatenate(windows), np.concatenate(starts)


MATCH_SCHEMA = ("shard long, place int, doc_id long, row_key long, n_words long, hits array<struct<from:int,to:int>>, items array<string>")


def search(index: DataFrame, windows: Windows, slop: int = 0) -> DataFrame:
    """One row per document: the ranges of its words hit by any window (merged), and the items found.

    ``slop`` 0 finds exact phrases; above it, proximity matches: every term of
    the window lies within ``slop`` words of its place, seen from the rarest term."""
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(),
             pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])), pa.list_(pa.string())]
    names = ["shard", "place", "doc_id", "row_key", "n_words", "hits", "items"]
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def one(shard, ids, keys, counts, terms, ends, positions):
        query = shared.value
        counts = np.asarray(counts, np.int64)
        stops = np.cumsum(counts)
        begins = stops - counts
        terms, ends = np.frombuffer(terms, "<i8"), np.frombuffer(ends, "<i4").astype(np.int64)
        which, starts = query.find(terms, ends, np.frombuffer(positions, "<i4").astype(np.int64), slop)
        lasts = starts + query.lengths[which] - 1
        total = int(stops[-1]) if len(stops) else 0
        ok = (starts >= 0) & (lasts < total)
        which, starts, lasts = which[ok], starts[ok], lasts[ok]
        doc = np.searchsorted(stops, starts, "right")
        ok = lasts < stops[doc] if len(doc) else ok[:0]  # not over the end of a document
        which, starts, lasts, doc = which[ok], starts[ok], lasts[ok], doc[ok]
        change = np.zeros(total + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, lasts + 1, -1)
        hits: list[list] = [[] for _ in ids]
        items: list[set] = [set() for _ in ids]
        if len(doc):
            hit = np.concatenate(([0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]))
            hit_edges = np.flatnonzero(np.diff(hit))
            for a, b in zip(hit_edges[::2].tolist(), hit_edges[1::2].tolist()):
                while a < b:  # a run may go on over the end of a document
                    d = int(np.searchsorted(stops, a, "right"))
                    stop = min(b, int(stops[d]))
                    hits[d].append({"from": a - int(begins[d]), "to": stop - int(begins[d])})
                    a = stop
            for d, w in set(zip(doc.tolist(), which.tolist())):
                items[d].update(str(query.items[k]) for k in query.owners[w] if query.items[k] is not None)
        return [[shard] * len(ids), list(range(len(ids))), ids, keys, counts, hits, [sorted(x) for x in items]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = [c[0] for c in batch.slice(at, 1).to_pydict().values()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(one(*row), types)], names=names)

    return index.mapInArrow(run, MATCH_SCHEMA)


def benchmark_windows(benchmark: DataFrame, size: int, max_chars: int) -> Iterator[Windows]:
    """Windows of the benchmark in blocks of about ``max_chars`` characters: the bound of what is broadcast."""
    block, chars = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        block.append((row["item_id"], row["text"]))
        chars += len(row["text"] or "")
        if chars > max_chars:
            yield Windows(block, size)
            block, chars = [], 0
    yield Windows(block, size)


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, slop: int = 0,
                  max_chars: int = 4_000_000) -> DataFrame:
    """Overlap of every document with the benchmark.

    Words: A-Z lower-cased, then runs of digits, a-z and non-ASCII characters.
    A window is ``size`` consecutive words of an item, or all words of a shorter
    one.  Columns: doc_id, n_words, n_hit (words inside any occurrence of a
    window), n_items and items_sha256 (items with an occurring window, sorted as
    strings, comma-joined), contaminated (n_hit > 0 and 20 * n_hit >= n_words),
    items.

    The benchmark is searched in blocks of ``max_chars`` characters, so what is
    sent to the tasks stays bounded however large it is.  Null or empty texts,
    of documents and of items, have no words: such documents come out with 0
    words and no hit.  Null item_ids hit words but name no item.  Rows with
    null or repeated doc_id come out row by row; an empty table gives no rows.
    """
    return _of_rows(docs, benchmark, size, slop, max_chars).drop("row_key")


def _of_rows(docs: DataFrame, benchmark: DataFrame, size: int = 13, slop: int = 0, max_chars: int = 4_000_000) -> DataFrame:
    """The columns of ``contamination`` and row_key, the hash of the text."""
    index = build_index(docs)
    found = [search(index, w, slop) for w in benchmark_windows(benchmark, size, max_chars)]
    rows = found[0]
    if len(found) > 1:
        for more in found[1:]:
            rows = rows.unionByName(more)
        rows = rows.groupBy("shard", "place").agg(
            F.first("doc_id").alias("doc_id"), F.first("row_key").alias("row_key"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("hits")).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["from"], h["to"] - 1)))))
    rows = rows.select("doc_id", "row_key", "n_words", covered.cast("long").alias("n_hit"), F.array_sort("items").alias("items"))
    return rows.select(
        "doc_id", "row_key", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without those that the rule of ``contamination`` names.

    Rows are told apart by doc_id and a hash of the text, so of rows that share
    a doc_id, or have none, only the contaminated ones go.  All columns stay,
    whatever their names.  An empty table gives no rows."""
    bad = _of_rows(docs, benchmark).where("contaminated").select("doc_id", "row_key").distinct().alias("bad")
    same = F.col("docs.doc_id").eqNullSafe(F.col("bad.doc_id")) & (F.xxhash64("docs.text") == F.col("bad.row_key"))
    return docs.alias("docs").join(bad, same, "left_anti")
