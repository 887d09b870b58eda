"""Exact Jaccard self-join of word shingles by token-combination prefixes.

Documents with equal sets are one class.  Tokens (shingle hashes) have a global
order: frequent ones last, by counts over all documents.  Two sets with a
Jaccard similarity of at least 0.8 share a tenth of the smaller one's size in
tokens within their extended prefixes (the first 0.2 n + n / 10 tokens).  So a
document with fewer prefix tokens that occur in other prefixes has no partner,
and drops out before any pair is formed.  Among the others, rare tokens are
indexed one by one, and tokens of long lists in combinations of two.  Pairs of
the same key are verified on the whole sets.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.llm.common import small, stored
from sensorloom.llm.components import connected_components
from sensorloom.llm.shingles import set_name, shingle_sets

BATCH = 400
CHUNK = 1 << 16  # counters of one row of the sketch
HELD = 1 << 23  # tokens that a task counts at a time
SUMS = 1 << 13  # groups of the first level of sums, about
RARE = 16  # longest list of a token that is indexed alone
BLOCK = 1000  # documents of one block of a long list
MAX_SHARED = 8_000_000  # tokens sent to every task: 64 MB; above, they are joined
MAX_COPIES = 4_000_000  # row keys of copies in a broadcast: 64 MB; above, they are joined


def extra(n):
    """Tokens by which the prefix of a set of ``n`` is extended: so many are shared at least."""
    return np.maximum(1, n // 10)


def prefix_length(n):
    return np.minimum(n, n - -(-4 * n // 5) + extra(n))


def linked(overlap, n, m):
    return 100 * overlap >= 80 * (n + m - overlap)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list[np.ndarray]]]:
    """(first column, second column, sets of the last column, a text) of small parts of the batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            yield part.column(0).to_pylist(), part.column(1).to_pylist(), shingle_sets(part.column(2).to_pylist())


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, row_key (of id and text), text."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row_key"), "text")


def set_table(docs: DataFrame, bits: int) -> DataFrame:
    """Rows with kind 0: doc_id, row_key, n, h1, h2 (name of the set) of each document.
    Rows with kind 1: a chunk of a task's counts of tokens by their first ``bits`` bits, those above zero."""
    schema = "kind int, doc_id long, row_key long, n long, h1 long, h2 long, chunk int, task int, counts binary"
    types = [pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in schema.split(", ")]

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        bucket, times = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(bucket, np.arange(0, (1 << bits) + 1, CHUNK))
        full, task = np.flatnonzero(np.diff(edges)), TaskContext.get().partitionId()
        for at in range(0, len(full), 64):
            chunks = full[at:at + 64].tolist()
            k = len(chunks)
            packed = [_counts(bucket[edges[c]:edges[c + 1]] % CHUNK, times[edges[c]:edges[c + 1]]) for c in chunks]
            columns = [[1] * k, *[[None] * k] * 5, chunks, [task] * k, packed]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for ids, keys, sets in _pieces(batches):
            held += [(np.concatenate(sets) >> np.uint64(64 - bits)).astype(np.uint32)] if sets else []
            named = [set_name(s) for s in sets]
            k = len(ids)
            columns = [[0] * k, ids, keys, [len(s) for s in sets], [h for h, _ in named], [h for _, h in named], *[[None] * k] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
            if sum(len(h) for h in held) >= HELD:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    return stored(keyed(docs).mapInArrow(run, schema), "sets")


def _counts(at: np.ndarray, times: np.ndarray) -> bytes:
    """Counts above zero of a chunk: the steps between their places, then the counts."""
    steps = np.diff(at.astype(np.int64), prepend=0).astype("<u2")
    return zlib.compress(steps.tobytes() + np.minimum(times, 2**32 - 1).astype("<u4").tobytes(), 1)


def _summed(rows: pd.Series) -> np.ndarray:
    """The CHUNK sums of what ``_counts`` has packed."""
    total = np.zeros(CHUNK, np.int64)
    for packed in rows:
        data = zlib.decompress(packed)
        k = len(data) // 6
        total[np.cumsum(np.frombuffer(data, "<u2", k), dtype=np.int64)] += np.frombuffer(data, "<u4", k, 2 * k)
    return total


def _gathered(chunks: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, packed, of rows (chunk, its bits packed); chunks without a row are zero."""
    out = np.zeros(1 << bits >> 3, np.uint8)
    for chunk, packed in chunks.collect():
        out[chunk * CHUNK >> 3:(chunk + 1) * CHUNK >> 3] = np.frombuffer(packed, np.uint8)
    return out


def frequent_buckets(sets: DataFrame, bits: int) -> np.ndarray:
    """For each bucket of tokens: is its count over all documents high?

    Counts are summed in two levels (up to 64 groups of tasks, then all), so that
    no group holds more than a small share of the tasks.  The result has 2**bits
    bits, at most 8 MB, whatever the corpus."""

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = _summed(rows["counts"])
        at = np.flatnonzero(total)
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "counts": [_counts(at, total[at])]})

    groups = int(np.clip(SUMS * CHUNK >> bits, 4, 64))
    parts = sets.where("kind = 1").select("chunk", F.pmod("task", F.lit(groups)).alias("part"), "counts") \
        .groupBy("chunk", "part").applyInPandas(add, "chunk int, counts binary")
    total = sets.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = max(32, 3 * total / (1 << bits) + 20)

    def high(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "high": [np.packbits(_summed(rows["counts"]) > limit).tobytes()]})

    return _gathered(parts.groupBy("chunk").applyInPandas(high, "chunk int, high binary"), bits)


def marks(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """(packed bits, number k of leading bits): which values of the first k bits a column of hashes has.

    At least four bits for each row up to 32 million rows, and 16 MB at most,
    whatever the rows: packed on the executors, chunk by chunk."""
    bits = int(np.clip(np.ceil(np.log2(max(1, hashes.count()) * 4)), 16, 27))
    first = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - bits)
    rows = hashes.select(F.shiftright(first, 16).cast("int").alias("chunk"), first.bitwiseAND(F.lit(CHUNK - 1)).cast("int").alias("at"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bit = np.zeros(CHUNK, bool)
        bit[rows["at"].to_numpy()] = True
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "marks": [np.packbits(bit).tobytes()]})

    return _gathered(rows.groupBy("chunk").applyInPandas(pack, "chunk int, marks binary"), bits), bits


def _marked(tokens: np.ndarray, packed: np.ndarray, bits: int) -> np.ndarray:
    """For each unsigned hash: is the bit of its first ``bits`` bits set?"""
    bucket = (tokens >> np.uint64(64 - bits)).astype(np.int64)
    return ((packed[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8)) & 1).astype(bool)


def _prefix(tokens: np.ndarray, high: np.ndarray, bits: int) -> np.ndarray:
    """The first tokens of a sorted set in the global order: frequent buckets last, then by value."""
    late = _marked(tokens, high, bits)
    return np.concatenate((tokens[~late], tokens[late]))[:prefix_length(len(tokens))]


def _prefix_tokens(docs: DataFrame, high, bits: int) -> DataFrame:
    def run(batches):
        for _, _, sets in _pieces(batches):
            found = [_prefix(s, high.value, bits) for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())], names=["token"])

    return docs.mapInArrow(run, "token long")


def _packed(tokens: DataFrame) -> np.ndarray:
    """The values of a column of longs, sorted; they travel as one binary value per batch."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(0).to_numpy().tobytes()], pa.binary())], names=["b"])

    parts = [np.frombuffer(r["b"], np.int64) for r in tokens.mapInArrow(run, "b binary").collect()]
    out = np.concatenate([np.zeros(0, np.int64), *parts])
    del parts
    out.sort()
    return out


def candidates(docs: DataFrame, high, bits: int) -> DataFrame:
    """(node, n, tokens, content) of the classes that may have a partner.

    tokens: prefix tokens that other prefixes have, at least n / 10 of them.
    ``docs`` has one row per class.  The tokens of two or more prefixes are
    sent to the tasks while they are no more than MAX_SHARED.  Beyond that, the
    prefixes are joined with them; what is sent are marks of the tokens' first
    bits, and of the names of the classes found, that leave out most of the
    others before the joins.  The sets themselves never pass the driver."""
    spark = docs.sparkSession
    shared = stored(_prefix_tokens(docs, high, bits).groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token"), "shared")
    schema = "node long, n long, tokens array<long>, content binary"
    names = ["node", "n", "tokens", "content"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    few = shared.count() <= MAX_SHARED
    known = spark.sparkContext.broadcast(_packed(shared) if few else marks(shared))

    def run(batches):
        for _, _, sets in _pieces(batches):
            rows: list[list] = [[] for _ in names]
            for s in sets:
                if not len(s):
                    continue
                prefix = _prefix(s, high.value, bits)
                if few:
                    prefix = prefix.view(np.int64)
                    at = np.minimum(np.searchsorted(known.value, prefix), max(0, len(known.value) - 1))
                    prefix = prefix[known.value[at] == prefix] if len(known.value) else prefix[:0]
                else:
                    prefix = prefix[_marked(prefix, *known.value)].view(np.int64)
                if len(prefix) >= extra(len(s)):
                    for column, value in zip(rows, (set_name(s)[0], len(s), np.sort(prefix), s.astype("<u8").tobytes() if few else None)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=names)

    found = docs.mapInArrow(run, schema)
    if not few:
        kept = found.select("node", "n", F.explode("tokens").alias("token")).join(shared, "token") \
            .groupBy("node", "n").agg(F.sort_array(F.collect_set("token")).alias("tokens")) \
            .where(F.size("tokens") >= F.greatest(F.lit(1), F.floor(F.col("n") / 10)))
        kept = stored(kept, "kept")
        chosen = spark.sparkContext.broadcast(marks(kept.select("node")))

        def contents(batches):
            for _, _, sets in _pieces(batches):
                sets = [s for s in sets if len(s)]
                nodes = np.array([set_name(s)[0] for s in sets], np.int64)
                keep = np.flatnonzero(_marked(nodes.view(np.uint64), *chosen.value))
                columns = [nodes[keep], [sets[k].astype("<u8").tobytes() for k in keep]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [types[0], types[3]])], names=["node", "content"])

        found = docs.mapInArrow(contents, "node long, content binary").join(kept, "node").select(*names)
    # rows that repeat a class leave one
    return stored(found.groupBy("node").agg(*[F.any_value(c).alias(c) for c in names[1:]]), "candidates")


def to_verify(found: DataFrame) -> DataFrame:
    """(hub, node, all): sets to compare with the hub's, or (all) every two members of the hub.

    Rare tokens: all pairs of a list of at most RARE, counted over the lists;
    a pair stays if it can reach the needed overlap.  Tokens of longer lists:
    combinations of two.  Two partners without a common rare token share s >= n
    / 12.5 frequent ones, so two of these lie less than ``reach`` apart in
    both documents' lists of frequent tokens; only such combinations are
    indexed.  Documents too small for that (n < 25) are indexed by single tokens
    as well.  The hub of a key is its least document."""
    rows = found.select("node", "n", F.explode("tokens").alias("token"))
    lists = rows.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    rows = stored(rows.join(lists, "token"), "index")
    frequent = rows.where(F.col("k") > RARE).groupBy("node", "n").agg(F.sort_array(F.collect_list("token")).alias("often"))
    often = frequent.select("node", F.size("often").alias("f"))
    member = F.struct("node", "n")
    small = rows.where(F.col("k") <= RARE).groupBy("token").agg(F.sort_array(F.collect_list(member)).alias("m"))
    pairs = F.flatten(F.transform("m", lambda x, i: F.transform(
        F.slice("m", i + 2, F.size("m")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    pairs = small.select(F.explode(pairs).alias("p")).select(
        F.col("p.x.node").alias("hub"), F.col("p.x.n").alias("hub_n"), F.col("p.y.node").alias("node"), F.col("p.y.n").alias("n"))
    pairs = pairs.where((F.least("n", "hub_n") * 5 >= F.greatest("n", "hub_n") * 4) & (F.col("hub") != F.col("node")))
    pairs = pairs.groupBy("hub", "hub_n", "node", "n").agg(F.count(F.lit(1)).alias("common"))

    def rest(c: str):
        n = F.col(c)
        return n - F.least(n, n - F.ceil(4 * n / 5) + F.greatest(F.lit(1), F.floor(n / 10)))

    need = F.ceil(4 * (F.col("n") + F.col("hub_n")) / 9) - F.greatest(rest("n"), rest("hub_n"))
    pairs = pairs.join(often, "node", "left").join(often.select(F.col("node").alias("hub"), F.col("f").alias("hub_f")), "hub", "left")
    pairs = pairs.where(F.col("common") + F.least(F.coalesce("f", F.lit(0)), F.coalesce("hub_f", F.lit(0))) >= need)
    pairs = pairs.select("hub", "node", F.lit(False).alias("all"))

    n, o = F.col("n"), F.col("often")
    s = F.floor(n * 4 / 50)  # tokens shared with any partner, at least
    # tokens of the prefixes of both that are not shared, dealt to the s - 1 gaps between shared ones
    reach = F.when(s < 2, F.size(o)).otherwise(F.floor((0.3 * n + 0.3 * 1.25 * n + 4 - 2 * s) / (s - 1)) + 1).cast("int")
    combos = F.flatten(F.transform(o, lambda x, i: F.transform(
        F.slice(o, i + 2, F.least(F.col("reach"), F.size(o))), lambda y: F.xxhash64(x, y))))
    single = F.when(n < 25, F.transform(o, lambda x: F.xxhash64(x))).otherwise(F.array().cast("array<bigint>"))
    keys = frequent.withColumn("reach", reach).select("node", F.explode(F.concat(combos, single)).alias("key"))
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1").select("key", "hub")
    many = keys.join(hubs, "key").select("hub", "node").distinct().withColumn("all", F.lit(True))
    return pairs.unionByName(many)


def _forest(nodes: np.ndarray, sets: list[np.ndarray], a: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect what the similar pairs among the sets connect (with ``a``: pairs with the first set only)."""
    sizes = np.array([len(s) for s in sets], np.int64)
    if a is not None or len(sets) == 2:
        return [(int(nodes[0]), int(nodes[i])) for i in range(1, len(sets))
                if 5 * min(sizes[0], sizes[i]) >= 4 * max(sizes[0], sizes[i])
                and linked(len(np.intersect1d(sets[0], sets[i], assume_unique=True)), sizes[0], sizes[i])]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = counts[column] > 1
    owner, column = owner[keep], (np.cumsum(counts > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    overlap = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (start, start + width))
        m = np.zeros((len(sets), width), np.float32)
        m[owner[lo:hi], column[lo:hi] - start] = 1
        overlap += m @ m.T
    similar = linked(overlap, sizes[:, None], sizes[None, :])
    np.fill_diagonal(similar, True)
    label = np.arange(len(sets))
    while True:
        new = np.where(similar, label[None, :], len(sets)).min(1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return [(int(nodes[i]), int(nodes[k])) for i, k in enumerate(label) if i != k]
        label = new


def links(found: DataFrame, check: DataFrame) -> DataFrame:
    """Edges (a, b) between similar sets that connect all that similar pairs connect.

    A hub with more than BLOCK members is cut into blocks by a hash of the
    members; every two blocks are one group, so that no group holds more than
    about 2 BLOCK sets.  Groups are dealt to buckets by a hash."""
    sized = check.where("all").groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    many = check.where("all").join(sized, "hub").withColumn("blocks", blocks) \
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    many = many.select("hub", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.lit(True).alias("all"))
    pairs = check.where("not all").select("hub", "node", F.lit(-1).alias("i"), F.lit(-1).alias("j"), F.lit(False).alias("all"))
    pairs = pairs.unionByName(pairs.select("hub", F.col("hub").alias("node"), "i", "j", "all").distinct())
    rows = stored(many.unionByName(pairs).distinct(), "groups")
    buckets = max(1, rows.count() // 500)
    rows = rows.join(found.select("node", "content"), "node") \
        .withColumn("bucket", F.pmod(F.xxhash64("hub", "i", "j"), F.lit(buckets)))

    def verify(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        for (hub, _, _, every), group in part.groupby(["hub", "i", "j", "all"], sort=True):
            if len(group) < 2:
                continue
            group = group.assign(first=group["node"] != hub).sort_values(["first", "node"])
            nodes = group["node"].to_numpy()
            out += _forest(nodes, [np.frombuffer(c, "<u8") for c in group["content"]], None if every else nodes[:1])
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("bucket").applyInPandas(verify, "a long, b long")


def similarity_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    component_id is the least doc_id reachable by links; two documents link if
    100 * intersection >= 80 * union of their sets of five-word shingles.
    Documents without words have no shingle and stand alone, under their own
    doc_id.  Documents with equal sets link.  Null doc_ids take part; they name
    a component only if no other doc_id does.  Rows with one doc_id are treated
    row by row.  An empty table gives no rows.
    """
    return _members(docs).select("doc_id", F.col("n").alias("n_shingles"),
                                 F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"))


def _members(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n of every row, how many rows have its set (k), and the least row of its component.

    ``least`` (no_id, doc_id, row_key) has a null doc_id only if no row of the
    component has one; ``k`` and ``least`` are null without shingles."""
    bits = int(np.clip(np.ceil(np.log2(max(1, docs.count()) * 16)), 16, 26))
    sets = set_table(docs, bits)
    rows = sets.where("kind = 0")
    classes = rows.where("n > 0").groupBy("h1", "h2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("least"), F.min(F.struct("doc_id", "row_key")).alias("one"), F.count(F.lit(1)).alias("k"))
    # the rows that repeat a class under another id or text
    copies = rows.where("n > 0").join(classes.where("k > 1").select("h1", "h2", "one"), ["h1", "h2"]) \
        .where(F.struct("doc_id", "row_key") != F.col("one")).select("row_key").distinct()
    copies = stored(copies, "copies")
    if copies.count() <= MAX_COPIES:
        copies = F.broadcast(copies)
    single = keyed(docs).join(copies, "row_key", "left_anti").select("doc_id", "row_key", "text")
    high = docs.sparkSession.sparkContext.broadcast(frequent_buckets(sets, bits))
    found = candidates(single, high, bits)
    labels = connected_components(links(found, to_verify(found)))
    named = classes.select("h1", "h2", "least", "k")
    joined = named.join(labels.select(F.col("node").alias("h1"), "label"), "h1", "left") \
        .select("h1", "h2", F.coalesce("label", "h1").alias("label"), "least", "k")
    least = joined.groupBy("label").agg(F.min("least").alias("least"))
    of_class = joined.drop("least").join(least, "label").select("h1", "h2", "least", "k")
    return rows.select("doc_id", "row_key", "n", "h1", "h2").join(of_class, ["h1", "h2"], "left").drop("h1", "h2")


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, all columns: the least doc_id, of several rows with it the least hash of the text.

    Rows are told apart by doc_id and text, so null and repeated doc_ids are
    decided row by row; a null doc_id is kept only if no row of the component
    has an id.  Rows equal in both leave one, the least by its other columns.
    Rows without words stand alone and all stay.
    """
    rows = _members(docs).where("n > 0")
    first = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("row_key") == F.col("least.row_key"))
    # rows that go, and rows kept of which there may be more than one
    out = rows.withColumn("first", first).where("k > 1 or not first").groupBy("doc_id", "row_key") \
        .agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1 or not first")
    out = stored(out.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), F.col("first").alias("__first")), "left-out")
    # columns of documents are told from the others by their frame, so that their names are free
    whole = docs.select(F.struct(*[F.col(names.quote(c)) for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("row.doc_id", "row.text") == F.col("__key"))
    kept = whole.join(out, same, "left_anti")
    several = out.where("__first")
    if not several.isEmpty():
        again = whole.join(small(several), same).groupBy("__id", "__key").agg(F.min("row").alias("row"))
        kept = kept.unionByName(again.select("row"))
    return kept.select("row.*")
