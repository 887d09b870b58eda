"""Near-duplicate components by b-bit MinHash: bands of minima find candidates, packed low bits filter them.

Every set of two-word shingles gets 240 minima.  Forty bands of six minima are
the keys of an index; two sets with a Jaccard similarity of 0.8 share no key
with a probability of 5e-6.  Four bits of each minimum are packed into a
signature of 120 bytes.  The similarity that two signatures suggest, corrected
for the sixteenth of unequal minima whose bits agree, filters the candidates:
only pairs 5.5 standard deviations below 0.8 are left out.  What remains is
confirmed on the whole sets.

A key of few sets gives all its pairs.  A key of many gives a star around its
least set; only where that leaves sets of different components under one key
are these compared block by block, so that a group of copies costs as many
comparisons as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import small, stored
from sensorloom.llm.components import connected_components
from sensorloom.llm.decontaminate import _mix
from sensorloom.llm.ngram_join import keyed, linked
from sensorloom.llm.shingles import set_name, shingle_sets

SHINGLE = 2
ROWS, BANDS = 6, 40
HASHES = ROWS * BANDS
BITS = 4
THRESHOLD = 0.8
BATCH = 400
FEW = 16  # sets of a key of which all pairs are compared
BLOCK = 500  # sets of one block of a longer list
SALT = 1000  # members of a star that read one copy of its centre

_MULTIPLIERS = (_mix(np.arange(1, HASHES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_BAND_FACTORS = _mix(np.arange(1000, 1000 + ROWS, dtype=np.uint64)) | np.uint64(1)
_CHANCE = 1 / (1 << BITS)  # unequal minima whose bits agree


def cut(threshold: float = THRESHOLD, deviations: float = 5.5) -> float:
    """The least estimate of a pair that is compared on its whole sets."""
    agree = threshold + (1 - threshold) * _CHANCE
    return threshold - deviations * float(np.sqrt(agree * (1 - agree) / HASHES)) / (1 - _CHANCE)


def minima(tokens: np.ndarray) -> np.ndarray:
    """The least value of each of the hash functions over a set of token hashes, not empty."""
    x = (tokens >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        np.minimum(out, (x[at:at + 512, None] * _MULTIPLIERS[None, :]).min(0), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """Rows of minima to rows of one key a band, the number of the band mixed in."""
    sums = (least.reshape(len(least), BANDS, ROWS).astype(np.uint64) * _BAND_FACTORS).sum(2, dtype=np.uint64)
    return _mix(sums + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def packed_bits(least: np.ndarray) -> np.ndarray:
    """Rows of minima to rows of 64-bit words, each of sixteen times four bits of a minimum.

    The bits are taken after a multiplication, because minima of neighbouring
    hash functions share their low bits if they come from the same token."""
    low = ((least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint64)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return (low.reshape(len(low), HASHES * BITS // 64, 64 // BITS) << shifts).sum(2, dtype=np.uint64).view(np.int64)


def estimated_similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity that two packed signatures suggest, corrected for bits that agree by chance."""

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))

    differ = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, k: s + k)
    return (1 - differ / HASHES - _CHANCE) / (1 - _CHANCE)


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All estimates between two stacks of packed signatures."""
    differ = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        d = a[:, k, None].view(np.uint64) ^ b[None, :, k].view(np.uint64)
        d |= d >> np.uint64(1)
        d |= d >> np.uint64(2)
        differ += np.bitwise_count(d & np.uint64(0x1111111111111111))
    return (1 - differ / HASHES - _CHANCE) / (1 - _CHANCE)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n, name (128 bits of the whole set), bands and bits of every row; stored.

    Without shingles, bands and bits are empty lists."""
    names = ["doc_id", "row_key", "n", "name", "bands", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                sets = shingle_sets(part.column(2).to_pylist(), SHINGLE)
                some = [i for i, s in enumerate(sets) if len(s)]
                least = np.stack([minima(sets[i]) for i in some]) if some else np.zeros((0, HASHES), np.uint32)
                columns = [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                           pa.array([_name(s) for s in sets], pa.binary())]
                ends = np.cumsum([0, *(len(s) > 0 for s in sets)]).astype(np.int32)
                for values in (band_keys(least), packed_bits(least)):
                    columns.append(pa.ListArray.from_arrays(pa.array(ends * np.int32(values.shape[1])), pa.array(values.ravel())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, row_key long, n long, name binary, bands array<long>, bits array<long>"
    return stored(keyed(docs).mapInArrow(run, schema), "signatures")


def _name(tokens: np.ndarray) -> bytes:
    return b"".join(h.to_bytes(8, "little", signed=True) for h in set_name(tokens))


def contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, tokens) of the sets named in ``wanted`` (row_key, node); stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                sets = shingle_sets(part.column(1).to_pylist(), SHINGLE)
                same = [i for i, (s, node) in enumerate(zip(sets, part.column(0).to_pylist())) if _name(s) == node]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(same, pa.int64())), pa.array(
                    [sets[i].view(np.int64) for i in same], pa.list_(pa.int64()))], names=["node", "tokens"])

    rows = keyed(docs).select("row_key", "text").join(small(wanted), "row_key").select("node", "text")
    found = rows.mapInArrow(run, "node binary, tokens array<long>")
    return stored(found.groupBy("node").agg(F.any_value("tokens").alias("tokens")), "contents")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar.  The centre of a large star is copied once for SALT members."""
    stars = stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("salts")).where("salts > 1"), "stars")
    salted = pairs.join(small(stars), "a", "left").select(
        "a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"), F.lit(0)).alias("salt"))
    centres = sets.join(small(stars.withColumnRenamed("a", "node")), "node", "left") \
        .select(F.col("node").alias("a"), F.col("tokens").alias("s"), F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    both = salted.join(centres, ["a", "salt"]).join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("t")), "b")
    common = F.size(F.array_intersect("s", "t"))
    return both.where(linked(common, F.size("s"), F.size("t"))).select("a", "b")


def candidate_pairs(nodes: DataFrame, index: DataFrame) -> DataFrame:
    """(a, b): all pairs of keys with at most FEW sets and the stars of the others, if their estimate allows; stored."""
    members = index.where(F.col("k") <= FEW).groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("m"))
    every = F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, FEW), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    pairs = members.select(F.explode(every).alias("p")).select("p.a", "p.b")
    stars = index.where(F.col("k") > FEW).select(F.col("hub").alias("a"), F.col("node").alias("b")).where("a <> b")
    pairs = pairs.unionByName(stars).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    right = nodes.select(F.col("node").alias("b"), "n", "bits")
    # sizes that differ by more than a fifth can't be similar
    near = (F.least("n", "n_a") * 5 >= F.greatest("n", "n_a") * 4) & (estimated_similarity(F.col("bits_a"), F.col("bits")) >= cut())
    return stored(pairs.join(left, "a").join(right, "b").where(near).select("a", "b"), "pairs")


def _open_pairs(part: pd.DataFrame) -> list[tuple[int, int]]:
    """Places of two sets of one group that are of different components, near by their bits, and meet here first."""
    label, rest = part["label"].to_numpy(), part["rest"].to_numpy()
    bits, bands = np.stack(part["bits"].to_numpy()), np.stack(part["bands"].to_numpy())
    sizes, band = part["n"].to_numpy(), int(part["band"].iloc[0])
    at = np.flatnonzero(rest)
    near = _estimates(bits[at], bits) >= cut()
    near &= 5 * np.minimum(sizes[at, None], sizes[None]) >= 4 * np.maximum(sizes[at, None], sizes[None])
    near &= label[at, None] != label[None]
    out = []
    for i, j in zip(*np.nonzero(near)):
        i = at[i]
        if (not rest[j] or i < j) and int(np.argmax(bands[i] == bands[j])) == band:
            out.append((int(i), int(j)))
    return out


def open_links(nodes: DataFrame, index: DataFrame, labels: DataFrame, sets_of) -> DataFrame:
    """Links between sets of different components that share a long list of the index.

    In each list, the sets outside its commonest component are dealt to blocks;
    each block meets every block of the list.  A first pass over signatures
    finds the sets that need their contents (``sets_of``), a second one
    compares these.  Both hold two blocks at a time and send no pairs that are
    not links."""
    rows = index.where(F.col("k") > FEW).join(labels.select("node", F.col("label")), "node", "left") \
        .withColumn("label", F.coalesce("label", "node"))
    shares = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"))
    most = shares.groupBy("key").agg(F.max(F.struct("c", "label")).alias("most"), F.sum("c").alias("k"), F.count(F.lit(1)).alias("labels"))
    most = stored(most.where("labels > 1").select("key", F.col("most.label").alias("main"), F.ceil((F.col("k") - F.col("most.c")) / BLOCK).cast("int").alias("n_rest"),
                                                  F.ceil(F.col("most.c") / BLOCK).cast("int").alias("n_main")), "open")
    rows = rows.select("key", "band", "node", "label").join(most, "key").withColumn("rest", F.col("label") != F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("rest"), F.col("n_rest")).otherwise(F.col("n_main"))).cast("int")
    own = F.when(F.col("rest"), own).otherwise(own + F.col("n_rest"))
    meets = F.when(F.col("rest"), F.sequence(F.lit(0), F.col("n_rest") + F.col("n_main") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_rest") - 1))
    rows = rows.withColumn("own", own).withColumn("other", F.explode(meets))
    rows = stored(rows.select("key", "band", "node", "label", "rest", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")), "blocks")
    whole = nodes.select("node", "n", "bits", "bands")

    def grouped(some: DataFrame, extra: DataFrame) -> DataFrame:
        buckets = max(1, some.count() // (2 * BLOCK))
        return some.join(extra, "node").withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(buckets))).groupBy("bucket")

    def need(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in part.groupby(["key", "i", "j"], sort=False):
            at = sorted({x for pair in _open_pairs(group) for x in pair})
            out.append(group.iloc[at][["key", "band", "i", "j", "node", "label", "rest"]])
        return pd.concat(out)

    schema = "key long, band int, i int, j int, node binary, label binary, rest boolean"
    needed = stored(grouped(rows, whole).applyInPandas(need, schema), "needed")
    if needed.isEmpty():
        return needed.select(F.col("node").alias("a"), F.col("node").alias("b"))
    extra = whole.join(sets_of(needed.select("node").distinct()), "node")

    def verify(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in part.groupby(["key", "i", "j"], sort=False):
            tokens, nodes_, label = group["tokens"].to_numpy(), group["node"].to_numpy(), dict()
            own = [label.setdefault(x, k) for k, x in enumerate(group["label"])]

            def root(x: int) -> int:
                while own[x] != x:
                    x = own[x]
                return x

            for i, j in _open_pairs(group):
                a, b = root(i), root(j)
                if a != b and linked(len(np.intersect1d(tokens[i], tokens[j], assume_unique=True)), len(tokens[i]), len(tokens[j])):
                    own[a] = b
                    out.append((nodes_[i], nodes_[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return grouped(needed, extra).applyInPandas(verify, "a binary, b binary")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    component_id is the least doc_id reachable by links; two documents link if
    100 * intersection >= 80 * union of their sets of two-word shingles (a
    single word is one shingle).  Documents without words have no shingle and
    stand alone, under their own doc_id.  ``kept`` marks the document that names
    its component.  Null doc_ids take part; they name a component only if no
    doc_id does.  Rows with one doc_id are treated row by row, so that rows
    repeating the naming doc_id are all marked.  Other columns of the input are
    ignored.  An empty table gives no rows.
    """
    rows = signatures(docs)
    classes = rows.where("n > 0").groupBy("name").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("least"), F.any_value("n").alias("n"),
        F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits"))
    nodes = stored(classes.select(F.col("name").alias("node"), F.col("least.doc_id").alias("doc_id"),
                                  F.col("least.row_key").alias("row_key"), "n", "bands", "bits"), "nodes")
    index = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    hubs = index.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1")
    index = stored(index.join(hubs, "key"), "index")

    def sets_of(some: DataFrame) -> DataFrame:
        return contents(docs, stored(nodes.join(some, "node").select("row_key", "node"), "wanted"))

    pairs = candidate_pairs(nodes, index)
    touched = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    edges = stored(confirmed(pairs, sets_of(touched)), "links")
    labels = connected_components(edges)
    more = stored(open_links(nodes, index, stored(labels, "labels"), sets_of), "links")
    if not more.isEmpty():
        labels = connected_components(edges.unionByName(more))
    named = nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"), "doc_id")
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = named.join(least, "label").select(F.col("node").alias("name"), "component_id")
    out = rows.select("doc_id", "n", "name").join(of_class, "name", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
