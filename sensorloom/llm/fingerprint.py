"""Document fingerprints: one-permutation MinHash with optimal densification, packed to low-order bits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import let

BINS_LOG2 = 8
BINS = 1 << BINS_LOG2
BITS = 4
WORDS = 5
TRIES = 6

_SHIFT = 63 - BINS_LOG2
_LAST = (1 << _SHIFT) - 1
BLANKS = r"[\x09-\x0D\x20]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """63-bit hashes of all runs of ``words`` words; of the whole sequence if it is shorter; none without words."""
    hashes = F.transform(F.filter(F.split(F.lower(text), BLANKS), lambda w: w != ""), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        whole = F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
        each = F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[h[i + k] for k in range(words)]))
        return F.when(F.size(h) >= words, each).otherwise(whole)

    return F.transform(let(hashes, runs), lambda x: F.shiftrightunsigned(x, 1))


def minima(hashes: Column) -> Column:
    """The least hash of each bin, NULL for an empty bin.

    The upper bits of a hash are its bin.  The largest value of every bin is
    added as a mark; after sorting, the first value of each bin is its least
    hash, or the mark if the bin is empty."""
    marks = F.lit([((b + 1) << _SHIFT) - 1 for b in range(BINS)]).cast("array<bigint>")

    def firsts(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (F.shiftright(x, _SHIFT) != F.shiftright(F.get(s, i - 1), _SHIFT)))

    return F.transform(let(F.sort_array(F.concat(hashes, marks)), firsts), lambda x: F.when(
        x.bitwiseAND(F.lit(_LAST)) != F.lit(_LAST), x))


def densified(bins: Column) -> Column:
    """Empty bins take the value of the first full bin in a random order of their own.

    The order of bin i is drawn by hashing (i, attempt).  After ``TRIES``
    attempts the rest of the order is settled at once: the full bin j with the
    least hash of (i, j).  Either way the choice depends on i and on which bins
    are full only, as optimal densification asks."""

    def fill(m: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: F.get(m, j).isNotNull())

        def with_full(f: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                tries = [F.get(m, F.pmod(F.xxhash64(i, F.lit(t)), F.lit(BINS)).cast("int")) for t in range(TRIES)]
                rest = F.array_min(F.transform(f, lambda j: F.struct(F.xxhash64(i, j, F.lit(TRIES)), F.get(m, j).alias("v"))))["v"]
                return F.coalesce(x, *tries, rest)

            return F.when(F.size(f) == 0, F.array().cast("array<bigint>")).when(F.size(f) == BINS, m).otherwise(F.transform(m, one))

        return let(full, with_full)

    return let(bins, fill)


def signature(text: Column) -> Column:
    """``BINS`` values of ``BITS`` bits; an empty array for a text without words.

    The low-order bits are taken of the hash of a bin's value and its number:
    two texts with few shingles would else agree in all bins at once where two
    borrowed values agree by chance."""
    return F.transform(densified(minima(shingle_hashes(text))), lambda v, i: F.xxhash64(v, i).bitwiseAND(
        F.lit((1 << BITS) - 1).cast("bigint")).cast("tinyint"))


def packed(values: Column) -> Column:
    """A signature as text, one hexadecimal digit for each value of four bits."""
    return F.array_join(F.transform(values, lambda v: F.element_at(F.lit(list("0123456789abcdef")), v.cast("int") + 1)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two signatures, corrected for values that agree by chance.

    Two texts without words are alike (1); one without words is like no other (0)."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    chance = 2.0 ** -BITS
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(
        F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))


def by_range(rows: DataFrame) -> DataFrame:
    """Rows with part, edge and tie, such that each row finds the next one in descending doc_id within its part.

    Ids are cut into ranges; the first row of each range also goes to the
    range before it (the first of all to the last range), marked ``edge``.  About sqrt(n)
    ranges of sqrt(n) rows, 2,000 at least: neither a range nor the list of
    ranges holds more than that many rows if ids are spread evenly.  Rows with
    one doc_id are ordered by a hash of the text; null ids come last."""
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    n, low, high = stats["n"], stats["low"] or 0, stats["high"] or 0
    ranges = max(1, n // max(2000, math.isqrt(n)))
    width = (high - low) // ranges + 1
    rows = rows.withColumn("part", F.coalesce(F.floor((F.col("doc_id") - low) / width), F.lit(-1)))
    tie = F.xxhash64("text")
    firsts = rows.groupBy("part").agg(F.max(F.struct("doc_id", tie.alias("tie"))).alias("first"))
    # one row per range: at most ranges + 2
    order = Window.orderBy("part")
    whole = Window.partitionBy(F.lit(0))
    firsts = firsts.select(F.col("first.doc_id").alias("first_id"), F.col("first.tie").alias("first_tie"),
                           F.coalesce(F.lead("part").over(order), F.min("part").over(whole)).alias("to_part"))
    edges = rows.join(F.broadcast(firsts), rows["doc_id"].eqNullSafe(F.col("first_id")) & (tie == F.col("first_tie")))
    both = rows.withColumn("edge", F.lit(False)).unionByName(
        edges.drop("part", "first_id", "first_tie").withColumnRenamed("to_part", "part").withColumn("edge", F.lit(True)))
    return both.withColumn("tie", tie)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, with their likeness.

    Shingles are runs of five words (lower case, cut at white space); a shorter
    text is one shingle.  The edited text replaces the last half of the code
    points by as many from the start of the next document in descending doc_id.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    A null text counts as empty.  The fingerprint of a text without words is
    the empty string.  Equal texts have equal fingerprints; the longest text
    needs memory for one hash per word.  An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    signed = by_range(rows).select("part", "edge", "doc_id", "text", "tie", signature(F.col("text")).alias("own"))
    order = Window.partitionBy("part").orderBy("edge", F.desc_nulls_last("doc_id"), F.desc("tie"))
    followed = signed.select("doc_id", "text", "own", "edge", F.lead("text").over(order).alias("next_text"),
                             F.lead("own").over(order).alias("next_own")).where(~F.col("edge"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = followed.select(
        "doc_id", n.cast("long").alias("n_chars"), "own", "next_own",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    edited = edited.select("doc_id", "n_chars", "own", "next_own", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                           signature(F.col("edited")).alias("edited_own"))
    return edited.select("doc_id", "n_chars", "edited_sha256", packed(F.col("own")).alias("fingerprint"),
                         packed(F.col("edited_own")).alias("edited_fingerprint"),
                         likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
                         likeness(F.col("own"), F.col("next_own")).alias("near_next"))
