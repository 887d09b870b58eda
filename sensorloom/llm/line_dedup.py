"""Line deduplication with a deletion-neighbourhood join.

Two lines are duplicates if they are equal or one edit apart.  Every line emits
the hashes of its variants with one character deleted; lines one edit apart
share a variant.  Each variant is hashed in three parts (before, inside and
behind a block of characters), so that a line of n characters costs n small
hashes and n / BLOCK long ones.

Almost no line has a near partner, so the variants are emitted late: a partner
of a line agrees with it in the first or in the second half.  Lines whose
halves occur in no other line are left out first, then blocks whose surroundings
occur in no other line; neither loses a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions import names
from sensorloom.llm.common import let, small, stored

BLOCK = 64


def _left(s: Column, n: Column) -> Column:
    return F.substring(s, F.lit(1), n)


def _behind(s: Column, n: Column, length: Column) -> Column:
    """The characters from place ``n`` (counted from 0) on."""
    return F.substring(s, n + 1, length)


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, tie (hash of the text), pos, line (without blanks at its ends) of all lines but blank ones."""
    # the hash below the generator: above it, every line would hash its whole text again
    whole = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.split("text", "\n", -1).alias("lines"))
    lines = whole.select("doc_id", "tie", F.posexplode("lines").alias("pos", "raw"))
    return lines.select("doc_id", "tie", "pos", F.trim("raw").alias("line")).where(F.col("line") != "")


def _ids(line: Column) -> list[Column]:
    """128 bits that name a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(17), line).alias("h2")]


def half_keys(line: Column, length: Column) -> Column:
    """Hashes of the halves of a line, for partners of its length and of one character less or more.

    Of two lines of at least m characters, one edit apart, the edit lies before
    or behind place m / 2: then what follows it, or what precedes it, is equal."""
    n, m = length, length - 1
    q, r = F.floor(n / 2).cast("int"), F.floor(m / 2).cast("int")
    return F.array(
        F.xxhash64(n, F.lit(0), _behind(line, q, length)), F.xxhash64(n, F.lit(1), _left(line, q)),
        F.xxhash64(m, F.lit(0), _behind(line, r + 1, length)), F.xxhash64(m, F.lit(1), _left(line, r)))


def blocks_of(lines: DataFrame) -> DataFrame:
    """The blocks of the lines that may hold the edit between two of them.

    Each block j comes with hashes of what stands before and behind it.  Two
    lines one edit apart agree in both around the block of the edit; blocks
    whose surroundings occur in one line only are left out."""
    n = F.col("length")
    blocks = lines.select("h1", "h2", "first", "line", "length",
                          F.explode(F.sequence(F.lit(0), F.floor(n / BLOCK).cast("int"))).alias("j"))
    at = F.col("j") * BLOCK
    parts = blocks.select(
        "h1", "h2", "first", "length", "j", F.xxhash64(_left(F.col("line"), at)).alias("before"),
        F.xxhash64(_behind(F.col("line"), at + BLOCK, n)).alias("behind"),
        F.xxhash64(_behind(F.col("line"), at + BLOCK - 1, n)).alias("behind_short"),
        F.substring("line", at + 1, F.lit(BLOCK)).alias("inside"))
    around = [F.xxhash64(n, "j", "before", "behind"),  # a partner of the same length
              F.xxhash64(n - 1, F.lit(1), "j", "before", "behind"),  # a shorter partner
              F.xxhash64(n, F.lit(1), "j", "before", "behind_short")]  # a longer partner
    parts = stored(parts.withColumn("around", F.array(*around)), "blocks")
    keys = parts.select("h1", F.explode("around").alias("key"))
    shared = stored(keys.groupBy("key").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("key"), "surroundings")
    alike = parts.select("h1", "h2", "j", F.explode("around").alias("key")).join(small(shared), "key").select("h1", "h2", "j").distinct()
    return parts.drop("around").join(alike, ["h1", "h2", "j"])


def variant_keys(lines: DataFrame) -> DataFrame:
    """(key, kind, h1, h2, first) for the variants of the lines.

    kind "s": one character left out, with its place and the line's length: the
    lines that share such a key differ in that character alone.  kind "d": one
    character left out, without its place; kind "w": the line itself, as the
    shorter one of a pair.  "d" and "w" rows share keys."""
    n, parts = F.col("length"), blocks_of(lines)

    def without(i: Column) -> Column:
        return F.concat(_left(F.col("inside"), i), F.substring(F.col("inside"), i + 2, F.lit(BLOCK)))

    places = F.sequence(F.lit(0), F.char_length("inside") - 1)
    left_out = F.flatten(F.transform(places, lambda i: F.array(
        F.struct(F.xxhash64(F.lit("s"), n, F.col("j") * BLOCK + i, F.col("before"), without(i), F.col("behind")).alias("key"),
                 F.lit("s").alias("kind")),
        F.struct(F.xxhash64(F.lit("d"), n - 1, F.col("j"), F.col("before"), without(i), F.col("behind")).alias("key"),
                 F.lit("d").alias("kind")))))
    whole = F.array(F.struct(
        F.xxhash64(F.lit("d"), n, F.col("j"), F.col("before"), _left(F.col("inside"), F.lit(BLOCK - 1)), F.col("behind_short")).alias("key"),
        F.lit("w").alias("kind")))
    every = F.when(F.char_length("inside") > 0, F.concat(F.array_distinct(left_out), whole)).otherwise(whole)
    return parts.select("h1", "h2", "first", F.explode(every).alias("v")).select("v.key", "v.kind", "h1", "h2", "first")


def near_lines(docs: DataFrame, distinct: DataFrame, edit_chars: int) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line one edit apart."""
    halves = distinct.where(F.col("length") >= edit_chars).select("h1", "h2", F.explode("halves").alias("half"))
    shared = stored(halves.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("half"), "halves")
    some = stored(halves.join(small(shared), "half").select("h1", "h2").distinct().join(
        distinct.select("h1", "h2", "first"), ["h1", "h2"]), "near-candidates")
    lines = lines_of(docs).select("line", *_ids(F.col("line")))
    # every candidate once, with its text: all its occurrences have the same
    texts = stored(lines.join(small(some), ["h1", "h2"]).groupBy("h1", "h2").agg(
        F.any_value("line").alias("line"), F.any_value("first").alias("first"))
        .withColumn("length", F.char_length("line")), "near-lines")
    # Lines are distinct, so a key holds at most one line for each character that
    # may stand at a place ("s"), or be put into the shorter line ("d", "w").
    key = Window.partitionBy("key")
    me = F.struct("first", "h1", "h2")
    seen = variant_keys(texts).select(
        "kind", "h1", "h2", "first", F.min(F.when(F.col("kind") == "s", me)).over(key).alias("first_s"),
        F.min(F.when(F.col("kind") == "d", me)).over(key).alias("first_d"),
        F.min(F.when(F.col("kind") == "w", me)).over(key).alias("first_w"))
    other = F.when(F.col("kind") == "s", F.col("first_s")).when(F.col("kind") == "d", F.col("first_w")).otherwise(F.col("first_d"))
    pairs = seen.select("h1", "h2", "first", other.alias("o")).where(F.col("o.first") < F.col("first")) \
        .select("h1", "h2", F.col("o.h1").alias("o1"), F.col("o.h2").alias("o2")).distinct()
    a, b = texts.select("h1", "h2", "line"), texts.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("line").alias("other"))
    checked = pairs.join(a, ["h1", "h2"]).join(b, ["o1", "o2"]).where(F.levenshtein("line", "other", 1) >= 0)
    return checked.select("h1", "h2").distinct()


def duplicate_lines(docs: DataFrame, edit_chars: int = 20) -> DataFrame:
    """(doc_id, tie, pos) of every line that repeats an earlier one, equal or one edit apart.

    Lines are ordered by doc_id, then by a hash of the document's text, then by
    place.  Lines of fewer than ``edit_chars`` characters repeat only equal ones."""
    lines = lines_of(docs)
    length = F.char_length("line")
    found = lines.select("doc_id", "tie", "pos", length.alias("length"), *_ids(F.col("line")),
                         F.when(length >= edit_chars, half_keys(F.col("line"), length)).alias("halves"))
    place = F.struct("doc_id", "tie", "pos")
    distinct = stored(found.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("length").alias("length"),
        F.any_value("halves").alias("halves")), "lines")
    near = near_lines(docs, distinct, edit_chars).withColumn("near", F.lit(True))
    watched = stored(distinct.select("h1", "h2", "first", "n").join(near, ["h1", "h2"], "left")
                     .where(F.col("near") | (F.col("n") > 1)).select("h1", "h2", "first", "near"), "repeated-lines")
    hits = found.select("doc_id", "tie", "pos", "h1", "h2").join(watched, ["h1", "h2"])
    return hits.where(F.coalesce("near", F.lit(False)) | (place != F.col("first"))).select("doc_id", "tie", "pos")


def drop_repeated_lines(docs: DataFrame, edit_chars: int = 20) -> DataFrame:
    """All rows and columns of ``docs``, with ``text`` reduced to its lines that repeat no earlier line.

    Adds n_lines (all lines) and n_dropped, in the place of columns of these names.  A line is a repetition if an
    earlier line of the corpus, of this or another document, is equal or (from
    ``edit_chars`` characters on) one edit away, whether or not that one was
    dropped itself.  Blanks at both ends of a line don't count; blank lines are
    kept.  A null text stays null, with 0 lines; an empty text is one blank
    line.  Rows equal in doc_id and text are one document to this operator:
    they all keep its first lines.  Null doc_ids come before all others.  Other
    columns stay, whatever their names.  Time and memory grow with the length
    of a text, however many of its lines go.  An empty table gives no rows.
    """
    drops = duplicate_lines(docs.select("doc_id", "text"), edit_chars).groupBy(
        F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).agg(F.sort_array(F.collect_list("pos")).alias("__drops"))
    joined = docs.join(drops, docs["doc_id"].eqNullSafe(drops["__id"]) & (F.xxhash64(docs["text"]) == drops["__tie"]), "left")
    lines, dropped = F.split(docs["text"], "\n", -1), drops["__drops"]
    text = F.when(dropped.isNull(), docs["text"]).otherwise(F.array_join(let(lines, lambda all_lines: without(all_lines, dropped)), "\n"))
    n = F.when(docs["text"].isNull(), F.lit(0)).otherwise(F.size(lines))
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*[text.alias("text") if c == "text" else docs[names.quote(c)] for c in kept_columns],
                         n.cast("long").alias("n_lines"),
                         F.when(dropped.isNull(), F.lit(0)).otherwise(F.size(dropped)).cast("long").alias("n_dropped"))


def without(values: Column, places: Column) -> Column:
    """``values`` without those at ``places`` (ascending, from 0): the stretches between them, in one pass over both."""
    before = F.concat(F.array(F.lit(-1)), places)

    def stretches(ends: Column) -> Column:
        return F.flatten(F.transform(before, lambda at, i: F.slice(values, at + 2, F.greatest(F.get(ends, i) - at - 1, F.lit(0)))))

    return let(F.concat(places, F.array(F.size(values))), stretches)
