"""Chat formatting: messages linked to the messages they quote, in reply order, without the quotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import let, stored

SLICE = 1024  # turns of one slice of a conversation

_MARK = r"^\s{0,3}(?:>\s?)+"
# The line that mail programs put above a quotation.
_ATTRIBUTION = r"(?i)^(on|am|le|el)\b.{0,200}(wrote|schrieb.{0,80}|a écrit|escribió)\s?:\s*$"


def parsed(text: Column) -> Column:
    """Lines of a message as (level, body): level counts the quotation marks in front."""
    return F.transform(F.split(text, "\n", -1), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, _MARK, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(line, _MARK, "").alias("body")))


def own_text(lines: Column) -> Column:
    """Lines of level 0, without the attribution above a quotation, joined again."""

    def keep(line: Column, i: Column) -> Column:
        following = F.get(lines, i + 1)["level"]
        return (line["level"] == 0) & ~(F.coalesce(following > 0, F.lit(False)) & line["body"].rlike(_ATTRIBUTION))

    return F.trim(F.regexp_replace(F.array_join(F.transform(F.filter(lines, keep), lambda x: x["body"]), "\n"), r"\n{3,}", "\n\n"), F.lit("\n "))


def passages(lines: Column) -> Column:
    """Paragraphs as (level, body): runs of lines of one level without a blank line."""

    def kind(i: Column) -> Column:
        line = F.get(lines, i)
        return F.when(F.trim(line["body"]) == "", F.lit(-1)).otherwise(line["level"])

    def of_runs(starts: Column, n: Column) -> Column:
        """A run ends where the next one starts, so every line is looked at a fixed number of times."""
        runs = F.transform(starts, lambda at, k: F.struct(
            kind(at).alias("level"), at.alias("at"), (F.coalesce(F.get(starts, k + 1), n) - at).alias("length")))
        return F.transform(F.filter(runs, lambda run: run["level"] >= 0), lambda run: F.struct(
            run["level"].alias("level"),
            F.array_join(F.transform(F.slice(lines, run["at"] + 1, run["length"]), lambda x: x["body"]), "\n").alias("body")))

    def from_starts(n: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (kind(i) != kind(i - 1)))
        return let(starts, lambda found: of_runs(found, n))

    return let(F.size(lines), from_starts)


def norm(body: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(body), r"\s+", " "))


def _keys(body: Column) -> list[Column]:
    return [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(29), body).alias("k2")]


def _units(rows: DataFrame) -> DataFrame:
    """Paragraphs, and their lines where there are several, with the hashes of their normalised text."""
    whole = F.struct(F.lit("paragraph").alias("unit"), norm(F.col("p.body")).alias("body"))
    each = F.transform(F.split("p.body", "\n"), lambda line: F.struct(F.lit("line").alias("unit"), norm(line).alias("body")))
    units = rows.withColumn("u", F.explode(F.when(F.instr("p.body", "\n") > 0, F.concat(F.array(whole), each)).otherwise(F.array(whole))))
    return units.where(F.col("u.body") != "").select(*[c for c in rows.columns if c != "p"], "p.level", "u.unit", *_keys(F.col("u.body")))


def quotation_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, unit, k1, k2, from_conv, from_turn): quoted passages and where they were written.

    A passage is looked up among the earlier messages of its conversation
    first, then among all other conversations; the earliest message that has it
    outside quotations is its origin.  Origins are reduced to one row per hash
    before the join (the least origin, and the least one of another
    conversation), so a passage that many messages contain stays one row."""
    # a message has a quotation mark at the head of a line, or it has nothing to look up
    quoting = messages.where(F.col("text").rlike(r"(?m)^\s{0,3}>"))
    quoted = _units(quoting.select("conv_id", "turn", parsed(F.col("text")).alias("lines"))
                    .select("conv_id", "turn", F.explode(passages(F.col("lines"))).alias("p")).where("p.level > 0"))
    quoted = quoted.distinct()
    wanted = quoted.select("k1", "k2").distinct()
    written = _units(messages.where(F.col("text").isNotNull()).select("conv_id", "turn", parsed(F.col("text")).alias("lines"))
                     .select("conv_id", "turn", F.explode(passages(F.col("lines"))).alias("p")).where("p.level = 0"))
    written = written.join(wanted, ["k1", "k2"], "left_semi")
    here = stored(written.groupBy("k1", "k2", F.col("conv_id").alias("here_conv")).agg(F.min("turn").alias("here_turn")), "origins")
    origin = F.min(F.struct(F.col("here_conv").alias("conv_id"), F.col("here_turn").alias("turn")))
    least = here.groupBy("k1", "k2").agg(origin.alias("there"))
    other = here.join(least, ["k1", "k2"]).where(~F.col("here_conv").eqNullSafe(F.col("there.conv_id"))) \
        .groupBy("k1", "k2").agg(origin.alias("other"))
    anywhere = least.join(other, ["k1", "k2"], "left")
    found = quoted.join(here, (quoted["k1"] == here["k1"]) & (quoted["k2"] == here["k2"]) & quoted["conv_id"].eqNullSafe(here["here_conv"])
                        & (here["here_turn"] < quoted["turn"]), "left").select(quoted["*"], "here_turn")
    found = found.join(anywhere, ["k1", "k2"], "left")
    there = F.when(~F.col("there.conv_id").eqNullSafe(F.col("conv_id")), F.col("there")).otherwise(F.col("other"))
    return found.select(
        "conv_id", "turn", "level", "unit", "k1", "k2",
        F.when(F.col("here_turn").isNotNull(), F.col("conv_id")).otherwise(there["conv_id"]).alias("from_conv"),
        F.coalesce("here_turn", there["turn"]).alias("from_turn"))


def reply_ordered(messages: DataFrame) -> DataFrame:
    """Every message with its place in its conversation, what it replies to, and its text without quotations.

    Columns: conv_id, turn, role, position (from 1, in reply order), reply_to
    (turn of the same conversation), quote_levels (deepest level), n_quoted
    (quoted paragraphs), n_linked (of them or of their lines, those with a known
    origin), origins (conv_id and turn of each origin, sorted), text.

    A message replies to the latest message of its conversation that it quotes
    at the lowest level; without a linked quotation, to the message before it.
    Both are earlier turns, so the order of turns is a reply order.

    Long conversations are numbered in slices of 1,024 turns.  A null text
    stays null and quotes nothing; a message of quotations only has an empty
    text.  Null conv_ids form one conversation; null turns come first.
    Repeated (conv_id, turn) rows all stay, in the order of role and text, with
    the links of all of them.  An empty table gives no rows.
    """
    rows = messages.select("conv_id", "turn", "role", "text")
    lines = parsed(F.col("text"))
    clean = F.when(F.col("text").rlike(r"(?m)^\s{0,3}>"), let(lines, own_text)).otherwise(F.col("text"))
    levels = F.coalesce(F.array_max(F.transform(lines, lambda x: x["level"])), F.lit(0))
    counted = let(lines, passages)
    quotes = F.col("text").rlike(r"(?m)^\s{0,3}>")
    rows = rows.select(
        "conv_id", "turn", "role", clean.alias("clean"), F.xxhash64("role", "text").alias("tie"),
        F.when(quotes, levels).otherwise(F.lit(0)).alias("quote_levels"),
        F.when(quotes, F.size(F.filter(counted, lambda p: p["level"] > 0))).otherwise(F.lit(0)).cast("long").alias("n_quoted"),
        F.floor(F.col("turn") / SLICE).alias("slice"))
    links = quotation_links(messages).where("from_turn is not null")
    lowest = F.min("level").over(Window.partitionBy("conv_id", "turn"))  # the quoted passages of one message
    links = links.withColumn("lowest", lowest).groupBy(F.col("conv_id").alias("q_conv"), F.col("turn").alias("q_turn")).agg(
        F.count(F.lit(1)).alias("n_linked"),
        F.max(F.when((F.col("level") == F.col("lowest")) & F.col("from_conv").eqNullSafe(F.col("conv_id")), F.col("from_turn"))).alias("quoted_turn"),
        F.sort_array(F.collect_set(F.struct(F.col("from_conv").alias("conv_id"), F.col("from_turn").alias("turn")))).alias("origins"))
    inside = Window.partitionBy("conv_id", "slice").orderBy("turn", "tie")
    earlier = Window.partitionBy("conv_id", "slice").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("nth", F.row_number().over(inside)).withColumn("before", F.max("turn").over(earlier))
    # one row per slice of a conversation
    of_slice = Window.partitionBy("s_conv").orderBy("s_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy(F.col("conv_id").alias("s_conv"), F.col("slice").alias("s_slice")).agg(
        F.count(F.lit(1)).alias("n"), F.max("turn").alias("last"))
    slices = slices.select("s_conv", "s_slice", F.coalesce(F.sum("n").over(of_slice), F.lit(0)).alias("skipped"),
                           F.max("last").over(of_slice).alias("before_slice"))
    placed = rows.join(slices, F.col("conv_id").eqNullSafe(F.col("s_conv")) & F.col("slice").eqNullSafe(F.col("s_slice")))
    out = placed.join(links, F.col("conv_id").eqNullSafe(F.col("q_conv")) & F.col("turn").eqNullSafe(F.col("q_turn")), "left")
    return out.select(
        "conv_id", "turn", "role", (F.col("skipped") + F.col("nth")).cast("long").alias("position"),
        F.coalesce("quoted_turn", "before", "before_slice").alias("reply_to"), "quote_levels", "n_quoted",
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("origins", F.array().cast("array<struct<conv_id:bigint,turn:bigint>>")).alias("origins"), F.col("clean").alias("text"))
