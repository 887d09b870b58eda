"""Repair of the structure of conversations: the cheapest edits that make roles alternate, by scalar big-integer weights.

A row may be kept, given another role or deleted, and rows without text may be
inserted, so that the initials of the roles read ``(s?(ua)+)?``.  The states of
that pattern and the rows form an acyclic graph.  The weight of a path is one
integer: its high digits are the cost, its low digits the letters of the edits
in order, three bits each in a field of fixed width, padded with zeros at the
end.  So the smaller integer is the cheaper path, or of two equally cheap ones
the one whose letters come first in ASCII, and a dynamic programme that takes
the least integer at every node decides everything.

Long conversations are cut into slices of turns.  Each slice gives the best
path between any two states, slices are joined in order, and neither the texts
nor the rows of a conversation are ever gathered: the repaired rows are written
as a stream along the sorted table.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs

SLICE = 256  # turns of a slice
CHUNK = 64  # rows that one integer spans
HEAD = 32  # characters of a text by which rows of one turn are ordered

# State before a row: 0 nothing yet, 1 after s, 2 after u, 3 after a; the states that an initial leads to.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_ACCEPTED = (0, 3)
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = " DIKR"
_ROLE = {"u": "user", "a": "assistant"}
# A row in one character: 4 * (initial in "sua", else 3) + (0 sound, 1 blank, 2 duplicate, 3 truncated), from "A" on.
_INITIALS = "sua-"


def _decoded(code: str) -> tuple[str, int]:
    k = ord(code) - 65
    return _INITIALS[k >> 2], k & 3


@lru_cache(maxsize=50_000)
def best_paths(codes: str, ends: tuple[int, ...]) -> tuple[tuple[int, str] | None, ...]:
    """(cost, letters) of the best path over the rows from each state to one of the states ``ends``; None without any.

    At most two insertions between two rows are of use: a third would pass a state twice."""
    width = 3 * (3 * len(codes) + 3)
    top, low = width - 3, (1 << width) - 1
    never = 1 << (width + 64)

    def edge(cost: int, letter: str, rest: int) -> int:
        if rest >= never:
            return never
        letters = rest & low
        return rest - letters + (cost << width) + (_DIGIT[letter] << top) + (letters >> 3)

    def inserted(best: list[int]) -> list[int]:
        for _ in range(2):
            best = [min(b, *(edge(INSERT, "I", best[to]) for c, to in _NEXT[q].items() if c != "s")) for q, b in enumerate(best)]
        return best

    best = inserted([0 if q in ends else never for q in range(4)])
    for code in reversed(codes):
        initial, fault = _decoded(code)
        after, best = best, []
        for q in range(4):
            options = [edge(DELETE, "D", after[q])]
            if fault not in (1, 2):
                more = TRUNCATED if fault == 3 else 0
                if initial in _NEXT[q]:
                    options.append(edge(KEEP + more, "K", after[_NEXT[q][initial]]))
                options += [edge(REROLE + more, "R", after[to]) for c, to in _NEXT[q].items() if c != "s"]
            best.append(min(options))
        best = inserted(best)
    out = []
    for weight in best:
        if weight >= never:
            out.append(None)
            continue
        letters = weight & low
        text = []
        while letters:
            text.append(_LETTER[letters >> top])
            letters = (letters << 3) & low
        out.append((weight >> width, "".join(text)))
    return tuple(out)


def _before(x: tuple | None, y: tuple | None) -> bool:
    """Do the letters of the linked pieces ``x`` come before those of ``y``?"""
    s = t = ""
    while True:
        while not s and x:
            s, x = x
        while not t and y:
            t, y = y
        k = min(len(s), len(t))
        if not k:
            return bool(t)
        if s[:k] != t[:k]:
            return s[:k] < t[:k]
        s, t = s[k:], t[k:]
        if not s and not t and x is y:
            return False


def join_paths(parts: list[tuple[list, list]]) -> tuple[int, list[str]]:
    """Cost and letters, part by part, of the best path through parts given by the (costs, letters) of their 16 paths.

    Paths between the same states with equal costs are never beginnings of one
    another, so the best path consists of best paths of the parts."""
    best: list = [(0, None) if q in _ACCEPTED else None for q in range(4)]
    for costs, letters in reversed(parts):
        new: list = [None] * 4
        for p in range(4):
            for q in range(4):
                if costs[4 * p + q] is None or best[q] is None:
                    continue
                cost, path = costs[4 * p + q] + best[q][0], (letters[4 * p + q], best[q][1])
                if new[p] is None or cost < new[p][0] or (cost == new[p][0] and _before(path, new[p][1])):
                    new[p] = (cost, path)
        best = new
    cost, path = best[0]
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return cost, out


def row_parts(rows: DataFrame) -> list[Column]:
    """Columns of a row that order it in its turn and tell it from others, beside its role."""
    return [F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("t1"), F.xxhash64("text", F.lit(1)).alias("t2")]


def _sound(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text; one space for a null role or text."""
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))


def coded_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text as its parts) with the codes of all their repetitions; stored.

    The repetitions of a row are counted before anything is shuffled."""
    rows = _sound(rows)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 4).when(initial == "a", 8).otherwise(12)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    closed = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    each = rows.select("conv_id", "turn", "role", *row_parts(rows), kind.alias("kind"), blank.alias("blank"), closed.alias("closed"))
    each = stored(each.groupBy(each.columns).agg(F.count(F.lit(1)).cast("int").alias("copies")), "turns")
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = each.groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("t1").alias("f1"), F.col("t2").alias("f2")) \
        .agg(F.min(place).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("t1") == F.col("f1")) & (F.col("t2") == F.col("f2"))

    def code(fault: int) -> Column:
        return F.char(65 + F.col("kind") + fault)

    own = F.when(F.col("closed"), code(0)).otherwise(code(3))
    repeats = F.col("copies") - F.when(place == F.col("first"), 1).otherwise(0)
    codes = F.when(F.col("blank"), F.repeat(code(1), F.col("copies"))).otherwise(
        F.concat(F.when(place == F.col("first"), own).otherwise(""), F.repeat(code(2), repeats)))
    return each.join(firsts, same).select("conv_id", "turn", "role", "head", "t1", "t2", codes.alias("codes"))


_PIECE = "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def pieces(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per slice of a conversation: its facts and its 16 paths, chunk by chunk.

    ``ids`` (conv_id) names conversations that are to appear even without rows."""
    in_order = F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull(), "turn", "role", "head", "t1", "t2", "codes")))
    coded = coded_rows(rows)
    found = coded.groupBy("conv_id", F.floor(F.col("turn") / SLICE).alias("slice")).agg(
        F.array_join(F.transform(in_order, lambda x: x["codes"]), "").alias("codes"),
        F.min("turn").cast("long").alias("low"), F.max("turn").cast("long").alias("high"), F.size(F.collect_set("turn")).cast("long").alias("turns"))
    found = found.unionByName(ids.select("conv_id").distinct().select(
        "conv_id", F.lit(None).cast("long").alias("slice"), F.lit("").alias("codes"), F.lit(None).cast("long").alias("low"),
        F.lit(None).cast("long").alias("high"), F.lit(0).cast("long").alias("turns")))
    names = ["conv_id", "slice", *(c.split()[0] for c in _PIECE.split(", ")), "costs", "letters"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts: list[list] = [[] for _ in range(6)]
            costs, letters = [], []
            for codes in batch.column(2).to_pylist():
                n = Counter((ord(c) - 65) & 3 for c in codes)
                initials = "".join(_decoded(c)[0] for c in codes)
                illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
                for column, value in zip(facts, (n[1], n[2], n[3], illegal, initials[:1], initials[-1:])):
                    column.append(value)
                part_costs, part_letters = [], []
                for at in range(0, len(codes), CHUNK):
                    to = [best_paths(codes[at:at + CHUNK], (q,)) for q in range(4)]
                    each = [to[q][p] for p in range(4) for q in range(4)]
                    part_costs += [e and e[0] for e in each]
                    part_letters += [e and e[1] for e in each]
                costs.append(part_costs)
                letters.append(part_letters)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *batch.columns[3:6], *(pa.array(v, t) for v, t in zip(facts, kinds)),
                 pa.array(costs, pa.list_(pa.int64())), pa.array(letters, pa.list_(pa.string()))], names=names)

    kind = rows.schema["conv_id"].dataType.simpleString()
    return found.mapInArrow(run, f"conv_id {kind}, slice long, {_PIECE}, costs array<long>, letters array<string>")


def plan(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The repairs of all conversations; stored.

    One row per conversation (piece false): gaps, blank, duplicate, truncated,
    illegal, cost, audit (the letters of all edits).  One row per slice (piece
    true): its letters, as ``audit``."""
    slices = pieces(rows, rows.select("conv_id") if ids is None else ids)
    slices = slices.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("slice"))
    facts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kind = rows.schema["conv_id"].dataType.simpleString()

    def solved(conv_id, some: list[dict]) -> Iterator[tuple]:
        low = min((s["low"] for s in some if s["low"] is not None), default=None)
        gaps = 0 if low is None else max(s["high"] for s in some if s["high"] is not None) - low + 1 - sum(s["turns"] for s in some)
        edges = [s["first"] + s["last"] for s in some if s["first"]]
        illegal = sum(s["illegal"] for s in some) + sum(a[1] + b[0] not in ("su", "ua", "au") for a, b in zip(edges, edges[1:]))
        counts = [sum(s[c] for s in some) for c in ("blank", "duplicate", "truncated")]
        parts = [(s["costs"][k:k + 16], s["letters"][k:k + 16]) for s in some for k in range(0, len(s["costs"]), 16)]
        cost, letters = join_paths(parts)
        yield (conv_id, False, None, gaps, *counts, illegal, cost, "".join(letters))
        at = 0
        for s in some:
            n = len(s["costs"]) // 16
            if n:
                yield (conv_id, True, s["slice"], *[None] * 6, "".join(letters[at:at + n]))
            at += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "piece", "slice", *facts, "audit"]
        conv, some, out = None, [], []

        def packed() -> pa.RecordBatch:
            types = [conv_type, pa.bool_(), *[pa.int64()] * 7, pa.string()]
            columns = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

        conv_type = None
        for batch in batches:
            conv_type = batch.schema.field(0).type
            for row in batch.to_pylist():
                if some and row["conv_id"] != conv:
                    out += solved(conv, some)
                    some = []
                    if len(out) > 2000:
                        yield packed()
                        out = []
                conv = row["conv_id"]
                some.append(row)
        if some:
            out += solved(conv, some)
        if out:
            yield packed()

    schema = f"conv_id {kind}, piece boolean, slice long, {', '.join(f'{c} long' for c in facts)}, audit string"
    return stored(slices.mapInArrow(run, schema), "repairs")


def repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows of all conversations after their repairs, in order within a partition.

    Columns: conv_id, place (from 1), turn (null for an inserted row), role,
    text, edit (K kept, R given another role, I inserted).  Rows and the letters
    of their slices meet in one sorted exchange and are read as a stream."""
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    texts = _sound(rows)
    texts = texts.select("conv_id", F.floor(F.col("turn") / SLICE).alias("slice"), F.lit(True).alias("is_row"), "turn", "role",
                         *row_parts(texts), "text", F.lit(None).cast("string").alias("audit"))
    letters = repairs.where("piece").select(
        "conv_id", "slice", F.lit(False).alias("is_row"), F.lit(None).cast(turn).alias("turn"), F.lit("").alias("role"), F.lit("").alias("head"),
        F.lit(0).cast("long").alias("t1"), F.lit(0).cast("long").alias("t2"), F.lit("").alias("text"), "audit")
    both = letters.unionByName(texts).repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("slice"), "is_row", F.asc_nulls_first("turn"), "role", "head", "t1", "t2")
    names = ["conv_id", "place", "turn", "role", "text", "edit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, state, place, audit, at = False, None, 0, 0, "", 0
        for batch in batches:
            types = [batch.schema.field(0).type, pa.int64(), batch.schema.field(3).type, *[pa.string()] * 3]
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                out: list[tuple] = []
                for conv_id, is_row, turn_, role, text, letters_ in zip(*(part.column(c).to_pylist() for c in
                                                                         ("conv_id", "is_row", "turn", "role", "text", "audit"))):
                    if not is_row or not begun or conv_id != conv:
                        for _ in audit[at:]:  # insertions behind the last row of a slice
                            place, initial = place + 1, next(c for c in _NEXT[state] if c != "s")
                            out.append((conv, place, None, _ROLE[initial], "", "I"))
                            state = _NEXT[state][initial]
                        if not begun or conv_id != conv:
                            begun, conv, state, place = True, conv_id, 0, 0
                        audit, at = letters_ or "", 0
                        if not is_row:
                            continue
                    while audit[at] == "I":
                        place, initial, at = place + 1, next(c for c in _NEXT[state] if c != "s"), at + 1
                        out.append((conv, place, None, _ROLE[initial], "", "I"))
                        state = _NEXT[state][initial]
                    letter, at = audit[at], at + 1
                    if letter != "D":
                        initial = role[0] if letter == "K" else next(c for c in _NEXT[state] if c != "s")
                        place, state = place + 1, _NEXT[state][initial]
                        out.append((conv, place, turn_, role if letter == "K" else _ROLE[initial], text, letter))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)
        out = []
        for _ in audit[at:]:
            place, initial = place + 1, next(c for c in _NEXT[state] if c != "s")
            out.append((conv, place, None, _ROLE[initial], "", "I"))
            state = _NEXT[state][initial]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)

    return both.mapInArrow(run, f"conv_id {kind}, place long, turn {turn}, role string, text string, edit string")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the result of ``repaired``: its ``role:text`` lines, hashed along the stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0).type
            done: list[tuple] = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if digest is None or conv_id != conv:
                    if digest is not None:
                        done.append((conv, digest.hexdigest()))
                    conv, digest, gap = conv_id, hashlib.sha256(), ""
                digest.update(f"{gap}{role}:{text}".encode("utf-8", "replace"))
                gap = "\n"
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done], pa.string())],
                                             names=["conv_id", "repaired_sha256"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return turns.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(rows: DataFrame, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(one row per conversation, the repaired rows) for rows conv_id, turn, role, text.

    Rows are taken by turn, nulls first, rows of one turn by role and text.
    The first fault of a row counts: blank (no character but blanks), duplicate
    (role and text came earlier in the conversation), truncated (its last
    character that is no blank is none of ``.!?``).  Blank and duplicate rows are
    deleted; the other edits are the cheapest ones, see the module.

    A null role or text is one space, so a row without text is blank.  Null
    conv_ids form one conversation.  Repeated rows are duplicates.  ``ids`` adds
    conversations without rows, which have zeros and an empty audit.  Other
    columns are ignored.  An empty table gives no rows.
    """
    repairs = plan(rows, ids)
    return repairs.where("not piece").drop("piece", "slice"), repaired(rows, repairs)


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults, chosen by crc32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the
    row, 4 makes its role user; nulls are one space."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fault = F.crc32(key.cast("binary")) % 20
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    out = rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), fault.alias("fault"))
    out = out.where("fault <> 0").withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return out.select("conv_id", "turn", "role", "text")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """Repairs of the damaged conversations: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    summary, turns = repair(damaged(conversations), conversations.select("conv_id"))
    digests = conversation_digests(turns).withColumnRenamed("conv_id", "d_conv")
    out = summary.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left").drop("d_conv")
    return out.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
