"""Repairs of conversations against a programme that carries (cost, letters) for every path length, and against all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import conversation_repair as cr

BLANKS = " \t\n\x0b\x0c\r"
ROLE = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        if not text.strip(BLANKS):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if text.strip(BLANKS)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def solve(rows, said):
    """Least (cost, letters) with the result, forwards, by initials read so far."""
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}
    layer = {"": [(0, "", ())]}

    def insertions(layer):
        for _ in range(3):
            for q, paths in list(layer.items()):
                for c, a, done in paths:
                    for x in nexts[q]:
                        if x != "s":
                            layer.setdefault(x, [])
                            new = (c + 2, a + "I", (*done, (ROLE[x], "")))
                            if new not in layer[x] and c + 2 <= min((p[0] for p in layer[x]), default=99) + 4:
                                layer[x].append(new)
        return layer

    for (_, role, text), fault in zip(rows, said):
        layer, new = insertions(layer), {}
        for q, paths in layer.items():
            for c, a, done in paths:
                new.setdefault(q, []).append((c + 3, a + "D", done))
                if fault in ("blank", "duplicate"):
                    continue
                extra = fault == "truncated"
                if role[:1] and role[:1] in nexts[q]:
                    new.setdefault(role[0], []).append((c + extra, a + "K", (*done, (role, text))))
                for x in nexts[q]:
                    if x != "s":
                        new.setdefault(x, []).append((c + 2 + extra, a + "R", (*done, (ROLE[x], text))))
        layer = {}
        for q, paths in new.items():
            least = min(p[0] for p in paths)
            layer[q] = sorted(p for p in set(paths) if p[0] == least)[:400]
    layer = insertions(layer)
    return min(p for q in ("", "a") for p in layer.get(q, []))


def brute(conversations):
    convs, out = {}, []
    for conv, turn, role, text in conversations:
        convs.setdefault(conv, [])
        text, role = " " if text is None else text, " " if role is None else role
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        convs[conv] += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for conv, rows in convs.items():
        out.append((conv, *brute_one(rows)))
    return sorted(out, key=repr)


def brute_one(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, done = solve(rows, said)
    text = "\n".join(f"{r}:{t}" for r, t in done)
    return (gaps, *(said.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def conversations(n, seed, most=9):
    rnd, rows = random.Random(seed), []
    for conv in range(n):
        turn = 0
        for _ in range(rnd.randrange(1, most)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rnd.choice(["Hello.", "yes", "no!", " \t", "", None, "a?  \n", "Well", "Éé…", "x" * 50 + "."])
            rows.append((conv, None if rnd.random() < .1 else turn, role, text))
            turn += rnd.choice([1, 1, 1, 2, 0, 300])
    return rows


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = cr.repair_damaged(df).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    check(spark, conversations(250, seed))


def test_slices_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(cr, "SLICE", 3)
    monkeypatch.setattr(cr, "CHUNK", 2)
    check(spark, conversations(120, 3, 20))


def test_nulls_ties_and_repeated_rows(spark):
    check(spark, [(None, None, None, None), (None, 1, "user", "a."), (5, None, "user", "b."), (5, None, "assistant", "c."), (5, None, "assistant", "c."),
                  (6, 2, "user", "same."), (6, 2, "user", "same."), (7, 10**12, "system", "s."), (7, -4, "system", "t.")])


def test_all_edits_of_short_conversations():
    """Every sequence of edits with at most two insertions between rows, for short conversations."""
    texts = {"sound": "x.", "truncated": "x", "blank": " "}

    def all_edits(rows):
        said = faults(rows)
        best = (99, "")
        gaps = [""] + ["".join(p) for k in (1, 2) for p in itertools.product("ua", repeat=k)]
        choices = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in said]
        for edits in itertools.product(*choices):
            for puts in itertools.product(gaps, repeat=len(rows) + 1):
                initials, audit, cost = "", "", 0
                for k, put in enumerate(puts):
                    initials, audit, cost = initials + put, audit + "I" * len(put), cost + 2 * len(put)
                    if k < len(rows):
                        e = edits[k]
                        audit += e[0]
                        cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (e != "D" and said[k] == "truncated")
                        initials += {"D": "", "K": rows[k][1][:1]}.get(e[0], e[1:])
                if re.fullmatch("(s?(ua)+)?", initials):
                    best = min(best, (cost, audit))
        return best

    for n in range(4):
        for roles in itertools.product(["system", "user", "assistant", "tool"], repeat=n):
            rnd = random.Random(repr(roles))
            rows = [(k, r, rnd.choice(list(texts.values())) + " " * k if rnd.random() < .3 else f"{k}{rnd.choice(['x.', 'y'])}") for k, r in enumerate(roles)]
            if n == 3 and rnd.random() < .8:
                continue
            codes = "".join(chr(65 + 4 * "sua".find(r[0]) + ["", "blank", "duplicate", "truncated"].index(f)) if r[0] in "sua"
                            else chr(65 + 12 + ["", "blank", "duplicate", "truncated"].index(f)) for (_, r, _), f in zip(rows, faults(rows)))
            assert cr.best_paths(codes, (0, 3))[0] == all_edits(rows) == solve(rows, faults(rows))[:2]


def test_cut_paths_join():
    """Paths joined from chunks equal the path over all rows."""
    rnd = random.Random(4)
    for _ in range(300):
        codes = "".join(chr(65 + rnd.randrange(16)) for _ in range(rnd.randrange(1, 40)))
        cuts = sorted(rnd.sample(range(len(codes) + 1), min(3, len(codes))))
        parts = []
        for part in (codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])):
            to = [cr.best_paths(part, (q,)) for q in range(4)]
            each = [to[q][p] for p in range(4) for q in range(4)]
            parts.append(([e and e[0] for e in each], [e and e[1] for e in each]))
        cost, letters = cr.join_paths(parts)
        assert (cost, "".join(letters)) == cr.best_paths(codes, (0, 3))[0]


def test_repaired_rows_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a.", "x", 1), (1, 1, "user", "b.", "y", 2), (1, 2, "assistant", "c", "z", 3)],
                                 "conv_id long, turn long, role string, text string, audit string, slice long")
    summary, turns = cr.repair(rows)
    assert summary.select("cost", "audit", "illegal").collect() == [(3, "KIKK", 1)]
    got = turns.orderBy("place").collect()
    assert [(r["place"], r["turn"], r["role"], r["text"], r["edit"]) for r in got] == [
        (1, 0, "user", "a.", "K"), (2, None, "assistant", "", "I"), (3, 1, "user", "b.", "K"), (4, 2, "assistant", "c", "K")]
    none = rows.where("turn > 9")
    assert cr.repair_damaged(none).collect() == [] and cr.repair(none)[1].collect() == []


def test_long_conversation_and_long_text(spark):
    """20,000 turns of one conversation, a third of them repeating one row, and a text of a million characters."""
    n = spark.range(20_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                   F.when(F.col("id") % 6 < 2, "again.").when(F.col("id") == 100, F.repeat(F.lit("w"), 1_000_000)).otherwise(
                                       F.concat(F.lit("t"), F.col("id").cast("string"), F.lit("."))).alias("text"))
    summary, turns = cr.repair(n)
    row = summary.collect()[0]
    assert row["duplicate"] == 6_666 and row["audit"].count("D") >= 6_666 and row["truncated"] == 1
    initials = "".join(r[0] for r in turns.orderBy("place").select(F.substring("role", 1, 1)).collect())
    assert re.fullmatch("(s?(ua)+)?", initials)
