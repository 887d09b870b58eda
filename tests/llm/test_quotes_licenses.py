"""Quotation links and license scans on small fixtures with known results."""

import random
import re

from sensorloom.llm.licenses import TEMPLATES, scan_licenses
from sensorloom.llm.quotes import quotation_links, reply_ordered

MESSAGES = [
    (1, 0, "user", "Hello there.\nHow are you?"), (1, 1, "assistant", "> How are you?\n\nFine, thanks."),
    (1, 2, "user", "On Monday X wrote:\n>> How are you?\n> Fine, thanks.\n\nGood to hear"),
    (1, 3, "user", "> Hello there.\n> How are you?\n\nto the first"), (2, 0, "user", "> GOOD to   hear\nwhat?"), (2, 1, "assistant", None),
    (2, 2, "user", "> never written\n"), (None, 0, "user", ""), (3, 5000, "user", "late"), (3, 2, "user", "early"),
    (3, 1030, "x", "> early\nmid"), (4, None, "user", "no turn"), (4, 1, "user", "a > b"), (4, 1, "user", "a > b"),
]


def test_replies(spark):
    df = spark.createDataFrame([(*m, 0) for m in MESSAGES], "conv_id long, turn long, role string, text string, position int")
    rows = reply_ordered(df).collect()
    assert len(rows) == len(MESSAGES)
    got = {(r["conv_id"], r["turn"]): r for r in rows}
    text = {k: r["text"] for k, r in got.items()}
    assert text[(1, 1)] == "Fine, thanks." and text[(1, 2)] == "Good to hear" and text[(1, 3)] == "to the first"
    assert text[(2, 0)] == "what?" and text[(2, 1)] is None and text[(2, 2)] == "" and text[(4, 1)] == "a > b" and text[(None, 0)] == ""
    reply = {k: r["reply_to"] for k, r in got.items()}
    assert [reply[(1, t)] for t in range(4)] == [None, 0, 1, 0] and reply[(3, 5000)] == 1030 and reply[(3, 1030)] == 2
    assert got[(1, 2)]["quote_levels"] == 2 and got[(1, 2)]["n_quoted"] == 2 and len(got[(1, 2)]["origins"]) == 2
    assert [tuple(o) for o in got[(2, 0)]["origins"]] == [(1, 2)] and got[(2, 2)]["n_linked"] == 0
    for conv in {m[0] for m in MESSAGES}:
        assert sorted(r["position"] for r in rows if r["conv_id"] == conv) == list(range(1, 1 + sum(m[0] == conv for m in MESSAGES)))
    assert [r["turn"] for r in sorted((r for r in rows if r["conv_id"] == 3), key=lambda r: r["position"])] == [2, 1030, 5000]


def plain_passages(text):
    """The paragraphs of a message, line by line."""
    found, last = [], None
    for line in text.split("\n"):
        mark = re.match(r"\s{0,3}(?:>\s?)+", line)
        level, body = (mark.group().count(">"), line[mark.end():]) if mark else (0, line)
        kind = level if body.strip(" ") else -1
        if kind >= 0:
            if kind == last:
                found[-1] = (level, found[-1][1] + "\n" + body)
            else:
                found.append((level, body))
        last = kind
    return found


def plain_norm(body):
    return re.sub(r"\s+", " ", body.lower()).strip(" ")


def test_links_by_brute_force(spark):
    """Every quoted paragraph or line, looked up among all messages by plain loops."""
    rnd = random.Random(11)
    said = [f"{rnd.choice(['yes', 'no', 'well', 'then'])} number {k}" for k in range(25)]
    messages = []
    for conv in range(12):
        for turn in range(8):
            lines = []
            for _ in range(rnd.randint(0, 7)):
                lines.append(rnd.choice(["", "> ", ">> ", "> > > ", "", " "]) + rnd.choice([*said, "", said[0].upper()]))
            messages.append((conv, turn, "user", "\n".join(lines)))
    written, quoted = {}, set()
    for conv, turn, _, text in messages:
        for level, body in plain_passages(text):
            units = [("paragraph", plain_norm(body))] + [("line", plain_norm(x)) for x in body.split("\n") if "\n" in body]
            for unit, key in units:
                if key and level:
                    quoted.add((conv, turn, level, unit, key))
                elif key:
                    written.setdefault(key, set()).add((conv, turn))
    want = set()
    for conv, turn, level, unit, key in quoted:
        here = [p for p in written.get(key, ()) if p[0] == conv and p[1] < turn]
        there = [p for p in written.get(key, ()) if p[0] != conv]
        want.add((conv, turn, level, unit, key, *min(here or there or [(None, None)])))
    df = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    keys = {r[1]: r[0] for r in spark.createDataFrame([(k,) for k in {q[4] for q in quoted}], "body string").selectExpr("body", "xxhash64(body)").collect()}
    got = [(r["conv_id"], r["turn"], r["level"], r["unit"], keys[r["k1"]], r["from_conv"], r["from_turn"]) for r in quotation_links(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and sum(w[5] is not None for w in want) > 50


def test_long_message(spark):
    """50,000 paragraphs, half of them quoted: time grows with the paragraphs, not with their square."""
    first = "\n\n".join(f"passage {k}" for k in range(25_000))
    second = "\n\n".join(f"> passage {k}\n\nanswer {k}" for k in range(25_000))
    df = spark.createDataFrame([(1, 0, "user", first), (1, 1, "assistant", second)], "conv_id long, turn long, role string, text string")
    row = next(r for r in reply_ordered(df).collect() if r["turn"] == 1)
    assert row["n_quoted"] == row["n_linked"] == 25_000 and row["reply_to"] == 0 and ">" not in row["text"]


def test_no_messages(spark):
    assert reply_ordered(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


FILES = [
    (1, "a/LICENSE", "Released under the MIT License.\nxx yy"), (2, "a/b/c/x.py", "nothing here"),
    (3, "a/b/y.py", "a lot of other text in many more words than the notice has itself, so that the file is code\n"
                    "Licensed under the Apache License, Version 2.0."),
    (4, "z/q.txt", "Licensed under CC BY-NC 4.0."), (5, "z/w/e.txt", "the text"), (6, "other.txt", None), (7, None, "abc"),
    (8, "a/b/d/COPYING", "This work is licensed under the GNU General Public License, version 3.\n" + "filler words " * 20),
    (9, "a/b/d/e/f/g.c", ""), (None, "a/n.txt", "Released under the MIT License."), (3, "a/b/y.py", "again"),
]


def test_licenses(spark):
    df = spark.createDataFrame([(*f, "x") for f in FILES], "file_id long, path string, text string, license string").drop("license")
    rows = scan_licenses(df).collect()
    assert len(rows) == len(FILES)
    got = {r["file_id"]: (r["license"], r["found"], r["license_dir"]) for r in rows}
    assert got[1][:2] == ("MIT", "file") and got[4][:2] == ("CC-BY-NC-4.0", "file") and got[3][:2] == ("Apache-2.0", "notice")
    assert got[2] == ("MIT", "inherited", "a") and got[5] == ("CC-BY-NC-4.0", "inherited", "z")
    assert got[8][:2] == ("GPL-3.0", "notice") and got[9] == ("GPL-3.0", "inherited", "a/b/d")
    assert got[6] == (None, None, None) and got[7] == (None, None, None) and got[None] == ("MIT", "inherited", "a")
    assert scan_licenses(df.limit(0)).count() == 0


def test_templates_name_themselves(spark):
    df = spark.createDataFrame([(i, f"d{i}/x", t) for i, (_, t) in enumerate(TEMPLATES)], "file_id long, path string, text string")
    for r in scan_licenses(df).collect():
        assert r["license"] == TEMPLATES[r["file_id"]][0] and r["cosine"] > 0.999


def test_origin_in_another_conversation(spark):
    """The quoting conversation has the least conv_id among the writers, but wrote the passage in the same or a later turn only."""
    rows = [(1, 0, "user", "> shared words\n\nshared words"), (1, 3, "user", "shared words"), (7, 2, "user", "shared words"), (7, 1, "user", "x\n\nshared words"),
            (5, 4, "user", "> shared words"), (9, 0, "user", "> only here"), (9, 1, "user", "only here"),
            (None, 0, "user", "> null first"), (None, 1, "user", "null first"), (3, 6, "user", "null first"), (4, 0, "user", "> null first")]
    got = {(r["conv_id"], r["turn"]): [tuple(o) for o in r["origins"]] for r in
           reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got[(1, 0)] == [(7, 1)] and got[(5, 4)] == [(1, 0)] and got[(9, 0)] == []
    assert got[(None, 0)] == [(3, 6)] and got[(4, 0)] == [(None, 1)]
