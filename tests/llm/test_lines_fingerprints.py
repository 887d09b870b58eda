"""Line deduplication and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from sensorloom.llm.fingerprint import fingerprints
from sensorloom.llm.line_dedup import drop_repeated_lines


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:]


def line_documents():
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abcd é") for _ in range(n)) for n in (20, 21, 25, 63, 64, 65, 127, 128, 129, 200, 300, 19, 5)]
    docs = []
    for d in range(90):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            s, k = rnd.choice(base), rnd.random()
            i = rnd.randrange(len(s))
            if k < .3:
                s = s[:i] + rnd.choice("abcdé") + s[i + 1:]
            elif k < .5:
                s = s[:i] + s[i + 1:]
            elif k < .7:
                s = s[:i] + rnd.choice("abcd") + s[i:]
            elif k < .8:
                s = "  " + s + " "
            lines.append(s)
        docs.append((d if d % 17 else None, "\n".join(lines) if d % 23 else None, 4))
    long_line = "".join(rnd.choice("abcdefgh ") for _ in range(20_000))
    return [*docs, docs[5], (7, "", 4), (500, long_line, 4), (501, long_line[:9000] + long_line[9001:], 4)]


def test_lines(spark):
    docs = line_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string, pos int")
    tie = {r[0]: r[1] for r in df.selectExpr("text", "xxhash64(text)").collect()}

    def place(d, t, p):
        return ((0, 0) if d is None else (1, d), tie[t], p)

    lines = {(place(d, t, p), x.strip(" ")) for d, t, _ in docs if t is not None for p, x in enumerate(t.split("\n")) if x.strip(" ")}
    dropped = {k for k, x in lines for k2, x2 in lines if k2 < k and (x == x2 or (len(x) >= 20 and len(x2) >= 20 and near(x, x2)))}
    want = Counter((d, None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if place(d, t, p) not in dropped)) for d, t, _ in docs)
    rows = drop_repeated_lines(df).collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == want and len(dropped) > 100
    assert all(r["n_lines"] == (0 if r["text"] is None else r["n_lines"]) and r["pos"] == 4 for r in rows)
    assert drop_repeated_lines(df.limit(0)).count() == 0


def test_lines_of_very_long_texts(spark):
    """200,000 lines, of which every second one repeats an earlier one: time grows with the lines, not with their square."""
    head = "\n".join(f"{k} {k * 7919 % 100_003} first" for k in range(100_000))
    mixed = "\n".join(f"{k} {k * 7919 % 100_003} first\n{chr(97 + k % 26) * 3}{k * 104_729 % 1_299_709} second {k}" for k in range(100_000))
    df = spark.createDataFrame([(1, head), (2, mixed)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in drop_repeated_lines(df, edit_chars=10_000).collect()}
    assert rows[1]["text"] == head and rows[1]["n_dropped"] == 0
    assert rows[2]["n_lines"] == 200_000 and rows[2]["n_dropped"] == 100_000
    assert rows[2]["text"] == "\n".join(mixed.split("\n")[1::2])


def test_lines_with_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a line\nb", 5, 6, 7, 8.0), (2, "a line\nc", 5, 6, 7, None)],
                               "doc_id long, text string, __id int, __tie int, __drops int, `a.b` double")
    out = drop_repeated_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a line\nb", 5, 6, 7, 8.0, 2, 0), (2, "c", 5, 6, 7, None, 2, 1)]


def shingles(text):
    w = [x for x in re.split(r"[\x09-\x0D\x20]+", text.lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints(spark):
    rng = np.random.default_rng(6)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 5000, n)) for n in (40, 300, 900, 2500)]
    docs = [(2 * i, base[i % 4] if i % 3 else base[i % 4] + " and more of it é" * (i % 5)) for i in range(60)]
    docs += [(200, None), (201, ""), (202, "one"), (203, "a b c d e"), (204, " \n"), (300, base[0]), (301, base[0])]
    rows = {r["doc_id"]: r for r in fingerprints(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    order = sorted(((d, t or "") for d, t in docs), reverse=True)
    errors = []
    for k, (d, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = rows[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for other, got in ((edited, r["near_edited"]), (after, r["near_next"])):
            a, b = shingles(t), shingles(other)
            errors.append(got - (len(a & b) / len(a | b) if a | b else 1.0))
            assert 0 <= got <= 1
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.2
    assert rows[300]["fingerprint"] == rows[301]["fingerprint"] and rows[200]["fingerprint"] == "" and len(rows[202]["fingerprint"]) == 256


@pytest.mark.parametrize("rows", [[], [(None, "x y z")], [(5, "same id"), (5, "same id"), (5, "another text")]])
def test_fingerprint_corners(spark, rows):
    assert fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(rows)
