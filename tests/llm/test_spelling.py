"""Spelling variants against comparing every two words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from sensorloom.llm import spelling as sp


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 199 == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        others = sorted((-words[v], v) for v in words if near(w, v))
        form = others[0][1] if others and -others[0][0] >= 5 * n else None
        out[w] = [n, len(others), form, words[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return sorted((w, *v) for w, v in out.items())


def check(spark, docs):
    got = sp.spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))
    want = brute(docs)
    assert sorted(map(tuple, got.select("word", "n", "n_near", "form", "form_n", "root").collect())) == want
    return want


def corpus(seed, stems, letters="abcé"):
    """Words with edited variants, frequencies far apart."""
    rnd, words = random.Random(seed), []
    for _ in range(stems):
        w = "".join(rnd.choice(letters) for _ in range(rnd.randrange(6, 12)))
        n = 5 ** rnd.randrange(1, 5)
        while n >= 5:
            words += [w] * n
            for _ in range(rnd.randrange(3)):
                k, v = rnd.randrange(len(w)), w
                v = rnd.choice([v[:k] + v[k + 1:], v[:k] + rnd.choice(letters) + v[k:], v[:k] + rnd.choice(letters) + v[k + 1:]])
                words += [v] * max(1, n // rnd.choice([4, 5, 6]))
                w = v
            n //= 5
    rnd.shuffle(words)
    return [(k, " ".join(words[at:at + 50])) for k, at in enumerate(range(0, len(words), 50))]


def test_random_words(spark):
    want = check(spark, corpus(1, 60))
    assert sum(r[3] is not None for r in want) > 20 and any(r[3] and r[5] != r[3] for r in want)


def test_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(sp, "SHARD", 7)
    monkeypatch.setattr(sp, "QUERIES", 5)
    monkeypatch.setattr(sp, "TABLE", 10)
    check(spark, corpus(2, 50, "ab"))


def test_edge_cases(spark):
    docs = [(1, None), (2, ""), (3, "12 -- 3"), (None, "Straße STRAßE straße strasse Über×÷x "), (4, "abcdef " * 30 + "abcdeg " * 6), (4, "ABCDEG abcdefg"),
            (5, "abcdefg " * 5 + "ÀBCDEFG " * 7 + "l" * 5000 + " "), (5, ("l" * 5000 + " ") * 6 + ("l" * 5001 + " ") * 40), (6, "œuvres " * 9 + "naïveté_naïvete " * 9),
            (7, "aaaaaa " * 10 + "aaaaaaa " * 60 + "aaaaaab " * 9)]
    check(spark, docs)


def test_clashing_columns_and_empty(spark):
    rows = spark.createDataFrame([(1, "letter " * 9, 3, "x")], "doc_id long, text string, n long, word string")
    assert sp.spelling_variants(rows).collect()[0].asDict() == {"word": "letter", "n": 9, "n_near": 0, "form": None, "form_n": None, "root": "letter"}
    assert sp.spelling_variants(rows.where("doc_id > 1")).collect() == []


def test_search_finds_each_near_word_once():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randrange(6, 10))) for _ in range(300)})
    index = sp.DelimitedIndex([w.encode() for w in words])
    halves = np.array([len(w) // 2 for w in words])
    q, w = sp.near_words(index, [x.encode() for x in words], halves)
    got = sorted(zip(q.tolist(), w.tolist()))
    want = [(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b) and b.startswith(a[:len(a) // 2])]
    assert got == want
