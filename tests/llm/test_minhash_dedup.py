"""b-bit MinHash components against counting all shared shingles."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from test_ngram_join import documents, find

from sensorloom.llm import minhash_dedup as md
from sensorloom.llm.shingles import shingle_sets


def brute(docs):
    sets, lists = [], {}
    for k, (_, t) in enumerate(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i:i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
        for s in sets[-1]:
            lists.setdefault(s, []).append(k)
    parent = list(range(len(docs)))
    for k, s in enumerate(sets):
        for x, o in Counter(x for t in s for x in lists[t] if x > k).items():
            if 100 * o >= 80 * (len(s) + len(sets[x]) - o):
                parent[find(parent, k)] = find(parent, x)
    least = {}
    for k, (d, _) in enumerate(docs):
        r = find(parent, k)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    rows = [(d, len(sets[k]), least[find(parent, k)]) for k, (d, _) in enumerate(docs)]
    return sorted(((*r, r[0] == r[2]) for r in rows), key=repr)


def check(spark, docs):
    got = md.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=repr) == brute(docs)


def test_random_groups(spark):
    check(spark, documents(60, 3000, 25, 1))


def test_few_words_and_long_lists(spark, monkeypatch):
    monkeypatch.setattr(md, "FEW", 3)
    monkeypatch.setattr(md, "BLOCK", 4)
    monkeypatch.setattr(md, "SALT", 3)
    check(spark, documents(40, 40, 40, 2))


def test_chain_under_one_key(spark, monkeypatch):
    """Neighbours in a chain are similar, its ends are not: the star around the least set misses most of it."""
    monkeypatch.setattr(md, "FEW", 2)
    monkeypatch.setattr(md, "BLOCK", 5)
    docs = [(k, " ".join(f"w{i}" for i in range(4 * k, 4 * k + 60))) for k in range(40)]
    check(spark, docs)
    assert len({r[2] for r in brute(docs)}) == 1


def test_edge_cases(spark):
    docs = [(None, "a b c d"), (3, "a b c d"), (4, ""), (5, None), (6, " \t\n"), (7, "one"), (8, "ONE"), (9, "Éé x"), (10, "éé x"),
            (3, "other words"), (11, " ".join(f"v{k}" for k in range(30_000))), (12, " ".join(f"v{k}" for k in range(29_000))), (12, "a B c D")]
    check(spark, docs)


def test_clashing_columns_and_empty(spark):
    rows = spark.createDataFrame([(1, "a b", "x", 7), (2, "a b", "y", 8)], "doc_id long, text string, name string, label long")
    assert sorted(map(tuple, md.near_duplicates(rows).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
    assert md.near_duplicates(rows.where("doc_id > 5")).collect() == []


@pytest.mark.parametrize("shared", [0, 300, 700, 900])
def test_estimate_is_corrected(shared):
    """The mean error of estimates over many pairs is small, and 5.5 deviations are never exceeded."""
    rnd, errors = random.Random(shared), []
    for _ in range(40):
        common = [rnd.getrandbits(64) for _ in range(shared)]
        a, b = (np.unique(np.array(common + [rnd.getrandbits(64) for _ in range(1000 - shared)], np.uint64)) for _ in "ab")
        true = shared / (2000 - shared)
        bits = md.packed_bits(np.stack([md.minima(a), md.minima(b)]))
        errors.append(float(md._estimates(bits[:1], bits[1:])[0, 0]) - true)
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.17


def test_bands_meet(spark):
    """Pairs at 0.8 share a band."""
    rnd, missed = random.Random(5), 0
    for _ in range(300):
        n = rnd.choice([9, 18, 45, 90, 450])  # 0.8 = 8 n / 9 shared of 10 n / 9
        common = [f"c{rnd.random()}" for _ in range(8 * n // 9)]
        sets = [np.unique(np.array([hash(c) & (2**64 - 1) for c in common] + [rnd.getrandbits(64) for _ in range(n // 9)], np.uint64)) for _ in "ab"]
        keys = md.band_keys(np.stack([md.minima(s) for s in sets]))
        missed += not (keys[0] == keys[1]).any()
    assert missed == 0
    assert len(shingle_sets(["a b c"], 2)[0]) == 2
