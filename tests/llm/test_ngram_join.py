"""Jaccard components against counting all shared shingles."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sensorloom.llm import ngram_join as nj
from sensorloom.llm.components import connected_components


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def brute(docs):
    sets, lists = [], {}
    for k, (_, t) in enumerate(docs):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
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
    return sorted(((d, len(sets[k]), least[find(parent, k)]) for k, (d, _) in enumerate(docs)), key=repr)


def documents(groups, vocabulary, most, seed):
    rnd = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(vocabulary)}" for _ in range(rnd.choice([1, 2, 4, 5, 6, 8, 12, 24, 30, 60, 120, 300]))]
        for _ in range(rnd.choice([1, 1, 2, 3, 8, most])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, len(base) // 60 + 1])):
                k, q = rnd.randrange(len(w)), rnd.random()
                if q < .6:
                    w[k] = f"X{rnd.randrange(10**6)}"
                elif q < .8 and len(w) > 1:
                    del w[k]
                else:
                    w.insert(k, f"y{rnd.randrange(50)}")
            docs.append((len(docs), " ".join(w)))
    rnd.shuffle(docs)
    return docs


def check(spark, docs):
    got = nj.similarity_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs)


def test_mixed(spark):
    docs = documents(40, 5000, 40, 1)
    check(spark, [*docs, (10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n\t "), (None, docs[3][1]), docs[0], (None, "only here and alone now")])


def test_frequent_tokens_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(nj, "RARE", 2)
    monkeypatch.setattr(nj, "BLOCK", 8)
    check(spark, documents(25, 60, 50, 2))


def test_joins_instead_of_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(nj, "MAX_SHARED", 0)
    monkeypatch.setattr(nj, "MAX_COPIES", 0)
    check(spark, documents(20, 3000, 20, 3))


def test_keep_first_and_empty(spark):
    docs = documents(12, 2000, 10, 4)
    df = spark.createDataFrame([(d, t, d) for d, t in docs], "doc_id long, text string, component_id long")
    kept = nj.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(docs)})
    assert nj.similarity_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(k, k + 1) for k in range(0, 120, 2)] + [(k + 1, k + 2) for k in range(40, 80, 2)]])
def test_components(spark, edges):
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        ra, rb = find(parent, a), find(parent, b)
        parent[max(ra, rb)] = min(ra, rb)
    assert got == {x: find(parent, x) for e in edges if e[0] != e[1] for x in e}


def test_keep_first_by_row(spark):
    """Null and repeated doc_ids: one row of each group stays, and clean rows that share an id with one that goes."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcde")
    docs = [(1, a), (None, a + " tail"), (None, b), (2, c), (2, c + " tail"), (2, d), (3, d + " end"), (None, e), (None, e + " end"),
            (4, b + " more words here"), (9, "x y z"), (9, "x y z"), (5, ""), (5, ""), (None, None), (None, None), (None, "alone here and now")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(docs)], "doc_id long, text string, least long")
    kept = nj.keep_first(df)
    rows = kept.collect()
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], (r["text"] or "")[:1]) for r in rows), key=repr)
    assert got == sorted([(1, "a"), (4, "b"), (2, "c"), (2, "d"), (None, "e"), (9, "x"), (5, ""), (5, ""), (None, ""), (None, ""), (None, "a")], key=repr)
    assert next(r["least"] for r in rows if r["doc_id"] == 9) == 10


def test_keep_first_with_clashing_columns(spark):
    a = " ".join(f"a{k}" for k in range(40))
    df = spark.createDataFrame([(1, a, 1, 2, 3, 4), (2, a + " end", 5, 6, 7, 8), (3, "x y z", 9, 9, 9, 9), (3, "x y z", 9, 9, 9, 9)],
                               "doc_id long, text string, __id int, __key int, row int, row_key int")
    kept = nj.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, a, 1, 2, 3, 4), (3, "x y z", 9, 9, 9, 9)]


def test_joined_sets_stay_off_the_driver(spark, monkeypatch):
    """Beyond MAX_SHARED no table of sets is marked for a broadcast, and what is sent has a fixed size."""
    plans, sent = {}, []

    def stored(df, name, write=nj.stored):
        plans[name] = df._jdf.queryExecution().analyzed().toString()
        return write(df, name)

    context, send = type(spark.sparkContext), type(spark.sparkContext).broadcast
    monkeypatch.setattr(nj, "stored", stored)
    monkeypatch.setattr(nj, "MAX_SHARED", 0)
    monkeypatch.setattr(nj, "MAX_COPIES", 0)
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or send(self, value))
    check(spark, documents(8, 3000, 12, 5))
    assert "kept" in plans and "broadcast" not in plans["candidates"].lower()
    assert [len(v[0]) for v in sent if isinstance(v, tuple)] == [1 << 13] * 2


def test_marks(spark):
    rnd = random.Random(6)
    hashes = [rnd.randrange(-2**63, 2**63) for _ in range(30_000)] + [-1, 0, 2**63 - 1, -2**63, 0]
    packed, bits = nj.marks(spark.createDataFrame([(h,) for h in hashes], "token long"))
    assert bits == 17 and len(packed) == 1 << 14
    assert np.flatnonzero(np.unpackbits(packed)).tolist() == sorted({(h % 2**64) >> 47 for h in hashes})
    assert nj._marked(np.array(hashes, np.int64).view(np.uint64), packed, bits).all()
    assert not nj.marks(spark.createDataFrame([], "token long"))[0].any()


def test_counts_of_tasks_that_count_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nj, "HELD", 50)
    texts = [" ".join(f"{x}{k}" for k in range(20)) for x in "abcdefgh" for _ in range(400 if x in "adg" else 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    counts = Counter(int(h) >> 47 for s in nj.shingle_sets(texts) for h in s)
    sets = nj.set_table(docs, 17)
    assert sets.where("kind = 1").count() > 4
    got = np.flatnonzero(np.unpackbits(nj.frequent_buckets(sets, 17))).tolist()
    assert got == sorted(b for b, k in counts.items() if k > 32) and got
