"""Contamination by the positional index against a scan of all windows."""

import hashlib
import re

import numpy as np
import pytest

from sensorloom.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])] - {None}
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(12)] + ["Été", "x-y", "ÀB"]
    items = [(i, " ".join(rng.choice(vocabulary, rng.integers(1, 40)))) for i in range(20)]
    items += [(20, None), (21, "..."), (None, "alone item"), (3, items[3][1])]
    docs = []
    for i in range(80):
        text = " ".join(rng.choice(vocabulary, rng.integers(0, 80)))
        if i % 3 == 0:
            text += ". " + str(items[i % 20][1]).upper().replace("É", "é") + "\n" + text[:40]
        docs.append((i, text))
    docs += [(None, items[2][1]), (100, None), (101, ""), (5, "again " + str(items[1][1])), (102, "w1 " * 30_000)]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("max_chars", [4_000_000, 300])
def test_contamination(tables, max_chars):
    docs, items, df, bench = tables
    rows = dc.contamination(df, bench, max_chars=max_chars).select(*COLUMNS).collect()
    assert sorted([tuple(r) for r in rows], key=repr) == brute(docs, items)


def test_many_shards(tables, monkeypatch):
    docs, items, df, bench = tables
    monkeypatch.setattr(dc, "SHARD_TOKENS", 20)  # the driver's value is not read by the workers: cut here instead
    assert list(dc._shards(["abc " * 50] * 4)) == [(0, 1), (1, 2), (2, 3), (3, 4)]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a b x c d"), (2, "a b c d"), (3, "d c b a q q q")], "doc_id long, text string")
    windows = dc.Windows([(9, "a b c d")], 4)
    index = dc.build_index(docs)
    exact = {r["doc_id"] for r in dc.search(index, windows).collect() if r["hits"]}
    near = {r["doc_id"] for r in dc.search(index, windows, slop=1).collect() if r["hits"]}
    assert exact == {2} and near == {1, 2}


def test_drop_and_empty(tables):
    docs, items, df, bench = tables
    kept = dc.drop_contaminated(df, bench)
    clean = [d for d, *_, c in brute(docs, items) if not c]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(clean, key=repr)
    assert dc.contamination(df.limit(0), bench).count() == 0
    assert dc.contamination(df, bench.limit(0)).where("n_hit > 0").count() == 0


def test_rows_without_id_go_one_by_one(spark):
    item = "the quick brown fox jumps over one lazy dog while nobody looks at it today"
    docs = spark.createDataFrame([(None, item), (None, "clean and null"), (None, None), (7, "clean"), (8, item)], "doc_id long, text string")
    kept = dc.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([(None, "clean and null"), (None, None), (7, "clean")], key=repr)


def test_rows_that_share_an_id_are_decided_by_text(spark):
    item = "the quick brown fox jumps over one lazy dog while nobody looks at it today"
    docs = spark.createDataFrame([(5, item, 1, "a"), (5, "clean twin", 2, "b"), (6, item, 3, "c"), (6, item, 4, "d")],
                                 "doc_id long, text string, row_key long, bad string")
    kept = dc.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert list(map(tuple, kept.collect())) == [(5, "clean twin", 2, "b")] and kept.columns == docs.columns
