"""Token ids, length histogram and packing against the tokenizer itself and plain loops."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sensorloom.llm import length_histogram as lh
from sensorloom.llm.packing import best_fit_decreasing, pack
from sensorloom.llm.tokens import Encoder, default_tokenizer

TEXTS = ["Hello, World. It's we'll DON'T", "", "  \n ", None, "a\x1cb İstanbul ΣΑΣ Ǆ ﬁ éa café.", "x,. ,. , . a.b, 12,3 1. %,.",
         "<|endoftext|> A<|endoftext|>b", "ẞtraße ÅÄ. naïve,", "word " * 3000, "é" * 700, "a.b" * 2000]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i if i != 4 else None, t, 7) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], 7)],
                                 "doc_id long, text string, start int")


def ids_of(text):
    return Tokenizer.from_file(default_tokenizer()).encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer():
    encoder = Encoder(default_tokenizer(), max_words=5)
    for _ in range(2):
        for text, got, n in zip(TEXTS, encoder.encode(TEXTS), encoder.counts(TEXTS)):
            assert got.tolist() == ids_of(text) and n == len(got)


def test_marks_and_capitals_between_words():
    """Closing marks and capitals are taken off words only where the tokenizer does so as well."""
    texts = ["Word, word. WORD.\nÉté, été.", "a,, b., c.. d ,e .f ...", "x ., y", "it's, don't. we've, ", "3.5, 7. 1,000. a1, b2.", "µ, ª. ß. ÿ, ×, ÷.",
             "naïve,\tword.\u00a0word, end.", ". , .", "œuf, Œuf. word, İ. I.", "(word), [word]. \"word.\" word", "word,\nword.\n\nword"]
    encoder = Encoder(default_tokenizer(), max_words=20)
    for _ in range(3):
        assert [e.tolist() for e in encoder.encode(texts)] == [ids_of(t) for t in texts]
        assert encoder.counts(texts).tolist() == [len(ids_of(t)) for t in texts]


def test_pack_round_trip(docs):
    rows = pack(docs, group_documents=3, keep_ids=True).toPandas()
    want = sorted([*(ids_of(t) + [1] for t in TEXTS), ids_of(TEXTS[0]) + [1]])
    assert rows["length"].sum() == sum(map(len, want)) and rows["length"].max() <= 2048
    for _, seq in rows.groupby("sequence_id"):
        seq = seq.sort_values("offset")
        assert (seq["offset"].to_numpy() == np.cumsum(seq["length"]) - seq["length"]).all() and seq["length"].sum() <= 2048
    for r in rows.itertuples():
        ids = np.array(r.ids, "<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32 and len(ids) == r.length
    one = rows[rows.doc_id == 8].sort_values("start")
    assert np.concatenate(list(one.ids)).tolist() == ids_of(TEXTS[8]) + [1]
    assert (one["start"].to_numpy() == np.cumsum(one["length"]) - one["length"]).all() and (one.doc_tokens == one["length"].sum()).all()


def test_best_fit_is_tightest():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 101, 400)
    place, offset = best_fit_decreasing(lengths, 100)
    free: list[int] = []
    for at in np.argsort(-lengths, kind="stable"):
        fits = [f for f in free if f >= lengths[at]]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - lengths[at])
        else:
            free.append(100 - lengths[at])
    used = np.bincount(place, lengths)
    assert sorted(100 - used) == sorted(free) and (offset + lengths <= 100).all()


def test_histogram(docs, spark):
    found = lh.length_histogram(docs)
    lengths = np.array([len(ids_of(t)) for t in [*TEXTS, TEXTS[0]]])
    rows = found.collect()
    assert {r["n_tokens"] for r in rows} == set(lengths.tolist())
    for r in rows:
        n = r["n_tokens"]
        assert r["n_docs"] == (lengths == n).sum() and r["docs_ge"] == (lengths >= n).sum() and r["docs_le"] == (lengths <= n).sum()
        assert r["tokens_ge"] == lengths[lengths >= n].sum() and r["tokens_le"] == lengths[lengths <= n].sum()
        assert r["truncated_tokens"] == np.minimum(lengths, n).sum()
        assert r["quantile_to"] == pytest.approx((lengths <= n).mean()) and r["quantile_from"] == pytest.approx((lengths < n).mean())
    limits = spark.createDataFrame([(c,) for c in (0, 1, 3, 2048, 10**6)], "context long")
    for r in lh.at_limits(found, limits).collect():
        assert r["truncated_tokens"] == np.minimum(lengths, r["context"]).sum() and r["docs_cut"] == (lengths > r["context"]).sum()
    assert lh.quantile(found, 0.5).first()["n_tokens"] == sorted(lengths)[len(lengths) // 2 - 1]


def test_empty_tables(docs):
    none = docs.limit(0)
    assert pack(none).count() == 0 and lh.length_histogram(none).count() == 0
