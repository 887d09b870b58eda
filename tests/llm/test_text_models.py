"""Language and toxicity models on held-out rows; restoration of disguised words."""

import zlib

import numpy as np
import pytest

from sensorloom.llm import language, toxicity

SYLLABLES = {"aa": "ba be bi bo bu".split(), "bb": "chra chre schi scho zwu".split(), "cc": "éla éli çon ère aux".split()}
HIDE = {"moron": "m0r0n", "idiot": "i d i o t", "loser": "looooser", "clown": "cl0wn"}


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    docs, labels = [], []
    for i in range(360):
        lang = list(SYLLABLES)[i % 3]
        words = ["".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(rng.integers(15, 60))]
        toxic = i % 4 == 0
        if toxic:
            bad = list(HIDE)[i // 4 % 4]
            words[3] = HIDE[bad] if i % 8 == 0 and i > 160 else bad
        docs.append((i, " ".join(words), lang if i % 7 else None, "x", 9.5))
        labels.append((i, int(toxic), "extra"))
    docs += [(None, None, "aa", None, 0.0), (1001, "", "bb", "x", 0.0), (1002, "123 %%", "cc", "x", 0.0), (0, docs[0][1], "aa", "x", 0.0)]
    labels += [(None, 1, "x"), (1001, None, "x"), (0, 1, "x")]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double"),
            spark.createDataFrame(labels, "doc_id long, toxic int, text string"))


def test_language(corpus):
    docs, _ = corpus
    rows = language.predict_languages(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1
        assert r["held_out"] == held and 0 <= r["score"] <= 1
        if r["doc_id"] in (None, 1001, 1002):
            assert r["lang_pred"] == "und" and r["ambiguous"]
        else:
            assert r["lang_pred"] == list(SYLLABLES)[r["doc_id"] % 3]


def test_language_without_labels(corpus, spark):
    docs, _ = corpus
    bare = docs.withColumn("lang", docs["lang"].substr(1, 0)).where("false")
    assert language.predict_languages(bare).count() == 0
    unlabelled = spark.createDataFrame([(5, "some text", None)], "doc_id long, text string, lang string")
    assert language.predict_languages(unlabelled).first()["lang_pred"] == "und"


@pytest.mark.parametrize("n", [2, 3, 4, 7, 12])
def test_codewords_differ(n):
    code = language.codewords(n)
    distance = (code.shape[1] - code @ code.T) // 2
    assert (distance[~np.eye(n, dtype=bool)] > 0).all() and (abs(code.sum(0)) < n).all()


def test_toxicity(corpus):
    docs, labels = corpus
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        if r["doc_id"] is not None and r["doc_id"] < 1000:
            assert r["predicted"] == int(r["doc_id"] % 4 == 0), r
        else:
            assert r["predicted"] == 0


def test_clean_columns_pass_through(corpus):
    docs, labels = corpus
    kept = toxicity.drop_toxic(docs, labels, ("doc_id", "text", "score"))
    assert kept.columns == ["doc_id", "text", "score"] and kept.where("doc_id % 4 = 0 and doc_id < 1000").count() == 0
    assert kept.count() == 270 + 3


def test_toxicity_without_labels(corpus):
    docs, labels = corpus
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def test_restore(corpus):
    docs, _ = corpus
    grams = [(r["gram"], r["n"]) for r in toxicity.trigram_counts(docs).collect()]
    model = toxicity.CharacterModel.of(grams)
    text = "the m0r0n and i d i o t, or looooser"
    assert toxicity.restored_words(text, model) == ["idiot", "moron", "loser"]
    assert toxicity.restored_words("nothing odd here!!! $5 or 10%", model) == []


@pytest.fixture(scope="module")
def english(spark):
    """A character model of plain sentences, and the evidence of two learned words."""
    text = ("you are an idiot and that was a stupid riot. the patriot said it is a stupid idea of an idiot. "
            "a pilot put a pivot there, but you did not do it. he is at home, or so it was said to me. an idiot is an idiot. "
            "is it so? you and i go to it as if it is a day of no end. i am on my way up to it. die or be a fat cat. ")
    docs = spark.createDataFrame([(i, text) for i in range(20)], "doc_id long, text string")
    grams = [(r["gram"], r["n"]) for r in toxicity.trigram_counts(docs).collect()]
    return toxicity.ToxicityModel(toxicity.CharacterModel.of(grams), {"idiot": 0.9, "stupid": 0.8, "moron": 0.9, "fat": 0.7}, 8.0, -5.0)


@pytest.mark.parametrize("text, word", [
    ("a i d i o t", "idiot"), ("you are a i d i o t there", "idiot"), ("a s.t.u.p.i.d idea", "stupid"), ("y o u i d i o t", "idiot"),
    ("y o u  i d i o t", "idiot"), ("an id10+", "idiot"), ("you idio7!", "idiot"), ("idi0+", "idiot"), ("1d10+", "idiot"),
    ("you id-iot", "idiot"), ("you id iot", "idiot"), ("the id.iot said", "idiot"), ("a stu pid day", "stupid"), ("mor on", "moron"),
    ("id i ot", "idiot"), ("you id 10t", "idiot"), ("so f a t", "fat"), ("i.d.i.o.t", "idiot"), ("idiooot", "idiot"), ("1d10t", "idiot")])
def test_disguises(english, text, word):
    strength, restored = english.strength(text)
    assert word in restored and strength == english.evidence[word]


@pytest.mark.parametrize("text", ["he is at home, or so it was said to me", "you did not do it!!", "is it so? no (it is) a day!", "10 + 7 = 17"])
def test_plain_text_is_no_disguise(english, text):
    assert english.strength(text)[0] == 0


def test_spaced_words_under_another_language(english):
    """Learned words are found among spaced letters though the character model knows none of their letters' order."""
    text = "ontion theand ing eren reing of the shwh tion ai an and diot wh ere ndea"
    grams = {}
    s = toxicity._symbols(text)
    for g in ((s[:-2] * 64 + s[1:-1]) * 64 + s[2:]).tolist():
        grams[g] = grams.get(g, 0) + 3
    model = toxicity.ToxicityModel(toxicity.CharacterModel.of(list(grams.items())), english.evidence)
    for disguise in ("a i d i o t", "y o u i d i o t", "a s.t.u.p.i.d", "i d i o t"):
        assert set(model.strength(disguise)[1]) & {"idiot", "stupid"}


def test_every_language_is_learned(spark):
    """More languages than rows that are wanted: one row of each is learned at least."""
    rows = [(3 * i + k, f"word{'abcdefghij'[i % 10] * 3} {'klmnopqrst'[i // 10] * 3}", f"l{i:02d}") for i in range(60) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = language.training_sample(docs, 20).collect()
    free = {lang for d, _, lang in rows if zlib.crc32(str(d).encode()) % 3 != 1}
    assert {r["lang"] for r in sample} == free and len(sample) == len(free)
    assert language.training_sample(docs.limit(0), 20).count() == 0


def _plain_disguised(text):
    out = [m.span() for m in toxicity._SPACED.finditer(text)]
    return out + [m.span() for m in toxicity._TOKEN.finditer(text) if toxicity._ODD.search(m.group())]


@pytest.mark.parametrize("part", [64, 1 << 18])
def test_hashed_lookups_find_what_plain_ones_find(monkeypatch, part):
    """Words, joins and stretches against plain loops: parts, letters beyond Latin-1, no word, one long word."""
    monkeypatch.setattr(toxicity, "PART", part)
    rng = np.random.default_rng(11)
    pieces = ["idiot", "id", "iot", "mo", "ron", "moronic", "straße", "слово", "сло", "во", "x", "1d10t", "looooser", "²", "٣a", "a4", "end!!"]
    marks = [" ", "-", ".", "  ", "\n", "_", "; ", "*"]
    texts = ["", " ", "!!!", "a", "q" * 700] + [
        "".join(rng.choice(pieces) + rng.choice(marks) for _ in range(int(rng.integers(1, 120)))) for _ in range(60)]
    grams = {}
    for t in texts:
        s = toxicity._symbols(t)
        for g in ((s[:-2] * 64 + s[1:-1]) * 64 + s[2:] if len(s) > 2 else []):
            grams[int(g)] = grams.get(int(g), 0) + 1
    evidence = {"idiot": 0.9, "moro~": 0.5, "слово": 0.7, "straß~": 0.6, "qqqq~": 0.2, "x": 0.1}
    model = toxicity.ToxicityModel(toxicity.CharacterModel.of(list(grams.items())), evidence)
    whole, begins = model.tables()
    for text in texts:
        assert model.telling(text) == {w for w in toxicity._WORD.findall(text) if model.of_word(w)}
        every = toxicity.joins(text, model.characters)
        some = toxicity.joins(text, model.characters, whole, begins)
        assert set(some) <= set(every)
        telling = {(w, likely) for w, likely in every if (model.of_word(w) if likely else evidence.get(w))}
        assert telling <= set(some)
        assert toxicity.disguised(text) == _plain_disguised(text)
