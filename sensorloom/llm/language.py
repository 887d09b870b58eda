"""Language identification with error-correcting output codes over character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import held_out, small, stored

UNDETERMINED = "und"
BUCKETS = 1 << 13

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: is it a letter?  Built once per process."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def features(text: str | None) -> np.ndarray | None:
    """Hashed counts of letter n-grams of one to three letters, scaled to length one; None without a letter.

    Every run of other characters is one blank, so that n-grams see word edges."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character after a letter stands for its run
    codes = np.where(letter, codes, 32)[keep].astype(np.uint32)
    codes = np.concatenate((np.array([32], np.uint32), codes))
    mixed = codes * np.uint32(2654435761)
    two = mixed[:-1] * np.uint32(31) + (codes[1:] ^ np.uint32(0x5BD1)) * np.uint32(2246822519)
    three = two[:-1] * np.uint32(37) + codes[2:] * np.uint32(3266489917)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    counts = np.bincount(np.concatenate((mixed >> shift, two >> shift, three >> shift)), minlength=BUCKETS)
    counts = np.sqrt(counts.astype(np.float32))
    return counts / np.float32(np.sqrt((counts * counts).sum()))


def codewords(n: int) -> np.ndarray:
    """One codeword of +1 and -1 for each of ``n`` languages.

    Up to seven languages get the exhaustive code: every split of the languages
    into two sides.  More get the random code, of 15 bits per binary digit of
    ``n``, with the largest least distance among 200 seeds."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        splits = range(1, 1 << (n - 1))
        return np.array([[1 if s >> k & 1 else -1 for s in splits] for k in range(n)])
    bits, best, least = 15 * (n - 1).bit_length(), None, -1
    for seed in range(200):
        code = np.random.default_rng(seed).choice((-1, 1), (n, bits))
        code = code[:, abs(code.sum(0)) < n]  # a bit that is alike for all languages says nothing
        apart = (code.shape[1] - code @ code.T) // 2 + bits * np.eye(n, dtype=int)
        if apart.min() > least:
            best, least = code, apart.min()
    return best


@dataclass
class CodeModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weight: np.ndarray  # languages x bits: how well each bit is known for the language
    w: np.ndarray  # buckets x bits
    b: np.ndarray

    def losses(self, x: np.ndarray) -> np.ndarray:
        """Loss-weighted distance of each row to each codeword."""
        margin = x @ self.w + self.b
        return np.stack([(np.logaddexp(0, -margin * c) * p).sum(1) for c, p in zip(self.code, self.weight)], 1)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nearest language, its share, its lead over the second) of each row."""
        near = np.exp(-self.losses(x) * self.code.shape[1])
        near /= near.sum(1, keepdims=True)
        best = near.argmax(1)
        order = np.sort(near, 1)
        lead = order[:, -1] - (order[:, -2] if near.shape[1] > 1 else 0)
        return best, order[:, -1], lead


def fit_bits(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 150) -> CodeModel:
    """Logistic regression of every bit of the codewords, by accelerated gradient descent."""
    code = codewords(len(languages))
    target = code[y].astype(np.float32)
    share = np.bincount(y, minlength=len(languages)).astype(np.float32)
    row_weight = (1 / share[y] / len(languages))[:, None]  # each language counts the same
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    w1, b1 = w, b
    for at in range(rounds):
        push = -target * row_weight / (1 + np.exp(np.clip(target * (x @ w1 + b1), -30, 30)))
        w2, b2 = w1 - 8 * (x.T @ push + 1e-5 * w1), b1 - 2 * push.sum(0)
        pace = at / (at + 3)
        w1, b1, w, b = w2 + pace * (w2 - w), b2 + pace * (b2 - b), w2, b2
    right = (np.sign(x @ w + b) == target).astype(np.float64)
    weight = np.stack([right[y == k].mean(0) for k in range(len(languages))]) + 1e-3
    return CodeModel(languages, code, weight / weight.sum(1, keepdims=True), w, b)


def training_sample(docs: DataFrame, max_train_docs: int) -> DataFrame:
    """Labelled rows that may be learned from: about ``max_train_docs``, evenly over all languages, one of each at least."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    each = max(1, max_train_docs // max(1, counts.count()))
    draw = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30))
    chance = F.least(F.lit(1.0), (1.5 * each + 4) / F.col("n"))
    # about 1.5 times the wanted rows, then exactly the first of them in the order of the hash
    some = rows.select("lang", "text", draw.alias("draw")).join(small(counts), "lang").where(F.col("draw") < chance * (1 << 30))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    return some.withColumn("nth", nth).where(F.col("nth") <= each).select("lang", "text")


def fit(docs: DataFrame, max_train_docs: int = 2000) -> CodeModel | None:
    """Learn the bits from a bounded sample of labelled rows; None without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, at, value = [], [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = features(text)
                if x is not None:
                    langs.append(lang)
                    at.append(np.flatnonzero(x).astype(np.int32))
                    value.append(x[at[-1]])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(value, pa.list_(pa.float32()))], names=["lang", "at", "value"])

    sample = training_sample(docs, max_train_docs)
    rows = sample.mapInArrow(run, "lang string, at array<int>, value array<float>").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["at"], r["value"]))
    languages = sorted({r["lang"] for r in rows})
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, r in enumerate(rows):
        x[i, r["at"]] = r["value"]
    return fit_bits(x, np.array([languages.index(r["lang"]) for r in rows]), languages)


def identify(docs: DataFrame, model: CodeModel | None, min_lead: float = 0.5) -> DataFrame:
    """Language of every whole text: doc_id, lang_pred, score (0 to 1), ambiguous.

    ``ambiguous`` marks texts whose best language leads the second by less than
    ``min_lead`` of the score.  Null texts and texts without a letter are
    ``und`` with score 0, ambiguous; so is every text if nothing was learned.
    Only the text enters a prediction.  Rows with null or repeated doc_id and
    repeated texts are treated row by row; an empty table gives no rows.
    """
    names = ["doc_id", "lang_pred", "score", "ambiguous"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = part.num_rows
                found = [features(t) if model else None for t in part.column(1).to_pylist()]
                rows = [i for i, x in enumerate(found) if x is not None]
                lang, score, unsure = [UNDETERMINED] * n, [0.0] * n, [True] * n
                if rows:
                    best, share, lead = model.decode(np.stack([found[i] for i in rows]))
                    for i, k, s, d in zip(rows, best.tolist(), share.tolist(), lead.tolist()):
                        lang[i], score[i], unsure[i] = model.languages[k], min(1.0, max(0.0, s)), d < min_lead
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def predict_languages(docs: DataFrame, max_train_docs: int = 2000) -> DataFrame:
    """Learn from the rows that are not held out and predict every row."""
    out = identify(docs, fit(docs, max_train_docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
