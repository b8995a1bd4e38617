"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its subwords (runs of two to four bytes within
words, their ends marked), hashed into a fixed number of buckets. A linear softmax
layer over it gives the languages. Both are trained by stochastic gradient descent in
numpy on a bounded sample; a part of it that isn't trained on calibrates the scores
and the score below which a prediction is rejected.

As the mean is linear, a trained model is one table of a score for each bucket and
language, however large the embeddings were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palabre.llm.common import stage
from palabre.llm.text import BYTE_VALUES, PLACE_FACTORS

UNKNOWN = "und"
BUCKET_BITS = 12
BUCKETS = 1 << BUCKET_BITS
LENGTHS = (2, 3, 4)
SIZE = 16
#: Bytes that are hashed at once; longer texts go piece by piece.
PIECE = 1 << 18

_LETTER = regex.compile(r"\p{L}")
#: All ASCII but letters ends a word; upper case was lowered before.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x61] = _FOLD[0x7B:0x80] = 0x20


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned from; nothing here bounds what is predicted."""

    rows_per_language: int = 500
    rows: int = 4_000
    #: Longer texts are not learned from.
    chars: int = 50_000
    #: Words of the passage of each text that is learned from besides the whole text.
    passage: int = 6
    epochs: int = 40
    rate: float = 0.5
    #: One row in so many is kept for calibration.
    calibrate: int = 5
    #: Share of right answers among what isn't rejected, aimed at.
    precision: float = 0.98


def subword_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the subwords of the whole text."""
    data = b" " + text.lower().encode("utf-8", "surrogatepass") + b" "
    buf = _FOLD[np.frombuffer(data, dtype=np.uint8)]
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for start in range(0, len(buf), PIECE):
        piece = buf[start : start + PIECE + max(LENGTHS) - 1]
        space, values = piece == 0x20, BYTE_VALUES[piece]
        for n in LENGTHS:
            m = min(PIECE, len(piece) - n + 1)
            if m <= 0:
                continue
            total = np.zeros(m, dtype=np.uint64)
            for k in range(n):
                total += values[k : k + m] * PLACE_FACTORS[k + n]
            # No word end within; at both ends only around a word of its own.
            outside = space[:m] & space[n - 1 : n - 1 + m] if n < 3 else np.zeros(m, dtype=bool)
            for k in range(1, n - 1):
                outside = outside | space[k : k + m]
            places = (total[~outside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            counts += np.bincount(places, minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    #: Of each bucket (rows) and language; the last row is added once.
    scores: np.ndarray
    #: What scores are divided by, so that they are probabilities on held-back rows.
    temperature: float
    #: A lower probability is a rejected prediction.
    limit: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language and its probability; ``und`` and 0 without a letter."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        counts = subword_counts(text)
        logits = counts @ self.scores[:-1] / max(1, counts.sum()) + self.scores[-1]
        shares = _softmax(logits[None, :] / self.temperature)[0]
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _train(x: np.ndarray, y: np.ndarray, classes: int, settings: Settings) -> np.ndarray:
    """Embeddings and a softmax layer by stochastic gradient descent; as one table."""
    random = np.random.default_rng(3)
    embed = random.normal(0, 0.1, (BUCKETS, SIZE)).astype(np.float32)
    layer = random.normal(0, 0.1, (SIZE, classes)).astype(np.float32)
    base = np.zeros(classes, np.float32)
    weight = (len(y) / classes / np.maximum(1, np.bincount(y, minlength=classes)))[y].astype(np.float32)
    # Squares of the gradients so far: rare subwords take larger steps.
    seen = [np.full_like(p, 1e-4) for p in (embed, layer, base)]
    for _ in range(settings.epochs):
        order = random.permutation(len(y))
        for start in range(0, len(y), 32):
            part = order[start : start + 32]
            mean = x[part] @ embed
            slope = _softmax(mean @ layer + base)
            slope[np.arange(len(part)), y[part]] -= 1
            slope *= weight[part, None] / len(part)
            used = np.flatnonzero(x[part].any(axis=0))
            grads = (x[part][:, used].T @ (slope @ layer.T), mean.T @ slope, slope.sum(axis=0))
            seen[0][used] += grads[0] ** 2
            embed[used] -= 0.1 * settings.rate * grads[0] / np.sqrt(seen[0][used])
            for p, s, g in ((layer, seen[1], grads[1]), (base, seen[2], grads[2])):
                s += g**2
                p -= 0.1 * settings.rate * g / np.sqrt(s)
    return np.concatenate((embed @ layer, base[None, :])).astype(np.float64)


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature at which the right languages are likeliest."""
    def loss(t: float) -> float:
        shares = _softmax(logits / t)[np.arange(len(y)), y]
        return float(-np.log(np.maximum(shares, 1e-12)).mean())

    return min((float(t) for t in np.geomspace(0.1, 10, 41)), key=loss)


def _reject_below(shares: np.ndarray, right: np.ndarray, precision: float) -> float:
    """The lowest score from which on so many of the answers are right."""
    order = np.argsort(-shares, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= precision
    kept = np.flatnonzero(good)
    return float(shares[order[kept[-1]]]) if len(kept) else 1.0


def train_language_id(docs: DataFrame, settings: Settings = Settings()) -> LanguageModel:
    """Train on a bounded sample of rows of ``docs`` that have a language.

    The sample takes rows of each language in the order of a hash of their doc_id, the
    same on every run. The driver gets the counts of the sample's subwords, at most
    ``BUCKETS`` for a row. Rows without a language or doc_id are not used.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").filter(
        F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & (F.col("lang") != UNKNOWN)
        & (F.length("text") <= settings.chars)
    )
    # A window limit runs before the shuffle: a frequent language is cut in every task.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        known.select("doc_id", "lang")
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= settings.rows_per_language)
        .orderBy("place", "lang")
        .limit(settings.rows)
        .select("doc_id")
        .distinct()
    )
    sample = stage(known.join(F.broadcast(ids), "doc_id"), "sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"], strict=True):
                words = text.split()
                at = doc_id % max(1, len(words) - settings.passage)
                passage = " ".join(words[at : at + settings.passage])
                for whole, part in ((1, text), (0, passage)):
                    counts = subword_counts(part)
                    used = np.flatnonzero(counts)
                    shares = counts[used] / max(1, counts.sum())
                    rows.append((doc_id, whole, lang, used.astype("<u2").tobytes(), shares.astype("<f4").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "whole", "lang", "used", "shares"])

    counted = sample.mapInPandas(count, "doc_id long, whole int, lang string, used binary, shares binary")
    rows = sorted(map(tuple, counted.collect()))
    languages = tuple(sorted({r[2] for r in rows}))
    if not languages:
        return LanguageModel((), np.zeros((BUCKETS + 1, 0)), 1.0, 1.0)
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for row, (_, _, _, used, shares) in zip(x, rows, strict=True):
        row[np.frombuffer(used, "<u2")] = np.frombuffer(shares, "<f4")
    y = np.array([languages.index(r[2]) for r in rows])
    held = np.array([i // 2 % settings.calibrate == 0 for i in range(len(rows))])
    table = _train(x[~held], y[~held], len(languages), settings)
    # Whole texts calibrate: that is what is predicted.
    held = held & np.array([r[1] == 1 for r in rows])
    held = held if held.any() else np.ones(len(rows), dtype=bool)
    logits = x[held] @ table[:-1] + table[-1]
    temperature = _temperature(logits, y[held])
    shares = _softmax(logits / temperature)
    right = shares.argmax(axis=1) == y[held]
    return LanguageModel(languages, table, temperature, _reject_below(shares.max(axis=1), right, settings.precision))


def predict_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for each row, from its whole text alone.

    ``lang_pred`` is a learned language, ``und`` (with score 0, rejected) for a missing
    text or one without a letter. ``score`` is the calibrated probability, ``rejected``
    tells that it is below the calibrated limit. Further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), predict(F.col("text")).alias("p"))
    return made.select(
        "doc_id", "p.lang_pred", "p.score",
        ((F.col("p.score") < model.limit) | (F.col("p.lang_pred") == UNKNOWN)).alias("rejected"),
    )
