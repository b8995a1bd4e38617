"""A convolutional text classifier for toxicity, trained in numpy.

Words are hashed; each known one has an embedding. Unknown words fall back on their
longest known beginning. Filters of several widths run over the embeddings, the two
largest values of each filter over the whole text are its features, and a linear layer
turns them into a score. Of the embedding, the first value starts as the cautious
log-odds of the word; all is then trained by stochastic gradient descent.

Only a bounded sample of labelled rows is learned from (see ``Settings``). The score
depends on the text alone; the thresholds' language is guessed from the text, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palabre.llm.common import stage
from palabre.llm.text import ALNUM, prefix_hashes, word_hashes, words_of

# Frequent short words of each language, by which it is guessed.
FREQUENT = {
    "de": "der die das und ist nicht ein eine zu von mit auf für den im sich auch es",
    "en": "the of and to in is that it for was on are with as be this by from",
    "es": "el la los las que y en un una del con por para su es se al lo",
    "fr": "le la les et des un une du est que pour dans qui sur pas au par avec",
}
PREFIXES = (8, 7, 6, 5, 4)
WIDTHS, FILTERS, SIZE, KEPT = (1, 2, 3), 8, 8, 2
#: Words that are convolved at once; longer texts go piece by piece.
PIECE = 1 << 16


@dataclass(frozen=True)
class Settings:
    """Bounds of what is learned from; nothing here bounds what is scored."""

    toxic_rows: int = 4_000
    clean_rows: int = 8_000
    #: Longer texts are not learned from.
    chars: int = 20_000
    vocabulary: int = 50_000
    least_rows: int = 3
    #: One row in so many is kept for calibration.
    calibrate: int = 4
    #: Texts that are gone through in training, the sample again and again.
    steps: int = 40_000
    rate: float = 0.05


def _lower(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _forms(text: str) -> np.ndarray:
    """The distinct words and word beginnings of a text."""
    data = _lower(text)
    words, starts, lengths = words_of(data, ALNUM)
    parts = [words, *(prefix_hashes(data, starts[lengths >= p], p) for p in PREFIXES)]
    return np.unique(np.concatenate(parts))


_LANGUAGES = sorted(FREQUENT)
_FREQUENT = {
    n: np.sort(word_hashes(FREQUENT[n].encode(), ALNUM)) for n in _LANGUAGES
}


def guess_language(words: np.ndarray) -> int:
    """The index of the language whose frequent words are most of the text's, else -1."""
    counts = [
        int((table[np.minimum(np.searchsorted(table, words), len(table) - 1)] == words).sum())
        for table in _FREQUENT.values()
    ]
    return int(np.argmax(counts)) if max(counts) else -1


class Words:
    """Known words and beginnings; row 0 stands for all others."""

    def __init__(self, known: np.ndarray):
        self.known = np.concatenate((np.zeros(1, np.uint64), known.astype(np.uint64)))
        bits = max(10, int(np.ceil(np.log2(len(self.known)))) + 3)
        self.shift = np.uint64(64 - bits)
        order = np.argsort(self.known[1:], kind="stable") + 1
        self.sorted, self.order = self.known[order], order.astype(np.int32)
        # A first look at one bit for each hash spares most of the searches.
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self.known[1:] >> self.shift] = True

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), dtype=np.int32)
        maybe = np.flatnonzero(self.seen[hashes >> self.shift])
        if len(maybe) and len(self.sorted):
            wanted = hashes[maybe]
            at = np.minimum(np.searchsorted(self.sorted, wanted), len(self.sorted) - 1)
            out[maybe] = np.where(self.sorted[at] == wanted, self.order[at], 0)
        return out

    def encode(self, text: str) -> tuple[np.ndarray, int]:
        """A row for each word of the whole text, and its guessed language."""
        data = _lower(text)
        words, starts, lengths = words_of(data, ALNUM)
        rows = self.rows(words)
        for size in PREFIXES:
            rest = np.flatnonzero((rows == 0) & (lengths >= size))
            if len(rest):
                rows[rest] = self.rows(prefix_hashes(data, starts[rest], size))
        return rows, guess_language(words)


class Network:
    """Embeddings, filters and the last layer."""

    def __init__(self, odds: np.ndarray):
        random = np.random.default_rng(7)
        self.embed = random.normal(0, 0.01, (len(odds), SIZE)).astype(np.float32)
        self.embed[:, 0] = odds
        self.embed[0] = 0
        self.filters = [random.normal(0, 0.1, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
        for part in self.filters:
            part[:, 0, :] += 0.5 / len(part)
        self.bias = [np.full(FILTERS, -0.1, np.float32) for _ in WIDTHS]
        self.out = np.full(len(WIDTHS) * FILTERS * KEPT, 0.02, np.float32)
        self.base = np.float32(-1.0)
        self._tables: list[list[np.ndarray]] | None = None

    def tables(self) -> list[list[np.ndarray]]:
        """What each known word adds to each filter at each place, made once."""
        if self._tables is None:
            self._tables = [[self.embed @ part[k] for k in range(len(part))] for part in self.filters]
        return self._tables

    def _pooled(self, rows: np.ndarray, part: np.ndarray, table: list[np.ndarray] | None):
        """The ``KEPT`` largest values of each filter and their places, 0 where there are none."""
        width = len(part)
        values = np.zeros((KEPT, FILTERS), np.float32)
        places = np.full((KEPT, FILTERS), -1)
        for start in range(0, max(0, len(rows) - width + 1), PIECE):
            piece = rows[start : start + PIECE + width - 1]
            n = len(piece) - width + 1
            total = np.zeros((n, FILTERS), np.float32)
            for k in range(width):
                own = piece[k : k + n]
                total += table[k][own] if table is not None else self.embed[own] @ part[k]
            best = np.argpartition(total, max(0, n - KEPT), axis=0)[-KEPT:]
            all_values = np.concatenate((values, np.take_along_axis(total, best, axis=0)))
            all_places = np.concatenate((places, best + start))
            order = np.argsort(-all_values, axis=0, kind="stable")[:KEPT]
            values = np.take_along_axis(all_values, order, axis=0)
            places = np.take_along_axis(all_places, order, axis=0)
        return values, places

    def forward(self, rows: np.ndarray, fast: bool = True):
        tables = self.tables() if fast else [None] * len(WIDTHS)
        pooled = [self._pooled(rows, p, t) for p, t in zip(self.filters, tables, strict=True)]
        features = np.concatenate(
            [np.maximum(v + b, 0).ravel() for (v, _), b in zip(pooled, self.bias, strict=True)]
        )
        return float(features @ self.out + self.base), features, pooled

    def train(self, texts: list[np.ndarray], labels: np.ndarray, steps: int, rate: float) -> None:
        """Stochastic gradient descent, one text at a time, both labels weighing the same."""
        random = np.random.default_rng(11)
        weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
        weight = weight * len(labels)
        epochs = max(1, round(steps / len(texts)))
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            for i in random.permutation(len(texts)):
                logit, features, pooled = self.forward(texts[i], fast=False)
                slope = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[i]) * min(weight[i], 5)
                back = (slope * self.out).reshape(len(WIDTHS), KEPT, FILTERS)
                self.out -= step * slope * features / (1 + np.linalg.norm(features))
                self.base -= np.float32(step * slope)
                for w, (part, (values, places)) in enumerate(zip(self.filters, pooled, strict=True)):
                    live = (values + self.bias[w] > 0) & (places >= 0)
                    self.bias[w] -= step * (back[w] * live).sum(axis=0)
                    for j, f in zip(*np.nonzero(live), strict=True):
                        own = texts[i][places[j, f] : places[j, f] + len(part)]
                        vectors = self.embed[own]
                        change = np.clip(step * back[w, j, f], -0.1, 0.1)
                        self.embed[own] -= change * part[:, :, f]
                        part[:, :, f] -= change * vectors / (1 + np.abs(vectors).max())
                self.embed[0] = 0
        self._tables = None


@dataclass(frozen=True)
class ToxicityModel:
    words: Words
    network: Network
    #: The logit from which a text counts as toxic, by language and at last for the rest.
    limits: tuple[float, ...]
    scale: float

    def score(self, text: str | None) -> float:
        rows, language = self.words.encode(text or "")
        logit = self.network.forward(rows)[0]
        return float(1 / (1 + np.exp(-np.clip(self.scale * (logit - self.limits[language]), -30, 30))))


def _limit(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit that parts both labels best, in the middle of the gap."""
    order = np.argsort(logits, kind="stable")
    logits, labels = logits[order], labels[order]
    clean, toxic = max(1, (1 - labels).sum()), max(1, labels.sum())
    # Right answers of each label if all from place i on counts as toxic.
    right = np.concatenate(([0], np.cumsum(1 - labels))) / clean
    right = right + np.concatenate((np.cumsum(labels[::-1])[::-1], [0])) / toxic
    best = np.flatnonzero(right >= right.max() - 1e-12)
    at = int(best[len(best) // 2])
    edge = np.concatenate(([logits[0] - 1], logits, [logits[-1] + 1]))
    return float((edge[at] + edge[at + 1]) / 2)


def calibrated(
    logits: np.ndarray, labels: np.ndarray, languages: np.ndarray, least: int = 10
) -> tuple[tuple[float, ...], float]:
    """A threshold for each language with enough rows of both labels, else the common one."""
    if not len(logits) or not 0 < labels.sum() < len(labels):
        return (0.0,) * (len(_LANGUAGES) + 1), 1.0
    common, limits = _limit(logits, labels), []
    for language in range(len(_LANGUAGES)):
        own = languages == language
        enough = min(labels[own].sum(), (1 - labels[own]).sum()) >= least
        limits.append(_limit(logits[own], labels[own]) if enough else common)
    spread = float(np.std(logits)) or 1.0
    return (*limits, common), 2.0 / spread


def labelled_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``text, toxic, chance``: a bounded sample of each label, the same on every run.

    Rows are taken in the order of a hash of their doc_id. Labels other than 0 and 1,
    and rows without a doc_id, are not used.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")
    ).filter("doc_id is not null and toxic in (0, 1)")
    known = known.withColumn("chance", F.xxhash64("doc_id"))
    picked = [
        known.filter(F.col("toxic") == label).orderBy("chance", "doc_id").limit(rows)
        for label, rows in ((1, settings.toxic_rows), (0, settings.clean_rows))
    ]
    ids = F.broadcast(picked[0].unionByName(picked[1]).dropDuplicates(["doc_id"]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    texts = texts.filter(F.length("text") <= settings.chars)
    return texts.join(ids, "doc_id").dropDuplicates(["doc_id"])


def train_toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> ToxicityModel:
    """Train on a bounded sample of ``docs`` with ``labels (doc_id, toxic)``.

    Spark picks the sample, counts words by label and encodes the texts; the driver gets
    the bounded vocabulary and the sample's word numbers. Without rows of both labels
    the model finds nothing toxic.
    """
    sample = stage(labelled_sample(docs, labels, settings), "sample")

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_forms(t) for t in batch["text"]]
            n = [len(x) for x in found]
            yield pd.DataFrame(
                {
                    "form": np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64),
                    "toxic": np.repeat(batch["toxic"].to_numpy(), n),
                }
            )

    learned = F.pmod(F.col("chance"), F.lit(settings.calibrate)) > 0
    totals = {r["toxic"]: r["n"] for r in sample.filter(learned).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return ToxicityModel(Words(np.empty(0, np.uint64)), Network(np.zeros(1)), (1.0,) * (len(_LANGUAGES) + 1), 1.0)

    def cautious(a: Column, b: Column) -> Column:
        """Log-odds less two standard errors, 0 if that changes their sign."""
        odds = F.log((a + 0.5) / (n1 + 1)) - F.log((b + 0.5) / (n0 + 1))
        error = 2 * F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        return F.signum(odds) * F.greatest(F.abs(odds) - error, F.lit(0.0))

    counted = (
        sample.filter(learned).mapInPandas(forms, "form long, toxic int")
        .groupBy("form")
        .agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
        .filter(F.col("a") + F.col("b") >= settings.least_rows)
        .select("form", cautious(F.col("a"), F.col("b")).alias("odds"), (F.col("a") + F.col("b")).alias("n"))
        .orderBy(F.abs("odds").desc(), F.col("n").desc(), "form")
        .limit(settings.vocabulary)
        .toPandas()
    )
    words = Words(counted["form"].to_numpy(np.int64).view(np.uint64))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coded = [words.encode(t) for t in batch["text"]]
            yield batch[["chance", "toxic"]].assign(
                language=[language for _, language in coded],
                rows=[rows.astype("<i4").tobytes() for rows, _ in coded],
            )

    coded = sample.mapInPandas(encode, "chance long, toxic int, language int, rows binary")
    rows = sorted(map(tuple, coded.collect()))
    texts = [np.frombuffer(r[3], "<i4") for r in rows]
    toxic = np.array([r[1] for r in rows])
    languages = np.array([r[2] for r in rows])
    held = np.array([r[0] % settings.calibrate == 0 for r in rows])

    network = Network(np.concatenate(([0.0], counted["odds"].to_numpy())).astype(np.float32))
    fit = np.flatnonzero(~held)
    network.train([texts[i] for i in fit], toxic[fit], settings.steps, settings.rate)
    part = np.flatnonzero(held)
    if not 0 < toxic[part].sum() < len(part):
        part = np.arange(len(rows))
    logits = np.array([network.forward(texts[i])[0] for i in part])
    limits, scale = calibrated(logits, toxic[part], languages[part])
    return ToxicityModel(words, network, limits, scale)


def toxicity_score(model: ToxicityModel, docs: DataFrame, text: str = "text") -> Column:
    """The score of each whole text, 0 to 1; from 0.5 on it counts as toxic.

    A missing or empty text has the score of a text without known words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        own = shared.value
        return pd.Series([own.score(t) for t in texts], dtype="float64")

    return score(F.col(f"`{text}`"))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, score, predicted`` for each row; further columns are not read."""
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), toxicity_score(model, docs).alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents that don't count as toxic, all columns and all repeated rows kept."""
    return docs.filter(toxicity_score(model, docs) < 0.5)
