"""Language identification: multinomial logistic regression on hashed character n-grams.

TF-IDF weights of n-grams of one to three letters are fed to a sparse linear model. The model is
trained online with follow-the-regularised-leader under an elastic-net penalty, then its scores are
calibrated with one temperature. Inverse document frequencies are counted over all training rows;
weights are fitted on a bounded sample of them.

Null and empty texts, and texts without a letter, are `und` with score 0. Repeated rows get the same
answer. An empty table gives an empty result. With no training row at all, every row is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from widefold.llm.common import as_struct, read_table, whole_text

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
MAX_ORDER = 3
#: Characters of a text handled at once, so that memory does not follow the longest text.
WINDOW = 1 << 20
#: About so many rows are fitted and calibrated on, as many of each language as there are.
SAMPLE_ROWS = 4_000
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    epochs: int = 5
    batch: int = 16


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, counts: np.ndarray) -> tuple[str, float]:
        total = counts.sum()
        if not total or not self.languages:
            return UNKNOWN, 0.0
        scores = softmax((features(counts, self.idf) @ self.weights) / self.temperature)
        best = int(scores.argmax())
        return self.languages[best], float(scores[best])


@cache
def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text; anything but a letter counts as one space.

    All zero where the text has no letter.
    """
    counts = np.zeros(BUCKETS, np.int64)
    letters = 0
    for start in range(0, len(text), WINDOW):
        piece = text[start : start + WINDOW + MAX_ORDER - 1].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letter_table()[codes]
        letters += int(is_letter.sum())
        codes = np.where(is_letter, codes, np.uint32(32))
        grams = np.zeros(len(codes), np.uint32)
        for order in range(1, MAX_ORDER + 1):
            if len(codes) < order:
                break
            grams = grams[: len(codes) - order + 1] * np.uint32(0x01000193) + codes[order - 1 :] + np.uint32(order)
            first = grams[: max(0, WINDOW)]
            buckets = (first * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
            counts += np.bincount(buckets, minlength=BUCKETS)
    return counts if letters else np.zeros(BUCKETS, np.int64)


def features(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with a damped count, scaled to unit length, and a constant for the bias."""
    values = np.log1p(counts) * idf
    norm = np.sqrt((values * values).sum(axis=-1, keepdims=True))
    values = values / np.maximum(norm, 1e-12)
    return np.concatenate([values, np.ones((*values.shape[:-1], 1))], axis=-1)


def softmax(scores: np.ndarray) -> np.ndarray:
    top = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return top / top.sum(axis=-1, keepdims=True)


class Sample:
    """Counts of the sampled rows, kept sparse; a batch of rows becomes dense features when asked for."""

    def __init__(self, rows: list, languages: tuple[str, ...], idf: np.ndarray):
        self.buckets = [np.frombuffer(r["buckets"], "<u2") for r in rows]
        self.counts = [np.frombuffer(r["counts"], "<u4") for r in rows]
        self.y = np.array([languages.index(r["lang"]) for r in rows])
        self.idf = idf

    def features(self, rows: np.ndarray) -> np.ndarray:
        dense = np.zeros((len(rows), BUCKETS))
        for at, i in enumerate(rows):
            dense[at, self.buckets[i]] = self.counts[i]
        return features(dense, self.idf)

    def scores(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return np.concatenate([self.features(rows[i : i + 64]) @ weights for i in range(0, len(rows), 64)])


def fit_ftrl(sample: Sample, rows: np.ndarray, classes: int, settings: Settings) -> np.ndarray:
    """Weights of a multinomial model, per coordinate by FTRL-proximal steps over mini-batches of the rows."""
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros_like(z)
    weights = np.zeros_like(z)
    order = np.random.default_rng(0)
    for _ in range(settings.epochs):
        shuffled = order.permutation(rows)
        for at in range(0, len(shuffled), settings.batch):
            batch = shuffled[at : at + settings.batch]
            x = sample.features(batch)
            wrong = softmax(x @ weights)
            wrong[np.arange(len(batch)), sample.y[batch]] -= 1
            gradient = x.T @ wrong
            step = (np.sqrt(n + gradient**2) - np.sqrt(n)) / settings.alpha
            z += gradient - step * weights
            n += gradient**2
            shrunk = np.sign(z) * settings.l1 - z
            weights = np.where(np.abs(z) <= settings.l1, 0, shrunk / ((settings.beta + np.sqrt(n)) / settings.alpha + settings.l2))
    return weights


def fit_temperature(scores: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""

    def loss(log_t: float) -> float:
        chosen = softmax(scores / np.exp(log_t))[np.arange(len(y)), y]
        return float(-np.log(np.maximum(chosen, 1e-12)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        if loss(left) < loss(right):
            high = right
        else:
            low = left
    return float(np.exp((low + high) / 2))


def held_out() -> Column:
    """True for the fifth of the rows that is never learned from. A null doc_id is held out."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def document_frequencies(texts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per n-gram and task: in how many texts it occurs. Bucket -1 counts the texts."""
    seen, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in texts:
        for text in batch["text"]:
            seen += ngram_counts(text) > 0
        rows += len(batch)
    found = np.flatnonzero(seen)
    yield pd.DataFrame({"bucket": np.append(found, -1), "n": np.append(seen[found], rows)})


def sparse_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, lang, spare in zip(batch["text"], batch["lang"], batch["spare"], strict=True):
            counts = ngram_counts(text)
            found = np.flatnonzero(counts)
            rows.append((lang, spare, found.astype("<u2").tobytes(), counts[found].astype("<u4").tobytes()))
        yield pd.DataFrame(rows, columns=["lang", "spare", "buckets", "counts"])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, settings: Settings = Settings()) -> LanguageModel:
    """Fit a model on the rows that are not held out and have a language.

    Document frequencies come from all of them. Weights and temperature come from about
    `sample_rows` rows, the same share for each language, chosen by a hash; only their counts, at most
    BUCKETS numbers a row, reach the driver.
    """
    rows = docs.where(~held_out() & F.col("lang").isNotNull()).select("doc_id", whole_text().alias("text"), "lang")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(sizes))
    frequency = np.zeros(BUCKETS)
    total = 0
    counted = rows.select("text").mapInPandas(document_frequencies, "bucket int, n long")
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            total = r["n"]
        else:
            frequency[r["bucket"]] = r["n"]
    idf = np.log((1 + total) / (1 + frequency)) + 1

    scale = 1_000_000
    share = F.lit(0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(scale, sample_rows * scale // (n * len(sizes)) + 1))).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale))
    chosen = rows.where(place < share).withColumn("spare", F.pmod(F.xxhash64("text", F.lit(1)), F.lit(5)) == 0)
    sample = chosen.select("text", "lang", "spare").mapInPandas(
        sparse_counts, "lang string, spare boolean, buckets binary, counts binary"
    ).collect()
    # Spark gives rows in no fixed order; training on a fixed one makes the model the same each time.
    sample = [r for r in sample if r["buckets"]]
    sample.sort(key=lambda r: (r["lang"], r["buckets"], r["counts"]))
    if not sample:
        return LanguageModel((), idf, np.zeros((BUCKETS + 1, 0)), 1.0)
    spare = np.array([r["spare"] for r in sample])
    if spare.all() or not spare.any():
        spare = np.arange(len(sample)) % 5 == 0
    counts = Sample(sample, languages, idf)
    learned, kept = np.flatnonzero(~spare), np.flatnonzero(spare)
    weights = fit_ftrl(counts, learned if len(learned) else kept, len(languages), settings)
    return LanguageModel(languages, idf, weights, fit_temperature(counts.scores(kept, weights), counts.y[kept]))


def predictor(model: LanguageModel, spark: SparkSession):
    """A function of a text column that gives lang_pred and score; model and weights are broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [shared.value.predict(ngram_counts(t)) for t in texts]
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    predict = predictor(model, docs.sparkSession)
    found = docs.select("doc_id", held_out().alias("held_out"), predict(whole_text()).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5) -> DataFrame:
    """The rows whose language the model tells with at least min_score, with all their columns."""
    predict = predictor(model, docs.sparkSession)
    marked = docs.select(as_struct(docs), predict(whole_text()).alias("p"))
    sure = (F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") >= min_score)
    return marked.where(sure).select("whole.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, train(docs))
