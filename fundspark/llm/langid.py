"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams are hashed. Document frequencies are counted over all training documents. The classifier
is trained with the follow-the-regularised-leader rule and elastic-net penalties on shards of a
bounded sample; the shards' weights are averaged, and a temperature is fitted on sample documents
that no shard has seen.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.llm.sampling import hashed_sample

BUCKETS = 2**15
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the character 1- to 3-grams within words, and how often each occurs."""
    plain = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    codes = np.frombuffer(plain.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    hashed = [codes * np.uint64(0x9E3779B97F4A7C15)]
    for length in (2, 3):
        if len(codes) >= length:
            shorter = hashed[-1][:-1] ^ (hashed[-1][:-1] >> np.uint64(29))
            hashed.append((shorter + codes[length - 1 :]) * np.uint64(0xBF58476D1CE4E5B9))
    buckets = np.concatenate(hashed) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    counts = np.bincount(buckets.astype(np.int64), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def tf_idf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, counts = gram_counts(text)
    values = (1 + np.log(counts)) * idf[found]
    return found, values / max(np.linalg.norm(values), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found, values = tf_idf(text, self.idf)
        p = softmax(values @ self.weights[found] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def follow_leader(
    examples: list[tuple[np.ndarray, np.ndarray, int]],
    classes: int,
    *,
    alpha: float,
    beta: float,
    l1: float,
    l2: float,
    epochs: int,
    seed: int,
) -> np.ndarray:
    """FTRL-proximal weights, per coordinate: 0 while \\|z\\| <= l1, else the closed form."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def leader(rows) -> np.ndarray:
        zr, nr = z[rows], n[rows]
        rate = (beta + np.sqrt(nr)) / alpha + l2
        return np.where(np.abs(zr) <= l1, 0.0, -(zr - np.sign(zr) * l1) / rate)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in rng.permutation(len(examples)):
            rows, values, label = examples[at]
            weights = leader(rows)
            error = softmax(values @ weights)
            error[label] -= 1
            slope = values[:, None] * error
            squared = n[rows] + slope**2
            z[rows] += slope - (np.sqrt(squared) - np.sqrt(n[rows])) / alpha * weights
            n[rows] = squared
    return leader(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-300)).mean()

    low, high, ratio = np.log(0.25), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        one, two = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, two) if loss(one) < loss(two) else (one, high)
    return float(np.exp((low + high) / 2))


def _document_frequency(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, documents = np.zeros(BUCKETS + 1, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            total[gram_counts(text)[0]] += 1
        documents += len(batch)
    total[BUCKETS] = documents
    found = np.flatnonzero(total)
    yield pd.DataFrame({"bucket": found, "documents": total[found]})


def _train(idf: np.ndarray, languages: tuple[str, ...], settings: dict):
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["id", "lang", "text"])
        examples = [
            (*tf_idf(text, idf), languages.index(lang))
            for text, lang in zip(shard["text"], shard["lang"], strict=True)
        ]
        weights = follow_leader(examples, len(languages), **settings)
        found = np.flatnonzero(weights.any(axis=1))
        return pd.DataFrame({"bucket": found, "weights": weights[found].tolist()})

    return run


def _logits(idf: np.ndarray, languages: tuple[str, ...], weights: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                found, values = tf_idf(text, idf)
                out.append((values @ weights[found]).tolist())
            labels = [languages.index(lang) for lang in batch["lang"]]
            yield pd.DataFrame({"logits": out, "label": labels})

    return run


def train_languages(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    fold: tuple[int, int] = (4, 2),
    sample: int = 8_000,
    shards: int = 4,
    max_languages: int = 512,
    seed: int = 3,
) -> LanguageModel:
    """Learn from text and language of the documents outside the held-out fold.

    Document frequencies cover all of them. The classifier is fitted on about ``sample`` documents
    at most: a fifth of these calibrate, the rest train in ``shards`` tasks (one if the sample is
    small). Rows with a NULL id, language or text, or a text without letters, teach nothing;
    without any such row the model predicts ``und``. More than ``max_languages`` languages are
    refused, as the model would outgrow a task.
    """
    folds, held = fold
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    rows = rows.where("id is not null and lang is not null and text is not null")
    rows = rows.where(F.crc32(F.col("id").cast("string").cast("binary")) % folds != held)
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    found = rows.select("lang").distinct().limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = tuple(sorted(r["lang"] for r in found))
    if not languages:
        return LanguageModel((), np.ones(BUCKETS), np.zeros((BUCKETS, 0)), 1.0)
    counted = rows.select("text").mapInPandas(_document_frequency, "bucket int, documents long")
    counted = counted.groupBy("bucket").agg(F.sum("documents").alias("documents")).toPandas()
    frequency = np.zeros(BUCKETS + 1)
    frequency[counted["bucket"]] = counted["documents"]
    idf = np.log((1 + frequency[BUCKETS]) / (1 + frequency[:BUCKETS])) + 1
    chosen = hashed_sample(rows, ["id", "text", "lang"], sample, seed)
    part = F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(5))
    size = chosen.count()
    used = max(1, min(shards, size // 1500))
    # A small sample passes more often, so that every weight has moved enough.
    epochs = int(np.clip(12_000 // max(size, 1), 3, 20))
    settings = {"alpha": 1.0, "beta": 1.0, "l1": 0.01, "l2": 0.01, "epochs": epochs, "seed": seed}
    shard = F.pmod(F.xxhash64("id", F.lit(seed + 2)), F.lit(used))
    trained = chosen.where(part != 0).groupBy(shard.alias("shard"))
    trained = trained.applyInPandas(
        _train(idf, languages, settings), "bucket int, weights array<double>"
    ).toPandas()
    weights = np.zeros((BUCKETS, len(languages)))
    if len(trained):
        np.add.at(weights, trained["bucket"], np.array(trained["weights"].tolist()) / used)
    held_back = chosen.where(part == 0).mapInPandas(
        _logits(idf, languages, weights), "logits array<double>, label int"
    ).toPandas()
    logits = np.array(held_back["logits"].tolist()).reshape(len(held_back), len(languages))
    temperature = fit_temperature(logits, held_back["label"].to_numpy())
    return LanguageModel(languages, idf, weights, temperature)


def identify(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, lang_pred, score`` for every row of docs, repeated rows included.

    A NULL text, or one without a letter, is ``und`` with score 0. Only the text goes in.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [model.predict(text) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "lang_pred": [lang for lang, _ in found],
                    "score": [score for _, score in found],
                }
            )

    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    return texts.mapInPandas(run, "id long, lang_pred string, score double")


def keep_identified(
    docs: DataFrame, model: LanguageModel, *, least: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """The rows of docs in a language told with at least ``least`` confidence, columns unchanged."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = [model.predict(text) for text in batch.column(at).to_pylist()]
            yield batch.filter(array([lang != UNKNOWN and s >= least for lang, s in found], bool_()))

    from pyarrow import array, bool_

    return docs.mapInArrow(run, docs.schema)
