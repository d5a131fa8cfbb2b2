"""Language identification: averaged hashed subword embeddings under a linear softmax, with calibrated rejection.

The model is trained on the driver, in numpy, on a bounded sample of labelled documents; it then scores every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import U

#: Hash buckets of subwords, and the size of their embeddings.
BUCKETS, DIM = 1 << 15, 16
#: Characters whose subwords are gathered at a time.
CHUNK = 1 << 17
UNKNOWN = "und"
#: The most languages that a model is trained for.
MOST_LANGUAGES = 500
_LETTER = re.compile(r"[^\W\d_]")
_IS_LETTER = np.array([chr(c).isalpha() for c in range(65536)])
_MULTIPLIERS = [U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xD6E8FEB86659FD93)]
#: Lengths of subwords. A border of a word counts as one character.
ORDERS = (2, 3, 4)


def subwords(text: str) -> Iterator[np.ndarray]:
    """Bucket numbers of a text's subwords, chunk by chunk: runs of 2 to 4 letters, borders of words included."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    for first in range(0, len(points), CHUNK):
        part = points[first : first + CHUNK + max(ORDERS) - 1]
        letter = _IS_LETTER[np.minimum(part, 65535)] | (part > 65535)
        values = np.where(letter, part, 32).astype(U)
        own = min(CHUNK, len(points) - first)
        hashed = values * _MULTIPLIERS[0]
        inner = np.ones(len(part), bool)
        for n in range(2, max(ORDERS) + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            hashed = (hashed[:m] ^ (hashed[:m] >> U(29))) * _MULTIPLIERS[1] + values[n - 1 :] * _MULTIPLIERS[n - 1]
            inner = inner[:m] & (letter[n - 2 : n - 2 + m] if n > 2 else True)
            if n in ORDERS:
                keep = inner & (letter[:m] | letter[n - 1 :])
                keep[own:] = False
                yield (hashed[keep] >> U(64 - 15)).astype(np.int64)


def counts_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a text."""
    total = np.zeros(BUCKETS, np.int64)
    for found in subwords(text):
        total += np.bincount(found, minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at]


@dataclass
class LanguageModel:
    """Languages, the embeddings times the softmax weights (all that scoring needs), and what calibration found."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for found in subwords(text):
            total += self.table[found].sum(axis=0, dtype=np.float64)
            n += len(found)
        return total / max(n, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); ``und`` and 0 for texts without letters."""
        if not self.languages or not text or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text)[None] / self.temperature)[0]
        return self.languages[int(p.argmax())], float(p.max())


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 32, rate: float = 40.0, accuracy: float = 0.99, seed: int = 5) -> LanguageModel:
    """Trains on rows (language, buckets, counts) by stochastic gradient descent with a falling rate.

    A tenth of the rows is held back to fit the temperature and the smallest probability above which predictions are
    right at least as often as ``accuracy`` (0 if they always are).
    """
    languages = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    if not rows:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    order = rng.permutation(len(rows))
    held, train = order[: len(rows) // 10], order[len(rows) // 10 :]
    label = np.array([languages.index(r[0]) for r in rows])
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weight = rng.uniform(-0.1, 0.1, (DIM, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    dense = np.zeros((batch, BUCKETS), np.float32)

    def filled(chosen: np.ndarray) -> np.ndarray:
        dense[:] = 0
        for i, k in enumerate(chosen):
            dense[i, rows[k][1]] = rows[k][2] / max(1, rows[k][2].sum())
        return dense[: len(chosen)]

    steps, step = epochs * -(-len(train) // batch), 0
    for _ in range(epochs):
        rng.shuffle(train)
        for first in range(0, len(train), batch):
            chosen = train[first : first + batch]
            x = filled(chosen)
            hidden = x @ embed
            slope = softmax(hidden @ weight + bias)
            slope[np.arange(len(chosen)), label[chosen]] -= 1
            slope /= len(chosen)
            now = rate * (1 - step / steps)
            back = slope @ weight.T
            weight -= now * 0.1 * (hidden.T @ slope)
            bias -= now * 0.01 * slope.sum(axis=0)
            embed -= now * (x.T @ back)
            step += 1
    model = LanguageModel(languages, (embed @ weight).astype(np.float32), bias.astype(np.float64))
    if len(held):
        z = np.array([(model.table[rows[k][1]] * rows[k][2][:, None]).sum(axis=0) / max(1, rows[k][2].sum()) + model.bias for k in held])
        truth = label[held]
        loss = {t: -np.log(softmax(z / t)[np.arange(len(held)), truth] + 1e-12).mean() for t in np.geomspace(0.2, 5, 25)}
        model.temperature = float(min(loss, key=loss.get))
        p = softmax(z / model.temperature)
        right, sure = p.argmax(axis=1) == truth, p.max(axis=1)
        falling = np.argsort(-sure)
        good = np.flatnonzero(np.cumsum(right[falling]) >= accuracy * np.arange(1, len(held) + 1))
        model.reject_below = 0.0 if len(good) and good[-1] == len(held) - 1 else float(sure[falling[good[-1]]]) if len(good) else 1.0
    return model


def train(labelled: DataFrame, per_language: int = 600) -> LanguageModel:
    """Fits the model on a sample of ``labelled`` (doc_id, text, lang): at most about ``per_language`` documents each.

    The sample is the documents with the smallest hashes of doc_id; only counts of subwords reach the driver. Rows with
    a null language or without letters teach nothing. No rows give a model that says ``und``. More than MOST_LANGUAGES
    are an error, so what reaches the driver is bounded.
    """
    known = labelled.where("lang is not null and text is not null").select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(lang, *counts_of(text)) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if _LETTER.search(text)]
            arrays = [pa.array([r[0] for r in out], pa.string())]
            arrays += [pa.array([r[i].astype("<i4").tobytes() for r in out], pa.binary()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "buckets", "counts"])

    found = known.where(place < share).select("lang", "text").mapInArrow(run, "lang string, buckets binary, counts binary")
    rows = [(r[0], np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<i4")) for r in found.collect()]
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    return fit(rows)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every whole text of ``docs`` (doc_id, text).

    lang_pred is the likeliest language and score its calibrated probability; rejected says that the score is below the
    calibrated threshold. Null texts and texts without letters are ``und`` with score 0, rejected. Equal texts get equal
    answers. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = [model.predict(cell.as_py()) for cell in batch.column(1)]
            arrays = [batch.column(0).cast(pa.int64()), pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.float64())]
            arrays.append(pa.array([r[0] == UNKNOWN or r[1] < model.reject_below for r in out], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
