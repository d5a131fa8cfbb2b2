"""Quality by nearest-neighbour voting over latent-semantic vectors of labelled documents.

Terms are hashed words and hashed runs of character classes (what a text looks like), with immediate repetitions as
terms of their own. A truncated singular value decomposition of the labelled sample's weighted terms gives the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import U, mix, text_blocks, words

#: Hash buckets of words and of class runs; then come terms for a word that repeats one of the two before it, or not.
WORDS, SHAPES = 512, 512
TERMS = WORDS + SHAPES + 4
#: Latent dimensions, neighbours that vote, and documents compared with all vectors at a time.
RANK, NEIGHBOURS, BLOCK = 32, 15, 256

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[65:91] = 65
_CLASS[97:123] = 97
_CLASS[128:] = 97
_CLASS[48:58] = 48
_CLASS[[9, 11, 12, 13]] = 32


def term_counts(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Relative term frequencies of a text column, block by block: (index of the first text, texts x TERMS)."""
    for first, data, at in text_blocks(column):
        n = len(at) - 1
        out = np.zeros((n, TERMS), np.float32)
        hashed, doc, _, _ = words(data, at)
        if len(hashed):
            per_doc = np.maximum(np.bincount(doc, minlength=n), 1)[:, None]
            out[:, :WORDS] = np.bincount(doc * WORDS + (hashed >> U(55)).astype(np.int64), minlength=n * WORDS).reshape(n, WORDS) / per_doc
            for lag in (1, 2):
                same = np.zeros(len(hashed), np.int64)
                same[lag:] = (hashed[lag:] == hashed[:-lag]) & (doc[lag:] == doc[:-lag])
                both = np.bincount(doc * 2 + same, minlength=2 * n).reshape(n, 2) / per_doc
                out[:, WORDS + SHAPES + 2 * lag - 2 : WORDS + SHAPES + 2 * lag] = both
        kinds = _CLASS[data]
        new = np.ones(len(kinds), bool)
        new[1:] = (kinds[1:] != kinds[:-1]) | ~np.isin(kinds[1:], [65, 97, 48, 32])
        edge = at[:-1][at[:-1] < len(kinds)]
        new[edge] = True
        place = np.flatnonzero(new)
        if len(place) > 2:
            runs, owner = kinds[place].astype(U), np.searchsorted(at, place, "right") - 1
            code = mix(runs[:-2] * U(65536) + runs[1:-1] * U(256) + runs[2:])
            code, owner = code[owner[:-2] == owner[2:]], owner[:-2][owner[:-2] == owner[2:]]
            found = np.bincount(owner * SHAPES + (code >> U(55)).astype(np.int64), minlength=n * SHAPES).reshape(n, SHAPES)
            out[:, WORDS : WORDS + SHAPES] = found / np.maximum(found.sum(axis=1, keepdims=True), 1)
        yield first, out


def weighted(terms: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square-rooted frequencies times inverse document frequency; words count half as much as looks."""
    out = np.sqrt(terms) * idf
    out[:, :WORDS] *= 0.5
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class QualityModel:
    """The projection and the labelled vectors: a few MB at most, whatever the corpus."""

    idf: np.ndarray
    mean: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, terms: np.ndarray) -> np.ndarray:
        return unit((weighted(terms, self.idf) - self.mean) @ self.basis)

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among each document's nearest labelled vectors, by exact products."""
        if not len(self.labels):
            return np.full(len(terms), 0.5)
        out = np.empty(len(terms))
        k = min(NEIGHBOURS, len(self.labels))
        for first in range(0, len(terms), BLOCK):
            near = self.project(terms[first : first + BLOCK]) @ self.vectors.T
            best = np.argpartition(-near, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(near, best, axis=1), 1e-6) ** 4
            out[first : first + BLOCK] = (weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def fit(terms: np.ndarray, labels: np.ndarray) -> QualityModel:
    """The latent-semantic model of labelled term frequencies."""
    idf = np.log((len(terms) + 1) / ((terms > 0).sum(axis=0) + 1)) + 0.5
    x = weighted(terms, idf)
    mean = x.mean(axis=0) if len(x) else np.zeros(TERMS)
    centered = x - mean
    _, vectors = np.linalg.eigh(centered.T.astype(np.float64) @ centered)
    basis = vectors[:, ::-1][:, :RANK]
    return QualityModel(idf.astype(np.float32), mean.astype(np.float32), basis.astype(np.float32), unit(centered @ basis).astype(np.float32), labels.astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500) -> QualityModel:
    """Fits on a sample of ``labels`` (doc_id, quality) joined with ``docs``: about ``per_label`` documents a label at most.

    The sample is the labelled documents with the smallest hashes of doc_id, so both labels vote alike. Null labels
    teach nothing; without labels every score is 0.5.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sizes = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(0.0)
    for label, n in sizes.items():
        share = F.when(F.col("quality") == label, F.lit(min(1.0, per_label / n))).otherwise(share)
    chosen = known.where(place < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, terms in term_counts(batch.column(0)):
                arrays = [batch.column(1).slice(first, len(terms)).cast(pa.int32()), pa.array([t.tobytes() for t in terms], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["quality", "terms"])

    # The sample's ids are bounded by per_label, so they may be broadcast.
    sample = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "quality")
    rows = sorted((bytes(r[1]), r[0]) for r in sample.mapInArrow(run, "quality int, terms binary").collect())
    terms = np.stack([np.frombuffer(r[0], np.float32) for r in rows]) if rows else np.zeros((0, TERMS), np.float32)
    return fit(terms, np.array([r[1] for r in rows]))


def scored(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) for every whole text of ``docs`` (doc_id, text).

    Null and empty texts have no terms and are scored like any text without them. Equal texts get equal scores. An empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, terms in term_counts(batch.column(1)):
                score = pa.array(shared.value.score(terms), pa.float64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(terms)).cast(pa.int64()), score], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def kept(docs: DataFrame, model: QualityModel, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``least`` or more. The rows pass through once, without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [shared.value.score(terms) >= least for _, terms in term_counts(batch.column(text))]
            yield batch.filter(pa.array(np.concatenate(good) if good else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)
