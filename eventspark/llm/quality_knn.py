"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are its hashed words, the hashed shapes of its words (case, length, closing mark, signs inside), and
words that repeat the word before them.  Log counts times inverse document frequency, projected on the leading
singular directions of a bounded sample of labelled texts, give its latent vector.  Every document is compared with all
labelled vectors by blocked cosine products, and its ``neighbours`` nearest vote for their labels, weighted by
similarity.

The sample takes up to ``per_class`` labelled rows of either label, those with the smallest hash of their doc_id; only
its term counts reach the driver (``2 * per_class * TERMS`` floats at most), and only its latent vectors and the
projection go to the tasks.  Labels, lang, source and doc_id are never inputs of a score.

Nulls and odd inputs: a null text counts as empty; a text without terms gets the sample's share of label 1 (half);
null or other labels than 0 and 1 are not learnt; a doc_id labelled twice takes the smaller label; without any labelled
row every score is 0.5.  Repeated rows each get their own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from eventspark.llm import words

U = np.uint64
WORDS, SHAPES = 512, 511
TERMS = WORDS + SHAPES + 1  # the last one: a word that repeats the word before it

_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_ALPHA = np.zeros(256, np.int64)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = 1
_SIGN = 1 - _ALPHA
_SIGN[48:58] = 0


def term_counts(column: pa.Array) -> np.ndarray:
    """``rows x TERMS`` counts of a text column."""
    out = np.zeros((len(column), TERMS), np.float32)
    for row, to, part, bounds in words.chunks(column):
        starts, ends, counts = words.chunk_words(part, bounds)
        if not len(starts):
            continue
        h = words.hash_spans(part, starts, ends)

        def total(table: np.ndarray, part=part, starts=starts, ends=ends) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(table[part])])
            return sums[ends] - sums[starts]

        upper, sign, size = total(_UPPER), total(_SIGN), ends - starts
        case = np.where(upper == 0, 0, np.where((upper == 1) & (_UPPER[part[starts]] == 1), 1, 2))
        last = np.where(_SIGN[part[ends - 1]] == 1, part[ends - 1].astype(np.int64), 0)
        length = np.digitize(size, [2, 4, 7, 12, 20, 40])
        shape = ((case * 8 + length) * 256 + last) * 4 + np.minimum(sign, 3)
        shape = (words.mix(shape.astype(U)) % U(SHAPES)).astype(np.int64) + WORDS
        of = np.repeat(np.arange(to - row), counts)
        again = np.flatnonzero((h[1:] == h[:-1]) & (of[1:] == of[:-1])) + 1
        term = np.concatenate([(h % U(WORDS)).astype(np.int64), shape, np.full(len(again), TERMS - 1)])
        at = np.concatenate([of, of, of[again]]) * TERMS + term
        out[row:to] += np.bincount(at, minlength=(to - row) * TERMS).reshape(-1, TERMS)
    return out


@dataclass
class Model:
    """Term weights, projection (terms x k), unit latent vectors of the sample and their labels."""
    idf: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        x = x @ self.projection
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray, block: int = 1024) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        out = np.empty(len(counts))
        k = min(self.neighbours, len(self.labels))
        for at in range(0, len(counts), block):
            sim = self.latent(counts[at:at + block]) @ self.vectors.T
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sim, near, 1), 0).astype(np.float64) ** self.power
            mass = weight.sum(axis=1)
            vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(mass, 1e-300)
            out[at:at + block] = np.where(mass > 0, vote, self.labels.mean())
        return np.clip(out, 0, 1)


def fit(counts: np.ndarray, labels: np.ndarray, dims: int, neighbours: int, power: float) -> Model:
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32),
                     np.zeros(0), neighbours, power)
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = np.log1p(counts) * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    _, _, right = np.linalg.svd(x, full_matrices=False)
    model = Model(idf, right[:dims].T.copy(), np.zeros((0, 1)), labels.astype(np.float64), neighbours, power)
    model.vectors = model.latent(counts)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _counted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        rows = term_counts(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in rows], pa.binary())],
                                         names=["quality", "counts"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1024, dims: int = 32, neighbours: int = 24,
          power: float = 4.0) -> Model:
    known = (labels.filter(~held_out() & F.col("quality").isin(0, 1)).groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("label_"))
             .join(docs.select("doc_id").distinct(), "doc_id", "leftsemi"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    sample = known.filter("label_ = 0").orderBy(*order).limit(per_class).union(
        known.filter("label_ = 1").orderBy(*order).limit(per_class)).collect()  # at most 2 * per_class (id, label)
    spark = docs.sparkSession
    sample = spark.createDataFrame([(r[0], r[1]) for r in sample], "doc_id long, label_ int")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # 2 * per_class pairs of numbers
    texts = texts.groupBy("doc_id").agg(F.first("label_").alias("label_"), F.min("text").alias("text")).select("label_", "text")
    rows = texts.mapInArrow(_counted, "quality int, counts binary").collect()
    rows = sorted((r["quality"], bytes(r["counts"])) for r in rows)  # order of arrival doesn't matter
    counts = np.frombuffer(b"".join(r[1] for r in rows), np.float32).reshape(-1, TERMS)
    return fit(counts, np.array([r[0] for r in rows]), dims, neighbours, power)


def quality_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a ``score`` column (0 to 1, higher: label 1 likelier).  A column of that name is replaced."""
    docs = docs.drop("score")
    names = [*docs.columns, "score"]
    at = names.index(text_col)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for first in range(0, batch.num_rows, 1024):
                part = batch.slice(first, 1024)
                score = pa.array(model.score(term_counts(part.column(at))))
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("score", DoubleType())]))
