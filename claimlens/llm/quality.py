"""Quality: nearest-neighbour voting among latent-semantic vectors.

Terms of a document are its words (hashed), the words' shapes (letter case,
digits and marks: ``NOW!!`` has the shape ``A!!``) and how much of the text
are words that repeat the one before. Log-scaled, weighted by inverse document
frequency and length-normalised, they are projected by a truncated singular
value decomposition that is fitted on the labelled sample.

At most ``MAX_LABELLED`` labelled documents (a documented bound, chosen by
hash of the id) are fitted and broadcast as vectors. Every document is
compared with all of them by blocked matrix products; its ``K`` nearest vote
with their label, weighted by a power of the cosine similarity.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import fold, map_arrow, texts

WORD_TERMS = 1 << 11
SHAPE_TERMS = 1 << 10
REPEATS = (0.05, 0.2, 0.5, 0.8)  # one term for each such share of words that repeat the one before
TERMS = WORD_TERMS + SHAPE_TERMS + len(REPEATS)
RANK = 48
MAX_LABELLED = 4096
K = 15
POWER = 4.0          # votes weigh similarity ** POWER
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
BLOCK = 256          # documents per matrix product
CACHE_WORDS = 150_000
LONGEST_CACHED = 60
_SHAPES = ((re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a"),
           (re.compile(r"\d+"), lambda m: "0"))


def shape(word: str) -> str:
    for pattern, to in _SHAPES:
        word = pattern.sub(to, word)
    return word


class Terms:
    """Term counts of texts; what a word counts for is looked up after its first use."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def of_word(self, word: str) -> tuple[int, int]:
        found = (zlib.crc32(word.lower().encode("utf-8", "replace")) % WORD_TERMS,
                 WORD_TERMS + zlib.crc32(shape(word).encode("utf-8", "replace")) % SHAPE_TERMS)
        if len(word) <= LONGEST_CACHED:
            if len(self.known) >= CACHE_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def counts(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.zeros(TERMS, np.float32)
        get, new = self.known.get, self.of_word
        ids = np.array([get(w) or new(w) for w in words])
        out = np.bincount(ids.ravel(), minlength=TERMS).astype(np.float32)
        again = np.count_nonzero((ids[1:] == ids[:-1]).all(axis=1))
        for k, share in enumerate(REPEATS):
            if again > share * len(words):
                out[WORD_TERMS + SHAPE_TERMS + k] = again
        return out


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of log-scaled counts times idf, of length 1 (or all zero)."""
    x = np.log1p(counts) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled training texts: t_id, y, text; of several texts of one id the smallest."""
    known = (labels.select(F.col("doc_id").cast("long").alias("t_id"), F.col(label).cast("int").alias("y"))
             .filter(F.col("t_id").isNotNull() & F.col("y").isin(0, 1))
             .filter(fold(F.col("t_id"), FOLDS) != HELD_OUT)
             .groupBy("t_id").agg(F.max("y").alias("y"))
             .orderBy(F.xxhash64("t_id"), "t_id").limit(most))
    picked = docs.select(F.col("doc_id").cast("long").alias("t_id"), F.col("text").cast("string").alias("text"))
    return (picked.join(F.broadcast(known), "t_id")  # at most ``most`` ids
            .groupBy("t_id", "y").agg(F.min("text").alias("text")))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_LABELLED):
    """Model: idf, projection, unit vectors of the labelled documents, their labels and the prior."""
    terms = Terms()

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        where, count = [], []
        for t in texts(batch):
            c = terms.counts(t)
            at = np.flatnonzero(c)
            where.append(at.astype("<i4").tobytes())
            count.append(c[at].tobytes())
        return pa.RecordBatch.from_arrays(
            [batch.column("t_id"), batch.column("y"), pa.array(where, pa.binary()), pa.array(count, pa.binary())],
            names=["t_id", "y", "places", "counts"])

    rows = map_arrow(labelled(docs, labels, label, most), features,
                     "t_id long, y int, places binary, counts binary").toPandas()
    rows = rows.sort_values("t_id")
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, (at, c) in enumerate(zip(rows["places"], rows["counts"])):
        x[i, np.frombuffer(at, "<i4")] = np.frombuffer(c, np.float32)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 0.01
    x = weigh(x, idf)
    # The leading eigenvectors of the term-by-term product are the right singular vectors.
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    projection = np.ascontiguousarray(vectors[:, ::-1][:, :RANK].astype(np.float32))
    latent = x @ projection
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
    y = rows["y"].to_numpy(np.float32)
    return idf, projection, latent, y, float(y.mean()) if len(y) else 0.5


def vote(sims: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Share of label 1 among the K most similar, weighted by similarity; ties by position."""
    k = min(K, sims.shape[1])
    if not k:
        return np.full(len(sims), prior)
    kth = np.partition(sims, -k, axis=1)[:, -k][:, None]
    above, tied = sims > kth, sims == kth
    room = k - above.sum(axis=1, keepdims=True)
    chosen = above | (tied & (np.cumsum(tied, axis=1) <= room))
    weight = np.where(chosen, np.maximum(sims, 0) ** POWER, 0).astype(np.float64)
    total = weight.sum(axis=1)
    return np.where(total > 1e-9, (weight @ y) / np.maximum(total, 1e-9), prior)


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= THRESHOLD) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_LABELLED vectors
    terms = Terms()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        idf, projection, latent, y, prior = shared.value
        out = np.full(batch.num_rows, prior)
        all_texts = texts(batch)
        for a in range(0, batch.num_rows, BLOCK):
            counts = np.stack([terms.counts(t) for t in all_texts[a:a + BLOCK]])
            z = weigh(counts, idf) @ projection
            size = np.linalg.norm(z, axis=1, keepdims=True)
            p = vote((z / np.maximum(size, 1e-12)) @ latent.T, y, prior)
            out[a:a + BLOCK] = np.where(size[:, 0] > 1e-9, p, prior)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(out),
             pa.array((out >= THRESHOLD).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"])

    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), (fold(doc_id, FOLDS) == HELD_OUT).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id long, held_out boolean, score double, predicted int")


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled rows, score every row of ``docs``.

    Null and empty texts, and all texts where no row is labelled, get the
    share of label 1 in training (0.5 without any). Repeated rows get the
    same score; an empty table gives no rows.
    """
    return score(docs, fit(docs, labels))
