"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes ratios.

Words are lower-cased and padded with a space at both ends; the features of a
document are the character n-grams of its distinct words, each counted once
per distinct word. Each feature is
scaled by its naive Bayes log-count ratio (how much likelier it is in toxic
training documents) and a logistic regression is trained on the scaled
features.

Training reads at most ``MAX_PER_CLASS`` labelled documents per class (a
documented bound; chosen by hash of the id). Every n-gram that occurs
``MIN_COUNT`` times in them and is likelier in toxic ones is a feature; which of
them count is left to the regression's penalty. (N-grams that speak against
the label pile up with a text's length: with them fewer toxic documents of the
validation fold are found.) ``MAX_FEATURES`` bounds the broadcast model.
Scoring reads every whole text: the model is linear,
so a document's score is the bias plus the sum over its distinct words, each
word's share being computed once per worker and then looked up.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import WORD, fold, let_go, map_arrow, runs, stored, texts

LENGTHS = (2, 3, 4, 5, 6)
MAX_PER_CLASS = 3000
MAX_FEATURES = 1 << 19  # of the broadcast model: several times what 6,000 documents of prose give
MIN_COUNT = 3
ALPHA = 1.0          # smoothing of the counts
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
AT_ONCE = 1 << 19    # features that a step of the training expands at a time
COUNTED = 128        # texts whose n-grams a worker counts at a time
CACHE_WORDS = 150_000
LONGEST_CACHED = 60  # characters
UNIT = 1 << 40       # weights are scored as whole multiples of its inverse


def _grams(word: str) -> Iterator[str]:
    w = f" {word} "
    return (w[i:i + n] for n in LENGTHS for i in range(len(w) - n + 1))


def grams(word: str) -> set[str]:
    return set(_grams(word))


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def training_ids(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled training ids of each class: t_id, t_label.

    Held-out ids and null labels are left out; of several labels of one id
    the largest counts.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("t_id"), F.col(label).cast("int").alias("t_label"))
             .filter(F.col("t_id").isNotNull() & F.col("t_label").isin(0, 1))
             .filter(fold(F.col("t_id"), FOLDS) != HELD_OUT)
             .groupBy("t_id").agg(F.max("t_label").alias("t_label")))
    of = [known.filter(F.col("t_label") == k).orderBy(F.xxhash64("t_id"), "t_id").limit(per_class) for k in (0, 1)]
    return of[0].unionByName(of[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic",
          per_class: int = MAX_PER_CLASS) -> tuple[dict[str, float], float]:
    """Weights by n-gram and the bias, see ``_fit``."""
    grams_, weights, bias = _fit(docs, labels, label, per_class)
    return {g: w for g, w in zip(grams_.to_pylist(), weights.tolist()) if w}, bias


def _fit(docs: DataFrame, labels: DataFrame, label: str = "toxic",
         per_class: int = MAX_PER_CLASS) -> tuple[pa.Array, np.ndarray, float]:
    """N-grams, their weights and the bias. Without labels of both classes: none, and the prior.

    Of several texts of one id the smallest is learnt from.
    The driver gets the features (at most MAX_FEATURES) and the training
    documents' counts of these, packed, as Arrow columns without a Python object for each; all n-grams
    are counted in Spark.
    """
    # At most 2 * per_class ids: a proven bound for the broadcast.
    ids = F.broadcast(training_ids(docs, labels, label, per_class))
    picked = docs.select(F.col("doc_id").cast("long").alias("t_id"), F.col("text").cast("string").alias("text"))
    picked = stored(picked.join(ids, "t_id").groupBy("t_id", "t_label").agg(F.min("text").alias("text"))
                    .select("t_label", "text"), "training")
    sizes = dict(picked.groupBy("t_label").count().collect())
    if not sizes.get(0) or not sizes.get(1):
        return *_packed({}), (4.0 if sizes.get(1) else -4.0)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = (Counter(), Counter())
        for y, t in zip(batch.column("t_label").to_pylist(), texts(batch)):
            for w in words_of(t):
                counts[y].update(grams(w))
        found = sorted(counts[0].keys() | counts[1].keys())
        return pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), *(pa.array([c[g] for g in found], pa.int64()) for c in counts)],
            names=["gram", "c0", "c1"])

    counted = stored(map_arrow(picked, count, "gram string, c0 long, c1 long", COUNTED).groupBy("gram")
                     .agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "grams")
    # Shares of all n-grams of the class, so that a class of longer texts is not favoured.
    of = counted.agg(F.sum("c0").alias("m0"), F.sum("c1").alias("m1"), F.count(F.lit(1)).alias("n")).first()
    if not of["n"]:
        return *_packed({}), 0.0
    mass = math.log((of["m1"] + ALPHA * of["n"]) / (of["m0"] + ALPHA * of["n"]))
    c1, c0 = F.col("c1") + F.lit(ALPHA), F.col("c0") + F.lit(ALPHA)
    chosen = (counted.filter(F.col("c0") + F.col("c1") >= MIN_COUNT)
              .withColumn("ratio", F.log(c1 / c0) - F.lit(mass)).filter(F.col("ratio") > 0)
              .withColumn("z", F.col("ratio") / F.sqrt(1 / c1 + 1 / c0))
              .orderBy(F.col("z").desc(), "gram").limit(MAX_FEATURES).select("gram", "ratio").toArrow())
    ratios = chosen["ratio"].to_numpy().astype(float)
    every = pa.concat_arrays(chosen["gram"].cast(pa.string()).chunks or [pa.array([], pa.string())])
    del chosen
    shared = docs.sparkSession.sparkContext.broadcast(every)  # at most MAX_FEATURES n-grams
    number: dict[str, int] = {}  # of a task

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        which, value, keys = [], [], []
        if not number:
            number.update((g, i) for i, g in enumerate(shared.value.to_pylist()))
        get = number.get
        for y, t in zip(batch.column("t_label").to_pylist(), texts(batch)):
            seen = Counter()
            for w in words_of(t):
                seen.update({i for i in map(get, _grams(w)) if i is not None})
            found = sorted(seen)
            which.append(np.array(found, "<i4").tobytes())
            value.append(np.array([seen[i] for i in found], "<i4").tobytes())
            keys.append(hashlib.md5(b"%d" % y + which[-1] + value[-1]).digest())
        return pa.RecordBatch.from_arrays(
            [batch.column("t_label"), *(pa.array(c, pa.binary()) for c in (which, value, keys))],
            names=["y", "which", "value", "key"])

    rows = stored(map_arrow(picked, features, "y int, which binary, value binary, key binary"), "features")
    # One order, whatever partition a document came from, so that sums repeat to the last bit.
    rows = rows.toArrow()
    order = np.argsort(np.array(rows.column("key").to_pylist(), object), kind="stable")
    rows = rows.drop_columns(["key"]).take(pa.array(order))
    shared.destroy()
    y = rows["y"].to_numpy().astype(float)
    which, sizes = _numbers(rows["which"])
    value, _ = _numbers(rows["value"])
    del rows
    w, bias = _logistic(sizes, which, value, ratios, y)
    del which, value
    let_go(__name__)
    return every, w * ratios, bias


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All 32-bit numbers of a column of packed ones, and how many each row has; not copied where the column is one chunk."""
    whole = pa.concat_arrays([c.cast(pa.binary()) for c in column.chunks])
    ends = np.frombuffer(whole.buffers()[1], "<i4", len(whole) + 1, 4 * whole.offset)
    data = whole.buffers()[2]
    numbers = np.frombuffer(data, "<i4", (ends[-1] - ends[0]) // 4, ends[0]) if ends[-1] > ends[0] else np.zeros(0, "<i4")
    return numbers, np.diff(ends).astype(np.int64) // 4


def _packed(weights: dict[str, float]) -> tuple[pa.Array, np.ndarray]:
    return pa.array(list(weights), pa.string()), np.array(list(weights.values()), float)


def _logistic(sizes, cols, values, scale, y, steps: int = 200, penalty: float = 1e-4, memory: int = 10):
    """Logistic regression with an L2 penalty by limited-memory quasi-Newton steps, classes weighed alike.

    ``cols`` and ``values`` hold the features of all documents one after the other, ``sizes``
    of each; a feature's values are scaled by ``scale``. ``AT_ONCE`` of them are expanded at a time.
    """
    n, m = len(y), len(scale)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    parts = [(a, b, slice(edges[a], edges[b])) for a, b in runs(sizes, AT_ONCE)]

    def forward(w):
        out = np.zeros(n)
        for a, b, s in parts:
            out[a:b] = np.bincount(np.repeat(np.arange(b - a), sizes[a:b]), values[s] * w[cols[s]], b - a)
        return out

    def back(err):
        out = np.zeros(m)
        for a, b, s in parts:
            out += np.bincount(cols[s], values[s] * np.repeat(err[a:b], sizes[a:b]), m)
        return out

    weight = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    sign = 2 * y - 1

    def cost(x):
        margin = sign * (forward(scale * x[:m]) + x[m])
        err = -weight * sign / (1 + np.exp(np.clip(margin, -500, 500)))
        slope = np.append(scale * back(err) + penalty * x[:m], err.sum())
        return weight @ np.logaddexp(0, -margin) + penalty / 2 * (x[:m] @ x[:m]), slope

    x = np.zeros(m + 1)
    value, slope = cost(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, alphas = -slope, []
        for s, g in reversed(pairs):
            alphas.append((s @ d) / (s @ g))
            d = d - alphas[-1] * g
        if pairs:
            s, g = pairs[-1]
            d = d * (s @ g) / (g @ g)
        for (s, g), alpha in zip(pairs, reversed(alphas)):
            d = d + s * (alpha - (g @ d) / (s @ g))
        down, rate = slope @ d, 1.0
        while rate > 1e-10:
            new, new_slope = cost(x + rate * d)
            if new <= value + 1e-4 * rate * down:
                break
            rate /= 2
        s, g = rate * d, new_slope - slope
        done = value - new < 1e-9
        x, value, slope = x + s, new, new_slope
        if done:
            break
        if s @ g > 1e-12:
            pairs = [*pairs, (s, g)][-memory:]
    return x[:m], float(x[m])


def _scored(rows: DataFrame, every: pa.Array, weights: np.ndarray, bias: float) -> DataFrame:
    """``rows`` with a column ``score`` behind the others; reads its column ``text``."""
    # At most MAX_FEATURES n-grams. Whole multiples of 1 / UNIT add up alike in any order.
    on = np.flatnonzero(weights)
    model = rows.sparkSession.sparkContext.broadcast((every.take(pa.array(on)), np.rint(weights[on] * UNIT).astype(np.int64)))
    table: dict[str, int] = {}  # of a task
    start = round(bias * UNIT)

    class Shares(dict):
        """Weights of words, computed when first asked for."""

        def __missing__(self, word: str) -> int:
            w = f" {word} "
            if not table:
                table.update(zip(model.value[0].to_pylist(), model.value[1].tolist()))
            held = {g for n in LENGTHS for i in range(len(w) - n + 1) if (g := w[i:i + n]) in table}
            share = sum(map(table.__getitem__, held))
            if len(word) <= LONGEST_CACHED:
                if len(self) >= CACHE_WORDS:
                    self.clear()
                self[word] = share
            return share

    shares = Shares()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.array([sum(map(shares.__getitem__, words_of(t)), start) / UNIT for t in texts(batch)], float)
        p = 1 / (1 + np.exp(-np.clip(out, -500, 500)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, "score"])

    return map_arrow(rows, run, f"{rows._jdf.schema().toDDL()}, score double")


def score(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (score >= 0.5) of every row."""
    return _rated(_read(docs), *_packed(weights), bias)


def _read(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), (fold(doc_id, FOLDS) == HELD_OUT).alias("held_out"),
                       F.col("text").cast("string").alias("text"))


def _rated(rows: DataFrame, every: pa.Array, weights: np.ndarray, bias: float) -> DataFrame:
    return _scored(rows, every, weights, bias).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = _scored(docs.select(row, F.col("text").cast("string").alias("text")), *_fit(docs, labels))
    return rows.filter(F.col("score") < THRESHOLD).select(
        *[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows, score every row of ``docs``.

    Null and empty texts get the score of a document without features;
    repeated rows get the same score; an empty table gives no rows.
    """
    return _rated(_read(docs), *_fit(docs, labels))
