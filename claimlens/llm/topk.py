"""Exact top-k search by inner product with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance to it. Inner
product becomes distance by one more coordinate that makes all vectors equally
long: |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the best products are the nearest
vectors. For a query, the triangle inequality |d(q', p) - d(x', p)| <=
d(q', x') leaves, in each pivot's cell, an annulus around the query's own
distance. Annuli start empty and expand in the order of their bounds until the
bound of everything outside is below the query's k-th best score.

The index is range-partitioned by (pivot, distance, id), so a cell of any
size, even of equal vectors, is spread over parts. Spark deals every query to
every part, behind the part's own rows: a task holds one part, reads the
queries as a stream in blocks of at most ``QUERY_BLOCK`` and returns the part's
best k for each; the best k of these remain. The index is read once however
many queries there are, and none pass through the driver. A threshold from the
pivot sample (its members are candidates, so their k-th best is a lower bound)
lets most parts return little.

Pivots are a bounded sample of ``PIVOTS`` vectors; the index holds every row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import importable, stored

SCALE = 1024
TOP = 10
PIVOTS = 256
QUERY_BLOCK = 2048   # queries that a task answers at once
CHUNK = 256          # queries, and index rows, of one matrix product
SLACK = 1e-6         # relative; bounds are floating-point numbers, scores are exact
LONGEST = 2.0 ** 31  # two vectors shorter than this have 64-bit products
WIDEST = 1.7976931348623157e308  # the largest double
LOW, HIGH = -2 ** 63, 2 ** 63 - 1


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v): whole components floor(scale * x), x as double, kept as doubles (exact at any size).

    Left out: null ids, null vectors and vectors with a null or non-finite
    component. Empty vectors stay and have all products 0. Where scale * x leaves
    the doubles, the component is the largest double of its sign.
    """
    x = F.transform(F.col(vec_col), lambda e: e.cast("double"))
    finite = ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))

    def whole(e: Column) -> Column:  # doubles from 2^52 on have no fraction
        y = F.greatest(F.lit(-WIDEST), F.least(F.lit(WIDEST), F.lit(float(scale)) * e))
        return F.when(F.abs(y) < F.lit(2.0 ** 52), F.floor(y).cast("double")).otherwise(y)

    return (vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(x, whole).alias("v")))


def _matrix(lists: list, width: int) -> np.ndarray:
    """Rows of equal width, shorter vectors filled with zeros, as exact doubles."""
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return out


def products(q: np.ndarray, x: np.ndarray, exact_floats: bool) -> np.ndarray:
    """Integer inner products of whole doubles; those beyond 64 bits become the nearest 64-bit number.

    By floating-point where every partial sum is exact there, else in 64 bits;
    rows of a length of ``LONGEST`` or more in integers of any size.
    """
    if exact_floats:
        return (q @ x.T).astype(np.int64)
    with np.errstate(over="ignore"):
        long_q, long_x = (np.einsum("ij,ij->i", a, a) >= LONGEST ** 2 for a in (q, x))
    out = np.zeros((len(q), len(x)), np.int64)
    out[np.ix_(~long_q, ~long_x)] = q[~long_q].astype(np.int64) @ x[~long_x].T.astype(np.int64)
    for rows, columns in ((long_q, np.ones(len(x), bool)), (~long_q, long_x)):
        if rows.any() and columns.any():
            left, right = (np.array([[int(e) for e in r] for r in a], object).reshape(len(a), -1)
                           for a in (q[rows], x[columns]))
            out[np.ix_(rows, columns)] = np.clip(left @ right.T, LOW, HIGH).astype(np.int64)
    return out


def _lift(x: np.ndarray, longest: float) -> np.ndarray:
    """The further coordinate that gives all vectors the length ``longest``."""
    return np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", x, x), 0.0))


def _distances(x: np.ndarray, lift: np.ndarray, pivots: np.ndarray, pivot_lift: np.ndarray) -> np.ndarray:
    gap = (np.einsum("ij,ij->i", x, x) + lift ** 2)[:, None] + (
        np.einsum("ij,ij->i", pivots, pivots) + pivot_lift ** 2)[None, :]
    gap -= 2 * (x @ pivots.T + lift[:, None] * pivot_lift[None, :])
    return np.sqrt(np.maximum(gap, 0.0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    return np.lexsort((ids, ~scores))[:k]


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
           k: int = TOP, scale: int = SCALE, n_pivots: int = PIVOTS) -> DataFrame:
    """The k best rows for each query row: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on column ``id``. Candidates are all rows but
    those of the query's own id; rows that repeat an id are candidates of
    their own with equal ids, and a query that repeats counts once, by its
    smallest vector. Vectors of different lengths are compared over their
    common components. Ties go to the smaller id. A product beyond 64 bits counts
    as the nearest 64-bit number. A query has fewer rows if there are fewer
    candidates, none without any.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = stored(quantised(vectors, id_col, vec_col, scale), "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)
    about = rows.agg(F.max(F.size("v")).alias("width"), F.max(norm).alias("longest")).first()
    width, longest = int(about["width"] or 0), float(about["longest"] or 0.0)
    exact = longest < 2.0 ** 52
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(n_pivots).collect()  # a bounded sample
    pivots = _matrix([r["v"] for r in sample], width)
    pivot_ids = np.array([r["id"] for r in sample], np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        pivot_lift = _lift(pivots, longest)
    shared = spark.sparkContext.broadcast((pivot_ids, pivots, pivot_lift))
    index = _index(rows, shared, width, longest)
    parts = int(index.agg(F.max("part")).first()[0] or 0) + 1

    queries = rows.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(True).alias("asks"), "id", "v",
        F.lit(None).cast("int").alias("pivot"), F.lit(None).cast("double").alias("distance"))
    dealt = (index.select("part", F.lit(False).alias("asks"), "id", "v", "pivot", "distance").unionByName(asked)
             .repartition(parts, "part").sortWithinPartitions("part", "asks", "pivot", "distance", "id"))
    found = dealt.mapInArrow(_searcher(shared, width, longest, exact, k, QUERY_BLOCK, CHUNK),
                             "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _index(rows: DataFrame, shared, width: int, longest: float) -> DataFrame:
    """Every row with its nearest pivot, its distance and the part it is in, a range of these; stored."""
    spark = rows.sparkSession

    def key(batches):
        _, pivots, pivot_lift = shared.value
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), width)
            with np.errstate(over="ignore", invalid="ignore"):
                d = _distances(x, _lift(x, longest), pivots, pivot_lift)
            near = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(near.astype(np.int32)),
                 pa.array(d[np.arange(len(d)), near])], names=["id", "v", "pivot", "distance"])

    keyed = rows.mapInArrow(key, "id long, v array<double>, pivot int, distance double")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stored(keyed.repartitionByRange(parts, "pivot", "distance", "id")
                  .withColumn("part", F.spark_partition_id()), "index")


def _seed(ids, q, pivot_ids, pivots, exact, k) -> np.ndarray:
    """A lower bound on each query's k-th best score: the k-th best among the pivots."""
    seed = np.full(len(ids), LOW, np.int64)
    if len(pivot_ids) and len(ids):
        s = products(q, pivots, exact)
        for i in range(len(ids)):
            own = s[i][pivot_ids != ids[i]]
            if len(own) >= k:
                seed[i] = np.partition(own, len(own) - k)[len(own) - k]
    return seed


class _Part:
    """One part of the index: its rows by (pivot, distance), cut into annuli of at most ``chunk`` rows."""

    def __init__(self, pieces: list[tuple], chunk: int, width: int):
        none = (np.zeros(0, np.int64), np.zeros((0, width)), np.zeros(0, np.int32), np.zeros(0))
        self.ids, self.x, self.cell, self.distance = (np.concatenate(c) for c in zip(*(pieces or [none])))
        edges = np.flatnonzero(np.diff(self.cell)) + 1
        self.annuli = [(s, min(s + chunk, e)) for a, e in zip([0, *edges], [*edges, len(self.cell)])
                       for s in range(a, e, chunk)]

    def gaps(self, to_pivot: np.ndarray) -> np.ndarray:
        """Each query's least distance to each annulus, as (annulus, query)."""
        out = np.zeros((len(self.annuli), len(to_pivot)))
        for n, (a, e) in enumerate(self.annuli):
            own = to_pivot[:, self.cell[a]]
            out[n] = np.maximum(np.maximum(own - self.distance[a:e].max(), self.distance[a:e].min() - own), 0.0)
        return out


def _searcher(shared, width: int, longest: float, exact: bool, k: int, block: int, chunk: int):
    def answer(part: _Part, ids: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        pivot_ids, pivots, pivot_lift = shared.value
        sizes = np.einsum("ij,ij->i", q, q)
        best_s = [np.zeros(0, np.int64)] * len(ids)
        best_i = [np.zeros(0, np.int64)] * len(ids)
        least = _seed(ids, q, pivot_ids, pivots, exact, k)

        def hopeless(i, d):  # the best score of queries i at distance d or more, with room for rounding, is too low
            bound = (sizes[i] + longest - d * d) / 2 + SLACK * (sizes[i] + longest) + 1
            return np.maximum(bound, float(LOW)) < least[i]  # false where lengths leave the doubles (NaN)

        # From the annulus nearest to the query outwards, all queries a step at a time;
        # a query stops at the first bound below its k-th best, as all later ones are lower.
        gaps = part.gaps(_distances(q, np.zeros(len(q)), pivots, pivot_lift))
        order = np.argsort(gaps, axis=0, kind="stable")
        active = np.arange(len(ids))
        for step in range(len(part.annuli)):
            active = active[~hopeless(active, gaps[order[step, active], active])]
            if not len(active):
                break
            mine = order[step, active]
            for annulus in np.unique(mine).tolist():
                a, e = part.annuli[annulus]
                group = active[mine == annulus]
                scores = products(q[group], part.x[a:e], exact)
                for row, i in enumerate(group.tolist()):
                    hit = np.flatnonzero((scores[row] >= least[i]) & (part.ids[a:e] != ids[i]))
                    if len(hit):
                        s = np.concatenate([best_s[i], scores[row][hit]])
                        v = np.concatenate([best_i[i], part.ids[a:e][hit]])
                        top = _best(s, v, k)
                        best_s[i], best_i[i] = s[top], v[top]
                        if len(top) == k:
                            least[i] = max(least[i], s[top[-1]])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, [len(s) for s in best_s])), pa.array(np.concatenate(best_i)),
             pa.array(np.concatenate(best_s))], names=["query_id", "vec_id", "score"])

    def run(batches):
        number, pieces, part = None, [], None  # the part at hand; complete at its first query
        for batch in batches:
            numbers = batch.column("part").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(numbers) | np.diff(asks)) + 1
            for a, e in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == e:
                    continue
                if numbers[a] != number:
                    number, pieces, part = numbers[a], [], None
                for s in range(a, e, block):
                    rows = batch.slice(s, min(block, e - s))
                    ids = rows.column("id").to_numpy()
                    x = _matrix(rows.column("v").to_pylist(), width)
                    if not asks[a]:
                        pieces.append((ids, x, rows.column("pivot").to_numpy(), rows.column("distance").to_numpy()))
                        continue
                    if part is None:
                        part, pieces = _Part(pieces, chunk, width), []
                    with np.errstate(over="ignore", invalid="ignore"):
                        yield answer(part, ids, x)

    return run
