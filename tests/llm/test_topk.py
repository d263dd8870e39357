import math
import random

from pyspark.sql import functions as F

from claimlens.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, pivot string, distance string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, "a", "b", "c") for i, v in rows], SCHEMA)


def plain(rows, k, every):
    import struct
    single = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    good = [(i, [math.floor(1024 * single(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({(i, tuple(min(v for j, v in good if j == i))) for i, _ in good if i % every == 0}):
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def got(spark, rows, k=10, every=20, **options):
    found = K.search(vectors(spark, rows).repartition(4), F.pmod(F.col("id"), F.lit(every)) == 0, k=k, **options)
    return sorted(tuple(r) for r in found.collect())


def cloud(n, seed=1, dims=8):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(dims)]) for i in range(n)]


def test_matches_all_pairs(spark):
    rows = cloud(700)
    assert got(spark, rows) == plain(rows, 10, 20)


def test_clusters_ties_and_equal_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [round(x, 1) for x in v]) for i, v in cloud(300, 3, 3)]
    rows += [(1000 + i, [0.5, 0.25, -0.5]) for i in range(250)]
    rows += [(2000 + i, [9 + rng.random() / 50, 9.0, 9.0]) for i in range(100)]
    assert got(spark, rows) == plain(rows, 10, 20)


def test_query_blocks_and_few_pivots(spark, monkeypatch):
    monkeypatch.setattr(K, "QUERY_BLOCK", 8)
    monkeypatch.setattr(K, "CHUNK", 16)
    rows = cloud(300, 5)
    assert got(spark, rows, n_pivots=3) == plain(rows, 10, 20)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = cloud(30, 7, 3) + [(40, None), (60, [nan, 1.0, 1.0]), (80, [inf, 0.0, 0.0]), (100, [None, 1.0, 2.0]),
                              (None, [1.0, 1.0, 1.0]), (120, []), (140, [2.0]), (160, [1.0] * 6), (0, [5.0, 5.0, 5.0]),
                              (0, [5.0, 5.0, 5.0]), (180, [0.0, 0.0, 0.0])]
    assert got(spark, rows) == plain(rows, 10, 20)


def test_fewer_candidates_than_asked_and_empty_table(spark):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [0.0, -1.0])]
    assert got(spark, rows) == plain(rows, 10, 20) and len(got(spark, rows)) == 2
    assert got(spark, rows[:1]) == []
    assert got(spark, []) == []


def test_components_of_any_size(spark):
    """Products beyond floating-point and 64 bits: exact, or the nearest 64-bit number."""
    big = [2.0 ** 60, -2.0 ** 60, 3e38, -3e38, 2.0 ** 45, 2.0 ** 30, 2.0 ** 21, 1e-30]
    rows = cloud(60, 11, 3) + [(100 + i, [b, 1.0, -2.0]) for i, b in enumerate(big)]
    rows += [(200 + 20 * i, [b, -b, 3.0]) for i, b in enumerate(big)] + [(400, [2.0 ** 60] * 3), (420, [0.0] * 3)]
    held = [(q, i, max(-2 ** 63, min(2 ** 63 - 1, s))) for q, _, i, s in plain(rows, len(rows), 20)]
    wanted = []
    for query in {q for q, _, _ in held}:
        best = sorted((-s, i) for q, i, s in held if q == query)[:10]
        wanted += [(query, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert got(spark, rows) == sorted(wanted)


def test_doubles_whose_lengths_leave_the_doubles(spark):
    rows = [(0, [1e300, 1.0]), (1, [1.0, 2.0]), (2, [-1e300, 0.0]), (3, [1.7e308, -1e-3]), (20, [0.5, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = K.search(df, F.pmod(F.col("id"), F.lit(20)) == 0, k=2).collect()
    high = 2 ** 63 - 1
    assert sorted(tuple(r) for r in found) == [(0, 1, 1, high), (0, 2, 3, high), (20, 1, 0, high), (20, 2, 3, high)]
