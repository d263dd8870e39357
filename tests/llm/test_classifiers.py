import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import CLASH, docs, odd_rows, prose

from claimlens.llm import quality as Q
from claimlens.llm import toxicity as T

INSULTS = ["grobnak", "zwiltor", "fnargle", "skrimpot"]


def labelled(spark, n=600):
    """Texts, some with insults (with endings of their own), some of capitals and marks."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(n):
        w = prose(i, 1 + i % 7, 15).split()
        toxic, bad = i % 6 == 0, i % 5 == 1 and i % 6 != 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(INSULTS) + rng.choice(["", "a", "en"]))
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for x in w[:9] for _ in range(12)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), int(toxic)))
    return rows, spark.createDataFrame(labels + [(None, 1, 1), (3, None, None), (10 ** 6, 1, 0)],
                                       "doc_id long, quality int, toxic int"), {i: (q, t) for i, q, t in labels}


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_held_out_accuracy(spark, which):
    rows, labels, truth = labelled(spark)
    run = T.score_toxicity if which == "toxic" else Q.score_quality
    got = {r["doc_id"]: r for r in run(docs(spark, rows), labels).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"]} == set(held) and len(held) > 80
    right = sum(got[i]["predicted"] == truth[i][which == "toxic"] for i in held)
    assert right >= 0.97 * len(held)
    least = 0.5 if which == "toxic" else 0.3
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= least) for r in got.values())


@pytest.mark.parametrize("run", [T.score_toxicity, Q.score_quality])
def test_held_out_labels_and_other_columns_are_not_read(spark, run):
    rows, labels, _ = labelled(spark, 200)
    order = lambda df: sorted((tuple(r) for r in df.collect()))
    changed = labels.selectExpr("doc_id", *[f"if(pmod(crc32(cast(doc_id as string)), 5) = 0, 1 - {c}, {c}) as {c}"
                                            for c in ("quality", "toxic")])
    plain = order(run(docs(spark, rows), labels))
    assert plain == order(run(docs(spark, rows).selectExpr("doc_id", "text", "'x' lang", "'y' source"), changed))


@pytest.mark.parametrize("run", [T.score_toxicity, Q.score_quality])
def test_odd_rows_no_labels_and_empty_table(spark, run):
    _, labels, _ = labelled(spark, 200)
    table = docs(spark, odd_rows(), CLASH)
    got = run(table, labels).collect()
    assert len(got) == len(odd_rows()) and all(r["score"] is not None for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (2, 3, 4)}) == 1
    assert run(table, labels.limit(0)).count() == len(odd_rows())
    assert run(docs(spark, []), labels).count() == 0


def test_score_is_the_linear_model_over_distinct_words(spark):
    weights, bias = {" kab": 1.5, "ban ": -0.25, "o": 0.125}, -0.5
    got = T.score(docs(spark, [(1, "Kaban o kaban zo")]), {k: v for k, v in weights.items()}, bias).first()["score"]
    total = bias + sum(sum(weights.get(g, 0) for g in T.grams(w)) for w in {"kaban", "o", "zo"})
    assert got == pytest.approx(1 / (1 + 2.718281828459045 ** -total))


def test_toxic_stage_keeps_clean_rows_with_all_columns(spark):
    rows, labels, truth = labelled(spark)
    table = docs(spark, rows + [(None, None)], CLASH)
    kept = T.keep_clean(table, labels)
    assert kept.columns == table.columns and kept.dtypes == table.dtypes
    ids = {r["doc_id"] for r in kept.collect()}
    clean = {i for i, (_, t) in truth.items() if not t}
    assert None in ids and len(clean - ids) <= 2 and len(ids - clean - {None}) <= 3


def test_vote_is_the_weighted_share_of_the_nearest():
    import numpy as np
    rng = np.random.default_rng(0)
    sims, y = rng.random((20, 60)).round(2), rng.integers(0, 2, 60)
    got = Q.vote(sims, y, 0.5)
    for row, g in zip(sims, got):
        best = sorted(range(60), key=lambda j: (-row[j], j))[:Q.K]
        weight = [row[j] ** Q.POWER for j in best]
        assert g == pytest.approx(sum(w * y[j] for w, j in zip(weight, best)) / sum(weight))


@pytest.mark.parametrize("run", [T.score_toxicity, Q.score_quality])
def test_of_several_texts_of_one_id_the_smallest_is_learnt_from(spark, run):
    rows, labels, _ = labelled(spark, 200)
    again = [(i, t) for i, t in rows if i % 2] + [(i, "zz " + prose(900 + i)) for i, _ in rows] + [(1, None)]
    score = lambda found: {r["doc_id"]: r["score"] for r in run(found, labels).filter("doc_id % 2 = 0").collect()}
    one = [(i, t) for i, t in rows if i % 2] + [(i, "zz " + prose(900 + i)) for i, _ in rows if i % 2 == 0]
    wanted = score(docs(spark, one))
    for order in (again, again[::-1]):
        assert score(docs(spark, order).repartition(3)) == pytest.approx(wanted, abs=1e-5)


def plain_toxicity(rows, labels):
    """Scores of the whole query: counts in dictionaries, and the regression's optimum by plain gradient steps."""
    import numpy as np
    train = [(y, T.words_of(t or "")) for i, t in rows for y in [labels.get(i)]
             if y is not None and zlib.crc32(str(i).encode()) % 5]
    counts = [{}, {}]
    for y, ws in train:
        for w in ws:
            for g in T.grams(w):
                counts[y][g] = counts[y].get(g, 0) + 1
    every = sorted(counts[0].keys() | counts[1].keys())
    c = np.array([[k.get(g, 0) for g in every] for k in counts], float) + T.ALPHA
    ratio = np.log(c[1] / c[0]) - np.log(c[1].sum() / c[0].sum())
    kept = np.flatnonzero((c.sum(axis=0) - 2 * T.ALPHA >= T.MIN_COUNT) & (ratio > 0))
    at = {every[i]: n for n, i in enumerate(kept)}

    def vector(ws):
        x = np.zeros(len(at))
        for w in ws:
            for g in T.grams(w):
                if g in at:
                    x[at[g]] += ratio[kept[at[g]]]
        return x

    x, y = np.array([vector(ws) for _, ws in train]), np.array([y for y, _ in train], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    # Newton steps in the space of the documents: the optimum is a combination of their vectors.
    gram, a, b = x @ x.T, np.zeros(len(y)), 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-(gram @ a + b)))
        h = weight * p * (1 - p)
        left = np.block([[h[:, None] * gram + 1e-4 * np.eye(len(y)), h[:, None]], [(h @ gram)[None], np.array([[h.sum()]])]])
        right = np.append(-(weight * (p - y) + 1e-4 * a), -(weight @ (p - y)))
        step = np.linalg.lstsq(left, right, rcond=None)[0]
        scale = min(1.0, 2.0 / max(1e-12, np.abs(gram @ step[:-1] + step[-1]).max()))
        a, b = a + scale * step[:-1], b + scale * step[-1]
    w = x.T @ a
    return {i: 1 / (1 + np.exp(-(vector(T.words_of(t or "")) @ w + b))) for i, t in rows}


def test_toxicity_matches_a_plain_version_of_the_whole_query(spark):
    rows, labels, truth = labelled(spark, 240)
    rows += [(1000, None), (1001, ""), (1002, "grobnak"), (1003, "fnargleen fnargle")]
    known = {i: t for i, (_, t) in truth.items()} | {3: int(truth[3][1])}
    got = {r["doc_id"]: r["score"] for r in T.score_toxicity(docs(spark, rows).repartition(4), labels).collect()}
    expected = plain_toxicity(rows, known)
    assert got.keys() == expected.keys()
    assert max(abs(got[i] - expected[i]) for i in got) < 0.01
    assert got[1000] == got[1001] < min(got[1002], got[1003])


def test_a_word_of_a_million_characters_and_rare_insults(spark):
    weights = {" zw": 2.0, "zwi": 1.0}
    rows = [(1, "zwi" * 400_000), (2, "zwiltor")]
    got = {r["doc_id"]: r["score"] for r in T.score(docs(spark, rows), weights, -1.0).collect()}
    assert got[1] == got[2] == pytest.approx(1 / (1 + 2.718281828459045 ** -2.0))


def test_toxicity_model_and_features_stay_packed_on_the_driver(spark):
    rows = [(i, f"{'zorg' if i % 2 else 'mild'} {prose(i, 1, 6)}") for i in range(60)] + [(60, "")]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    grams, weights, bias = T._fit(docs(spark, rows), labels)
    as_dict, same = T.train(docs(spark, rows), labels)
    assert isinstance(grams, pa.Array) and isinstance(weights, np.ndarray) and bias == same
    assert as_dict and as_dict == {g: w for g, w in zip(grams.to_pylist(), weights) if w}
    packed = pa.chunked_array([pa.array([np.array(x, "<i4").tobytes() for x in part], pa.binary()) for part in ([[1, 2], []], [[], [3]])])
    numbers, sizes = T._numbers(packed.slice(1))
    assert numbers.tolist() == [3] and sizes.tolist() == [0, 0, 1]
