import collections
import math
import re
import zlib

import pytest
from helpers import CLASH, docs, odd_rows, prose

from claimlens.llm import lm as M


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


def remainder(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7


def plain(rows):
    """Counts in dictionaries, weights by the same expectation-maximisation over single tokens."""
    texts = [(i, tokens(t)) for i, t in rows]
    uni, bi = {0: collections.Counter(), 1: collections.Counter()}, {0: collections.Counter(), 1: collections.Counter()}
    for i, w in texts:
        for kind, on in ((0, remainder(i) != 2), (1, remainder(i) == 3)):
            if on:
                uni[kind].update(w)
                uni[kind]["<s>"] += 1
                bi[kind].update(zip(["<s>", *w], w))
    n = sum(c for w, c in uni[0].items() if w != "<s>")
    v = len(uni[0]) - (1 if "<s>" in uni[0] else 0)
    n_main = n - sum(c for w, c in uni[1].items() if w != "<s>")

    def klass(c):
        return 0 if c == 0 else min(1 + int(math.log2(c)), M.CLASSES - 1)

    def estimates(u, w, cu, cb, size):
        c = cu(u)
        return klass(c), (cb((u, w)) / max(c, 1), cu(w) / max(size, 1), 1 / (v + 1))

    if not n:
        return [(i, remainder(i) == 2, len(w), 0, 0, 0.0, 0.0) for i, w in texts]
    main = [estimates(u, w, lambda x: uni[0][x] - uni[1][x], lambda x: bi[0][x] - bi[1][x], n_main)
            for i, ws in texts if remainder(i) == 3 for u, w in zip(["<s>", *ws], ws)]
    weights, before = {k: (1 / 3,) * 3 if k else (0.0, 0.5, 0.5) for k in range(M.CLASSES)}, None
    for _ in range(M.STEPS if main else 0):
        mass = {k: [M.PRIOR] * 3 for k in range(M.CLASSES)}
        gain = 0.0
        for k, p in main:
            total = sum(a * b for a, b in zip(weights[k], p))
            gain += math.log(total)
            for j in range(3):
                mass[k][j] += weights[k][j] * p[j] / total
        mass[0][0] = 0.0
        weights = {k: tuple(x / sum(m) for x in m) for k, m in mass.items()}
        if before is not None and (gain - before) / len(main) < M.TOLERANCE:
            break
        before = gain
    out = []
    for i, ws in texts:
        base = sum(math.log10((uni[0][w] + 1) / (n + v + 1)) for w in ws)
        score = 0.0
        for u, w in zip(["<s>", *ws], ws):
            k, p = estimates(u, w, lambda x: uni[0][x], lambda x: bi[0][x], n)
            score += math.log10(sum(a * b for a, b in zip(weights[k], p)))
        out.append((i, remainder(i) == 2, len(ws), sum(uni[0][w] > 0 for w in ws), n, base, score))
    return out


def compare(got, expected):
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6)))
    got, expected = order([tuple(r) for r in got]), order(expected)
    assert len(got) == len(expected)
    for g, e in zip(got, expected):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], rel=1e-9, abs=1e-9) and g[6] == pytest.approx(e[6], rel=1e-6, abs=1e-6)


def test_matches_plain_version(spark):
    rows = [(i, prose(i % 50, 3, 12)) for i in range(120)]
    compare(M.score_texts(docs(spark, rows).repartition(4)).collect(), plain(rows))


def test_many_blocks_and_buckets_change_nothing(spark, monkeypatch):
    rows = [(i, prose(i % 50, 3, 12)) for i in range(120)]
    monkeypatch.setattr(M, "BLOCK_CHARS", 1500)
    monkeypatch.setattr(M, "BUCKET_TOKENS", 300)
    compare(M.score_texts(docs(spark, rows).repartition(3)).collect(), plain(rows))


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows()
    compare(M.score_texts(docs(spark, rows, CLASH)).collect(), plain(rows))


def test_beats_the_base_on_held_out_texts(spark):
    out = M.score_texts(docs(spark, [(i, prose(i % 40, 4, 12)) for i in range(200)]))
    row = out.filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert row["s"] > row["b"]


def test_no_training_text_and_empty_table(spark):
    only = next(i for i in range(100) if remainder(i) == 2)
    r = M.score_texts(docs(spark, [(only, "a b")])).first()
    assert tuple(r) == (only, True, 3, 0, 0, 0.0, 0.0)
    assert M.score_texts(docs(spark, [])).count() == 0
