import random
import re
from itertools import permutations

import numpy as np
from helpers import CLASH, docs, odd_rows, prose, sentence

from claimlens.llm import filter_audit as A

LABELS = "doc_id long, quality long, toxic long"


def fails(rows):
    """The filters that each (doc_id, text) row fails, by reading the rules one row at a time."""
    out = []
    for i, text in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(w) < 100) + "B" * (100 * len(set(w)) < 80 * len(w))
        f += "C" * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        f += "E" * (i is not None and any(j is not None and j < i and (u or "") == t for j, u in rows))
        out.append(f)
    return out


def plain(rows, langs, labels):
    failed, out = fails(rows), []
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1} - {None} for k in (0, 1))
    for part in {p or "" for p in langs}:
        own = [(r[0], f) for r, f, p in zip(rows, failed, langs) if (p or "") == part]
        shapley, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in own) - len(gone),
                              sum(f == x for _, f in own), sum(d[0] in good for d in gone),
                              sum(d[0] in toxic for d in gone), x))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    rows = odd_rows()
    for i in range(20, 160):
        words = sentence(rng, rng.choice((30, 99, 100, 130))).split()
        if rng.random() < 0.4:
            words = words[:20] * 6
        if rng.random() < 0.3:
            words = [w.upper() if rng.random() < 0.3 else w for w in words]
        if rng.random() < 0.3:
            words[0] += rng.choice("#$%&*|")
        rows.append((i, rng.choice((" ", "\n", "\x0b ", "\xa0")).join(words)))
    rows += [(200 - i, prose("same", 8)) for i in range(20)] + [(None, prose("same", 8)), (15, "É" * 9 + "A"), (16, "É" * 8 + "A")]
    return rows


def test_equals_a_plain_walk(spark):
    rows, rng = corpus(), random.Random(5)
    langs = [rng.choice(("en", "fr", "", None)) for _ in rows]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1))) for i in range(0, 190, 2)] + [(20, 1, 1), (20, 0, 0), (None, 1, 1)]
    table = spark.createDataFrame([(i, t, p, "s", None, "x") for (i, t), p in zip(rows, langs)],
                                  "doc_id long, text string, lang string, source string, n_chars long, mask string")
    got = A.audit_filters(table.repartition(5), spark.createDataFrame(labels, LABELS))
    assert got.columns == [c.split()[0] for c in A.AUDIT.split(", ")]
    assert sorted(map(tuple, got.collect())) == plain(rows, langs, labels)


def test_extra_columns_and_cells(spark):
    rows = corpus()
    cells = A.mask_cells(docs(spark, rows, CLASH), spark.createDataFrame([], LABELS)).collect()
    want = {}
    for f in fails(rows):
        mask = sum(1 << "ABCDE".index(x) for x in f)
        want[mask] = want.get(mask, 0) + 1
    assert {r["mask"]: r["n"] for r in cells} == want
    assert all(r["good"] == r["toxic"] == 0 for r in cells)


def test_states_of_the_walk_are_survivors():
    rng = np.random.default_rng(1)
    masks, counts = np.arange(32), rng.integers(0, 50, (32, 3))
    states = A.gray_states(masks, counts)
    for active in range(32):
        assert (states[active] == counts[masks & active == 0].sum(axis=0)).all()


def test_empty_table(spark):
    assert A.audit_filters(docs(spark, []), spark.createDataFrame([], LABELS)).count() == 0
