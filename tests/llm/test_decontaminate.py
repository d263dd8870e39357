import random

from helpers import CLASH, WORDS, docs, odd_rows, prose, sentence, words

from claimlens.llm import decontaminate as D


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def plain(rows, items):
    out = set()
    for i, t in rows:
        for k, x in items:
            q, a = D.split_item(x or "")
            if k is not None and (q or a) and D.overlap(q, words(t)) >= D.OVERLAP and D.overlap(a, words(t)) >= D.OVERLAP:
                out.add((i, k))
    return out


def corpus():
    rng = random.Random(9)
    items = [(k, f"{sentence(rng, rng.randint(8, 40))}. {sentence(rng, 9)}.") for k in range(60)]
    items += [(60, f"{sentence(rng, 30)}\n{sentence(rng, 8)}"), (61, sentence(rng, 300)), (62, None), (63, ""), (64, "one")]
    rows = [(i, prose(i, 3 + i % 30, 20)) for i in range(120)]
    for n, (k, x) in enumerate(items[:62]):
        filler = prose(5000 + n, 1 + n % 9, 20)
        rows.append((200 + n, f"{filler}\n{x.upper() if n % 3 == 0 else x}\n{filler}"))
        w = x.split()
        w[len(w) // 3] = "changed"
        rows.append((300 + n, f"{filler} {' '.join(w)} {filler}"))
        rows.append((400 + n, f"{filler} {' '.join(w[:len(w) // 2])}"))
    return rows, items


def test_matches_all_pairs(spark):
    rows, items = corpus()
    got = D.contaminated(docs(spark, rows).repartition(4), bench(spark, items))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == plain(rows, items)
    assert {(200 + n, n) for n in range(62)} <= plain(rows, items)


def test_shards_change_nothing(spark, monkeypatch):
    rows, items = corpus()
    monkeypatch.setattr(D, "SHARD", 20)
    got = D.contaminated(docs(spark, rows), bench(spark, items))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == plain(rows, items)
    left = D.drop_contaminated(docs(spark, rows, CLASH), bench(spark, items))
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in plain(rows, items)}
    assert left.columns == docs(spark, rows, CLASH).columns


def index(items):
    parts = [(k, [w for p in D.split_item(t) for w in p]) for k, t in items]
    df = {}
    for _, w in parts:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    return D.Index(items, df, len(items), sum(len(w) for _, w in parts) / len(items))


def test_block_max_wand_retrieves_all_above_the_threshold(monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 4)
    rng = random.Random(1)
    x = index([(k, sentence(rng, rng.randint(5, 30))) for k in range(150)])
    for threshold in (0.2, 0.35, 0.5):
        for _ in range(40):
            terms = sorted(rng.sample(range(len(x.terms)), rng.randint(1, 60)))
            exact = {}
            for t in terms:
                for item, v in zip(x.items[t].tolist(), x.impacts[t].tolist()):
                    exact[item] = exact.get(item, 0.0) + v
            got = dict(x.search(terms, threshold))
            assert set(got) == {i for i, s in exact.items() if s >= threshold - 1e-9}
            assert all(abs(got[i] - exact[i]) < 1e-9 for i in got)


def test_odd_rows_and_empty_tables(spark):
    rows, items = corpus()
    table = docs(spark, odd_rows(), CLASH)
    assert D.contaminated(table, bench(spark, items)).count() == len(
        [1 for r in odd_rows() for p in plain([r], items)])
    assert D.drop_contaminated(table, bench(spark, [])).count() == len(odd_rows())
    assert D.contaminated(docs(spark, []), bench(spark, items)).count() == 0
    assert D.contaminated(table, bench(spark, [])).count() == 0


def test_decoys_and_distant_answers(spark):
    rng = random.Random(4)
    items = [(k, f"{' '.join(rng.sample(WORDS, 30))}. {' '.join(rng.sample(WORDS, 12))}.") for k in range(20)]
    rows = []
    for k, x in items:
        q, a = x.split(". ")
        mixed = x.replace(".", "").split()
        rng.shuffle(mixed)
        far = prose(k, 40, 20)
        rows += [(100 + k, f"{' '.join(mixed)}\n{far}\n{x}"),              # all words, scattered, before the copy
                 (200 + k, f"{q}. {' '.join(a.split()[:8])}\n{far}\n{x}"),  # a part of the answer only
                 (300 + k, f"{q}\n{far}\n{a}"),                           # the answer at the end
                 (400 + k, f"{' '.join(q.split()[:16])}\n{far}\n{' '.join(q.split()[12:])}\n{far}\n{a}"),
                 (500 + k, f"{' '.join(mixed)}\n{far}")]
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs(spark, rows), bench(spark, items)).collect()}
    assert got == plain(rows, items) == {(n + k, k) for n in (100, 200, 300, 400) for k in range(20)}


def templated():
    """Items with most words in common, and documents that lack the rare part of one."""
    rng = random.Random(8)
    common, ends = rng.sample(WORDS, 24), [f"rare{k}x" for k in range(400)]
    items = [(k, " ".join([*common[:12], ends[2 * k], ends[2 * k + 1]])) for k in range(100)]
    items += [(100 + k, " ".join([*common, *(ends[2 * (100 + k)] + c for c in "abcde")])) for k in range(100)]
    rows = [(k, f"{prose(k, 2)}\n{' '.join(x.split()[:n])}\n{prose(-k, 2)}")
            for k, x in items[::10] for n in ([12] if k < 100 else [24, 23])]
    return rows, items


def test_templated_benchmark(spark):
    rows, items = templated()
    got = [(r["doc_id"], r["item_id"]) for r in D.contaminated(docs(spark, rows), bench(spark, items)).collect()]
    assert set(got) == plain(rows, items) and len(plain(rows, items)) > 1000


def test_an_item_needs_no_more_than_any_choice_of_its_shingles_leaves():
    rng = random.Random(2)
    for _ in range(300):
        q, a = ([rng.choice(WORDS[:30]) for _ in range(rng.randint(1, n))] for n in (24, 12))
        impact = {t: rng.choice([0.1, 1.0, 5.0]) * rng.random() + 1e-3 for t in q + a}
        need = D.least_left((q, a), impact, D.OVERLAP)
        for _ in range(30):
            left = set()
            for part in (q, a):
                grams = sorted(D.shingles(part))
                n = next(n for n in range(len(grams) + 1) if n / len(grams) >= D.OVERLAP)
                drop = rng.randint(0, len(grams) - n)  # the run that is missing, or any
                kept = rng.sample(grams, n) if rng.random() < 0.5 else (grams[:drop] + grams[drop + len(grams) - n:])[:n]
                left |= {t for g in kept for t in g}
            assert need <= sum(impact[t] for t in left) + 1e-9


def test_items_without_an_id_are_known_but_not_named(spark):
    rng = random.Random(21)
    leaked, named, clean = (sentence(rng, 20) for _ in range(3))
    table = docs(spark, [(1, f"{prose(1)} {leaked} {prose(2)}"), (2, f"{prose(3)} {named}"), (3, f"{prose(4)} {clean}")])
    items = bench(spark, [(None, leaked), (None, None), (7, named), (None, named), (None, "")])
    assert [(r["doc_id"], r["item_id"]) for r in D.contaminated(table, items).collect()] == [(2, 7)]
    assert [r["doc_id"] for r in D.drop_contaminated(table, items).collect()] == [3]
