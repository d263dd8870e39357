import random

import numpy as np
from helpers import CLASH, WORDS, docs, odd_rows, prose, words

from claimlens.llm import near_dedup as N


def aligned(a, b):
    """Longest common subsequence of the 5-word windows, by full dynamic programming."""
    x, y = ([tuple(w[i:i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)] for w in (a, b))
    row = [0] * (len(y) + 1)
    for p in x:
        new = [0]
        for j, q in enumerate(y):
            new.append(row[j] + 1 if p == q else max(new[-1], row[j + 1]))
        row = new
    return row[-1] / (len(x) + len(y) - row[-1]) if x and y else 0.0


def plain_classes(rows):
    """Connected components over all pairs."""
    keyed = [(i, tuple(words(t))) for i, t in rows]
    root = list(range(len(keyed)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(keyed):
        for j in range(i):
            b = keyed[j][1]
            if a and b and (a == b or aligned(a, b) >= N.SIMILARITY):
                root[find(i)] = find(j)
    out = {}
    for i, (_, w) in enumerate(keyed):
        out.setdefault(find(i), []).append(i)
    return [sorted([keyed[i][0] for i in g], key=str) for g in out.values()]


def edited(text, rng, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS) + rng.choice("xyz")
    return " ".join(w)


def corpus():
    rng = random.Random(3)
    rows = [(i, prose(i, 3, 20)) for i in range(40)]
    for i in range(60):
        rows.append((100 + i, edited(prose(i % 10, 3, 20), rng, i % 4)))
    rows += [(300 + i, prose(3, 3, 20)) for i in range(5)]
    rows += [(400, "tiny text"), (401, "Tiny, text!"), (402, "tiny other")]
    return rows


def classes(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["class_id"], []).append(r["doc_id"])
    return sorted(sorted(v, key=str) for v in out.values())


def test_matches_all_pairs(spark):
    rows = corpus()
    assert classes(N.near_duplicates(docs(spark, rows).repartition(5))) == sorted(plain_classes(rows))


def test_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(4)
    base = prose("base", 10, 30)
    rows = [(i, edited(base, rng, 2)) for i in range(400)] + [(1000 + i, prose(i)) for i in range(20)]
    out = N.near_duplicates(docs(spark, rows))
    assert out.filter("doc_id < 1000").select("class_id").distinct().count() == 1
    assert out.filter("doc_id >= 1000 and class_size > 1").count() == 0


def test_banded_alignment_equals_full_alignment():
    rng = random.Random(6)
    for k in range(60):
        a = [rng.choice(WORDS[:12]) for _ in range(rng.randint(1, 60))]
        b = a[:]
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randint(0, 1)] = [rng.choice(WORDS) for _ in range(rng.randint(0, 2))]
        if not b:
            continue
        reader = N.word_hashes
        # Occurrence labels tell repeated windows apart, so they can only be stricter.
        got = N.aligned_similarity(*(N.kmers(reader(" ".join(x))) for x in (a, b)))
        full = aligned(a, b)
        assert got == 0.0 or got <= full + 1e-12
        if full >= N.SIMILARITY and len(set(zip(a, a[1:], a[2:], a[3:], a[4:]))) == max(0, len(a) - 4):
            assert abs(got - full) < 1e-12


def test_moved_blocks_are_no_near_copies():
    reader = N.word_hashes
    one, two = prose("one", 5, 20), prose("two", 5, 20)
    a, b = (N.kmers(reader(t)) for t in (one + " " + two, two + " " + one))
    assert len(np.intersect1d(a, b)) / len(np.union1d(a, b)) > 0.9
    assert N.aligned_similarity(a, b) < N.SIMILARITY


def test_odd_rows(spark):
    out = N.near_duplicates(docs(spark, odd_rows(), CLASH))
    rows = {}
    for r in out.collect():
        rows.setdefault(r["doc_id"], []).append(r)
    assert out.count() == len(odd_rows())
    assert rows[1][0]["class_id"] == rows[5][0]["class_id"] == 1 and rows[1][0]["class_size"] == 3
    assert rows[3][0]["class_id"] == 3 and rows[3][0]["class_size"] == 1


def test_stage_keeps_one_row_of_each_class(spark):
    table = docs(spark, odd_rows(), CLASH)
    kept = N.drop_near_copies(table)
    assert kept.columns == table.columns
    ids = sorted([r["doc_id"] for r in kept.collect()], key=lambda x: (x is None, x or 0))
    assert ids == [1, 2, 3, 4, 6, 7, 8, 9, 10, 10, 11, None, None]
    rows = corpus()
    kept = {r["doc_id"] for r in N.drop_near_copies(docs(spark, rows)).collect()}
    assert kept == {min(g) for g in plain_classes(rows)}


def test_empty_table(spark):
    assert N.near_duplicates(docs(spark, [])).count() == 0
    assert N.drop_near_copies(docs(spark, [])).count() == 0


def test_pairs_in_a_large_group_of_one_template(spark):
    # Documents of a template are 0.73 alike, and links only a few pairs of 0.8 and more.
    rng = random.Random(12)
    template = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(200)]

    def filled(fields):
        w = template[:]
        for at, word in fields.items():
            w[at] = word
        return w

    def fields(doc, n):
        return {at: f"own{doc}x{at}" for at in rng.sample(range(6, 194, 6), n)}

    texts = []
    for doc in range(1200):
        own = fields(doc, 3)
        texts.append(filled(own))
        if doc % 40 == 0:  # one field in common, two others
            first = min(own)
            texts.append(filled({**fields(5000 + doc, 2), first: own[first]}))
    grams = {}
    seen = np.zeros((len(texts), 40_000), np.float32)
    for i, w in enumerate(texts):
        for k in range(len(w) - 4):
            seen[i, grams.setdefault(tuple(w[k:k + 5]), len(grams))] = 1
    common = seen @ seen.T
    links = np.argwhere(np.triu(common / (2 * 196 - common) >= N.SIMILARITY, 1))
    root = list(range(len(texts)))
    for i, j in links.tolist():
        a, b = root[i], root[j]
        root = [min(a, b) if x in (a, b) else x for x in root]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(spark, [(i, " ".join(w)) for i, w in enumerate(texts)])).collect()}
    assert len(links) >= 15 and [got[i] for i in range(len(texts))] == root


def test_orders_of_a_bucket_decide_nothing(spark, monkeypatch):
    # As if no order brought any similar members together.
    neighbours = N._neighbours
    monkeypatch.setattr(N, "_neighbours", lambda *a: neighbours(*a).filter("false"))
    rows = corpus()
    assert classes(N.near_duplicates(docs(spark, rows))) == sorted(plain_classes(rows))


def test_no_link_in_a_large_group_is_left_to_chance(spark, monkeypatch):
    # With hardly a centre or neighbour, and blocks of a few texts, all links of one template's texts are found.
    for name, value in (("CENTRES", 0), ("NEXT", 0), ("ROUNDS", 1), ("BLOCK", 64), ("REACH", 0), ("FEW", 4)):
        monkeypatch.setattr(N, name, value, raising=False)
    rng = random.Random(5)
    template = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(200)]
    rows = []
    for doc in range(300):
        w = template[:]
        # Every tenth differs from the one before in the same four places, and shares only the template with it.
        places = places if doc % 10 == 9 else rng.sample(range(6, 194, 6), 4)
        for at in places:
            w[at] = f"own{doc}x{at}"
        rows.append((doc, " ".join(w)))
    seen = [set(zip(w, w[1:], w[2:], w[3:], w[4:])) for w in (words(t) for _, t in rows)]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(seen[i] & seen[j]) >= N.SIMILARITY * len(seen[i] | seen[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    got = {r["doc_id"]: r["class_id"] for r in N.near_duplicates(docs(spark, rows)).collect()}
    assert 30 < len(set(root)) < 290 and [got[i] for i, _ in rows] == root


def test_rounds_end_when_little_is_left(spark, monkeypatch):
    """No round of pairing follows one that leaves nothing to compare; the classes are those of all rounds."""
    rounds = []
    plain = N._across
    monkeypatch.setattr(N, "_across", lambda holders, roots, turn, least: rounds.append(turn) or plain(holders, roots, turn, least))
    rows = corpus()
    assert classes(N.near_duplicates(docs(spark, rows))) == sorted(plain_classes(rows))
    assert rounds == [0]


def test_components_of_small_graphs_take_one_turn(spark, monkeypatch):
    """Chains, rings and stars, links either way: solved in the tasks that read them, and known to be so at once."""
    turns = []
    plain = N.stored
    monkeypatch.setattr(N, "stored", lambda df, name: turns.append(name) or plain(df, name))
    pairs = [(i, i + 1) for i in range(40)] + [(101, 100), (102, 101), (100, 102)] + [(209, i) for i in range(200, 209)]
    links = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary").coalesce(1)
    got = {(bytes(r.key)[0], bytes(r.root)[0]) for r in N.components(links).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(101, 100), (102, 100)} | {(i, 200) for i in range(201, 210)}
    assert turns == ["links"]
    monkeypatch.setattr(N, "NODES", 2)  # and where the tasks solve next to nothing
    apart = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in pairs], "a binary, b binary").repartition(8)
    assert {(bytes(r.key)[0], bytes(r.root)[0]) for r in N.components(apart).collect()} == got


def test_large_groups_are_sorted_only_where_many_are_outside_the_largest_class(spark, monkeypatch):
    """What few hold is paired once; what one class holds nearly all of is paired by centres and left to _rest."""
    monkeypatch.setattr(N, "CENTRES", 0)
    key = lambda i: bytes([i])
    few, main, alone = [key(i) for i in range(200, 203)], [key(i) for i in range(50)], [key(i) for i in range(50, 60)]
    schema = "mer long, key binary, m int, at int, small boolean, own int, next long"
    holders = spark.createDataFrame([(mer, bytearray(k), 100, 0, True, i, i) for mer, keys in ((1, few), (2, main + alone))
                                     for i, k in enumerate(keys)], schema).repartition(5)
    roots = spark.createDataFrame([(bytearray(k), bytearray(main[0])) for k in main[1:]], "key binary, root binary")

    def across(holders, turn):
        pairs, left = N._across(holders, roots, turn, N.SIMILARITY)
        return {(bytes(r.a), bytes(r.b)) for r in pairs.collect()}, left

    all_few = {(a, b) for a in few for b in few if a < b}
    centre = {(main[0], k) for k in alone}
    pairs, left = across(holders, 0)
    assert pairs == all_few | centre
    assert {bytes(r.key) for r in left.select("key").collect()} == set(main + alone)
    assert across(left, 1)[0] == centre
    monkeypatch.setattr(N, "PER_HOLDER", len(alone) - 1)  # one more than _rest may meet for each holder
    pairs, _ = across(holders, 0)
    assert all_few | centre < pairs and {(a, b) for a, b in zip(alone, alone[1:])} < pairs
