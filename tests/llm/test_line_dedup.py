import random

from helpers import CLASH, docs, odd_rows, prose, sentence

from claimlens.llm import line_dedup as L


def plain(rows):
    """The same rule over all chunks in one dictionary, by text."""
    seen, out = {}, {}
    places = []
    for i, t in sorted({r for r in rows if r[1]}, key=lambda r: (r[0] is not None, r[0] or 0, __import__("hashlib").md5(r[1].encode()).digest())):
        lines = t.split("\n")
        for a, b in L.chunks(lines):
            body = "\n".join(lines[a:b])
            if L._counts(lines, a, b, body):
                places.append((body, (i, t), a, b))
    gone = {}
    for body, doc, a, b in places:
        if body in seen:
            gone.setdefault(doc, set()).update(range(a, b))
        seen.setdefault(body, doc)
    for i, t in rows:
        lines = t.split("\n") if t is not None else []
        cut = gone.get((i, t), set())
        out.setdefault(i, []).append(t if not cut else "\n".join(x for k, x in enumerate(lines) if k not in cut))
    return {k: sorted(v, key=str) for k, v in out.items()}


def got(df):
    out = {}
    for r in df.select("doc_id", "text").collect():
        out.setdefault(r["doc_id"], []).append(r["text"])
    return {k: sorted(v, key=str) for k, v in out.items()}


def corpus():
    rng = random.Random(5)
    passage = "\n".join(sentence(rng, 18) for _ in range(12))
    long_line = sentence(rng, 60)
    rows = [(i, "\n".join([prose(i, rng.randint(1, 6)), passage, prose(1000 + i, rng.randint(1, 6))])) for i in range(30)]
    rows += [(100 + i, f"{prose(2000 + i, 2)}\n{long_line}") for i in range(20)]
    rows += [(200, prose(777, 3)), (201, "short line\nshort line")]
    return rows, passage, long_line


def test_matches_plain_version(spark):
    rows, _, _ = corpus()
    assert got(L.dedup_lines(docs(spark, rows).repartition(7))) == plain(rows)


def test_passages_go_from_all_documents_but_one(spark):
    rows, passage, long_line = corpus()
    out = got(L.dedup_lines(docs(spark, rows)))
    assert [i for i in out if long_line in out[i][0]] == [100]
    inner = passage.split("\n")[4:8]  # boundaries inside a passage do not depend on what is around it
    assert sum(all(x in out[i][0] for x in inner) for i in range(30)) == 1
    assert out[200] == [prose(777, 3)]


def test_boundaries_resist_shifts():
    lines = prose("shift", 200, 8).split("\n")
    ends = {(lines[b - 1], lines[b - 2]) for _, b in L.chunks(lines)}
    shifted = {(x[b - 1], x[b - 2]) for x in [["new line"] * 3 + lines] for _, b in L.chunks(x)}
    assert len(ends & shifted) >= 0.95 * len(ends)


def test_a_hash_collision_removes_nothing(spark, monkeypatch):
    # With a constant line, equal hashes and equal bytes: removed; the text is what decides.
    a, b = prose("a", 6), prose("b", 6)
    out = got(L.dedup_lines(docs(spark, [(1, a), (2, b), (3, a)])))
    assert out[1] == [a] and out[2] == [b] and out[3] != [a]


def test_odd_rows_and_clashing_columns(spark):
    rows = odd_rows()
    table = docs(spark, rows, CLASH)
    assert got(L.dedup_lines(table)) == plain(rows)
    kept = L.dedup_lines(table, keep_columns=True)
    assert kept.columns == table.columns and kept.dtypes == table.dtypes
    assert got(kept) == plain(rows)
    assert kept.filter("`a b` != 'own a b'").count() == 0
    assert kept.filter("text is not null and n_chars != length(text)").count() == 0


def test_empty_table(spark):
    assert L.dedup_lines(docs(spark, [])).count() == 0


def test_whole_passages_of_few_lines_go_from_all_copies_but_one(spark):
    # Passages of 2 to 12 lines and over 50 words, each between other neighbours in every document.
    rng = random.Random(11)
    passages = [[sentence(rng, 52 // n + 1 + rng.randint(0, 2)) for _ in range(n)] for n in range(2, 13) for _ in range(8)]
    passages.append(["one two", "", *[sentence(rng, 3) for _ in range(18)], "", "", "the end"])
    rows = [(10 * k + c, "\n".join([prose(f"{k} {c} a", 1 + (k + c) % 3, 9), *p, prose(f"{k} {c} b", 1 + k % 4, 9)]))
            for k, p in enumerate(passages) for c in range(3)]
    out = L.dedup_lines(docs(spark, rows).repartition(5)).collect()
    for r in out:
        p, c = passages[r["doc_id"] // 10], r["doc_id"] % 10
        gone = [x for x in dict(rows)[r["doc_id"]].split("\n") if x not in r["text"].split("\n")]
        assert (gone == [] and r["removed_chunks"] == 0) if c == 0 else (gone == [x for x in p if x in gone])
        assert r["removed_lines"] == (len(p) if c else 0)
        assert not c or not any(x and x in r["text"].split("\n") for x in p)


def test_every_repeated_run_of_lines_is_covered():
    rng = random.Random(3)
    for _ in range(300):
        run = [sentence(rng, rng.choice([1, 2, 3, 9, 12, 60])) if rng.random() < 0.8 else "" for _ in range(rng.randint(2, 9))]
        if sum(len(x.split()) for x in run) < L.MIN_WORDS:
            continue
        around = [sentence(rng, rng.randint(1, 20)) for _ in range(8)]
        found = [(a, b) for a, b in L.chunks(around[:4] + run + around[4:]) if a >= 4 and b <= 4 + len(run)]
        assert {i for a, b in found for i in range(a, b)} == set(range(4, 4 + len(run)))


def test_an_occurrence_that_overlaps_the_first_stays(spark):
    x = prose("x", 1, 20)
    out = got(L.dedup_lines(docs(spark, [(1, "\n".join([x] * 3)), (2, "\n".join([x] * 4)), (3, f"{x}\nother")])))
    assert out == {1: ["\n".join([x] * 3)], 2: [""], 3: [f"{x}\nother"]}


def test_long_runs_of_empty_lines_go_with_their_passage(spark):
    a, b = prose("a", 1, 10), prose("b", 1, 10)
    passage = "\n".join([a, *[""] * 200, b])
    assert got(L.dedup_lines(docs(spark, [(1, passage), (2, f"x\n{passage}\ny"), (3, "\n" * 3000)]))) == {
        1: [passage], 2: ["x\ny"], 3: ["\n" * 3000]}


def test_lines_of_one_hash_but_other_bytes_stay():
    lines = [prose(i, 1, 12) for i in range(6)]
    keys = {(a, b): k for a, b, k in L.keyed_chunks(lines)}
    moved = {(a - 2, b - 2): k for a, b, k in L.keyed_chunks(["one", "two", *lines])}
    assert {k: v for k, v in moved.items() if k in keys} == keys  # a key depends on its own lines alone
    assert len(set(keys.values())) == len(keys)


def test_unlike_lines_are_told(spark, monkeypatch):
    rows = [(1, f"{prose('p', 2)}\n{prose('q', 2)}"), (2, f"{prose('p', 2)}\nother")]
    table = docs(spark, rows)
    every = b"\xff" * (1 << 21)
    assert L._unlike(table, every).count() == 0
    assert L._holding(table, every).select("line").distinct().count() == 5
    unlike = L._holding(table, every).filter(f"hex(line) = '{L.xxhash.xxh3_128_hexdigest(prose('p', 2).split(chr(10))[0]).upper()}'")
    monkeypatch.setattr(L, "_unlike", lambda docs, bits: unlike.select("line").distinct())
    assert got(L.dedup_lines(table)) == {i: [t] for i, t in rows}
