import base64
import hashlib

import numpy as np
import pytest

from claimlens.llm import warc as W

M = W.MAGIC
EVIL = f"x{M}WARC-Type: response\r\nX-Page-Id: 77\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n{M}tail"
ROWS = [(1, "http://a/x\r\nWARC-Type: fake", "hello"), (2, None, "hello"), (None, "u", "hello"), (4, "é", EVIL),
        (5, "q", EVIL + EVIL), (6, "q", M), (7, "q", ""), (8, "q", None), (9, "q", "\r\n\r\n"), (3, "q", ""),
        (10, "z", f"ü\r\n{M}\r\n\r\n"), (1, "http://a/x", "hello"), (None, "k", "lone"), (11, "q", EVIL),
        (12, "q", "HTTP/1.1 200 OK\r\n\r\nzz"), (13, "q", M * 3), (14, "q", f"end {M[:5]}"), (15, "", "long " * 50_000)]


def plain(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(h or "")
        to = None if to == i else to
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' as value", "'y' as payload", "1 as own", "2 as `same`")


def test_round_trip_with_magic_in_payloads(spark):
    assert got(W.round_trip(pages(spark).repartition(3))) == plain(ROWS)


@pytest.mark.parametrize("split", ["300", "1000"])
def test_files_split_anywhere(spark, split):
    names = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        rows = ROWS[:-1]
        assert got(W.round_trip(pages(spark, rows).coalesce(1))) == plain(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_small_payloads_are_responses(spark):
    assert got(W.round_trip(pages(spark), min_bytes=6)) == plain(ROWS, 6)


def test_one_large_group_of_copies(spark):
    rows = [(i, "u", "same" if i % 3 else f"own {i}") for i in range(1, 900)]
    assert got(W.round_trip(pages(spark, rows).repartition(5))) == plain(rows)


def test_file_is_a_chain_of_standard_records(spark, tmp_path):
    W.write_archives(pages(spark).coalesce(1), f"file://{tmp_path}/out")
    data = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("part-*"))
    at = n = 0
    while at < len(data):
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
        assert rest[size:size + 4] == b"\r\n\r\n"
        at, n = at + len(head) + 4 + size + 4, n + 1
    assert n == len(ROWS)


def test_pointer_jumping_equals_walking():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 17, 200):
        offsets = np.sort(rng.choice(np.arange(1, 5000), n, replace=False)) if n else np.zeros(0, np.int64)
        if n:
            offsets[0] = 0
        step = np.append(offsets[1:], 9999)
        to = np.where(rng.random(n) < 0.8, step, rng.integers(0, 5000, n)) if n else offsets
        to = np.where(to <= offsets, -1, to)
        walked, at = set(), 0
        place = {int(o): int(t) for o, t in zip(offsets, to)}
        while at in place:
            walked.add(at)
            at = place[at]
        assert set(offsets[W.reachable(offsets, to)].tolist()) == walked


def test_empty_table(spark):
    assert W.round_trip(pages(spark).limit(0)).count() == 0
