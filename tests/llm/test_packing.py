import random
import zlib

import numpy as np
import public_tokenizers
from helpers import CLASH, docs, odd_rows, prose
from tokenizers import Tokenizer

from claimlens.llm import packing as P


def plain_pieces(rows, size=P.SIZE):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [P.END_ID]
        first = len(ids) % size or min(size, len(ids))
        cuts = [0, *range(first, len(ids), size), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check_places(rows, size=P.SIZE):
    at = {}
    for r in rows:
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size
    return len(at)


def test_pieces_and_places(spark):
    rows = [(i, prose(i, 1 + i % 40, 30)) for i in range(300)] + odd_rows()
    got = P.best_fit_pack(docs(spark, rows, CLASH).repartition(6), per_partition=60).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == plain_pieces(rows)
    bins = check_places(got)
    assert bins <= 1.02 * P.lower_bound(np.array([r["length"] for r in got]), P.SIZE) + 1


def test_best_fit_decreasing_is_valid_and_bounded():
    rng = random.Random(2)
    for n in (0, 1, 5, 300):
        lengths = np.array([rng.randint(1, 100) for _ in range(n)], np.int64)
        bins, offsets, free = P.best_fit_decreasing(lengths, 100)
        fill = np.bincount(bins, lengths, len(free)) if n else np.zeros(0)
        assert (fill + free == 100).all()
        assert len(free) >= P.lower_bound(lengths, 100) >= -(-int(lengths.sum()) // 100)


def test_lower_bound_never_exceeds_the_optimum():
    assert P.lower_bound(np.array([51, 51, 51]), 100) == 3
    assert P.lower_bound(np.array([60, 60, 40, 40]), 100) == 2
    assert P.lower_bound(np.array([34] * 4), 100) == 2
    rng = random.Random(8)
    for _ in range(50):  # items cut from full bins: the optimum is known
        items, bins = [], rng.randint(1, 6)
        for _ in range(bins):
            left = 100
            while left:
                x = rng.randint(1, left)
                items.append(x)
                left -= x
        assert P.lower_bound(np.array(items), 100) == bins


def test_exchange_saves_bins(spark):
    # Partitions of 0.6 and of 0.4 of a sequence fit together only after an exchange.
    table = docs(spark, [(i, prose(i, 1, 30)) for i in range(400)])
    split = P.best_fit_pack(table, size=128, per_partition=20).select("sequence_id").distinct().count()
    alone = P.best_fit_pack(table, size=128, per_partition=10 ** 6).select("sequence_id").distinct().count()
    assert split <= 1.03 * alone + 1


def test_fast_encoder_gives_the_same_ids():
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in [t or "" for _, t in odd_rows()] + [" " * 5000 + "x", "a\r\n\r\n b c  d", "'s't 12345 ---- ñandú"]:
        assert P.encode(text) == exact.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert P.best_fit_pack(docs(spark, [])).count() == 0
