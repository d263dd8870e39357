"""Best-fit packing of tokenized documents, certified by lower bounds.

Every document is tokenized, cut into pieces of at most ``size`` tokens, and
the pieces are packed into as few sequences as possible:

1. Pieces are dealt to partitions by hash; each runs best-fit decreasing.
2. Dual feasible functions give a lower bound on the bins a partition needs.
   A partition whose bin count meets its bound is certified.
3. Space is lost in uncertified partitions and in bins that stay open.
   These partitions give up their open bins; the freed pieces are dealt to fewer
   partitions, which mixes documents of several partitions, and run
   best-fit decreasing again, until one partition is left or nothing is
   gained.

Only lengths travel: the token ids are read once, where the text is.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import hold, map_arrow, map_groups, pick, stored, texts

SIZE = 1024
END_ID = 2
BPE = "byte_bpe_50k"
# Fixed value: the one special token of the vocabulary file.
SPECIAL = "<|endoftext|>"
PER_PARTITION = 4000  # pieces that one best-fit run gets, on average

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, doc_key long")
PLACED = PIECES + ", sequence_id long, offset long, part long, bins int, bound int, free int"


@lru_cache(maxsize=2)
def _encoders(vocabulary: str):
    """The tokenizer by its file, and the same vocabulary as ranks (faster)."""
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    hold(__name__, _encoders.cache_clear)
    exact = Tokenizer.from_file(P.path(f"{vocabulary}.json"))
    with open(P.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    fast = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return exact, fast


def encode(text: str, vocabulary: str = BPE) -> list[int]:
    """Token ids of ``text`` without special tokens added.

    Both encoders hold the same vocabulary and give the same ids; a text that
    spells the special token, or that the fast one refuses, goes to the other.
    """
    exact, fast = _encoders(vocabulary)
    if SPECIAL not in text:
        try:
            return fast.encode_ordinary(text)
        except Exception:  # its regular expression gives up on some very long runs
            pass
    return exact.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = BPE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and a hash to deal by).

    A document is its ids and then ``end_id``; longer ones are cut so that
    only the first piece may be shorter than ``size``. A null text is empty
    (one piece, the end id); rows that repeat are documents of their own.
    """
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, out = batch.column("doc_id").to_pylist(), [[] for _ in range(6)]
        for doc_id, text in zip(ids, texts(batch)):
            tokens = np.array([*encode(text, vocabulary), end_id], dtype="<u4")
            head = len(tokens) % size or min(size, len(tokens))
            key = zlib.crc32(f"{doc_id}".encode())
            starts = [0, *range(head, len(tokens), size)]
            for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(tokens)])):
                for column, value in zip(out, (doc_id, k, a, b - a, zlib.crc32(tokens[a:b].tobytes()), key * 1009 + k)):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "doc_key"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, PIECES)


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the free space of each bin.

    Bins are stacked by free space; a bit mask over the free spaces finds the
    tightest one that still holds the piece.
    """
    order = np.argsort(-lengths, kind="stable")
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    mask, free, bins, offsets = 0, [], np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in order:
        n = int(lengths[i])
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = open_bins[space].pop()
            if not open_bins[space]:
                mask &= ~(1 << space)
        else:
            b, space = len(free), size
            free.append(size)
        bins[i], offsets[i] = b, size - space
        free[b] = left = space - n
        if left:
            open_bins[left].append(b)
            mask |= 1 << left
    return bins, offsets, np.array(free, np.int64)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """Bins that any packing needs, by the best of two families of dual feasible functions.

    A dual feasible function maps lengths so that no full bin exceeds 1;
    the sum of the mapped lengths is then a bound. u_k rounds multiples of
    1/(k+1); f_e counts pieces over size - e whole and drops those under e.
    """
    if not len(lengths):
        return 0
    x = lengths.astype(np.int64)
    best = -(-int(x.sum()) // size)
    for k in range(1, 20):
        whole = (x * (k + 1)) % size == 0
        best = max(best, -(-int(np.where(whole, x * k, (x * (k + 1)) // size * size).sum()) // (k * size)))
    for e in np.unique(x[x <= size // 2])[:: max(1, size // 256)]:
        f = np.where(x > size - e, size, np.where(x >= e, x, 0))
        best = max(best, -(-int(f.sum()) // size))
    return best


def _pack_part(size: int):
    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_key", "doc_id", "start"], kind="stable")
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets, free = best_fit_decreasing(lengths, size)
        part = int(key[0])
        return frame.drop(columns="part").assign(
            sequence_id=bins, offset=offsets, part=part, bins=len(free),
            bound=lower_bound(lengths, size), free=free[bins])
    return pack


def best_fit_pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, vocabulary: str = BPE,
                  per_partition: int = PER_PARTITION) -> DataFrame:
    """Pack all documents; one row per piece with its sequence and place.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    An empty table gives no rows; a null doc_id stays null. Sequence ids are
    unique numbers without meaning.
    """
    spark = docs.sparkSession
    left = stored(pieces(docs, size, end_id, vocabulary), "pieces")
    done, round_no, before, as_before = [], 0, None, None
    while True:
        n = left.count()
        parts = max(1, -(-n // per_partition))
        # The row number deals pieces of one id apart (ids may be null or repeat).
        key = F.pmod(F.xxhash64("doc_key", "start", F.monotonically_increasing_id(), F.lit(round_no)),
                     F.lit(parts)).cast("long")
        placed = stored(map_groups(left.withColumn("part", key), ["part"], _pack_part(size), PLACED),
                        f"packed-{round_no}")
        # A sequence keeps the number of its round and partition for good.
        numbered = placed.withColumn(
            "sequence_id", (F.lit(round_no).cast("long") * F.lit(1 << 56)) + F.col("part") * F.lit(1 << 32)
            + F.col("sequence_id"))
        per_part = placed.groupBy("part").agg(F.first("bins").alias("bins"))
        total = per_part.agg(F.sum("bins")).first()[0] or 0
        if before is not None and total > before:  # worse than it was: that stays
            done.append(as_before)
            break
        if parts == 1 or total == before:
            done.append(numbered)
            break
        # Certified partitions give up nothing but their one bin that is far from full;
        # the others all bins that are not nearly full.
        certified = F.col("bins") <= F.col("bound")
        opened = (certified & (F.col("free") >= size // 4)) | (~certified & (F.col("free") > size // 64))
        done.append(numbered.filter(~opened))
        as_before = numbered.filter(opened)
        left = pick(placed.filter(opened), "doc_id", "piece", "start", "length", "ids_crc32", "doc_key")
        before = as_before.select("sequence_id").distinct().count()
        round_no += 1
        if before == 0:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return pick(out, "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
