"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document is its lower-cased words. Its k-mers are windows of ``K`` words,
labelled with their occurrence number, so repeated ones stay distinct. For
each of ``SAMPLES`` hash functions the ``TAKE`` smallest k-mers are taken and
kept in text order: two documents share a sample if they share these k-mers
in the same order, which makes the sketch sensitive to edit similarity.

1. Equal word sequences are one class at once (grouped by a 128-bit hash of
   the words' hashes, with map-side combining); only one representative of each goes on.
2. Documents that share a sample are a bucket. Its members are sorted by
   the rest of their sketch and each is paired with the next: linear in the
   members. Every sample sorts its own way, so a document meets many others,
   and all of a small group. Where the members of a bucket are still in
   several classes, they are sorted some other ways and paired across the
   classes; then the members of buckets that are open even so are paired by
   their rarest k-mers: all of those that few hold, and a number linear in the
   holders of the others, see ``_across``. What classes are left among the holders
   of a k-mer is then compared in whole, see ``_rest``: no pair that shares a
   sample is left out.
3. A candidate pair is verified by aligning the k-mer sequences: common k-mers
   within the band, as a longest increasing chain, must be ``SIMILARITY`` of
   all. The band loses nothing, see ``aligned_similarity``.
4. Classes are the connected components of the links.

Definitions: null text is empty; documents without words are in no class but
their own; rows of equal doc_id and words are copies like any other. A class
is named by its smallest doc_id.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import (WORD, bitmap, hold, importable, in_bitmap, map_arrow, map_groups, maybe_in, stored, text_md5,
                                  texts)

K = 5
SIMILARITY = 0.8
SAMPLES = 16
TAKE = 2
LEAST_AGREEING = 3  # of the samples, for pairs tried early; a pair of similarity 0.8 shares fewer once in some 30,000
TURNS = 1           # further orders of a bucket that are tried, and
REACH = 2           # how far apart members of an open bucket are paired; _across finds what these leave
RANKS = 1 << 22     # slots of the k-mers' frequencies, whatever the data (8 MB)
FEW = 32            # holders of a k-mer that are all paired with each other, and
CENTRES = 6         # of the holders of others that all of them meet, and
ROUNDS = 4          # of pairing across classes at most, with other centres and orders; a fifth finds next to nothing
PER_HOLDER = 128    # pairs a holder that _rest may look at without further rounds
NEXT = 12           # how far apart those of others are paired, in each order; _rest finds what these leave
BLOCK = 2048        # holders of a k-mer that meet as many others at a time, and
CELLS_AT_ONCE = 1 << 17  # pairs of them that are looked at in one step
NODES = 1 << 17     # of a graph that a task solves at a time
PARITY = 1024       # bits of a text's parity signature
CELLS = 1 << 17     # k-mers times samples that are hashed at once
CACHE_WORDS = 150_000
_MULT = np.uint64(0x9E3779B97F4A7C15)
_LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)
_SEEDS = np.array([xxhash.xxh3_64_intdigest(f"sample {i}") | 1 for i in range(SAMPLES)], np.uint64)


_KNOWN: dict[str, int] = {}  # of this worker


def word_hashes(text: str) -> np.ndarray:
    """The lower-cased words of a text as 32-bit hashes; a worker hashes each word once."""
    words = WORD.findall(text.lower())
    if not _KNOWN:
        hold(__name__, _KNOWN.clear)
    if len(_KNOWN) > CACHE_WORDS:
        _KNOWN.clear()
    try:
        return np.fromiter(map(_KNOWN.__getitem__, words), np.uint32, len(words))
    except KeyError:
        for w in set(words):
            if w not in _KNOWN:
                _KNOWN[w] = xxhash.xxh32_intdigest(w)
        return np.fromiter(map(_KNOWN.__getitem__, words), np.uint32, len(words))


def text_key(words: np.ndarray) -> bytes:
    """What equal word sequences share."""
    return xxhash.xxh3_128_digest(words.tobytes())


def kmers(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of the windows of K words (of all words, if fewer), with occurrence labels."""
    if not len(words):
        return np.zeros(0, np.uint64)
    w = words.astype(np.uint64)
    k = min(K, len(w))
    n = len(w) - k + 1
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = (h ^ w[i:i + n]) * _MULT
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if same.any():
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        number = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        label = np.empty(n, np.uint64)
        label[order] = number.astype(np.uint64)
        h = h + label * np.uint64(0xD1B54A32D192ED03)
    return h


def sketch(mers: np.ndarray) -> np.ndarray:
    """One 64-bit value per sample: the smallest k-mers in text order, hashed."""
    out = np.arange(SAMPLES, dtype=np.uint64)
    at = np.empty((SAMPLES, min(TAKE, len(mers))), np.int64)
    mixed = mers ^ (mers >> np.uint64(32))
    step = max(1, CELLS // len(mers))
    for a in range(0, SAMPLES, step):
        v = mixed[None, :] * _SEEDS[a:a + step, None]
        v ^= v >> np.uint64(31)
        v *= _MULT
        every = np.arange(len(v))
        for j in range(at.shape[1]):
            at[a:a + step, j] = v.argmin(axis=1)
            v[every, at[a:a + step, j]] = _LARGEST
    at.sort(axis=1)
    for j in range(at.shape[1]):
        out = (out ^ mers[at[:, j]]) * _MULT + np.uint64(0x632BE59B)
        out ^= out >> np.uint64(32)
    return out


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned k-mers over all k-mers of both (0 where it is surely below ``least``).

    The alignment is the longest chain of common k-mers that is increasing in
    both. Band: if the similarity is at least s, at most
    (1 - s) / (1 + s) * (m + n) k-mers are unmatched, and two matched k-mers
    cannot be further apart than that, so others are dropped at once.
    """
    m, n = len(a), len(b)
    if not m or not n or min(m, n) < least * max(m, n):
        return 0.0
    band = int((1 - least) / (1 + least) * (m + n)) + 1
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    j = j[np.argsort(i, kind="stable")]
    if len(j) < least / (1 + least) * (m + n) - 1e-9:
        return 0.0
    if (np.diff(j) > 0).all():
        common = len(j)
    else:
        ends: list[int] = []
        for x in j.tolist():
            p = bisect_left(ends, x)
            ends[p:p + 1] = [x]
        common = len(ends)
    return common / (m + n - common)


def _sketched(docs: DataFrame) -> DataFrame:
    """doc_id, raw (MD5 of the text), key (hash of the words), mers (number of k-mers) and sketch of every row.

    key is null, and mers 0, where a text has no words.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], []]
        for text in texts(batch):
            words = word_hashes(text)
            mers = kmers(words)
            row = (text_key(words), len(mers), sketch(mers).astype("<i8")) if len(mers) else (None, 0, None)
            for column, value in zip(out, row):
                column.append(value)
        kinds = (pa.binary(), pa.int32(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("raw"), *(pa.array(c, k) for c, k in zip(out, kinds))],
            names=["doc_id", "raw", "key", "mers", "sketch"])

    text = F.col("text").cast("string")
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                                 text_md5(text).alias("raw")), run,
                     "doc_id long, raw binary, key binary, mers int, sketch array<long>")


def _words_of(docs: DataFrame, found: DataFrame, wanted: DataFrame) -> DataFrame:
    """key and word hashes of each wanted text.

    ``found`` names one text (raw) for each key; only texts that a bitmap of
    these lets through are split into words and moved.
    """
    texts_of = stored(found.join(wanted, "key").groupBy("key").agg(F.min("raw").alias("raw")), "wanted")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(texts_of.select("raw")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raws = batch.column("raw").to_pylist()
        on = [i for i, r in enumerate(raws) if r is not None and in_bitmap(shared.value, r)]
        words = [word_hashes(batch.column("text")[i].as_py()).tobytes() for i in on]
        return pa.RecordBatch.from_arrays(
            [pa.array([raws[i] for i in on], pa.binary()), pa.array(words, pa.binary())], names=["raw", "words"])

    text = F.col("text").cast("string")
    rows = map_arrow(docs.select(text.alias("text"), text_md5(text).alias("raw")), run, "raw binary, words binary")
    return rows.dropDuplicates(["raw"]).join(texts_of, "raw").select("key", "words")


def _members(reps: DataFrame) -> DataFrame:
    """A row for each sample of each text: its bucket (sample, value) and a byte of every sample."""
    low = F.transform("sketch", lambda x: F.substring(F.hex(F.lit(256) + F.pmod(x, F.lit(256))), -2, 2))
    return reps.select("key", "mers", "sketch", F.unhex(F.array_join(low, "")).alias("sign"),
                       F.posexplode("sketch").alias("sample", "value"))


def _neighbours(members: DataFrame, turn: int, least: float, reach: int, with_class: bool) -> DataFrame:
    """Pairs of members up to ``reach`` apart in their bucket's order: linear in the members.

    A bucket is sorted by further samples, which depend on ``turn``, so that
    similar members come together, and then at random. The rows are
    range-partitioned by bucket and order, so a bucket of any size is spread
    over tasks (a pair across two tasks is left to the other samples and
    turns, and to ``_across``). With classes, only near pairs of different ones whose
    bytes of the samples agree LEAST_AGREEING times at least (of equal samples there are no more;
    ``_across`` and ``_rest`` find the others). ``near``: the lengths allow the similarity.
    """
    def other(k):  # samples that this one's buckets are sorted by, in this turn
        return F.element_at("sketch", (F.col("sample") + F.lit(k * (1 + turn))) % F.lit(SAMPLES) + 1)

    rows = members.select(
        "sample", "value", "key", "mers", "sign", *(["root"] if with_class else []), other(1).alias("next"),
        F.xxhash64(other(2), other(3)).alias("then"), F.xxhash64("key", "sample", F.lit(turn)).alias("last"))

    def run(batches):
        last = None
        for batch in batches:
            rows = batch.to_pandas()
            old = 0 if last is None else len(last)
            if old:
                rows = pd.concat([last, rows], ignore_index=True)
            last = rows.tail(reach)
            sample, value, key, mers = (rows[c].to_numpy() for c in ("sample", "value", "key", "mers"))
            sign = np.frombuffer(b"".join(rows["sign"]), np.uint8).reshape(len(rows), SAMPLES)
            for d in range(1, min(reach, len(rows) - 1) + 1):
                hit = (sample[d:] == sample[:-d]) & (value[d:] == value[:-d]) & (key[d:] != key[:-d])
                if with_class:
                    root = rows["root"].to_numpy()
                    hit &= root[d:] != root[:-d]
                at = np.flatnonzero(hit)
                at = at[at + d >= old]  # pairs within the rows carried over were told before
                if with_class:  # where the buckets are known to be open, only pairs that may be similar
                    low, high = np.minimum(mers[at], mers[at + d]), np.maximum(mers[at], mers[at + d])
                    at = at[(low >= least * high) & ((sign[at] == sign[at + d]).sum(axis=1) >= LEAST_AGREEING)]
                low, high = np.minimum(mers[at], mers[at + d]), np.maximum(mers[at], mers[at + d])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([min(key[i], key[i + d]) for i in at], pa.binary()),
                     pa.array([max(key[i], key[i + d]) for i in at], pa.binary()),
                     pa.array(sample[at].astype(np.int32)), pa.array(value[at].astype(np.int64)),
                     pa.array(low >= least * high)], names=["a", "b", "sample", "value", "near"])

    importable(members.sparkSession)
    order = ["sample", "value", "next", "then", "last"]
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .mapInArrow(run, "a binary, b binary, sample int, value long, near boolean"))


def _verified(pairs: DataFrame, words: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose aligned similarity reaches ``least``."""
    of = lambda x: words.select(F.col("key").alias(x), F.col("words").alias(f"{x}_words"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        good = []
        for aw, bw in zip(batch.column("a_words").to_pylist(), batch.column("b_words").to_pylist()):
            good.append(aligned_similarity(kmers(np.frombuffer(aw, np.uint32)), kmers(np.frombuffer(bw, np.uint32)),
                                           least) >= least)
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())],
                                          names=["a", "b", "good"])

    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "a_words", "b_words")
    return map_arrow(both, run, "a binary, b binary, good boolean").filter("good").select("a", "b")


def _hung(links: DataFrame) -> DataFrame:
    """The links as u and v, those that a task reads solved among themselves: each node hangs to the smallest it is linked with.

    Fewer turns are left to ``components``; a task holds NODES nodes at most.
    """
    def run(batches):
        over: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while over[x] != x:
                over[x] = x = over[over[x]]
            return x

        def told() -> pa.RecordBatch:
            pairs = [(x, r) for x in over if (r := top(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.binary()),
                                               pa.array([r for _, r in pairs], pa.binary())], names=["u", "v"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                over.setdefault(a, a)
                over.setdefault(b, b)
                a, b = top(a), top(b)
                if a != b:
                    over[max(a, b)] = min(a, b)
            if len(over) > NODES:
                yield told()
                over.clear()
        yield told()

    importable(links.sparkSession)
    return links.select("a", "b").mapInArrow(run, "u binary, v binary")


def components(links: DataFrame) -> DataFrame:
    """key and root (the smallest key it is linked with, directly or not), by alternating stars.

    Each turn hangs the larger neighbours of a node, then the smaller ones,
    to the smallest it knows; the result of a turn is stored. When every larger
    node hangs to one that hangs to none, the classes are found. A node with
    very many links is a skewed join key, which adaptive execution splits.
    """
    edges = _hung(links)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter(F.col("v") > F.col("u")).join(lowest, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
                                               .alias("u"), F.col("m").alias("v"))
        edges = stored(small.distinct(), "links")
        ends = edges.select(F.col("u").alias("key"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
            edges.select(F.col("v").alias("key"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        nodes = ends.groupBy("key").agg((F.sum("hangs") + F.max("holds")).alias("n"))
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("root"))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after further links: these tie roots together, so only they are a graph to solve."""
    of = lambda x: roots.select(F.col("key").alias(x), F.col("root").alias(f"{x}_root"))
    tied = stored(links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).filter("a != b"), "ties")
    moves = components(tied).select(F.col("key").alias("root"), F.col("root").alias("to"))
    kept = roots.join(moves, "root", "left").select("key", F.coalesce("to", "root").alias("root"))
    alone = moves.join(roots.select(F.col("key").alias("root")), "root", "left_anti").select(
        F.col("root").alias("key"), F.col("to").alias("root"))
    return stored(kept.unionByName(alone).distinct(), "classes")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()


def _open(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Buckets (sample, value) with members of several classes, and n, how many members."""
    again = members.select("key", "sample", "value").join(roots, "key", "left").withColumn(
        "class", F.xxhash64(F.coalesce("root", "key")))
    return (again.groupBy("sample", "value").agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("lo"),
                                                 F.max("class").alias("hi"))
            .filter("lo != hi").select("sample", "value", "n"))


def _ranks(words: DataFrame) -> np.ndarray:
    """How often the k-mers of each of RANKS hash slots occur (up to 65,535).

    Each batch counts the slots it has, so small tasks are cheap; the sums are packed
    by ranges of slots, so the driver gets RANKS short numbers.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        slots = [_slots(kmers(np.frombuffer(w, np.uint32))) for w in batch.column("words").to_pylist()]
        on, n = np.unique(np.concatenate([np.zeros(0, np.int32), *slots]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(n, pa.int64())], names=["slot", "n"])

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(1 << 12, "<u2")
        out[frame["slot"].to_numpy() & 4095] = np.minimum(frame["n"].to_numpy(), 65_535)
        return pd.DataFrame({"block": [int(key[0])], "packed": [out.tobytes()]})

    found = map_arrow(words.select("words"), run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    blocks = map_groups(found.withColumn("block", F.shiftright("slot", 12)), ["block"], pack, "block int, packed binary")
    out = np.zeros(RANKS, np.uint16)
    for r in blocks.collect():
        out[r["block"] << 12:(r["block"] + 1) << 12] = np.frombuffer(r["packed"], "<u2")
    return out


def _slots(mers: np.ndarray) -> np.ndarray:
    return (mers >> np.uint64(40)).astype(np.int32) & np.int32(RANKS - 1)


def _holders(words: DataFrame, least: float) -> DataFrame:
    """A row for each of the rarest k-mers of each text (key, words), as many as ``_across`` needs.

    Without those that surely no other text has: nothing can be paired by them. mer, key, m (the text's k-mers), at (place of the k-mer
    in the order of rarity), small (whether the text may be the smaller one
    of a pair by this k-mer), own (k-mers that no other text has) and next
    (a hash of the two k-mers that follow in that order).
    """
    shared = words.sparkSession.sparkContext.broadcast(_ranks(words))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts: list[list[np.ndarray]] = [[] for _ in range(6)]
        keys = []
        for key, text in zip(*(batch.column(c).to_pylist() for c in ("key", "words"))):
            mers = kmers(np.frombuffer(text, np.uint32))
            often = shared.value[_slots(mers)]
            mers = mers[np.lexsort((mers, often))]
            m = len(mers)
            n = min(m, m - int(np.ceil(least * m - 1e-9)) + 1)
            after = np.append(mers[1:n + 2], np.zeros(2, np.uint64))
            following = (after[:n] ^ (after[1:n + 1] * _MULT)) * _MULT
            own = int((often == 1).sum())  # the first ones in the order
            row = (mers[:n].view(np.int64), np.full(n, m), np.arange(n),
                   np.arange(n) <= m - np.ceil(2 * least / (1 + least) * m - 1e-9), np.full(n, own), following.view(np.int64))
            for column, values in zip(parts, row):
                column.append(values[own:])
            keys += [key] * max(0, n - own)
        kinds = (np.int64, np.int32, np.int32, bool, np.int32, np.int64)
        mer, m, at, small, own, following = (
            pa.array(np.concatenate([np.zeros(0, k), *x]).astype(k)) for x, k in zip(parts, kinds))
        return pa.RecordBatch.from_arrays([mer, pa.array(keys, pa.binary()), m, at, small, own, following],
                                          names=["mer", "key", "m", "at", "small", "own", "next"])

    return map_arrow(words.select("key", "words"), run,
                     "mer long, key binary, m int, at int, small boolean, own int, next long", 256)


def _fits(x: dict, y: dict, least: float):
    """Whether two holders of a k-mer may be similar (NumPy arrays or Columns by field).

    By their sizes; by the k-mers of both before and after this one, which
    bound how many they have in common; and the smaller's place.
    """
    columns = not isinstance(x["m"], np.ndarray)
    lesser, larger = (F.least, F.greatest) if columns else (np.minimum, np.maximum)
    low, high = lesser(x["m"], y["m"]), larger(x["m"], y["m"])
    common = lesser(x["at"], y["at"]) + lesser(x["m"] - x["at"], y["m"] - y["at"])
    return ((x["class"] != y["class"]) & (low >= least * high - 1e-9)
            & (common >= least / (1 + least) * (low + high) - 1e-6)
            & ((x["small"] & (x["m"] == low)) | (y["small"] & (y["m"] == low))))


def _across(holders: DataFrame, roots: DataFrame, turn: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of different classes that may be similar, and the holders whose k-mers classes share.

    Texts of m and n k-mers with similarity s have s / (1 + s) * (m + n) in
    common: of the larger text's, s * m at least; of the smaller one's,
    2 * s / (1 + s) * n. In any one order of all k-mers, the first
    m - s * m + 1 of the larger and n - 2 * s / (1 + s) * n + 1 of the smaller
    must therefore share one. Rare ones come first, by the frequencies of hash slots.

    The holders of a k-mer that at most FEW texts hold are all paired, in the first turn, so texts
    alike by what few others have are always found. What a large group has
    common would pair all its members; there each holder meets centres of each
    length that may fit, the one with the fewest k-mers of its own (a text that is
    like another by the common part is like that one) and CENTRES drawn by hash anew
    for each k-mer. Where more than PER_HOLDER holders are outside the largest class,
    so that ``_rest`` would look at more than that for each holder, they also meet those next to them
    in two orders: by the k-mers of their own and by the rare k-mers that follow. All is linear in the rows.
    """
    rows, sizes = _sizes(holders, roots)
    held = stored(rows.drop("root").join(sizes.select("mer", "n", (F.col("n") - F.col("main.n")).alias("outside")), "mer"), "holders")
    names = ("class", "m", "at", "small")

    # Centres of each length band (texts of similarity ``least`` are at most ``reach`` bands apart).
    band, reach = F.floor(F.log(1.08, F.col("m"))).cast("int"), int(np.log(1 / least) / np.log(1.08)) + 1
    hot = held.filter(F.col("n") > FEW).withColumn("band", band)
    ranks = [F.struct(F.col("own").cast("long").alias("own"), F.xxhash64("key").alias("any")),
             *(F.struct(F.lit(0).cast("long").alias("own"), F.xxhash64("key", "mer", F.lit(turn), F.lit(i)).alias("any"))
               for i in range(CENTRES))]
    of = F.struct(F.col("key").alias("k"), *(F.col(c).alias(f"{c}_of") for c in names)).alias("of")
    drawn = F.array(*(F.min(F.struct(r.alias("rank"), of)).getField("of") for r in ranks))
    centres = hot.groupBy("mer", "band").agg(F.array_distinct(drawn).alias("z")).select(
        "mer", F.explode(F.sequence(F.col("band") - reach, F.col("band") + reach)).alias("band"), "z").select("mer", "band", F.inline("z"))
    star = hot.join(centres, ["mer", "band"]).filter(
        _fits({c: F.col(c) for c in names}, {c: F.col(f"{c}_of") for c in names}, least)).select(
        F.least("key", "k").alias("a"), F.greatest("key", "k").alias("b"))

    parts = int(holders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["mer", "turn", "o1", "o2"]
    placed = hot.filter(F.col("outside") > PER_HOLDER).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("turn")).select(
        "mer", "turn", F.when(F.col("turn") == 0, F.col("own")).otherwise(F.col("next")).cast("long").alias("o1"),
        F.xxhash64("key", "turn", F.lit(turn)).alias("o2"), "key", *names)
    near = _near(placed.repartitionByRange(parts, *by).sortWithinPartitions(*by, "key"), ["mer", "turn"], NEXT, least)
    if not turn:
        few = held.filter(F.col("n") <= FEW).select("mer", "key", *names)
        near = near.unionByName(_near(few.repartition(parts, "mer").sortWithinPartitions("mer"), ["mer"], FEW - 1, least))
    return near.unionByName(star).distinct(), held.filter(F.col("n") > FEW).drop("class", "n", "outside")


def _near(rows: DataFrame, group: list[str], apart: int, least: float) -> DataFrame:
    """Pairs (a, b) of the holders up to ``apart`` from each other in a group, in the order of the rows, that may be similar."""
    def run(batches):
        last = None
        for batch in batches:
            rows = batch.to_pandas()
            old = 0 if last is None else len(last)
            if old:
                rows = pd.concat([last, rows], ignore_index=True)
            last = rows.tail(apart) if apart else None
            key = rows["key"].to_numpy()
            of = [rows[c].to_numpy() for c in group]
            fields = {c: rows[c].to_numpy() for c in ("class", "m", "at", "small")}
            found = set()
            for d in range(1, min(apart + 1, len(rows))):
                hit = _fits({c: v[:-d] for c, v in fields.items()}, {c: v[d:] for c, v in fields.items()}, least)
                for g in of:
                    hit &= g[d:] == g[:-d]
                at = np.flatnonzero(hit)
                at = at[at + d >= old]  # pairs within the rows carried over were told before
                found.update((min(key[i], key[i + d]), max(key[i], key[i + d])) for i in at)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()),
                                              pa.array([y for _, y in found], pa.binary())], names=["a", "b"])

    importable(rows.sparkSession)
    return rows.mapInArrow(run, "a binary, b binary")


def _parities(words: DataFrame) -> DataFrame:
    """key and parity: for each of PARITY hash slots, whether an odd number of the text's k-mers are in it."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in batch.column("words").to_pylist():
            slots = (kmers(np.frombuffer(text, np.uint32)) >> np.uint64(30)).astype(np.int64) % PARITY
            out.append(np.packbits(np.bincount(slots, minlength=PARITY) & 1).tobytes())
        return pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.binary())], names=["key", "parity"])

    return map_arrow(words.select("key", "words"), run, "key binary, parity binary", 256)


def _sizes(holders: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The holders with their class, and of each k-mer in several classes: n holders and the largest class, main."""
    rows = holders.join(roots, "key", "left").withColumn("class", F.xxhash64(F.coalesce("root", "key")))
    sizes = rows.groupBy("mer", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("mer").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"))
    return rows, sizes.filter(F.col("n") > F.col("main.n"))


def _cells(holders: DataFrame, roots: DataFrame) -> tuple[float, int]:
    """How many pairs ``_rest`` would look at, and how many holders the k-mers concerned have."""
    cells = F.col("n").cast("double") * (F.col("n") - F.col("main.n"))
    cells, n = _sizes(holders, roots)[1].filter(F.col("n") > FEW).agg(F.sum(cells), F.sum("n")).first()
    return cells or 0.0, n or 0


def _rest(holders: DataFrame, words: DataFrame, roots: DataFrame, least: float) -> DataFrame | None:
    """All pairs (a, b) that may be similar of the classes left among the holders of k-mers of more than FEW.

    The holders outside a k-mer's largest class meet all its holders, in blocks of
    BLOCK by BLOCK that are dealt to tasks, so a task's memory is bounded and
    the work on one k-mer is spread; where one class holds nearly all, that is
    linear. A pair is tested by the first k-mer in the order of rarity that it has in common
    (before that it has none, which bounds what it has), and by parities: each k-mer that only one of
    the texts has changes one bit, so the bits that differ are no more than such k-mers, of
    which there are at most (1 - s) / (1 + s) * (m + n). Neither drops a similar pair.
    """
    rows, sizes = _sizes(holders, roots)
    sizes = sizes.filter(F.col("n") > FEW).select(
        "mer", F.col("main.class").alias("main"), F.ceil(F.col("n") / BLOCK).cast("int").alias("chunks"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("blocks"))
    left = stored(rows.join(sizes, "mer").select(
        "mer", "key", "class", "m", "at", "small", (F.col("class") != F.col("main")).alias("out"), "chunks", "blocks"), "left")
    total = left.agg(F.sum(F.col("blocks") + F.when(F.col("out"), F.col("chunks")).otherwise(0))).first()[0]
    if not total:
        return None
    signed = left.join(_parities(words.join(left.select("key").distinct(), "key", "left_semi")), "key")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.col(n)).cast("int")
    place = lambda block, chunk, outer: F.struct(block.alias("block"), chunk.alias("chunk"), F.lit(outer).alias("outer"))
    inner = F.transform(upto("blocks"), lambda b: place(b, own("chunks", 0), False))
    outer = F.when(F.col("out"), F.transform(upto("chunks"), lambda c: place(own("blocks", 1), c, True)))
    empty = F.array().cast("array<struct<block:int,chunk:int,outer:boolean>>")
    placed = signed.select("mer", "key", "class", "m", "at", "small", "out", "parity",
                           F.inline(F.concat(inner, F.coalesce(outer, empty))))
    parts = max(int(holders.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // (8 * BLOCK))

    def run(_: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["mer", "block", "chunk", "outer"], kind="stable")
        key, kind, m, at, small, out, outer = (frame[c].to_numpy() for c in ("key", "class", "m", "at", "small", "out", "outer"))
        parity = np.frombuffer(b"".join(frame["parity"]), np.uint64).reshape(len(frame), -1)
        cell = frame[["mer", "block", "chunk"]].to_numpy()
        edges = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]).any(axis=1), [True])))
        found = set()
        for start, end in zip(edges[:-1], edges[1:]):
            middle = start + int((~outer[start:end]).sum())
            y = np.arange(start, middle)[None, :]
            step = max(1, CELLS_AT_ONCE // max(1, middle - start))
            for a in range(middle, end, step):
                x = np.arange(a, min(end, a + step))[:, None]
                both = m[x] + m[y]
                low = np.minimum(m[x], m[y])
                hit = ((kind[x] != kind[y]) & (low >= least * (both - low) - 1e-9)
                       & (np.minimum(m[x] - at[x], m[y] - at[y]) >= least / (1 + least) * both - 1e-6)
                       & ((small[x] & (m[x] == low)) | (small[y] & (m[y] == low))))
                i, j = np.nonzero(hit)
                i, j = i + a, j + start
                differ = np.bitwise_count(parity[i] ^ parity[j]).sum(axis=1, dtype=np.int64)
                near = differ <= (1 - least) / (1 + least) * (m[i] + m[j]) + 1e-6
                for p, q in zip(i[near], j[near]):
                    found.add((min(key[p], key[q]), max(key[p], key[q])))
        return pd.DataFrame({"a": [x for x, _ in found], "b": [x for _, x in found]})

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("mer", "block", "chunk"), F.lit(parts)))
    return map_groups(dealt, ["part"], run, "a binary, b binary").distinct()


def _classes(docs: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, raw, key) of all documents, and the class of each text.

    Classes: key, root, least_id (smallest doc_id of the text), copies (its rows).
    """
    found = stored(_sketched(docs), "sketched")
    some = found.filter(F.col("key").isNotNull())
    reps = stored(some.groupBy("key").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"),
                                          F.first("mers").alias("mers"), F.first("sketch").alias("sketch")), "texts")
    pairs = stored(_neighbours(_members(reps), 0, least, 1, False), "pairs")
    tried = stored(pairs.filter("near").select("a", "b").distinct(), "tried")
    texts_found = some.select("key", "raw")
    words = stored(_words_of(docs, texts_found, _ends(tried)), "words")
    links = stored(_verified(tried, words, least), "links")
    roots = components(links)

    def with_words(keys: DataFrame) -> DataFrame:
        missing = stored(keys.select("key").join(words.select("key"), "key", "left_anti"), "missing")
        return words if missing.isEmpty() else words.unionByName(stored(_words_of(docs, texts_found, missing), "words"))

    # Buckets with several classes (a pair by itself is done, where it has met).
    met = pairs.groupBy("sample", "value").agg(F.lit(True).alias("met"))
    buckets = stored(_open(_members(reps), roots).join(met, ["sample", "value"], "left")
                     .filter("n > 2 or met is null").select("sample", "value"), "open")
    bucket = F.xxhash64("sample", "value")
    maybe = maybe_in(_members(reps), bucket, buckets.select(bucket.alias("bucket")), "maybe").filter("maybe").drop("maybe")
    members = stored(maybe.join(buckets, ["sample", "value"], "left_semi"), "members")
    rooted = lambda: members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    found_pairs = None
    for t in range(1, 1 + TURNS):
        one = _neighbours(rooted(), t, least, REACH, True)
        found_pairs = one if found_pairs is None else found_pairs.unionByName(one)
    def linked(pairs: DataFrame, known: bool = True) -> bool:
        """Verify what has not been tried, and merge the classes of the links; whether there were any.

        ``known``: the words of all their texts are there.
        """
        nonlocal tried, words, roots
        fresh = stored(pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "fresh")
        if not known:
            words = with_words(_ends(fresh))
        new = stored(_verified(fresh, words, least), "links")
        tried = tried.unionByName(fresh)
        if new.isEmpty():
            return False
        roots = _merged(roots, new)
        return True

    linked(found_pairs, known=False)
    # What is open even so: pairs across classes by rare k-mers.
    still = stored(rooted().join(_open(members, roots), ["sample", "value"], "left_semi").select("key").distinct(), "still")
    words = stored(with_words(still).join(still, "key", "left_semi"), "still-words")  # all that is verified from here on
    holders = stored(_holders(words, least), "rarest")
    before = None
    for turn in range(ROUNDS):
        found_pairs, holders = _across(holders, roots, turn, least)
        more = linked(found_pairs)
        cells, n = _cells(holders, roots)
        if not more or cells <= PER_HOLDER * n or (before is not None and cells > 0.9 * before):
            break  # _rest compares them all, and a further round would not spare it much
        before = cells
    rest = _rest(holders, words, roots, least)
    if rest is not None:
        linked(rest)
    classes = (reps.select("key", "least_id", "copies").join(roots, "key", "left")
               .withColumn("root", F.coalesce("root", "key")))
    return found.select("doc_id", "raw", "key"), classes


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size, text_copies.

    ``class_size`` counts the rows of the class, ``text_copies`` those of
    equal words. Documents without words have class_size and text_copies 1
    and their own doc_id as class. A class_id is null only if all ids of the
    class are. An empty table gives no rows.
    """
    found, classes = _classes(docs, least)
    of_root = classes.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("copies").alias("class_size"))
    by_key = classes.join(of_root, "root").select("key", "class_id", "class_size", F.col("copies").alias("text_copies"))
    return (found.join(by_key, "key", "left")
            .select("doc_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
                    .alias("class_id"),
                    F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
                    F.coalesce("text_copies", F.lit(1)).cast("long").alias("text_copies")))


def drop_near_copies(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class with all its columns, and all rows without words.

    Kept is the row of the smallest doc_id (null ids last; then by the text's
    hash and the row itself). Rows are known by doc_id and the text's MD5, so
    the texts are not read as words again, and only rows that may be in a
    class of several are moved.
    """
    found, classes = _classes(docs, least)
    rooted = found.join(classes.select("key", "root"), "key")
    rank = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("raw").alias("r"))
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.min(rank).alias("best"))
    several = rooted.join(sizes.filter(F.col("rows") > 1), "root").select(
        F.col("doc_id").alias("d_id"), F.col("raw").alias("d_raw"), (rank == F.col("best")).alias("is_best"))
    several = stored(several.groupBy("d_id", "d_raw").agg(F.max("is_best").alias("is_best")), "several")

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = whole.withColumn("raw", text_md5(F.col("row.text")))
    rows = maybe_in(whole, F.col("raw"), several.select("d_raw"), "maybe")
    alone = rows.filter("not maybe").select("row")
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("d_id")) & (F.col("raw") == F.col("d_raw"))
    moved = rows.filter("maybe").join(several, same, "left")
    # The best row may itself repeat: one of its copies stays.
    best = moved.filter("is_best").groupBy("d_id", "d_raw").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    kept = alone.unionByName(moved.filter(F.col("is_best").isNull()).select("row")).unionByName(best)
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
