"""Benchmark decontamination: BM25 over an inverted index of test items.

The index holds the benchmark items; every training document is a query. Its
terms are the words that stand in a run of ``SHINGLE`` words (of a whole part,
where that has fewer) which some item of the index has as well, wherever in
the document they are. A document may hold an item's parts far apart, and
decoys of it: each run counts.

Each item's BM25 score is divided by the score that the whole item would get,
so the normalised score says how much of an item's weight a document's known
runs cover. What a document must reach is an item's own need: the least score
that ``OVERLAP`` of each part's shingles can leave, see ``least_left``. Impacts are
divided by it, so that block-max WAND retrieves every item that reaches 1:
postings are in blocks of items with each block's largest impact; WAND's
pivot and the block maxima skip items that cannot reach it.

Every item that is retrieved is verified once on the words of the whole
document: the question and the answer (the item's last line or sentence, where
it has one) must each have ``OVERLAP`` of their five-word shingles in it.

The benchmark is dealt to shards of at most ``SHARD`` items; one shard's index
at a time is broadcast, so its size is bounded however many items there are.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import WORD, map_arrow, texts

SHINGLE = 5
OVERLAP = 0.8
SHARD = 20_000       # items per broadcast index
BLOCK = 64           # postings per block
K1, B = 1.2, 0.75
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SENTENCE = re.compile(r"[.!?]\s+")


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and the answer: the last line, else the last sentence, is the answer."""
    text = text.strip()
    cut = text.rfind("\n")
    if cut < 0:
        ends = [m.end() for m in _SENTENCE.finditer(text)]
        cut = ends[-1] if ends else len(text)
    return WORD.findall(text[:cut].lower()), WORD.findall(text[cut:].lower())


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    k = min(SHINGLE, len(words))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()


def places(words: list[str], k: int) -> dict[tuple[str, ...], int]:
    """The runs of k words, each with the word at which it first starts."""
    return {tuple(words[i:i + k]): i for i in reversed(range(len(words) - k + 1))}


def overlap(part: list[str], doc_words: list[str]) -> float:
    """Share of the part's shingles that the words hold; 1 for an empty part."""
    wanted = shingles(part)
    if not wanted:
        return 1.0
    return len(wanted & places(doc_words, min(SHINGLE, len(part))).keys()) / len(wanted)


def gram_hashes(terms: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k terms."""
    out = np.zeros(max(0, len(terms) - k + 1), np.uint64)
    for i in range(k):
        out = (out ^ terms[i:i + len(out)].astype(np.uint64)) * _MULT
        out ^= out >> np.uint64(29)
    return out


def least_left(parts: tuple[list[str], list[str]], impact: dict[str, float], least: float) -> float:
    """No more than the impact of the terms that ``least`` of each part's shingles hold, whichever these are.

    A term is missing only if all shingles with it are. So many may be missing,
    each with ``k`` terms at most, which bounds how many terms can go, each
    counted by its shingles; the dearest by this measure go first, the last
    in part. A term of both parts can go only with the question's shingles.
    One of the item's terms is always left.
    """
    gone, seen = 0.0, set()
    for part in parts:
        wanted = shingles(part)
        if not wanted:
            continue
        lost = len(wanted) - math.ceil(least * len(wanted) - 1e-9)
        room = lost * min(SHINGLE, len(part))
        held = Counter(t for g in wanted for t in set(g))
        for t in sorted(held.keys() - seen, key=lambda t: (-impact[t] / held[t], t)):
            if room <= 0:
                break
            if held[t] <= lost:
                gone += impact[t] * min(1.0, room / held[t])
                room -= held[t]
        seen |= held.keys()
    return max(sum(impact.values()) - gone, min(impact.values()))


class Index:
    """Inverted index of one shard, with impacts as shares of each item's need, and block maxima."""

    def __init__(self, items: list[tuple[int, str]], df: dict[str, int], n_items: int, mean_length: float,
                 least: float = OVERLAP):
        self.ids = [i for i, _ in items]
        self.parts = [split_item(t) for _, t in items]
        self.lengths = [len(q) + len(a) for q, a in self.parts]
        self.needs: list[float] = []  # as shares of the whole item's score
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for x, (q, a) in enumerate(self.parts):
            counts = Counter(q + a)
            size = K1 * (1 - B + B * self.lengths[x] / max(mean_length, 1e-9))
            impact = {t: math.log(1 + (n_items - df.get(t, 1) + 0.5) / (df.get(t, 1) + 0.5)) * c * (K1 + 1) / (c + size)
                      for t, c in counts.items()}
            need = least_left((q, a), impact, least)
            self.needs.append(need / sum(impact.values()))
            for t, v in impact.items():
                postings[t].append((x, v / need))
        self.terms = {t: k for k, t in enumerate(sorted(postings))}
        lists = [postings[t] for t in self.terms]
        self.items = [np.array([x for x, _ in p], np.int64) for p in lists]
        self.impacts = [np.array([v for _, v in p]) for p in lists]
        self.block_max = [np.maximum.reduceat(v, np.arange(0, len(v), BLOCK)) for v in self.impacts]
        self.max_impact = np.array([v.max() for v in self.impacts] or [0.0])
        grams: dict[int, list[np.ndarray]] = defaultdict(list)  # of the parts, by their words' number
        for part in (p for both in self.parts for p in both if p):
            k = min(SHINGLE, len(part))
            grams[k].append(gram_hashes(np.array([self.terms[w] for w in part], np.int64), k))
        self.grams = {k: np.unique(np.concatenate(h)) for k, h in grams.items()}

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items with a score of ``threshold`` or more for a query of distinct terms (block-max WAND)."""
        at = dict.fromkeys(terms, 0)
        found = []
        while True:
            live = sorted((t for t in at if at[t] < len(self.items[t])), key=lambda t: self.items[t][at[t]])
            bound, pivot = 0.0, None
            for k, t in enumerate(live):
                bound += self.max_impact[t]
                if bound >= threshold - 1e-9:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = int(self.items[live[pivot]][at[live[pivot]]])
            while pivot + 1 < len(live) and self.items[live[pivot + 1]][at[live[pivot + 1]]] == item:
                pivot += 1
            ahead = live[:pivot + 1]
            blocks = {}
            for t in ahead:  # to the block that may hold the item, without reading on
                p = int(np.searchsorted(self.items[t], item))
                blocks[t] = p
            bound = sum(self.block_max[t][blocks[t] // BLOCK] for t in ahead if blocks[t] < len(self.items[t]))
            if bound >= threshold - 1e-9:
                score = sum(float(self.impacts[t][blocks[t]]) for t in ahead
                            if blocks[t] < len(self.items[t]) and self.items[t][blocks[t]] == item)
                if score >= threshold - 1e-9:
                    found.append((item, score))
                after = item + 1
            else:  # no item before the end of the nearest block can reach it
                ends = [int(self.items[t][min((blocks[t] // BLOCK + 1) * BLOCK, len(self.items[t])) - 1])
                        for t in ahead if blocks[t] < len(self.items[t])]
                after = max(item, min(ends, default=item)) + 1
                if pivot + 1 < len(live):
                    after = max(item + 1, min(after, int(self.items[live[pivot + 1]][at[live[pivot + 1]]])))
            for t in ahead:
                at[t] = int(np.searchsorted(self.items[t], after))

    def known(self, terms: np.ndarray) -> np.ndarray:
        """The distinct terms in runs that an item has too; ``terms``: of each of a text's words, or -1.

        A run is known by its hash: a collision adds a term to the query, and loses none.
        """
        on = np.zeros(len(terms), bool)
        if not (terms >= 0).any():
            return terms[on]
        strange = np.concatenate(([0], np.cumsum(terms < 0)))
        for k, hashes in self.grams.items():
            at = np.flatnonzero(strange[k:] == strange[:-k])  # runs without strange words
            h = gram_hashes(terms, k)[at]
            found = np.searchsorted(hashes, h)
            at = at[hashes[np.minimum(found, len(hashes) - 1)] == h]
            for i in range(k):
                on[at + i] = True
        return np.unique(terms[on])


def shards(bench: DataFrame, least: float = OVERLAP, unnamed: bool = False):
    """Indexes over at most ``SHARD`` items each, by one and the same statistics of all items.

    Only one shard's items are on the driver at a time. Rows that repeat are
    one item; items without words match nothing and are left out, and those
    without an id too, unless ``unnamed``.
    """
    items = (bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .filter((F.lit(unnamed) | F.col("item_id").isNotNull()) & F.col("text").isNotNull()).distinct())

    def tokens(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(len(w), sorted(set(w))) for w in ([*q, *a] for q, a in map(split_item, texts(batch)))]
        return pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("text"), pa.array([n for n, _ in found], pa.int64()),
             pa.array([t for _, t in found], pa.list_(pa.string()))], names=["item_id", "text", "n", "terms"])

    items = map_arrow(items, tokens, "item_id long, text string, n long, terms array<string>").filter(F.col("n") > 0)
    stats = items.agg(F.count(F.lit(1)).alias("n"), F.avg("n").alias("mean")).first()
    df = items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    count = max(1, -(-int(stats["n"]) * 5 // (SHARD * 4)))  # a fifth to spare for uneven hashing
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        own = part.select(F.explode("terms").alias("term")).distinct().join(df, "term")
        rows = sorted(((r["item_id"], r["text"]) for r in part.select("item_id", "text").collect()),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Index(rows, {r["term"]: r["df"] for r in own.collect()}, int(stats["n"]), float(stats["mean"] or 0), least)


def contaminated(docs: DataFrame, bench: DataFrame, least: float = OVERLAP) -> DataFrame:
    """Verified matches: doc_id, item_id, bm25 (normalised), question_overlap, answer_overlap, place.

    ``place`` is the word at which the first of the item's shingles starts. A null text is empty
    and matches nothing, as does an item without words; an item without an id cannot be
    named and has no matches here (``drop_contaminated`` knows it); repeated rows match
    alike; an empty table on either side gives no rows.
    """
    schema = "doc_id long, item_id long, bm25 double, question_overlap double, answer_overlap double, place long"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for index in shards(bench, least):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most SHARD items
        found = map_arrow(rows, _matcher(shared, least), schema)
        out = found if out is None else out.unionByName(found)
    return out


def _matcher(shared, least: float):
    def match(index: Index, doc_id: int | None, words: list[str], out: list[list]) -> None:
        get = index.terms.get
        known = index.known(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))
        at: dict[int, dict[tuple[str, ...], int]] = {}  # the document's runs by length, made once for all items
        for item, score in index.search(known.tolist(), 1.0):
            shares, first = [], len(words)
            for part in index.parts[item]:
                k, wanted = min(SHINGLE, len(part)), shingles(part)
                if wanted and k not in at:
                    at[k] = places(words, k)
                found = [at[k][g] for g in wanted if g in at[k]]
                shares.append(len(found) / len(wanted) if wanted else 1.0)
                first = min([first, *found])
            if min(shares) >= least:
                for column, value in zip(out, (doc_id, index.ids[item], score * index.needs[item], *shares, first)):
                    column.append(value)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[] for _ in range(6)]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
            match(shared.value, doc_id, WORD.findall(text.lower()), out)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)],
            names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "place"])
    return run


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with or without an id, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for index in shards(bench, unnamed=True):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        match = _matcher(shared, OVERLAP)

        def clean(batch: pa.RecordBatch, match=match) -> pa.RecordBatch:
            at = pa.array(range(batch.num_rows), pa.int64())
            numbered = pa.RecordBatch.from_arrays([at, batch.column("text")], names=["doc_id", "text"])
            hit = set(match(numbered).column("doc_id").to_pylist())
            return batch.filter(pa.array([i not in hit for i in range(batch.num_rows)], pa.bool_()))

        rows = map_arrow(rows, clean, rows._jdf.schema().toDDL())
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
