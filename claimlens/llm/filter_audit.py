"""Audit of five text filters: what each removes, in every order of applying them.

Every document gets a mask of the filters it fails. Documents are counted by
(part, mask), at most 32 cells a part, and only these cells go on. For each
part a Gray code walks through all 32 sets of filters, toggling one at a
time: each cell keeps the number of active filters that it fails, and running
sums hold what survives. The state after every toggle is stored; any step of
any order is then the difference of two states.

The filters, on the whole text (null is empty; words are maximal
``[^\\x20\\x09-\\x0D]+``, case-sensitive), fail where

- A: there are under ``MIN_WORDS`` words;
- B: distinct words are under ``MIN_DISTINCT`` % of the words;
- C: ``[A-Z]`` are over ``MAX_CAPITALS`` % of the code points;
- D: one of ``#$%&*|`` occurs;
- E: a smaller doc_id has the same text (by SHA-256), removed or not.

Rows without a doc_id never fail E and let no other row fail it; rows that repeat
a doc_id and its text do not fail E for each other. A null lang is the part
''. A document is good (toxic) if any ``labels`` row of its id says so. An
empty table has no parts, so no rows.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import map_groups, pick, stored

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
WORD = r"[^\x20\x09-\x0D]+"
SETS = 1 << len(FILTERS)
COUNTS = ("n", "good", "toxic")
AUDIT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
         "good_lost long, toxic_lost long, shapley long")


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id, part, hash of the text and own (the mask of the filters A to D) of every row; no text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n, kinds = F.size("words").cast("long"), F.size(F.array_distinct("words")).cast("long")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]", "")).cast("long")
    fails = (n < MIN_WORDS, kinds * 100 < n * MIN_DISTINCT, capitals * 100 > F.length("text").cast("long") * MAX_CAPITALS,
             F.col("text").rlike("[#$%&*|]"))
    own = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("hash"), own.cast("int").alias("own"))


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by part and mask: part, mask, n, good, toxic (at most 32 rows a part).

    A text's copies are first summed by (part, text) with map-side
    combining, so a text that a third of all rows share is a row per part when
    its smallest doc_id is looked for.
    """
    rows = stored(_digests(docs), "digests")
    said = pick(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = rows.filter(F.col("doc_id").isNotNull()).join(said, "doc_id", "left")
    ones = known.groupBy("hash", "part", "own", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    by_text = ones.groupBy("hash", "part", "own").agg(
        F.min(F.struct("doc_id", *COUNTS)).alias("least"), *(F.sum(c).alias(c) for c in COUNTS))
    first = by_text.groupBy("hash").agg(F.min("least.doc_id").alias("first"))
    by_text = by_text.join(first, "hash")
    spared = F.col("least.doc_id") == F.col("first")  # the rows of the smallest doc_id do not fail E
    stays = by_text.filter(spared).select("part", F.col("own").alias("mask"), *(F.col(f"least.{c}").alias(c) for c in COUNTS))
    fails = by_text.select("part", F.col("own").bitwiseOR(F.lit(SETS // 2)).alias("mask"), *(
        (F.col(c) - F.when(spared, F.col(f"least.{c}")).otherwise(0)).alias(c) for c in COUNTS))
    unnamed = rows.filter(F.col("doc_id").isNull()).groupBy("part", F.col("own").alias("mask")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    every = stays.unionByName(fails).unionByName(unnamed)
    return every.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in COUNTS)).filter("n > 0")


def gray_states(masks: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What survives each set of filters: SETS rows of the columns of ``counts``.

    Step k of the walk toggles the filter of k's lowest set bit. A cell drops
    out when its first active failure appears, and is back when the last goes.
    """
    states = np.zeros((SETS, counts.shape[1]), np.int64)
    failing, alive, active = np.zeros(len(masks), np.int64), counts.sum(axis=0), 0
    states[0] = alive
    for k in range(1, SETS):
        bit = (k & -k).bit_length() - 1
        active ^= 1 << bit
        hit = (masks >> bit & 1).astype(bool)
        if active >> bit & 1:
            alive = alive - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            alive = alive + counts[hit & (failing == 0)].sum(axis=0)
        states[active] = alive
    return states


def audit_part(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, as differences of stored states."""
    masks = cells["mask"].to_numpy(np.int64)
    states = gray_states(masks, cells[list(COUNTS)].to_numpy(np.int64))
    everything, none = SETS - 1, 0
    failing = [int(states[none, 0] - states[1 << i, 0]) for i in range(len(FILTERS))]
    unique = [int(states[everything ^ (1 << i), 0] - states[everything, 0]) for i in range(len(FILTERS))]
    out, shapley = [], [0] * len(FILTERS)
    for order in permutations(range(len(FILTERS))):
        name, done = "".join(FILTERS[i] for i in order), none
        for step, i in enumerate(order, 1):
            removed, good, toxic = (int(x) for x in states[done] - states[done | 1 << i])
            done |= 1 << i
            shapley[i] += removed
            out.append([name, step, int(states[done, 0]), removed, failing[i] - removed, unique[i], good, toxic, i])
    frame = pd.DataFrame(out, columns=["filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                                       "good_lost", "toxic_lost", "shapley"])
    frame["shapley"] = [shapley[i] for i in frame["shapley"]]
    frame.insert(0, "part", key[0])
    return frame


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the five filters and step; see the contract's columns in ``AUDIT``.

    kept: documents left after the step; removed: that it removes; redundant:
    that fail its filter but went earlier; unique_fails: that fail its filter
    only; good_lost, toxic_lost: labelled documents among the removed;
    shapley: its filter's removed documents over all orders.
    """
    return map_groups(mask_cells(docs, labels), ["part"], audit_part, AUDIT)
