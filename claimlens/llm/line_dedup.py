"""Removal of multi-line chunks that repeat anywhere in the corpus.

Lines are hashed to 128 bits, and a rolling hash over the line hashes (modulo a
prime, so that any run of lines costs one subtraction) gives every chunk its key.
Chunk boundaries are content-defined and resist shifts: a chunk begins at
every line and one ends at every line, each the shortest run of lines that
counts. It depends on its own lines only, and every line of a repeated
passage that counts is in a chunk inside the passage: the chunk that begins
there or, near its end, the one that ends with the passage. (Boundaries thinned
out by hash, as in chunking of files, lie inside a passage of few lines by chance
only; then no chunk of it repeats, and it stays.)

Chunks whose key's half occurs more than once (counted with map-side
combining) go on, by a bitmap, to the exact count by key. The lines of those that
repeat are then compared byte for byte, each line once however many chunks it is
in, by grouping their texts by hash; every occurrence of a chunk but the first
(smallest doc_id, then text hash, then place) is removed. Documents without
such a chunk are not moved.

Definitions: lines end at "\\n". A chunk counts if it has two lines or more and
``MIN_WORDS`` words at least, or is one line of ``LONG_WORDS`` words or more. An
occurrence that overlaps the first one is no repetition of it. Null text stays
null. Rows that repeat doc_id and text in whole are one document: each gets
the same result, and they are no repetition of each other.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import bitmap, in_bitmap, map_arrow, maybe_in, stored, text_md5

MIN_LINES = 2
LONG_WORDS = 50
MIN_WORDS = 10
PRIME = (1 << 127) - 1
BASE = xxhash.xxh3_128_intdigest(b"base of the rolling hash") % PRIME


def chunks(lines: list[str]) -> list[tuple[int, int]]:
    """Ranges (first line, line after the last) of a document's chunks, in order."""
    words = [len(line.split(None, LONG_WORDS)) for line in lines]
    total = [0, *accumulate(words)]
    found = set()
    for i, n in enumerate(words):
        if n >= LONG_WORDS:
            found.add((i, i + 1))
            continue
        a = min(i + 1 - MIN_LINES, bisect_right(total, total[i + 1] - MIN_WORDS) - 1)
        if a >= 0:
            found.add((a, i + 1))
        b = max(i + MIN_LINES, bisect_left(total, total[i] + MIN_WORDS))
        if b <= len(lines):
            found.add((i, b))
    return sorted(found)


def _counts(lines: list[str], a: int, b: int, text: str) -> bool:
    if b - a < MIN_LINES:
        return len(lines[a].split(None, LONG_WORDS)) >= LONG_WORDS
    return len(text.split(None, MIN_WORDS)) >= MIN_WORDS


_POWERS = [1]


def keyed_chunks(lines: list[str]) -> list[tuple[int, int, bytes]]:
    """First line, line after the last and key of each chunk: the rolling hash over its lines' hashes."""
    upto = [0]
    for line in lines:
        upto.append((upto[-1] * BASE + xxhash.xxh3_128_intdigest(line) % PRIME + 1) % PRIME)
    out = []
    for a, b in chunks(lines):
        while len(_POWERS) <= b - a:
            _POWERS.append(_POWERS[-1] * BASE % PRIME)
        out.append((a, b, ((upto[b] - upto[a] * _POWERS[b - a]) % PRIME).to_bytes(16, "big")))
    return out


def _likely(docs: DataFrame) -> bytes:
    """A bitmap of the chunks that may occur more than once."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [int.from_bytes(key[:8], "big") for text in batch.column(0).to_pylist() if text
               for _, _, key in keyed_chunks(text.split("\n"))]
        return pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["half"])

    halves = map_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "half long")
    several = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return bitmap(several.select(F.unhex(F.lpad(F.hex("half"), 16, "0")).alias("chunk")))


def _chunk_rows(docs: DataFrame, bits: bytes) -> DataFrame:
    """Chunks whose bit is set: doc_id, text_hash, first, lines, chunk (its key)."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)  # 2 MB

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[] for _ in range(5)]
        for doc_id, text, own in zip(*(c.to_pylist() for c in batch.columns)):
            for a, b, key in keyed_chunks(text.split("\n")) if text else ():
                if in_bitmap(shared.value, key):
                    for column, value in zip(out, (doc_id, own, a, b - a, key)):
                        column.append(value)
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                          names=["doc_id", "text_hash", "first", "lines", "chunk"])

    text = F.col("text").cast("string")
    return map_arrow(docs.select(F.col("doc_id").cast("long"), text, text_md5(text)), run,
                     "doc_id long, text_hash binary, first int, lines int, chunk binary")


def _unlike(docs: DataFrame, bits: bytes) -> DataFrame:
    """Hashes of lines (``line``) that stand for different texts, among the lines of chunks whose bit is set."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = set()
        for text in batch.column(0).to_pylist():
            lines = text.split("\n") if text else []
            for a, b, key in keyed_chunks(lines):
                if in_bitmap(shared.value, key):
                    found.update(lines[a:b])
        return pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(x) for x in found], pa.binary()),
                                           pa.array(list(found), pa.string())], names=["line", "body"])

    rows = map_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "line binary, body string")
    # Every text is compared with the others of its hash: all but one text for a hash are too many.
    return rows.distinct().groupBy("line").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("line")


def _holding(docs: DataFrame, bits: bytes) -> DataFrame:
    """chunk and line (hash) of every line of every chunk whose bit is set."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = set()
        for text in batch.column(0).to_pylist():
            lines = text.split("\n") if text else []
            for a, b, key in keyed_chunks(lines):
                if in_bitmap(shared.value, key):
                    found.update((key, xxhash.xxh3_128_digest(x)) for x in lines[a:b])
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.binary()),
                                           pa.array([x for _, x in found], pa.binary())], names=["chunk", "line"])

    return map_arrow(docs.select(F.col("text").cast("string").alias("text")), run, "chunk binary, line binary")


# One sortable value for an occurrence: ids in order (null first), then text hash, then place.
def _place():
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    return F.struct(order.alias("o"), F.col("text_hash").alias("t"), F.col("first").alias("f"))


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """Occurrences to remove: doc_id, text_hash, first, lines (all but the first of each chunk)."""
    found = stored(_chunk_rows(docs, _likely(docs)), "chunks").withColumn("at", _place())
    ends = found.groupBy("chunk").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    repeated = stored(ends.filter(F.col("lo") != F.col("hi")).select("chunk", F.col("lo").alias("keep")), "repeated")
    bits = bitmap(repeated.select("chunk"))
    unlike, proven = stored(_unlike(docs, bits), "unlike"), repeated
    if not unlike.isEmpty():  # a hash of 128 bits that two lines share: their chunks stay
        proven = repeated.join(_holding(docs, bits).join(unlike, "line", "left_semi").select("chunk"), "chunk", "left_anti")
    of_keep = ((F.col("at.o") == F.col("keep.o")) & (F.col("at.t") == F.col("keep.t"))
               & (F.col("first") < F.col("keep.f") + F.col("lines")))  # the first itself, or it overlaps the first
    # Stored before they are grouped by document, so that a hot chunk's rows can be split over tasks.
    return stored(found.join(proven, "chunk").filter(~of_keep).select("doc_id", "text_hash", "first", "lines"), "found")


def _merged(cuts: DataFrame) -> DataFrame:
    """The cuts of each document (doc_id, text_hash, cuts) as runs of lines that neither overlap nor touch."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for found in batch.column("cuts").to_pylist():
            ranges: list[dict[str, int]] = []
            for first, end in sorted((c["first"], c["first"] + c["lines"]) for c in found):
                if ranges and first <= ranges[-1]["first"] + ranges[-1]["lines"]:
                    ranges[-1]["lines"] = max(ranges[-1]["lines"], end - ranges[-1]["first"])
                else:
                    ranges.append({"first": first, "lines": end - first})
            out.append(ranges)
        kind = pa.list_(pa.struct([("first", pa.int32()), ("lines", pa.int32())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(out, kind)],
                                          names=["doc_id", "text_hash", "cuts"])

    return map_arrow(cuts, run, "doc_id long, text_hash binary, cuts array<struct<first:int,lines:int>>")


def dedup_lines(docs: DataFrame, keep_columns: bool = False) -> DataFrame:
    """Every document with its repeated chunks removed.

    Returns doc_id, text, n_lines, removed_lines and removed_chunks (runs of
    lines, each of one repeated chunk or several that join); with ``keep_columns`` the input's columns instead, with the new text (and
    n_chars, where the input has it). A null text counts 0 lines, an empty
    one 1. An empty table gives no rows.
    """
    cuts = (repeated_chunks(docs).distinct()
            .groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("first", "lines")).alias("cuts")))
    cuts = stored(_merged(cuts), "cuts")
    # The input row travels as one struct, so no column of any name can clash.
    text, doc_id = F.col("row.text").cast("string"), F.col("row.doc_id").cast("long")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = maybe_in(whole.withColumn("own", text_md5(text)), F.col("own"), cuts.select("text_hash"), "maybe")
    joined = (whole.filter("maybe").join(
        cuts, doc_id.eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("text_hash")), "left").select("row", "cuts")
        .unionByName(whole.filter("not maybe").select("row", F.lit(None).cast(cuts.schema["cuts"].dataType).alias("cuts"))))
    lines = F.split(text, "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.exists(
        "cuts", lambda c: (i >= c["first"]) & (i < c["first"] + c["lines"])))
    cut = joined.withColumn("left", F.when(F.col("cuts").isNull(), text).otherwise(F.concat_ws("\n", kept)))
    removed = F.coalesce(F.aggregate("cuts", F.lit(0), lambda n, c: n + c["lines"]), F.lit(0))
    if not keep_columns:
        return cut.select(
            doc_id.alias("doc_id"), F.col("left").alias("text"),
            F.when(text.isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
            removed.alias("removed_lines"),
            F.when(F.col("cuts").isNull(), 0).otherwise(F.size("cuts")).alias("removed_chunks"))
    kinds = dict(docs.dtypes)
    new = {"text": F.col("left"),
           "n_chars": F.when(F.col("cuts").isNotNull(), F.length("left").cast(kinds.get("n_chars", "long")))
           .otherwise(F.col("row.n_chars")) if "n_chars" in kinds else None}
    return cut.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
