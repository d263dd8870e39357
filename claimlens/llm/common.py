"""Helpers shared by the training-data operators: tables, shared storage, slots."""

from __future__ import annotations

import ctypes
import gc
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import new_scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
WORD = re.compile(r"\w+")

# Slots of the bounded pre-filter (see ``maybe_in``): at most this many
# integers are ever broadcast, whatever the size of the data.
SLOTS = 1 << 20
ROWS = 1024      # of a batch that are worked on at a time
BITS = 1 << 24   # of a broadcast bitmap: 2 MB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "uncompressed") -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage).

    The rows survive the loss of any executor, and later jobs read them
    instead of computing them again. Most are hashes, packed bytes and small
    numbers, so they are not compressed unless asked for; a codec's native
    buffers would outlast the many small files of a long run.
    """
    path = new_scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def maybe_in(df: DataFrame, key: Column, keys: DataFrame, flag: str, slots: int = SLOTS) -> DataFrame:
    """Add boolean ``flag``: false only where ``key`` is surely not in ``keys``.

    ``keys`` has one column. Its hash slots, at most ``slots`` integers, are
    broadcast. A full slot table only means that every row goes on to the
    exact join that must follow, so the result never depends on it.
    """
    name = keys.columns[0]
    taken = keys.select(slot_of(F.col(name), slots).alias("__slot")).distinct().withColumn("__hit", F.lit(True))
    return (df.withColumn("__slot", slot_of(key, slots))
            .join(F.broadcast(taken), "__slot", "left")
            .withColumn(flag, F.coalesce("__hit", F.lit(False)))
            .drop("__slot", "__hit"))


def bitmap(keys: DataFrame) -> bytes:
    """A bit for each key of a binary column of hashes, for ``in_bitmap``: BITS bits, whatever the data.

    A pre-filter like ``maybe_in``, but finer: an exact join must follow.
    """
    name = keys.columns[0]
    bit = F.pmod(F.conv(F.hex(F.substring(name, 1, 6)), 16, 10).cast("long"), F.lit(BITS))
    words = (keys.select(bit.alias("bit")).groupBy((F.col("bit") / 32).cast("long").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("v")).toPandas())
    out = np.zeros(BITS // 32, "<u4")
    out[words["word"].to_numpy(np.int64)] = words["v"].to_numpy(np.int64)
    return out.tobytes()


def in_bitmap(bits: bytes, key: bytes) -> bool:
    bit = int.from_bytes(key[:6], "big") % BITS
    return bool(bits[bit >> 3] >> (bit & 7) & 1)


def importable(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package from it.

    On a cluster the package is shipped with ``--py-files``; this serves
    sessions that were started from another folder on the same machine.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


_HELD: dict[str, Callable[[], None]] = {}  # of this worker: what its modules keep between tasks


def hold(owner: str, clear: Callable[[], None]) -> None:
    """Have ``clear`` called when this worker begins a task of another module than ``owner``."""
    _HELD[owner] = clear


def let_go(owner: str) -> None:
    """Free what other modules' tasks left in this worker, and memory that its allocators keep."""
    others = [o for o in _HELD if o != owner]
    for o in others:
        _HELD.pop(o)()
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_groups(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """applyInPandas over groups of ``keys``."""
    importable(df.sparkSession)
    return df.groupBy(*keys).applyInPandas(fn, schema)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
              rows: int = ROWS) -> DataFrame:
    """mapInArrow for a function from one record batch to one batch.

    Batches are handed on in slices of ``rows``, so that only few texts are Python
    objects at a time; the function sees every row once.
    """
    owner = fn.__module__

    def run(batches):
        let_go(owner)
        for b in batches:
            for at in range(0, b.num_rows, rows):
                yield fn(b.slice(at, rows))
        pa.default_memory_pool().release_unused()
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch as Python strings, null as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (null id: as empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_md5(text: Column) -> Column:
    """The 16 bytes of a text's MD5."""
    return F.unhex(F.md5(text.cast("string").cast("binary")))


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash."""
    return df.select(*[F.col(c) for c in columns])


def runs(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut consecutive rows into ranges of at most ``limit`` in total, one row at least."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)
