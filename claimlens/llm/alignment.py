"""Alignment of two tokenizers: which ids stand for the same bytes, over a whole corpus.

Every text is encoded by a byte-level BPE (A, which gets a space before the
text) and by a piece BPE (B, which adds the space itself). Byte offsets where tokens of both end cut
the tokens into groups; all A and B occurrences of a group are linked. The
count of an id pair is the number of documents that hold it linked.

1. Texts are encoded in blocks of bounded size. A fixed array maps each A id
   to the B id of the same bytes. Groups of one A token and its B id by that array, nearly
   all of them in most texts, are counted in one vector of the
   vocabulary's length per task; nothing of them is shuffled.
2. The pairs of irregular groups are counted within the block. Only its
   distinct pairs, each with the number of its documents, enter the shuffle: a pair
   that every document holds is one row per block.
3. Pair counts go back to the blocks that asked, where the packed pairs of
   each document are turned into its sums.

An identity pair that also stands in an irregular group counts once for a
document, in the vector. Broadcast are the vector and the highest count of each A id:
as long as A's vocabulary.

Definitions: texts null, empty, or whose tokens' bytes are not the space and the text
have no tokens, all numbers 0 and no groups. Special tokens spelled in a text are plain
text. Rows that repeat are documents of their own; doc_id may be null. An
empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import hold, importable, runs, stored

A_NAME = "byte_bpe_50k"
B_NAME = "piece_bpe_32k"
BLOCK = 4 << 20      # bytes of text in a block (one text may have more)
EXPAND = 1 << 21     # pairs that are made at once
DOC, PAIRS, VECTOR = 0, 1, 2   # kinds of packed rows

PACKED = ("kind int, block long, row int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
          "groups_sha256 string, ids binary, counts binary, odd binary, odd_counts binary")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


class Pair:
    """Both tokenizers, the bytes of their ids, and the array from A's ids to B's of the same bytes (-1: none)."""

    def __init__(self, a_name: str, b_name: str):
        import public_tokenizers as P
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(P.path(f"{a_name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(i) for x, i in (line.split() for line in f if line.strip())}
        self.fast = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(P.path(f"{a_name}.json"))
        self.exact.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=P.path(f"{b_name}.model"))
        self.a_size, self.b_size = max(ranks.values()) + 1, self.pieces.vocab_size()
        self.a_bytes = [b""] * self.a_size
        for x, i in ranks.items():
            self.a_bytes[i] = x
        self.b_bytes, as_byte = [], re.compile("<0x([0-9A-F]{2})>")
        of = {}
        for i in range(self.b_size):
            piece = self.pieces.id_to_piece(i)
            byte = as_byte.fullmatch(piece)
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
            if byte or not self.pieces.is_control(i) and not self.pieces.is_unknown(i):
                if not byte or self.b_bytes[i] not in of:  # a piece goes before the byte of the same value
                    of[self.b_bytes[i]] = i
        self.a_length = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        self.same = np.array([of.get(x, -1) for x in self.a_bytes], np.int64)
        # The written form of a token of A, A's last of a group, B, B's last of a group.
        self.written = [b"%d%b" % (i, end) for n, ends in ((self.a_size, (b",", b"|")), (self.b_size, (b",", b";")))
                        for end in ends for i in range(n)]

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids by A and B; none where they do not spell the space and the text."""
        if not text:
            return [], []
        spaced = " " + text
        try:
            a = self.fast.encode_ordinary(spaced)
        except Exception:  # its regular expression gives up on some very long runs
            a = self.exact.encode(spaced, add_special_tokens=False).ids
        b, raw = self.pieces.encode(text), spaced.encode()
        if b"".join(map(self.b_bytes.__getitem__, b)) != raw or b"".join(map(self.a_bytes.__getitem__, a)) != raw:
            return [], []
        return a, b


@lru_cache(maxsize=1)
def pair(a_name: str = A_NAME, b_name: str = B_NAME) -> Pair:
    hold(__name__, pair.cache_clear)
    return Pair(a_name, b_name)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of n of each."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n, first)


class Block:
    """The groups and pairs of some texts, all in flat arrays over the block's tokens."""

    def __init__(self, batch: list[str], p: Pair):
        coded = [p.encode(t) for t in batch]
        self.p, self.size = p, len(batch)
        self.n_a = np.array([len(a) for a, _ in coded], np.int64)
        self.n_b = np.array([len(b) for _, b in coded], np.int64)
        self.a = np.concatenate([np.zeros(0, np.int64), *(np.array(a, np.int64) for a, _ in coded)])
        self.b = np.concatenate([np.zeros(0, np.int64), *(np.array(b, np.int64) for _, b in coded)])
        # Both tokens of a text spell the same bytes, so offsets may run on through the block.
        a_end, b_end = np.cumsum(p.a_length[self.a]), np.cumsum(p.b_length[self.b])
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        self.a_in, self.b_in = (np.bincount(g, minlength=len(ends)) for g in (self.a_group, self.b_group))
        a_doc = np.repeat(np.arange(self.size), self.n_a)
        self.doc = a_doc[np.cumsum(self.a_in) - 1]  # of each group
        self.n_groups = np.bincount(self.doc, minlength=self.size)
        links = np.append(0, np.cumsum(self.a_in * self.b_in))
        at = np.append(0, np.cumsum(self.n_groups))
        self.n_links = links[at[1:]] - links[at[:-1]]

    def pairs(self, expand: int = EXPAND) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Links by document: of identity pairs (doc * A + a, n) and of the others (doc * A * B + a * B + b, n)."""
        p, first_a, first_b = self.p, np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        regular = (self.a_in == 1) & (self.b_in == 1)
        regular[regular] = p.same[self.a[first_a[regular]]] == self.b[first_b[regular]]
        own = [(self.doc[regular] * p.a_size + self.a[first_a[regular]], np.ones(int(regular.sum()), np.int64))]
        odd = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        # Distinct ids of each irregular group with their numbers, then every A with every B of it.
        ka, ca = self._ids_of(self.a, self.a_group, ~regular, p.a_size)
        kb, cb = self._ids_of(self.b, self.b_group, ~regular, p.b_size)
        group = ka // p.a_size
        lo, hi = np.searchsorted(kb, group * p.b_size), np.searchsorted(kb, (group + 1) * p.b_size)
        for i, j in runs(hi - lo, expand):
            n = (hi - lo)[i:j]
            x = np.repeat(np.arange(i, j), n)
            y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + lo[x]
            a, b, doc, times = ka[x] % p.a_size, kb[y] % p.b_size, self.doc[group[x]], ca[x] * cb[y]
            is_own = p.same[a] == b
            own.append(_summed((doc * p.a_size + a)[is_own], times[is_own]))
            odd.append(_summed(((doc * p.a_size + a) * p.b_size + b)[~is_own], times[~is_own]))
        join = lambda parts: _summed(*(np.concatenate([part[k] for part in parts]) for k in (0, 1)))
        return join(own), join(odd)

    @staticmethod
    def _ids_of(ids: np.ndarray, groups: np.ndarray, wanted: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        on = wanted[groups]
        return np.unique(groups[on] * size + ids[on], return_counts=True)

    def written(self) -> list[bytes]:
        """The groups of each text: A's ids, a bar, B's ids; groups are parted by semicolons."""
        p = self.p
        last_a = np.append(self.a_group[1:] != self.a_group[:-1], True)[:len(self.a)]
        last_b = np.append(self.b_group[1:] != self.b_group[:-1], True)[:len(self.b)]
        out = np.empty(len(self.a) + len(self.b), np.int64)
        before_b = np.cumsum(self.b_in) - self.b_in
        out[np.arange(len(self.a)) + before_b[self.a_group]] = self.a + last_a * p.a_size
        out[np.arange(len(self.b)) + np.cumsum(self.a_in)[self.b_group]] = self.b + 2 * p.a_size + last_b * p.b_size
        ends = np.cumsum(self.n_a + self.n_b)
        return [b"".join(map(p.written.__getitem__, out[i:j].tolist()))[:-1] for i, j in zip(np.append(0, ends), ends)]


def _blocks(batch: pa.RecordBatch, p: Pair, size: int = BLOCK):
    """Consecutive rows of bounded size: the doc_ids and the block of each run."""
    column = batch.column("text")
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    for i, j in runs(sizes + 64, size):
        yield batch.column("doc_id").slice(i, j - i), Block([t or "" for t in column.slice(i, j - i).to_pylist()], p)


def _rows(docs: DataFrame) -> DataFrame:
    importable(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def aligned_groups(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME) -> DataFrame:
    """doc_id and groups, as ``a1,a2|b1;a3|b2,b3``: the alignment itself, of every row."""
    def run(batches):
        for batch in batches:
            for ids, block in _blocks(batch, pair(a_name, b_name)):
                yield pa.RecordBatch.from_arrays([ids, pa.array([w.decode() for w in block.written()], pa.string())],
                                                 names=["doc_id", "groups"])

    return _rows(docs).mapInArrow(run, "doc_id long, groups string")


def packed(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME, block_bytes: int = BLOCK) -> DataFrame:
    """Rows of three kinds: a document's packed links, a block's distinct irregular pairs, a task's vector.

    DOC: ids and counts hold the identity links by A id, odd and odd_counts
    the others by place among the block's pairs. PAIRS: odd holds these pairs
    (a * B + b) in order, odd_counts how many of its documents hold each.
    VECTOR: counts, by A id, how many of the task's documents hold the identity pair.
    """
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()),
                        *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()),
                        *((c, pa.binary()) for c in ("ids", "counts", "odd", "odd_counts"))])

    def run(batches):
        p, block_no = pair(a_name, b_name), TaskContext.get().partitionId() << 32
        vector, nothing = np.zeros(p.a_size, np.int64), dict.fromkeys(schema.names)
        for batch in batches:
            for ids, block in _blocks(batch, p, block_bytes):
                (own, own_n), (odd, odd_n) = block.pairs()
                own_doc, own_a = np.divmod(own, p.a_size)
                odd_doc, odd_pair = np.divmod(odd, p.a_size * p.b_size)
                vector += np.bincount(own_a, minlength=p.a_size)
                kinds, place, holders = np.unique(odd_pair, return_inverse=True, return_counts=True)
                docs_at = np.arange(block.size + 1)
                o, d = np.searchsorted(own_doc, docs_at), np.searchsorted(odd_doc, docs_at)
                binary = [[x[i:j].astype("<u4").tobytes() for i, j in zip(at, at[1:])]
                          for x, at in ((own_a, o), (own_n, o), (place, d), (odd_n, d))]
                sha = [hashlib.sha256(w).hexdigest() if w else "" for w in block.written()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(block.size, DOC, np.int32)), pa.array(np.full(block.size, block_no, np.int64)),
                     pa.array(np.arange(block.size, dtype=np.int32)), ids,
                     *(pa.array(x.astype(np.int64)) for x in (block.n_a, block.n_b, block.n_groups, block.n_links)),
                     pa.array(sha, pa.string()), *(pa.array(x, pa.binary()) for x in binary)], schema=schema)
                yield pa.RecordBatch.from_pylist(
                    [nothing | {"kind": PAIRS, "block": block_no, "odd": kinds.astype("<i8").tobytes(),
                                "odd_counts": holders.astype("<u4").tobytes()}], schema=schema)
                block_no += 1
        yield pa.RecordBatch.from_pylist(
            [nothing | {"kind": VECTOR, "counts": vector.astype("<i8").tobytes()}], schema=schema)

    return _rows(docs).mapInArrow(run, PACKED)


def _vector(links: DataFrame, size: int) -> np.ndarray:
    """The tasks' vectors, summed: documents that hold each A id's identity pair."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column("counts").to_pylist():
                total += np.frombuffer(x, "<i8")
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(total[on])], names=["a", "n"])

    found = (links.filter(F.col("kind") == VECTOR).select("counts").mapInArrow(run, "a long, n long")
             .groupBy("a").agg(F.sum("n").alias("n")).toPandas())  # no more rows than A has ids
    out = np.zeros(size, np.int64)
    out[found["a"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def _asked(links: DataFrame) -> DataFrame:
    """block, pair, n (its documents in the block) of every distinct irregular pair of every block."""
    def run(batches):
        for batch in batches:
            for block, pairs, n in zip(*(batch.column(c).to_pylist() for c in ("block", "odd", "odd_counts"))):
                pairs = np.frombuffer(pairs, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), block, np.int64)), pa.array(pairs),
                     pa.array(np.frombuffer(n, "<u4").astype(np.int64))], names=["block", "pair", "n"])

    return links.filter(F.col("kind") == PAIRS).select("block", "odd", "odd_counts").mapInArrow(
        run, "block long, pair long, n long")


def link_counts(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME) -> DataFrame:
    """a, b, documents: in how many documents each linked id pair occurs, over the corpus."""
    p, links = pair(a_name, b_name), stored(packed(docs, a_name, b_name), "links", "zstd")
    vector = _vector(links, p.a_size)
    on = np.flatnonzero(vector)
    same = docs.sparkSession.createDataFrame(pd.DataFrame({"a": on, "b": p.same[on], "documents": vector[on]}),
                                             "a long, b long, documents long")
    odd = _asked(links).groupBy("pair").agg(F.sum("n").alias("documents"))
    of = F.lit(p.b_size).cast("long")
    return same.unionByName(odd.select(F.floor(F.col("pair") / of).alias("a"), F.pmod("pair", of).alias("b"), "documents"))


def align(docs: DataFrame, a_name: str = A_NAME, b_name: str = B_NAME, block_bytes: int = BLOCK) -> DataFrame:
    """One row per document, see ``ALIGNED``.

    n_links counts linked occurrence pairs, count_sum adds their id pairs'
    counts, n_best counts those whose count is the highest of their A id;
    groups_sha256 is the hash of what ``aligned_groups`` gives ('' without tokens).
    """
    spark, p = docs.sparkSession, pair(a_name, b_name)
    links = stored(packed(docs, a_name, b_name, block_bytes), "links", "zstd")
    asked = _asked(links)
    counts = stored(asked.groupBy("pair").agg(F.sum("n").alias("n")), "link-counts")
    vector, b_size = _vector(links, p.a_size), p.b_size
    highest = counts.groupBy(F.floor(F.col("pair") / F.lit(b_size)).alias("a")).agg(F.max("n").alias("n")).toPandas()
    best = vector.copy()
    at = highest["a"].to_numpy(np.int64)
    best[at] = np.maximum(best[at], highest["n"].to_numpy(np.int64))
    shared = spark.sparkContext.broadcast((vector, best))  # two numbers for each A id

    def told(documents: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        own, best = shared.value
        answers = answers.sort_values("pair")
        count, best_of = answers["n"].to_numpy(np.int64), best[answers["pair"].to_numpy(np.int64) // b_size]
        sums, hits = [], []
        for ids, n, odd, m in zip(*(documents[c] for c in ("ids", "counts", "odd", "odd_counts"))):
            ids, n, odd, m = (np.frombuffer(x, "<u4").astype(np.int64) for x in (ids, n, odd, m))
            sums.append(int((own[ids] * n).sum() + (count[odd] * m).sum()))
            hits.append(int(n[own[ids] == best[ids]].sum() + m[count[odd] == best_of[odd]].sum()))
        return documents[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].assign(
            n_best=hits, count_sum=sums, groups_sha256=documents["groups_sha256"])

    rows = links.filter(F.col("kind") == DOC).drop("kind", "row")
    answers = asked.select("block", "pair").join(counts, "pair").select("block", "pair", "n")
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(told, ALIGNED)
