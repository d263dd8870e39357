"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

P(w | u) = a(u) c(u w) / c(u) + b(u) c(w) / N + d(u) / (V + 1)

c: counts in the training texts, N their tokens, V their distinct tokens. The
weights a, b, d add to 1 and depend on u only through the logarithm of how
often u was seen (context-frequency buckets). They are learned by expectation-
maximisation on held-out counts: one fold of the training texts is deleted
from the counts, and the mixture that these counts give predicts the fold.
The scores then use the counts of all training texts.

How it runs. Texts become blocks of numbered words. A block asks for the counts
of its distinct words and bigrams: it sends their hashes, with its own counts,
to hash buckets; each bucket adds up what all blocks sent and answers every
block for what it asked. So a block's repeated n-grams travel once, a frequent
n-gram costs one entry a block, and no task gets more than a block or a bucket,
whose number grows with the corpus. All n-grams of all training texts count.

N-grams are known by 64-bit hashes of their words (48 bits within a bucket).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import fold, importable, map_arrow, map_groups, runs, stored, texts

FOLDS, HELD_OUT, DELETED = 7, 2, 3   # remainders: scored only; the fold that weights are learned on
BLOCK_CHARS = 8_000_000              # bytes of a block's texts (one text at least)
BUCKET_TOKENS = 1_500_000            # tokens of the corpus per hash bucket
CLASSES = 24                         # context-frequency buckets: unseen, 1, 2-3, 4-7, ...
STEPS = 12                           # expectation-maximisation turns at most
TOLERANCE = 1e-5                     # nats a token; smaller gains end them
PRIOR = 1.0                          # tokens that each estimate gets in each bucket beforehand
_START, _STOP = np.uint64(xxhash.xxh3_64_intdigest("<s>") | 1), np.uint64(xxhash.xxh3_64_intdigest("</s>") & ~1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64((1 << 48) - 1)


class Ids(dict):
    """Numbers for words in the order in which they first come."""

    def __missing__(self, word):
        n = self[word] = len(self) + 2  # 0: start, 1: end of text
        return n


def words_of(text: str) -> list[bytes]:
    """ASCII-lower-cased words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def packed(values: np.ndarray, kind: str) -> bytes:
    """Little-endian integers as byte planes, compressed."""
    raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize)
    return zstandard.compress(np.ascontiguousarray(raw.T).tobytes(), 1)


def unpacked(data: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


BUNDLE = "block string, docs binary, missing binary, roles binary, sizes binary, tokens binary, words binary"


def _bundles(docs: DataFrame) -> DataFrame:
    """A row per block: its documents (id, role, length), their tokens, and the hashes of its distinct words."""
    doc_id = F.col("doc_id").cast("long")
    remainder = fold(doc_id, FOLDS)
    role = F.when(remainder == HELD_OUT, 2).when(remainder == DELETED, 1).otherwise(0).cast("int")
    rows = docs.select(doc_id.alias("doc_id"), role.alias("role"), F.col("text").cast("string").alias("text"))

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            for a, b in runs(sizes, BLOCK_CHARS):
                some = batch.slice(a, b - a)
                ids, roles = some.column("doc_id").to_pylist(), some.column("role").to_numpy()
                known, tokens, sizes = Ids(), [], []
                for t in texts(some):
                    words = words_of(t)
                    found = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
                    tokens += [found, np.ones(1, np.uint32)]
                    sizes.append(len(words) + 1)
                hashes = np.array([_START, _STOP, *map(xxhash.xxh3_64_intdigest, known)], np.uint64)
                row = (f"{part}-{number}", packed(np.array([x or 0 for x in ids], np.int64), "<i8"),
                       packed(np.array([x is None for x in ids]), "u1"), packed(roles, "u1"),
                       packed(np.array(sizes), "<u4"), packed(np.concatenate(tokens), "<u4"), hashes.tobytes())
                number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[0]]), *(pa.array([x], pa.binary()) for x in row[1:])],
                    names=["block", "docs", "missing", "roles", "sizes", "tokens", "words"])

    importable(docs.sparkSession)
    return rows.mapInArrow(run, BUNDLE)


def _each(batch: pa.RecordBatch):
    """The rows as dictionaries, one at a time: a row is a whole block."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


class Block:
    """A block's tokens with their contexts, and its distinct words and bigrams."""

    def __init__(self, row):
        self.sizes = unpacked(row["sizes"], "<u4").astype(np.int64)
        self.roles = unpacked(row["roles"], "u1")
        self.tokens = unpacked(row["tokens"], "<u4").astype(np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        first = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.before = np.concatenate(([0], self.tokens[:-1]))
        self.before[first] = 0  # the start of a text
        self.role_of = np.repeat(self.roles, self.sizes)
        pairs, self.pair_of = np.unique(self.before * len(self.words) + self.tokens, return_inverse=True)
        u, w = np.divmod(pairs, len(self.words))
        h = (self.words[u] * _A) ^ (self.words[w] * _B + (self.words[w] >> np.uint64(31)))
        h = (h ^ (h >> np.uint64(29))) * _A
        self.pairs = h ^ (h >> np.uint64(32))

    def counts(self, kind: int, role: int) -> np.ndarray:
        """This block's counts in training texts (role 0) or its deleted fold (role 1): words (kind 0) or bigrams."""
        on = self.role_of == 1 if role else self.role_of < 2
        if kind:
            return np.bincount(self.pair_of[on], minlength=len(self.pairs))
        found = np.bincount(self.tokens[on], minlength=len(self.words))
        found[0] = (self.roles == 1).sum() if role else (self.roles < 2).sum()  # texts begun
        return found

    def dealt(self, kind: int, buckets: int):
        """Order of the block's distinct n-grams by (bucket, key), the bucket edges and the keys."""
        h = self.pairs if kind else self.words
        bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        order = np.lexsort((h & _LOW, bucket))
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        return order, edges, (h & _LOW)[order]


def _requests(bundles: DataFrame, buckets: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for row in _each(batch):
                block = Block(row)
                for kind in (0, 1):
                    order, edges, keys = block.dealt(kind, buckets)
                    train, deleted = block.counts(kind, 0)[order], block.counts(kind, 1)[order]
                    out = []
                    for k in range(buckets):
                        a, b = edges[k], edges[k + 1]
                        if b > a:
                            gaps = np.diff(keys[a:b], prepend=np.uint64(0))
                            out.append((k, row["block"], kind, packed(gaps, "<u8"), packed(train[a:b], "<u4"),
                                        packed(deleted[a:b], "<u4")))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in out], t) for i, t in enumerate(
                            (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                        names=["bucket", "block", "kind", "keys", "train", "deleted"])

    importable(bundles.sparkSession)
    return bundles.select("block", "sizes", "roles", "tokens", "words").mapInArrow(
        run, "bucket int, block string, kind int, keys binary, train binary, deleted binary")


ANSWER = "block string, bucket int, kind int, train binary, deleted binary, distinct long"


def _answer(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Add up a bucket's requests and answer each of them in its own order."""
    bucket, out = int(key[0]), []
    for kind, rows in frame.groupby("kind", sort=True):
        keys = [np.cumsum(unpacked(k, "<u8"), dtype=np.uint64) for k in rows["keys"]]
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = [np.bincount(where, np.concatenate([unpacked(x, "<u4") for x in rows[c]]), len(every)).astype(np.int64)
                 for c in ("train", "deleted")]
        distinct = int((total[0] > 0).sum()) if kind == 0 else 0
        at = 0
        for block, k in zip(rows["block"], keys):
            mine = where[at:at + len(k)]
            at += len(k)
            out.append((block, bucket, int(kind), packed(total[0][mine], "<u8"), packed(total[1][mine], "<u8"), distinct))
            distinct = 0  # told once for each bucket
    return pd.DataFrame(out, columns=["block", "bucket", "kind", "train", "deleted", "distinct"])


def _events(buckets: int):
    """A block with its answers: documents, and per token the row of a table of distinct count triples."""
    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        head = frame[frame["tokens"].notna()].iloc[0]
        block = Block(head)
        counts = {}
        for kind in (0, 1):
            order, edges, _ = block.dealt(kind, buckets)
            for name in ("train", "deleted"):
                counts[kind, name] = np.zeros(len(order), np.int64)
            for _, row in frame[frame["kind"] == kind].iterrows():
                mine = order[edges[int(row["bucket"])]:edges[int(row["bucket"]) + 1]]
                for name in ("train", "deleted"):
                    counts[kind, name][mine] = unpacked(row[f"a_{name}"], "<u8")
        triple = lambda name: np.stack([counts[0, name][block.before], counts[1, name][block.pair_of],
                                        counts[0, name][block.tokens]], axis=1)
        all_train = triple("train")
        table, row_of = _table(all_train)
        on = block.role_of == 1
        kept, at = _table(all_train[on] - triple("deleted")[on])
        known = np.add.reduceat(all_train[:, 2] > 0, np.cumsum(block.sizes) - block.sizes)
        fields = {"docs": head["docs"], "missing": head["missing"], "roles": head["roles"], "sizes": head["sizes"],
                  "known": packed(known, "<u4"), "rows": packed(row_of, "<u4"), "table": packed(table.ravel(), "<u8"),
                  "held": packed(kept.ravel(), "<u8"), "times": packed(np.bincount(at, minlength=len(kept)), "<u4")}
        return pd.DataFrame({k: [v] for k, v in fields.items()})
    return run


def _table(triples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and the place of each row among them."""
    if not len(triples):
        return triples, np.zeros(0, np.int64)
    order = np.lexsort(triples.T)
    s = triples[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]).any(axis=1)))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return s[new], place


def _parts(table: np.ndarray, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """Context class and the three estimates of each count triple (context, bigram, word)."""
    context, pair, word = table[:, 0], table[:, 1], table[:, 2]
    klass = np.minimum(np.frexp(context.astype(float))[1], CLASSES - 1)  # 0 for 0, else 1 + floor(log2)
    estimates = np.stack([pair / np.maximum(context, 1), word / max(n, 1), np.full(len(table), 1.0 / (v + 1))], axis=1)
    return klass, estimates


def _learn(blocks: DataFrame, n: int, v: int) -> np.ndarray:
    """Weights by context class: expectation-maximisation over the held-out counts of all blocks."""
    weights = np.full((CLASSES, 3), 1 / 3)
    weights[0] = 0.0, 0.5, 0.5  # an unseen context has no bigram estimate
    held = blocks.select("held", "times")
    before = None
    for _ in range(STEPS):
        def expect(batch: pa.RecordBatch, weights=weights) -> pa.RecordBatch:
            mass, gain, seen = np.zeros((CLASSES, 3)), 0.0, 0
            for row in _each(batch):
                table = unpacked(row["held"], "<u8").astype(np.int64).reshape(-1, 3)
                count = unpacked(row["times"], "<u4")
                klass, estimates = _parts(table, n, v)
                share = weights[klass] * estimates
                total = share.sum(axis=1)
                share *= (count / total)[:, None]
                for j in range(3):
                    mass[:, j] += np.bincount(klass, share[:, j], CLASSES)
                gain += float(count @ np.log(total))
                seen += int(count.sum())
            return pa.RecordBatch.from_arrays([pa.array([mass.ravel().tolist()], pa.list_(pa.float64())),
                                               pa.array([gain]), pa.array([seen], pa.int64())],
                                              names=["mass", "gain", "seen"])

        rows = map_arrow(held, expect, "mass array<double>, gain double, seen long")
        sums = [F.sum(F.col("mass")[i]).alias(f"m{i}") for i in range(3 * CLASSES)]
        got = rows.agg(F.sum("gain").alias("gain"), F.sum("seen").alias("seen"), *sums).first()
        if not got["seen"]:
            break
        mass = np.array([got[f"m{i}"] for i in range(3 * CLASSES)]).reshape(CLASSES, 3) + PRIOR
        mass[0, 0] = 0.0
        weights = mass / mass.sum(axis=1, keepdims=True)
        if before is not None and (got["gain"] - before) / got["seen"] < TOLERANCE:
            break
        before = got["gain"]
    return weights


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of all whole texts under the model that the training texts give.

    Returns doc_id, held_out, n_tokens, n_known (seen in training),
    train_tokens (N), base_score (add-one unigram) and score, both log10.
    Tokens are words and one end per text, so a null or empty text has one.
    A null doc_id is dealt to a fold as an empty id; repeated rows count and are scored one by
    one; without training texts every token has probability 1 / (V + 1) = 1.
    An empty table gives no rows.
    """
    bundles = stored(_bundles(docs), "blocks")

    def tally(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [unpacked(x, "<u4").astype(np.int64) for x in batch.column("sizes").to_pylist()]
        roles = [unpacked(x, "u1") for x in batch.column("roles").to_pylist()]
        sums = [[int(s[cond(r)].sum()) for s, r in zip(sizes, roles)]
                for cond in (lambda r: r < 3, lambda r: r < 2, lambda r: r == 1)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in sums], names=["tokens", "train", "deleted"])

    sums = map_arrow(bundles.select("sizes", "roles"), tally, "tokens long, train long, deleted long")
    total, n, deleted = (int(x or 0) for x in sums.agg(F.sum("tokens"), F.sum("train"), F.sum("deleted")).first())
    buckets = min(1 << 16, max(1, -(-total // BUCKET_TOKENS)))
    answers = stored(map_groups(_requests(bundles, buckets).repartition(
        min(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4), "bucket"),
        ["bucket"], _answer, ANSWER), "counts")
    v = int(answers.agg(F.sum("distinct")).first()[0] or 0) - (1 if n else 0)  # without the start of texts
    v = max(v, 0)

    nothing = lambda kind: F.lit(None).cast(kind)
    asked = bundles.select("*", nothing("int").alias("bucket"), nothing("int").alias("kind"),
                           nothing("binary").alias("a_train"), nothing("binary").alias("a_deleted"))
    told = answers.select("block", *[nothing("binary").alias(c) for c in bundles.columns[1:]], "bucket", "kind",
                          F.col("train").alias("a_train"), F.col("deleted").alias("a_deleted"))
    binary = "docs missing roles sizes known rows table held times".split()
    blocks = stored(map_groups(asked.unionByName(told), ["block"], _events(buckets),
                               ", ".join(f"{c} binary" for c in binary)), "events")
    weights = _learn(blocks, n - deleted, v) if n else np.tile([0.0, 0.0, 1.0], (CLASSES, 1))
    floor = float(n + v + 1)

    def scores(batches):
        for batch in batches:
            for row in _each(batch):
                sizes = unpacked(row["sizes"], "<u4").astype(np.int64)
                table = unpacked(row["table"], "<u8").astype(np.int64).reshape(-1, 3)
                klass, estimates = _parts(table, n, v)
                of_row = np.log10((weights[klass] * estimates).sum(axis=1))
                base_row = np.log10((table[:, 2] + 1) / floor)
                at = unpacked(row["rows"], "<u4").astype(np.int64)
                first = np.cumsum(sizes) - sizes
                ids = pa.array(unpacked(row["docs"], "<i8"), mask=unpacked(row["missing"], "u1").astype(bool))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(unpacked(row["roles"], "u1") == 2), pa.array(sizes),
                     pa.array(unpacked(row["known"], "<u4").astype(np.int64)),
                     pa.array(np.full(len(sizes), n)), pa.array(np.add.reduceat(base_row[at], first)),
                     pa.array(np.add.reduceat(of_row[at], first))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.select("docs", "missing", "roles", "sizes", "known", "rows", "table").mapInArrow(
        scores, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double")
