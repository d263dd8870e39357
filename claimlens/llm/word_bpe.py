"""BPE encoding and decoding of whole texts, by batched merge rounds in numpy.

Texts are cut at special tokens, normalised and split into words, which are
looked up among those that the task has met. The new words of a whole batch are
encoded together: their symbols lie in one flat array; adjacent pairs get
their ranks by binary search over the sorted pair keys, and in each round
every word's lowest-ranked pair is merged wherever it occurs; words without a
known pair leave the array. A very long word would need very many rounds over
all of it, so it merges by a queue of its pairs instead, which gives the same ids.

Definitions: a null text is empty, and an empty text (or one of white space
only) has no ids and decodes to ''. Rows that repeat are encoded alike. An
empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import hold, map_arrow, texts

VOCABULARY = "word_bpe_49k"
LONG = 2048            # symbols of a word from which it has a queue of its own
CACHE_WORDS = 200_000  # that a task remembers at most
CACHE_LENGTH = 64      # characters of a word that is worth remembering
ENCODED = "doc_id long, ids binary"
DECODED = ENCODED + ", decoded string"
# The white space that the vocabulary's normaliser knows; texts of ASCII and the plain letters
# of Latin-1, which normalisation only lower-cases; and their words.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
PLAIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^ \t-\ra-z0-9\xdf-\xf6\xf8-\xff]+")
_NONE = np.int64(1) << np.int64(40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = (b for b in range(256) if b not in set(plain))
    out = dict.fromkeys(range(256), "") | {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(other)}
    return [out[b] for b in range(256)]


class Vocabulary:
    """A word-level BPE file as arrays: pair keys in order, their ranks and results, and the tokens' texts."""

    def __init__(self, name: str):
        import public_tokenizers as P
        from tokenizers import Tokenizer

        path = P.path(f"{name}.json")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        vocab, suffix = spec["model"]["vocab"], spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        letters = byte_letters()
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        self.of_last = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.byte_of = {c: b for b, c in enumerate(letters)}
        left, right = (np.array([vocab[m[k]] for m in spec["model"]["merges"]], np.int64) for k in (0, 1))
        result = np.array([vocab["".join(m)] for m in spec["model"]["merges"]], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys)
        kind = np.uint32 if self.size < 1 << 16 else np.int64
        self.keys, self.ranks, self.results = keys[order].astype(kind), order.astype(np.int64), result[order]
        self.token = [""] * self.size
        for text, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = text
        self.words: dict[str, bytes] = {}

    @cached_property
    def lookup(self) -> dict[int, tuple[int, int]]:
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.results.tolist())))

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (_NONE if unknown) and result of each pair of symbols."""
        key = (left * self.size + right).astype(self.keys.dtype)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), self.results[at]

    def split(self, text: str) -> list[str]:
        """The normalised words of a text."""
        if PLAIN.fullmatch(text):
            return PLAIN_WORD.findall(text.lower())
        out = []
        for chunk in SPACE.split(text):  # neither normalising nor words reach across white space
            if PLAIN.fullmatch(chunk):
                out += PLAIN_WORD.findall(chunk.lower())
            else:
                found = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
                out += [bytes(map(self.byte_of.__getitem__, w)).decode() for w, _ in found]
        return out


@lru_cache(maxsize=1)
def vocabulary(name: str = VOCABULARY) -> Vocabulary:
    hold(__name__, vocabulary.cache_clear)
    return Vocabulary(name)


def merge_queue(symbols: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The symbols of one word after all merges, lowest rank and leftmost first."""
    s, n = symbols.tolist(), len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank, result = v.pairs(symbols[:-1], symbols[1:])
    heap = [(r, i, x, s[i], s[i + 1]) for i, (r, x) in enumerate(zip(rank.tolist(), result.tolist())) if r < _NONE]
    heapq.heapify(heap)
    while heap:
        _, i, x, a, b = heapq.heappop(heap)
        j = after[i]
        if s[i] != a or j >= n or s[j] != b:
            continue
        s[i], s[j] = x, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for p in (before[i], i):
            q = after[p] if p >= 0 else n
            known = v.lookup.get(s[p] * v.size + s[q]) if p >= 0 and q < n else None
            if known:
                heapq.heappush(heap, (known[0], p, known[1], s[p], s[q]))
    return np.array([x for x in s if x >= 0], np.int64)


def merge_rounds(symbols: np.ndarray, word: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Merge the symbols of many words; ``word`` numbers each symbol's word, in order. Both shrink together.

    rank and result belong to the pair of a symbol and the next one (none at the
    end of a word); a merge changes only its own pair and the one before.
    """
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank, result = v.pairs(symbols[:-1], symbols[1:])
    rank = np.append(np.where(word[:-1] == word[1:], rank, _NONE), _NONE)[:len(symbols)]
    result = np.append(result, 0)[:len(symbols)]
    while len(symbols):
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
        over = lowest == _NONE
        if over.any():
            done.append((symbols[over], word[over]))
            symbols, word, rank, result, lowest = (x[~over] for x in (symbols, word, rank, result, lowest))
            if not len(symbols):
                break
        at = np.flatnonzero(rank == lowest)
        start = np.append(True, np.diff(at) != 1)  # in a run of one symbol every other pair merges
        number = np.arange(len(at)) - np.flatnonzero(start)[np.cumsum(start) - 1]
        at = at[number % 2 == 0]
        symbols[at] = result[at]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        at = (np.cumsum(stays) - 1)[at]
        symbols, word, rank, result = (x[stays] for x in (symbols, word, rank, result))
        changed = np.zeros(len(symbols), bool)
        changed[at] = changed[np.maximum(at - 1, 0)] = True
        at = np.flatnonzero(changed)
        on = np.minimum(at + 1, len(symbols) - 1)
        new, result[at] = v.pairs(symbols[at], symbols[on])
        rank[at] = np.where((word[at] == word[on]) & (on > at), new, _NONE)
    symbols, word = (np.concatenate([np.zeros(0, np.int64), *(d[k] for d in done)]) for k in (0, 1))
    order = np.argsort(word, kind="stable")
    return symbols[order], word[order]


def encode_words(words: list[bytes], v: Vocabulary) -> list[bytes]:
    """The ids of each word, as little-endian unsigned 32-bit integers."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    symbols = v.of_byte[raw]
    ends = np.cumsum(lengths)
    symbols[ends[lengths > 0] - 1] = v.of_last[raw[ends[lengths > 0] - 1]]
    word = np.repeat(np.arange(len(words)), lengths)
    long = lengths > LONG
    short = ~long[word]
    merged, of = merge_rounds(symbols[short], word[short], v)
    ids, at = merged.astype("<u4").tobytes(), 4 * np.searchsorted(of, np.arange(len(words) + 1))
    out = [ids[i:j] for i, j in zip(at.tolist(), at[1:].tolist())]
    for i in np.flatnonzero(long):
        out[i] = merge_queue(symbols[ends[i] - lengths[i]:ends[i]], v).astype("<u4").tobytes()
    return out


def encode_batch(batch: list[str], v: Vocabulary) -> list[bytes]:
    """The ids of each text. Special tokens spelled in a text become their ids, as the file's library has it."""
    known, cut, fresh = v.words, [], set()
    if len(known) > CACHE_WORDS:
        known.clear()
    if not known:
        known.update((t, np.array([i], "<u4").tobytes()) for t, i in v.special.items())
    for text in batch:
        words = []
        for piece in v.at_special.split(text) if v.special else [text]:
            words += [piece] if piece in v.special else v.split(piece)
        cut.append(words)
        fresh.update(words)
    new = [w for w in fresh if w not in known]
    known.update(zip(new, encode_words([w.encode() for w in new], v)))
    out = [b"".join(map(known.__getitem__, words)) for words in cut]
    for w in new:
        if len(w) > CACHE_LENGTH:
            del known[w]
    return out


def encode(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers, packed) of every row's whole text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(encode_batch(texts(batch), vocabulary(name)), pa.binary())],
            names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                     run, ENCODED, 256)


def decode(encoded: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and the decoded text: the tokens, special ones too, with a space between any two."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        token = vocabulary(name).token
        decoded = [" ".join(map(token.__getitem__, np.frombuffer(x or b"", "<u4").tolist()))
                   for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(decoded, pa.string())],
                                          names=["doc_id", "ids", "decoded"])

    return map_arrow(encoded.select("doc_id", "ids"), run, DECODED, 256)
