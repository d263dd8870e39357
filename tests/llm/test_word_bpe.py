import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from helpers import CLASH, docs, odd_rows, prose
from tokenizers import Tokenizer

from claimlens.llm import queries
from claimlens.llm import word_bpe as W


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def wild(seed, n=3000):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghij '") if rng.random() < 0.9 else rng.choice("Σ İßéÉ 　\x1c\x85<|5!?'sTLḾ\U0001F600")
                   for _ in range(n))


def same(library, batch):
    got = [np.frombuffer(x, "<u4").tolist() for x in W.encode_batch(batch, W.vocabulary())]
    assert got == [e.ids for e in library.encode_batch(batch, add_special_tokens=False)]


def test_ids_are_the_librarys(library):
    rng = random.Random(2)
    batch = [wild(i) for i in range(40)] + [t or "" for _, t in odd_rows()]
    batch += ["<|endoftext|>A<|startoftext|> b<|endoftext|", "<|endoftext|>" * 3, "it's I'LL 'S 's's 123 ab12 Ünïcode don't",
              "a" * 5001 + "b", "ab" * 3000, "".join(rng.choice("abcdefgh") for _ in range(20_000))]
    same(library, batch)
    same(library, batch[::-1])  # from the chunks met before, too


def test_every_code_point(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    same(library, ["a" + "b ".join(points[i:i + 200]) + "C" for i in range(0, len(points), 200)])


def test_queue_and_rounds_agree():
    v, rng = W.vocabulary(), random.Random(9)
    words = [bytes(rng.choice(b"abcde") for _ in range(rng.randint(1, 300))) for _ in range(200)] + [b"a" * k for k in range(1, 40)]
    for word, ids in zip(words, W.encode_words(words, v)):
        raw = np.frombuffer(word, np.uint8)
        assert W.merge_queue(np.append(v.of_byte[raw[:-1]], v.of_last[raw[-1]]), v).tolist() == np.frombuffer(ids, "<u4").tolist()
    assert W.encode_words([], v) == []


def test_tables_equal_the_library(spark, library):
    rows = odd_rows() + [(100 + i, prose(i)) for i in range(50)] + [(200, wild(7))]
    got = W.decode(W.encode(docs(spark, rows, CLASH).repartition(4))).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in got), key=str) == \
        sorted(want, key=str)


def test_query_over_the_whole_table(spark, sf_dir, library):
    got = {r["doc_id"]: r for r in queries.op12_word_bpe(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert tuple(got[i]) == (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                 hashlib.sha256(decoded.encode()).hexdigest())


def test_empty_table(spark):
    assert W.decode(W.encode(docs(spark, []))).count() == 0
