import base64
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import sentencepiece
from helpers import CLASH, docs, odd_rows, prose
from tokenizers import Tokenizer

from claimlens.llm import alignment as A
from claimlens.llm import queries


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        of = {int(i): base64.b64decode(x) for x, i in map(bytes.split, f)}
    return a, of, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def groups(text, tokenizers):
    """Groups of one text as lists of (A ids, B ids), token by token."""
    a, of, b = tokenizers
    if not text:
        return []
    raw = (" " + text).encode()
    xs, ys = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    as_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
                for p in map(b.id_to_piece, ys)]
    if b"".join(as_bytes) != raw or b"".join(of[x] for x in xs) != raw:
        return []
    out, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
    while i < len(xs) or j < len(ys):
        if at_a <= at_b and i < len(xs):
            out[-1][0].append(xs[i])
            at_a += len(of[xs[i]])
            i += 1
        else:
            out[-1][1].append(ys[j])
            at_b += len(as_bytes[j])
            j += 1
        if at_a == at_b:
            out.append(([], []))
    return out[:-1]


def plain(rows, tokenizers):
    every, held = [groups(t, tokenizers) for _, t in rows], Counter()
    links = [Counter((x, y) for a, b in g for x in a for y in b) for g in every]
    for one in links:
        held.update(one.keys())
    best = {}
    for (x, _), n in held.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (i, _), g, one in zip(rows, every, links):
        w = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
                    sum(n for k, n in one.items() if held[k] == best[k[0]]), sum(n * held[k] for k, n in one.items()),
                    hashlib.sha256(w.encode()).hexdigest() if w else ""))
    return out, held


def corpus():
    rng = random.Random(3)
    rows = odd_rows() + [(20 + i, prose(i % 25, 2, 30)) for i in range(60)]
    rows += [(100 + i, "".join(rng.choice("abcdeÉßñ日本語 \n\t=.▁" if i % 4 == 0 else "abcdeÉßñ日本語 \n\t=-.") for _ in range(400)))
             for i in range(30)]
    return rows + [(200, "a ▁ b"), (201, "<s> </s> <unk> <0x41> <|endoftext|>"), (202, "=" * 3000 + "-" * 500), (203, "  x  ")]


@pytest.mark.parametrize("block", [A.BLOCK, 3000])
def test_equals_a_plain_alignment(spark, tokenizers, block):
    rows = corpus()
    got = A.align(docs(spark, rows, CLASH).repartition(5), block_bytes=block)
    assert got.columns == [c.split()[0] for c in A.ALIGNED.split(", ")]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows, tokenizers)[0], key=str)


def test_groups_and_counts(spark, tokenizers):
    rows = corpus()
    got = {r["doc_id"]: r["groups"] for r in A.aligned_groups(docs(spark, rows)).collect() if r["doc_id"] and r["doc_id"] > 10}
    for i, t in rows:
        if i and i > 20:
            assert got[i] == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups(t, tokenizers))
    counts = A.link_counts(docs(spark, rows).repartition(3)).collect()
    assert {(r["a"], r["b"]): r["documents"] for r in counts} == plain(rows, tokenizers)[1]
    assert len(counts) == len(plain(rows, tokenizers)[1])


def test_pairs_made_in_small_steps():
    block = A.Block([t or "" for _, t in corpus()], A.pair())
    for (x, n), (y, m) in zip(block.pairs(), block.pairs(7)):
        assert x.tolist() == y.tolist() and n.tolist() == m.tolist()
    assert sum(n.sum() for _, n in block.pairs()) == block.n_links.sum()


def test_identity_map(tokenizers):
    p = A.pair()
    known = [i for i in range(p.a_size) if p.same[i] >= 0]
    assert len(known) > 5000 and all(p.a_bytes[i] == p.b_bytes[p.same[i]] for i in known)


def test_query_over_the_whole_table(spark, sf_dir, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op11_alignment(spark, sf_dir).collect())) == sorted(plain(rows, tokenizers)[0])


def test_empty_table(spark):
    assert A.align(docs(spark, [])).count() == 0
    assert A.align(docs(spark, [(1, None), (2, "")])).select("n_links", "groups_sha256").distinct().collect() == [(0, "")]
