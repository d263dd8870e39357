"""Small corpora and plain versions that the operators' tests share."""

import random
import re

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "pe", "ro", "sa", "ti", "vu", "za") for b in
         ("ban", "der", "fil", "gor", "hum", "jin", "kel", "lat", "mor", "nes")]
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def prose(seed, lines=4, words=20):
    rng = random.Random(seed)
    return "\n".join(sentence(rng, words) + "." for _ in range(lines))


def docs(spark, rows, clash=()):
    """A documents table of (doc_id, text) rows, with further columns of the given names."""
    full = [(i, t, "en", "src", None if t is None else len(t), *(f"own {c}" for c in clash)) for i, t in rows]
    return spark.createDataFrame(full, DOC_SCHEMA + "".join(f", `{c}` string" for c in clash))


CLASH = ("row", "key", "cuts", "maybe", "own", "left", "score", "text_hash", "chunk", "words", "__slot", "a b", "host")


def odd_rows():
    """Nulls, empty and long texts, repeated rows and odd characters."""
    long = prose("long", 400, 30)
    return [(1, prose(1)), (2, None), (3, ""), (None, prose(2)), (None, None), (4, "   \n\n \t"), (5, prose(1)),
            (5, prose(1)), (6, long), (7, "x" * 70_000), (8, "é ü \U0001F600 \x00 end"), (9, "one"), (10, prose(10)),
            (10, prose(11)), (11, "<|endoftext|> and more <|endoftext|>")]


def words(text):
    return re.findall(r"\w+", (text or "").lower())
