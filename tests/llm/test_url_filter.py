import collections
import hashlib
import math
import random

import pytest

from claimlens.llm import url_filter as U


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), tail[:end]


def rule(host, path):
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def plain(rows):
    counts = collections.Counter(u for _, u in rows if u is not None)
    grams = {c: [collections.Counter() for _ in range(U.ORDER + 1)] for c in ("allow", "block")}
    held = {}
    for u, n in counts.items():
        v = rule(*parts(u))[1]
        kept = int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % U.CALIBRATION == 0
        if v and kept:
            held[u] = v
        if v and not kept:
            s = U._START * U.ORDER + u + U._END
            for i in range(U.ORDER, len(s)):
                for k in range(U.ORDER + 1):
                    grams[v][k][s[i - k:i + 1]] += n
    contexts = {c: [collections.defaultdict(lambda: [0, 0]) for _ in range(U.ORDER + 1)] for c in grams}
    for c in grams:
        for k in range(U.ORDER + 1):
            for g, n in grams[c][k].items():
                contexts[c][k][g[:-1]][0] += n
                contexts[c][k][g[:-1]][1] += 1

    def probability(c, window):
        p = 1 / U.ALPHABET
        for k in range(U.ORDER + 1):
            g = window[len(window) - k - 1:]
            total, kinds = contexts[c][k].get(g[:-1], (0, 0))
            if total >= U.MIN_CONTEXT:
                p = (grams[c][k][g] + kinds * p) / (total + kinds)
        return p

    def score(u):
        s = U._START * U.ORDER + u + U._END
        total = sum(round((math.log(probability("allow", w)) - math.log(probability("block", w))) * U.UNIT)
                    for w in (s[i - U.ORDER:i + 1] for i in range(U.ORDER, len(s))))
        return total / (len(u) + 1) / U.UNIT

    bins = collections.defaultdict(lambda: [0, 0])
    for u, v in held.items():
        bins[math.floor(max(-U.LIMIT, min(U.LIMIT, score(u))) * U.BINS)][v == "block"] += counts[u]
    a, r = (sum(x[j] for x in bins.values()) for j in (0, 1))
    threshold = 0.0
    if a and r:
        best = [(-(1 - sum(x[0] for c, x in bins.items() if c < b) / a + sum(x[1] for c, x in bins.items() if c < b) / r),
                 abs(b), b) for b in bins]
        threshold = min(best)[2] / U.BINS
    out = []
    for i, u in rows:
        host, path = parts(u)
        name, verdict = rule(host, path)
        s = None if u is None or verdict else score(u)
        out.append((i, host, path, name, verdict or ("allow" if s is not None and s >= threshold else "block"), s))
    return out


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(400):
        host = rng.choice(["news", "blog.kaban", "shop", "Casino-WIN", "www.fil"]) + "." + rng.choice(
            ["example.net", "example.com", "example.org", "org", "net"])
        path = rng.choice(["/en/", "/fr/", "/de/", "/", ""]) + rng.choice(["", str(rng.randint(1, 99)), "a.html"])
        rows.append((i, f"http{'s' * rng.randint(0, 1)}://{host}{path}{rng.choice(['', '?q=/x', '#t'])}"))
    rows += [(500, None), (501, ""), (502, "no scheme"), (503, "http://"), (None, "http://net/"), (504, "x://net"),
             (505, "http://notnet.example/"), (506, "a://NET/?x#y"), (507, "http://ünet.org/fr/é"), (508, "http://a.org/fr"),
             (509, "http://h/" + "p" * 5000), (509, "http://h/" + "p" * 5000), (510, "a://b://net/"), (511, "u://org\n/fr/")]
    return rows


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h") for i, u in rows], "page_id long, url string, html string").selectExpr(
        "*", "'x' as host", "1 as n", "'k' as `key`", "2 as score")


def compare(got, expected):
    got, expected = (sorted((tuple(r) for r in x), key=lambda r: str(r[:5])) for x in (got, expected))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    for g, e in zip(got, expected):
        assert g[5] == (None if e[5] is None else pytest.approx(e[5], abs=2e-6))


def test_matches_plain_version(spark):
    rows = corpus()
    compare(U.judge_urls(pages(spark, rows).repartition(4)).collect(), plain(rows))


def test_one_class_and_empty_table(spark):
    rows = [(i, f"http://a{i}.net/x") for i in range(20)] + [(50, "http://else.where/y"), (51, None)]
    compare(U.judge_urls(pages(spark, rows)).collect(), plain(rows))
    assert U.judge_urls(pages(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    text = U.judge_urls(pages(spark, corpus()))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
