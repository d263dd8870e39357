"""URL filter: rules first, then a character language-model ratio; DataFrame operations only.

URLs that a rule allows or blocks are the accepted and rejected training
URLs. For each class a variable-order Markov model gives the probability of a
character after its longest known context of up to ``ORDER`` characters,
smoothed towards the shorter contexts by Witten-Bell weights down to a uniform
distribution. A URL's score is the difference of the two log-likelihoods over
its number of characters. A fifth of the training URLs is kept from counting
and calibrates the threshold (the best balanced accuracy).

Counting is per distinct URL with its number of rows, so copies of a URL are
one row early on. The scores are sums of whole micronats: they repeat exactly.

Definitions: a URL that is null or has no "://" has an empty host and path and
no rule. A null URL has no score and is blocked; an empty one is scored like
any text. Where one class has no training URL, the threshold is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import stored

# Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4
ALPHABET = 256       # of the uniform distribution that unknown characters get
MIN_CONTEXT = 2      # a context counts from so many occurrences
CALIBRATION = 5      # one training URL in so many
BINS = 1000          # of a threshold, per nat
LIMIT = 20           # nats; scores beyond are in the last bin
UNIT = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\x02", "\x03"


def host_of(url: Column) -> Column:
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, _UPPER, _LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(url.substr(at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and path, like ``net/``) and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, f"{h}{p}").otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _windows(urls: DataFrame, *columns: str) -> DataFrame:
    """A row for each character and the end of each URL: the context of ORDER characters, then it."""
    chars = F.split(F.concat(F.lit(_START * ORDER), "url", F.lit(_END)), "")
    at = F.sequence(F.lit(1), F.size("chars") - F.lit(ORDER))
    windows = F.transform(at, lambda i: F.array_join(F.slice("chars", i, ORDER + 1), ""))
    return (urls.withColumn("chars", F.filter(chars, lambda c: c != ""))
            .select(*columns, F.explode(windows).alias("window")))


def _tail(c: str, k: int) -> Column:
    """The last k characters."""
    return F.col(c).substr(F.length(c) - (k - 1), F.lit(k)) if k else F.lit("")


def _head(c: str) -> Column:
    """All but the last character."""
    return F.col(c).substr(F.lit(1), F.length(c) - 1)


def models(counts: DataFrame) -> DataFrame:
    """(window, delta): log P(character | context) accepted less rejected, in micronats.

    ``counts`` has each window that is to be scored with its counts a and r in
    accepted and rejected training URLs. Order by order, the probability of
    each n-gram is mixed from its context's counts and the shorter n-gram.
    """
    shorter = None
    for k in range(ORDER + 1):
        grams = (counts.groupBy(_tail("window", k + 1).alias("gram"))
                 .agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
                 .withColumn("context", _head("gram")))
        contexts = grams.groupBy("context").agg(
            F.sum("a").alias("na"), F.sum("r").alias("nr"),
            F.count_if(F.col("a") > 0).alias("ta"), F.count_if(F.col("r") > 0).alias("tr"))
        both = grams.join(contexts, "context")
        if shorter is None:
            both = both.withColumn("pa", F.lit(1.0 / ALPHABET)).withColumn("pr", F.lit(1.0 / ALPHABET))
        else:
            both = both.withColumn("less", _tail("gram", k)).join(shorter, "less")

        def mixed(n: str, total: str, kinds: str, p: str) -> Column:
            known = F.col(total) >= MIN_CONTEXT
            return F.when(known, (F.col(n) + F.col(kinds) * F.col(p)) / (F.col(total) + F.col(kinds))).otherwise(F.col(p))

        probabilities = both.select("gram", mixed("a", "na", "ta", "pa").alias("pa"), mixed("r", "nr", "tr", "pr").alias("pr"))
        shorter = probabilities.withColumnRenamed("gram", "less")
    delta = F.round((F.log("pa") - F.log("pr")) * UNIT).cast("long")
    return probabilities.select(F.col("gram").alias("window"), delta.alias("delta"))


def _threshold(scored: DataFrame) -> float:
    """The score at which accepted and rejected calibration URLs are told apart best (0 without both)."""
    bin_of = F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.col("score"))) * BINS)
    bins = scored.groupBy(bin_of.alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("r"))
    everything = Window.partitionBy(F.lit(0))  # over at most 2 * LIMIT * BINS + 1 rows
    below = everything.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    share = (F.lit(1) - F.coalesce(F.sum("a").over(below), F.lit(0)) / F.nullif(F.sum("a").over(everything), F.lit(0))
             + F.coalesce(F.sum("r").over(below), F.lit(0)) / F.nullif(F.sum("r").over(everything), F.lit(0)))
    best = bins.select("bin", share.alias("share")).filter(F.col("share").isNotNull())
    row = best.orderBy(F.col("share").desc(), F.abs("bin"), "bin").first()
    return row["bin"] / BINS if row else 0.0


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """Every page: page_id, host, path, rule, verdict and score (of URLs without a rule).

    Repeated rows are judged alike; an empty table gives no rows.
    """
    url = F.col("url").cast("string")
    rows = pages.select(F.col("page_id"), url.alias("url"))
    key = F.unhex(F.md5(F.col("url").cast("binary")))
    rule, verdict = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    urls = stored(rows.filter(F.col("url").isNotNull()).groupBy("url").agg(F.count(F.lit(1)).alias("n"))
                  .select("url", "n", key.alias("key"), verdict.alias("verdict"))
                  .withColumn("kept", F.conv(F.substring(F.md5(F.col("url").cast("binary")), 1, 8), 16, 10).cast("long")
                              % CALIBRATION == 0), "urls")
    training = urls.filter(F.col("verdict").isNotNull() & ~F.col("kept"))
    judged = urls.filter(F.col("verdict").isNull() | F.col("kept"))
    seen = _windows(training, "verdict", "n").groupBy("window").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("r"))
    asked = _windows(judged, "key")
    every = (seen.unionByName(asked.select("window").distinct().select("window", F.lit(0).cast("long").alias("a"),
                                                                        F.lit(0).cast("long").alias("r")))
             .groupBy("window").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    model = stored(models(stored(every, "windows")), "model")
    sums = asked.join(model, "window").groupBy("key").agg(F.sum("delta").alias("total"), F.count(F.lit(1)).alias("size"))
    scored = stored(judged.join(sums, "key").select(
        "key", "verdict", "n", (F.col("total") / F.col("size") / F.lit(UNIT)).alias("score")), "scored")
    threshold = _threshold(scored.filter(F.col("verdict").isNotNull()))
    by_model = scored.filter(F.col("verdict").isNull()).select(F.col("key").alias("s_key"), "score")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = (rows.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))
           .withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("key", key))
    out = out.join(by_model, F.col("key") == F.col("s_key"), "left")
    own = F.when(F.col("score") >= F.lit(threshold), "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), "score")
