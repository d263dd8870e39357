"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import (alignment, decontaminate, filter_audit, line_dedup, lm, near_dedup, packing, quality, topk,
                           toxicity, url_filter, warc, word_bpe)
from claimlens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(100)) == 0)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = word_bpe.decode(word_bpe.encode(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


# Base32 of the 160 bits of a SHA-1: four groups of 40 bits, eight digits each.
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT *, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS f FROM p)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
         (CAST('0x' || substr(h, 1 + 10 * (k // 8), 10) AS BIGINT) >> (35 - 5 * (k % 8))) & 31 AS INTEGER) + 1, 1)
         FOR k IN range(32)], '') AS payload_digest,
       CASE WHEN f IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f IS DISTINCT FROM page_id THEN f END AS refers_to
FROM d
"""


# Every item against every document by shared windows of five words (of all words, where a part has fewer).
OP3_SQL = r"""
WITH items AS (SELECT DISTINCT item_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS t FROM benchmark WHERE item_id IS NOT NULL),
cut AS (
  SELECT item_id, CASE WHEN contains(t, chr(10)) THEN regexp_extract(t, '(?s)^(.*)\n([^\n]*)$', ['q', 'a'])
                       WHEN regexp_matches(t, '(?s)[.!?]\s') THEN regexp_extract(t, '(?s)^(.*[.!?]\s+)(.*)$', ['q', 'a'])
                       ELSE {'q': t, 'a': ''} END AS c FROM items),
parts AS (
  SELECT item_id, part, regexp_extract_all(lower(CASE part WHEN 1 THEN c.q ELSE c.a END), '[\p{L}\p{N}_]+') AS w
  FROM cut, (VALUES (1), (2)) v(part)),
wanted AS (
  SELECT DISTINCT item_id, part, least(5, len(w)) AS k, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM parts WHERE len(w) > 0)),
need AS (SELECT item_id, part, COUNT(*) AS n FROM wanted GROUP BY 1, 2),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL),
runs AS (
  SELECT r, doc_id, ks.k, array_to_string(w[i:i + ks.k - 1], ' ') AS gram
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs) d, (SELECT DISTINCT k FROM wanted) ks
  WHERE i + ks.k - 1 <= len(w)),
have AS (SELECT DISTINCT r, doc_id, k, gram FROM runs),
hits AS (SELECT r, doc_id, item_id, part, COUNT(*) AS n FROM have JOIN wanted USING (k, gram) GROUP BY ALL)
SELECT doc_id, item_id FROM hits JOIN need USING (item_id, part) WHERE hits.n >= 0.8 * need.n
GROUP BY r, doc_id, item_id HAVING COUNT(*) = (SELECT COUNT(*) FROM need x WHERE x.item_id = hits.item_id)
"""


# Cells of (part, failures) against all 120 orders, step by step.
OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS part, coalesce(text, '') AS t, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(min(doc_id) OVER (PARTITION BY coalesce(text, '')) < doc_id, false) AS e FROM documents),
cells AS (
  SELECT part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, e,
         COUNT(*) AS n, COUNT(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS good,
         COUNT(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS toxic
  FROM d GROUP BY ALL),
failed AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
                  || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS f, n, good, toxic FROM cells),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM l p, l q, l r, l s, l t
           WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, CAST(k AS INTEGER) AS step, filter_order[k] AS x, left(filter_order, k - 1) AS before
          FROM orders, (SELECT unnest(range(1, 6)) AS k)),
told AS (
  SELECT part, filter_order, step, x,
         CAST(SUM(CASE WHEN translate(f, before || x, '') = f THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(SUM(CASE WHEN contains(f, x) AND translate(f, before, '') = f THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(SUM(CASE WHEN contains(f, x) AND translate(f, before, '') <> f THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(SUM(CASE WHEN f = x THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(SUM(CASE WHEN contains(f, x) AND translate(f, before, '') = f THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(SUM(CASE WHEN contains(f, x) AND translate(f, before, '') = f THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM failed, steps GROUP BY ALL)
SELECT * EXCLUDE (x), CAST(SUM(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM told
"""


def _op9_sql() -> str:
    """Rules, then the two Markov models order by order, the calibrated threshold and the verdicts."""
    host = "translate(regexp_extract(url[strpos(url, '://') + 3:], '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract(url[strpos(url, '://') + 3:], '^[^/?#]*([^?#]*)', 1)"
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}') THEN " for _, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {f}'{h}{p}'" for f, (_, h, p) in zip(fits, rules)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f}'{v}'" for f, (v, _, _) in zip(fits, rules)) + " END"
    k_max, least, limit, bins = url_filter.ORDER, url_filter.MIN_CONTEXT, url_filter.LIMIT, url_filter.BINS
    orders = []
    for k in range(k_max + 1):
        shorter = f"JOIN p{k - 1} l ON l.gram = right(g.gram, {k})" if k else \
            f"CROSS JOIN (SELECT 1.0::DOUBLE / {url_filter.ALPHABET} AS pa, 1.0::DOUBLE / {url_filter.ALPHABET} AS pr) l"
        mix = lambda n, total, kinds, p: (
            f"CASE WHEN {total} >= {least} THEN (g.{n} + {kinds} * l.{p}) / CAST({total} + {kinds} AS DOUBLE) ELSE l.{p} END AS {p}")
        orders.append(f"""
g{k} AS (SELECT right("window", {k + 1}) AS gram, left(right("window", {k + 1}), {k}) AS context,
         CAST(SUM(a) AS BIGINT) AS a, CAST(SUM(r) AS BIGINT) AS r FROM every GROUP BY 1, 2),
c{k} AS (SELECT context, CAST(SUM(a) AS BIGINT) AS na, CAST(SUM(r) AS BIGINT) AS nr, COUNT(*) FILTER (WHERE a > 0) AS ta,
         COUNT(*) FILTER (WHERE r > 0) AS tr FROM g{k} GROUP BY 1),
p{k} AS (SELECT g.gram, {mix('a', 'na', 'ta', 'pa')}, {mix('r', 'nr', 'tr', 'pr')}
         FROM g{k} g JOIN c{k} c USING (context) {shorter})""")
    below = "(ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
WITH parts AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN {host} ELSE '' END AS host,
                      CASE WHEN contains(url, '://') THEN {path} ELSE '' END AS path FROM pages),
ruled AS (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM parts),
urls AS (SELECT url, by_rule, COUNT(*) AS n, CAST('0x' || md5(url)[1:8] AS BIGINT) % {url_filter.CALIBRATION} = 0 AS kept
         FROM ruled WHERE url IS NOT NULL GROUP BY url, by_rule),
padded AS (SELECT *, repeat(chr(2), {k_max}) || url || chr(3) AS s FROM urls),
windows AS (SELECT url, by_rule, n, kept, substr(s, i, {k_max + 1}) AS "window"
            FROM (SELECT *, unnest(range(1, length(url) + 2)) AS i FROM padded)),
every AS (SELECT "window", SUM(CASE WHEN by_rule = 'allow' AND NOT kept THEN n ELSE 0 END) AS a,
                 SUM(CASE WHEN by_rule = 'block' AND NOT kept THEN n ELSE 0 END) AS r FROM windows GROUP BY 1),
{",".join(orders)},
scored AS (SELECT url, any_value(by_rule) AS by_rule, any_value(n) AS n,
                  CAST(SUM(CAST(round((ln(pa) - ln(pr)) * {url_filter.UNIT}) AS BIGINT)) AS DOUBLE) / COUNT(*) / {url_filter.UNIT} AS score
           FROM windows JOIN p{k_max} ON gram = "window" WHERE kept OR by_rule IS NULL GROUP BY url),
bins AS (SELECT CAST(floor(greatest(-{limit}, least({limit}, score)) * {bins}) AS BIGINT) AS bin,
                CAST(SUM(CASE WHEN by_rule = 'allow' THEN n ELSE 0 END) AS DOUBLE) AS a,
                CAST(SUM(CASE WHEN by_rule = 'block' THEN n ELSE 0 END) AS DOUBLE) AS r
         FROM scored WHERE by_rule IS NOT NULL GROUP BY 1),
best AS (SELECT bin, 1 - coalesce(SUM(a) OVER {below}, 0) / nullif(SUM(a) OVER (), 0)
                       + coalesce(SUM(r) OVER {below}, 0) / nullif(SUM(r) OVER (), 0) AS share FROM bins),
chosen AS (SELECT coalesce((SELECT bin / {bins}.0 FROM best WHERE share IS NOT NULL ORDER BY share DESC, abs(bin), bin LIMIT 1), 0) AS t)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(ruled.by_rule, CASE WHEN score >= (SELECT t FROM chosen) THEN 'allow' ELSE 'block' END) AS verdict
FROM ruled LEFT JOIN scored ON scored.url = ruled.url
"""


def queries() -> dict[str, Query]:
    found = (op1_line_dedup, op2_lm_score, op3_decontamination, op4_best_fit_packing, op5_toxicity, op6_warc,
             op7_near_dedup, op8_topk, op9_url_filter, op10_quality, op11_alignment, op12_word_bpe, op13_filter_audit)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": OP3_SQL, "op6_warc": OP6_SQL, "op8_topk": OP8_SQL, "op9_url_filter": _op9_sql(),
            "op13_filter_audit": OP13_SQL}
