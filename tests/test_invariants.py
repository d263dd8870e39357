"""Invariants over the mapped test tables (SURVEY section 5 (c))."""

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.plans import kpis


def test_one_fact_row_per_claim(wh):
    f = wh.fact
    assert f.count() == f.select("claim_id").distinct().count()
    assert f.count() == wh.claim_detail.select("claim_id").distinct().count()


def test_aging_totals_match_denials_of_types_with_average(wh):
    f = wh.fact
    typed = kpis.avg_paid_by_type(f).select("claim_type")
    denied = f.filter(F.col("adjudication_status") == C.DENIED).join(typed, "claim_type").count()
    totals = kpis.ar_aging_totals(kpis.ar_aging_matrix(f))
    assert totals.agg(F.sum("claim_count")).first()[0] == denied


def test_preventability_counts_equal_reason_counts(wh):
    top = kpis.top_carc_denials(wh.fact, wh.dim_carc_denials, sort=False)
    mix = kpis.preventability_mix(top)
    assert mix.agg(F.sum("denial_count")).first()[0] == top.agg(F.sum("denial_count")).first()[0]


def test_extremes_at_most_twenty(wh):
    ext = kpis.provider_extremes(kpis.clean_claim_rate_by_provider(wh.fact, sort=False))
    rows = ext.collect()
    assert len(rows) <= 2 * C.EXTREMES_SIZE
    assert sum(r.rank_group == C.RANK_BOTTOM for r in rows) == min(C.EXTREMES_SIZE, len(rows))


def test_every_denied_claim_has_a_code(wh):
    f = wh.fact
    assert f.filter((F.col("adjudication_status") == C.DENIED) & F.col("carc_code").isNull()).count() == 0
    assert f.filter((F.col("adjudication_status") != C.DENIED) & F.col("carc_code").isNotNull()).count() == 0


def test_expected_counts_sf0001(wh):
    # FIXTURES.md section 4, sf0.001 column
    r = kpis.clean_claim_rate(wh.fact).first()
    assert (r.total_claims, r.denied_claims) == (1473, 81)
    buckets = {x.ar_aging_bucket: x["count"] for x in
               wh.fact.filter(F.col("adjudication_status") == C.DENIED).groupBy("ar_aging_bucket").count().collect()}
    assert buckets == {"0-30": 1, "90+": 80}
    assert wh.fact.select("provider_id").distinct().count() == 10
