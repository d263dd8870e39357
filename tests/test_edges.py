"""Hand-made edge frames (FIXTURES.md section 5) for what the mapped test
tables cannot show."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators import quality as Q
from claimlens.plans import dims, fact as factmod, kpis, quality, warehouse
from claimlens.sources import fixtures
from claimlens.sources.files import all_string_schema

SEG = fixtures.SEGMENT_COLUMNS


def seg(claim, paid, ctype="Outpatient", start="20100101", end="20100105", provider="P1",
        patient="B1", dx="4280"):
    row = {c: None for c in SEG}
    row.update(CLM_ID=claim, DESYNPUF_ID=patient, PRVDR_NUM=provider, CLM_FROM_DT=start,
               CLM_THRU_DT=end, CLM_PMT_AMT=paid, NCH_PRMRY_PYR_CLM_PD_AMT="0",
               ICD9_DGNS_CD_1=dx, CLAIM_TYPE=ctype)
    return tuple(row[c] for c in SEG)


BENE_COLS = ["DESYNPUF_ID", "BENE_BIRTH_DT", "BENE_DEATH_DT", "BENE_SEX_IDENT_CD", "BENE_RACE_CD",
             "SP_STATE_CODE", *C.CHRONIC_FLAGS]


def bene_frame(spark, rows):
    """rows: (id, birth, sex, year) -> a full beneficiary file frame."""
    full = [(i, b, None, s, "1", "01", *(["2"] * len(C.CHRONIC_FLAGS)), y) for i, b, s, y in rows]
    schema = ", ".join(f"{c} string" for c in BENE_COLS) + ", SNAPSHOT_YEAR int"
    return spark.createDataFrame(full, schema)


def build(spark, rows, lookup=None, bene=None):
    segments = spark.createDataFrame(rows, all_string_schema(SEG))
    bene = bene if bene is not None else [bene_frame(spark, [("B1", "19400101", "1", 2010)])]
    lookup = lookup if lookup is not None else fixtures.carc_lookup_raw(spark)
    return warehouse.from_raw(spark, segments, bene, lookup)


def test_empty_fact_gives_null_rates(spark):  # D15
    wh = build(spark, [])
    r = kpis.clean_claim_rate(wh.fact).first()
    assert (r.total_claims, r.denied_claims, r.clean_claim_rate_pct) == (0, 0, None)
    h = kpis.header_cards(wh.fact).first()
    assert h.total_expected_revenue is None and h.net_collection_ratio_pct is None
    assert kpis.clean_claim_rate_by_provider(wh.fact).count() == 0


def test_type_without_paid_claims(spark):  # D10, D22
    rows = [seg("1", "0", "Inpatient"), seg("2", None, "Inpatient"),
            seg("3", "100", "Outpatient"), seg("4", "300", "Outpatient"), seg("5", "0", "Outpatient")]
    wh = build(spark, rows)
    h = kpis.header_cards(wh.fact).first()
    # Expected revenue counts only the type with an average: 100 + 300 + 200 (denied proxy)
    assert h.total_expected_revenue == 600.0
    assert h.net_collection_ratio_pct == pytest.approx(400 * 100 / 600)
    # Clean rate counts every claim, including the type without an average
    assert h.clean_claim_rate_pct == pytest.approx(2 * 100 / 5)
    m = kpis.ar_aging_matrix(wh.fact)
    assert m.agg(F.sum("claim_count")).first()[0] == 1  # only the Outpatient denial
    totals = kpis.ar_aging_totals(m)
    assert totals.agg(F.sum("claim_count")).first()[0] == 1


def test_tied_snapshots_pick_deterministically(spark):  # D17
    bene = bene_frame(spark, [("B1", "19500101", "2", 2010), ("B1", "19400101", "1", 2010),
                              ("B1", "19300101", "1", 2009)])
    out = dims.dim_patient(bene).collect()
    assert len(out) == 1
    assert out[0].birth_dt == datetime.date(1940, 1, 1) and out[0].sex == "Male"


def test_negative_payment_is_paid(spark):  # D1
    wh = build(spark, [seg("1", "-25.5")])
    assert wh.fact.first().adjudication_status == C.PAID_FIRST_PASS


def test_segments_roll_up(spark):  # A2, D7
    rows = [seg("1", "10.25", start="20100110", end="20100112", provider=None),
            seg("1", "5.5", start="20100105", end="20100120", provider="P9")]
    f = build(spark, rows).fact_base.first()
    assert f.clm_pmt_amt == 15.75 and f.provider_id == "P9"
    assert f.clm_from_dt == datetime.date(2010, 1, 5) and f.clm_thru_dt == datetime.date(2010, 1, 20)


def test_start_after_as_of_is_current(spark):  # D16
    rows = [seg("1", "0", start="20100301", end="20100302"), seg("2", "5", start="20100101", end="20100201")]
    wh = build(spark, rows)
    f = {r.claim_id: r for r in wh.fact.collect()}
    assert f["1"].days_since_submission == 1 and f["1"].ar_aging_bucket == "0-30"
    assert f["2"].days_since_submission == 60 and f["2"].ar_aging_bucket == "31-60"
    # explicit as-of date
    base, draws = wh.fact_base, wh.carc_draws
    g = {r.claim_id: r for r in factmod.fact_claims(base, draws, as_of="2010-02-15").collect()}
    assert g["1"].days_since_submission == -14 and g["1"].ar_aging_bucket == "0-30"


def _draws(spark, lookup_rows, weights=None):
    lookup = dims.dim_carc_denials(spark.createDataFrame(lookup_rows, "c string, d string"))
    weights = factmod.carc_weights(spark) if weights is None else weights
    draws = factmod.carc_draws(factmod.carc_pool(weights, lookup)).first()["draws"]
    return {c: hi - lo for c, lo, hi in zip(draws["codes"], [0, *draws["ends"]], draws["ends"])}


def test_full_pool_draws_follow_weights(spark):
    assert _draws(spark, [(c, "x") for c, _ in C.CARC_WEIGHTS]) == dict(C.CARC_WEIGHTS)


def test_pool_renormalises_missing_codes(spark):  # D3: shares of 82, none lost or rounded
    present = {c: w for c, w in C.CARC_WEIGHTS if c != "18"}
    got = _draws(spark, [(c, "x") for c in present])
    assert got == present and sum(got.values()) == 82


def test_pool_of_many_codes_loses_none(spark):
    rows = [(i, f"Z{i:03d}", 1) for i in range(150)]
    weights = spark.createDataFrame(rows, "ordinal int, carc_code string, weight int")
    assert _draws(spark, [(c, "x") for _, c, _ in rows], weights) == {c: 1 for _, c, _ in rows}


def test_pool_falls_back_to_first_codes(spark):  # D3 fallback
    assert _draws(spark, [(f"Z{i:02d}", "x") for i in range(15)]) == {f"Z{i:02d}": 1 for i in range(10)}


def test_every_denied_claim_gets_a_code(spark):
    rows = [seg(str(i), "0") for i in range(200)]
    f = build(spark, rows).fact
    assert f.filter(F.col("carc_code").isNull()).count() == 0


def test_duplicate_claim_ids_and_accepted_values(spark):  # Q5, Q3
    f = spark.createDataFrame([("1", "0-30"), ("1", "0-30"), ("2", "120+")],
                              "claim_id string, ar_aging_bucket string")
    dup = quality.duplicate_claim_ids(f).collect()
    assert [(r.claim_id, r.c) for r in dup] == [("1", 2)]
    bad = Q.accepted_values_failures(f, "ar_aging_bucket", C.AGING_BUCKETS).collect()
    assert [r.ar_aging_bucket for r in bad] == ["120+"]
    assert Q.not_null_failures(f, "claim_id").count() == 0
    assert [r.claim_id for r in Q.unique_failures(f, "claim_id").collect()] == ["1"]


def test_rounding_midpoint_is_half_up(spark):  # D13
    rows = [seg("1", "0.5025", ctype="Outpatient"), seg("2", "0.5025", ctype="Outpatient")]
    out = kpis.claim_type_summary(build(spark, rows).fact).first()
    assert out.total_paid_amt == 1.01  # 1.005 rounds up


def test_orphans_include_null_patients(spark):  # J4
    rows = [seg("1", "5", patient="B1"), seg("2", "5", patient="B2"), seg("3", "5", patient=None)]
    wh = build(spark, rows)
    got = sorted(r.claim_id for r in quality.orphaned_claims(wh.fact, wh.dim_patient).collect())
    assert got == ["2", "3"]


def test_unmapped_diagnosis_skips_null_codes(spark):  # J5
    rows = [seg("1", "5", dx="4280"), seg("2", "5", dx="OTHER"), seg("3", "5", dx=None)]
    wh = build(spark, rows)
    got = [r.claim_id for r in quality.unmapped_diagnosis(wh.fact, wh.dim_diagnosis).collect()]
    assert got == ["2"]


def test_lookup_cleaning(spark):  # S4, X10
    out = {r.carc_code: r for r in dims.dim_carc_denials(fixtures.carc_lookup_raw(spark)).collect()}
    assert "45" in out and None not in out
    assert out["A1"].preventability_bucket == "Preventable - Process"
    assert out["ZZ"].preventability_bucket == C.UNCLASSIFIED


def test_header_scopes_and_no_overdue(spark):  # D10, D11
    rows = [seg("1", "0", "Inpatient", start="20100301", end="20100302"),
            seg("2", "100", "Outpatient", start="20100301", end="20100302"),
            seg("3", "0", "Outpatient", start="20100301", end="20100302")]
    wh = build(spark, rows)
    a = kpis.header_cards(wh.fact).first()
    j = kpis.header_cards(wh.fact, scope="joined").first()
    assert a.overdue_ar_90plus is None and j.overdue_ar_90plus is None  # no claim is 90+ days old
    assert a.clean_claim_rate_pct == pytest.approx(100 / 3)   # every claim
    assert j.clean_claim_rate_pct == pytest.approx(100 / 2)   # claims of types with an average


def test_header_cards_with_a_third_status_and_no_type(spark):
    """Any status but a denial counts its own amount; claims without a type are in the clean rate only."""
    from claimlens.plans import kpis
    rows = [("Paid - First Pass", "Inpatient", 100.0, "90+"), ("Paid - Resubmitted", "Inpatient", 50.0, "0-30"),
            ("Denied", "Inpatient", None, "90+"), ("Denied", "Outpatient", 0.0, "90+"),
            ("Paid - First Pass", None, 1000.0, "0-30")]
    fact = spark.createDataFrame(rows, "adjudication_status string, claim_type string, billed_paid_amt double, "
                                       "ar_aging_bucket string")
    paid = [a for s, t, a, _ in rows if s == "Paid - First Pass" and t == "Inpatient"]
    average = sum(paid) / len(paid)
    own = [(average if s == "Denied" else a, a or 0.0, s) for s, t, a, _ in rows if t == "Inpatient"]
    every, joined = kpis.header_cards(fact).first(), kpis.header_cards(fact, scope="joined").first()
    for r in (every, joined):
        assert r.total_expected_revenue == sum(e for e, _, _ in own) == 250.0
        assert r.net_collection_ratio_pct == 150.0 * 100 / 250.0
        assert r.overdue_ar_90plus == average
    assert every.clean_claim_rate_pct == pytest.approx(100 * 2 / 5)
    assert joined.clean_claim_rate_pct == pytest.approx(100 / 3)


def test_odd_payments_are_paid(spark):
    rows = [seg("1", "200000000000000"), seg("2", "0.00004"), seg("3", "NaN"), seg("4", "0"), seg("5", "1e300")]
    got = {r.claim_id: r.adjudication_status for r in build(spark, rows).fact.collect()}
    assert got == {"1": C.PAID_FIRST_PASS, "2": C.PAID_FIRST_PASS, "3": C.PAID_FIRST_PASS, "4": C.DENIED,
                   "5": C.PAID_FIRST_PASS}


def test_average_is_over_the_rows_of_its_sum(spark):
    from claimlens.plans import kpis
    rows = [(C.PAID_FIRST_PASS, "Inpatient", 2e14), (C.PAID_FIRST_PASS, "Inpatient", 100.0)]
    fact = spark.createDataFrame(rows, "adjudication_status string, claim_type string, billed_paid_amt double")
    assert kpis.avg_paid_by_type(fact).first().avg_paid_amt == (2e14 + 100) / 2


def test_flag_column_that_no_year_has_is_an_error(spark, sf_dir):
    from claimlens.sources import fixtures
    years = [df.drop("SP_CHF") for df in fixtures.beneficiary_files(spark, sf_dir)]
    with pytest.raises(ValueError, match="SP_CHF"):
        dims.dim_patient(dims.beneficiaries(years))


def test_report_counts_failing_tests(spark):
    """The one-pass report and the failing rows agree where every test fails."""
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("b", "z"), (None, "z"), (None, None)],
                               "k string, v string")
    tests = [Q.SchemaTest("t", "k", "unique"), Q.SchemaTest("t", "k", "not_null"),
             Q.SchemaTest("t", "v", "accepted_values", ("x",)), Q.SchemaTest("t", "v", "unique")]
    got = {(r["column"], r["test"]): r["n_failing"] for r in Q.test_report({"t": df}, tests).collect()}
    assert got == {("k", "unique"): 2, ("k", "not_null"): 2, ("v", "accepted_values"): 2, ("v", "unique"): 1}
    assert all(t.failures(df).count() == got[t.column, t.test] for t in tests)


def test_extremes_with_few_providers(spark):  # D26
    from claimlens.plans.kpis import provider_extremes
    rows = [(f"P{i:02d}", 20 + i, float(i)) for i in range(12)] + [(None, 50, 5.5)]
    by_provider = spark.createDataFrame(
        rows, "provider_id string, total_claims long, clean_claim_rate_pct double")
    out = provider_extremes(by_provider).collect()
    groups = [r.rank_group for r in out]
    assert len(out) == 13
    assert groups.count("Bottom 10") == 10 and groups.count("Top 10") == 3
    assert {r.provider_id for r in out if r.rank_group == "Top 10"} == {"P11", "P10", "P09"}


def test_heavy_pool_draws_by_interval(spark):  # X18, F8: any weights, exact shares
    weights = [(1, "A", 3), (2, "B", 0), (3, "C", 10 ** 9), (4, "D", 1), (5, "E", 7 * 10 ** 8), (5, "EE", 1)]
    pool = spark.createDataFrame(weights, "ordinal int, carc_code string, weight long").repartition(3)
    intervals = factmod.pool_intervals(pool, 4)
    ends, at = [], 0
    for _, code, w in weights:
        at += w
        if w:
            ends.append((at - w, at, code))
    assert sorted((r.start, r.end, r.carc_code) for r in intervals.collect()) == ends
    claims = spark.createDataFrame([(str(i), i) for i in range(400)] + [(None, -1)], "claim_id string, n int").repartition(5)

    def code(key):
        h = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % at
        return next(c for lo, hi, c in ends if lo <= h < hi)

    for cells in (1, 7, 4096):
        got = factmod.draw_by_interval(claims, intervals, "claim_id", cells=cells).collect()
        assert sorted(tuple(r) for r in got if r.claim_id) == sorted((str(i), i, code(str(i))) for i in range(400))
        assert [tuple(r) for r in got if r.claim_id is None] == [(None, -1, None)]
    empty = factmod.pool_intervals(pool.filter("weight < 0"))
    assert {r.carc_code for r in factmod.draw_by_interval(claims, empty, "claim_id").collect()} == {None}


def test_kpis_of_cells_equal_those_of_the_fact(spark):
    rows = [seg(str(i), [None, "0", "10.01", "99.99", "NaN", "-3"][i % 6 if i % 2 else 2], "Inpatient" if i % 3 else "Outpatient",
                provider=f"P{i % 4}" if i % 5 else None, start=f"2010{1 + i % 9:02d}01", end="20101001") for i in range(300)]
    wh = build(spark, rows)
    fact, cells = wh.fact, kpis.claim_cells(wh.fact)
    by = lambda of: kpis.clean_claim_rate_by_provider(of, min_claims=1)
    for model in (kpis.clean_claim_rate, by, kpis.claim_type_summary, kpis.avg_paid_by_type, kpis.ar_aging_matrix,
                  kpis.header_cards, lambda of: kpis.header_cards(of, "joined"),
                  lambda of: kpis.top_carc_denials(of, wh.dim_carc_denials)):
        a, b = model(fact), model(cells)
        assert a.schema.simpleString() == b.schema.simpleString()
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
