"""Skew: one provider and a NULL patient each hold a third of all claims.

With AQE's skew thresholds lowered so the skew split really happens, the
results must equal direct counts (correctness under the skew code paths)."""

import contextlib
from decimal import Decimal

from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.plans import fact as factmod
from claimlens.plans import kpis, quality, warehouse
from claimlens.session import new_scratch_path
from claimlens.sources import fixtures
from claimlens.sources.files import all_string_schema

SEG = fixtures.SEGMENT_COLUMNS


@contextlib.contextmanager
def skew_conf(spark):
    kv = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
          "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
          "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
          "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_provider_and_null_patient(spark):
    n = 3000
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        row = dict.fromkeys(SEG)
        row.update(CLM_ID=str(i), DESYNPUF_ID=None if hot else f"B{i % 50}",
                   PRVDR_NUM="HOT" if hot else f"P{i % 40}", CLM_FROM_DT="20100101",
                   CLM_THRU_DT="20100301", CLM_PMT_AMT="0" if i % 7 == 0 else "10.5",
                   NCH_PRMRY_PYR_CLM_PD_AMT="1", ICD9_DGNS_CD_1="4280",
                   CLAIM_TYPE=C.INPATIENT if i % 2 else C.OUTPATIENT)
        rows.append(tuple(row[c] for c in SEG))
    segments = spark.createDataFrame(rows, all_string_schema(SEG)).repartition(16)
    bene = spark.createDataFrame([(f"B{i}", "19400101", 2010) for i in range(25)],
                                 "DESYNPUF_ID string, BENE_BIRTH_DT string, SNAPSHOT_YEAR int")
    for c in ("BENE_DEATH_DT", "BENE_SEX_IDENT_CD", "BENE_RACE_CD", "SP_STATE_CODE", *C.CHRONIC_FLAGS):
        bene = bene.withColumn(c, F.lit(None).cast("string"))
    with skew_conf(spark):
        wh = warehouse.from_raw(spark, segments, [bene], fixtures.carc_lookup_raw(spark))
        by_provider = {r.provider_id: r.total_claims
                       for r in kpis.clean_claim_rate_by_provider(wh.fact).collect()}
        assert by_provider["HOT"] == n // 3
        orphans = quality.orphaned_claims(wh.fact, wh.dim_patient).count()
        # NULL patients (a third) plus patients B25..B49 that have no beneficiary row
        expected = sum(1 for i in range(n) if i % 3 == 0 or (i % 50) >= 25)
        assert orphans == expected
        rate = kpis.clean_claim_rate(wh.fact).first()
        assert rate.total_claims == n
        assert rate.denied_claims == sum(1 for i in range(n) if i % 7 == 0)


def shuffled_rows(df):
    """Rows that the exchanges of a plan that has run wrote, in all."""
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind == "ShuffleQueryStageExec":
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                found += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_hot_claim_id_is_combined_before_the_shuffle(spark):
    """A placeholder id and NULL each hold a third of all segments: a row per task of each is shuffled."""
    n, tasks = 6000, 16
    rows = []
    for i in range(n):
        row = dict.fromkeys(SEG)
        row.update(CLM_ID=("HOT", None, str(i))[i % 3], DESYNPUF_ID=f"B{i % 70:02d}", PRVDR_NUM=f"P{i % 40:02d}",
                   CLM_FROM_DT=f"2010{i % 12 + 1:02d}01", CLM_THRU_DT="20100301", CLM_PMT_AMT=f"{i}.1",
                   NCH_PRMRY_PYR_CLM_PD_AMT="0.2", ICD9_DGNS_CD_1=None if i % 2 else "4280", CLAIM_TYPE=C.INPATIENT)
        rows.append(tuple(row[c] for c in SEG))
    segments = spark.createDataFrame(rows, all_string_schema(SEG)).repartition(tasks)
    root = new_scratch_path(spark, "hot-claims")
    segments.write.parquet(root)
    base = factmod.fact_base(factmod.claim_detail(spark.read.parquet(root)))
    got = {r.claim_id: r for r in base.collect()}
    assert len(got) == n // 3 + 2
    for key, k in (("HOT", 0), (None, 1)):
        r = got[key]
        assert (r.patient_id, r.provider_id, str(r.clm_from_dt)) == (
            "B00", f"P{min(i % 40 for i in range(k, n, 3)):02d}", "2010-01-01" if k == 0 else "2010-02-01")
        assert r.clm_pmt_amt == float(sum(Decimal(f"{i}.1") for i in range(k, n, 3)))
        assert r.primary_pyr_pd_amt == 400.0
    assert shuffled_rows(base) <= n // 3 + 2 * tasks
