"""End to end from raw files: the mapped test data written as all-text CSV
(two claim files, three yearly beneficiary files, a lookup), built into the
star schema by the batch job, must give the same KPIs as the in-memory path."""

from pyspark.sql import functions as F

from claimlens import constants as C, jobs
from claimlens.plans import kpis, quality
from claimlens.session import new_scratch_path
from claimlens.sources import fixtures


def _write_raw(spark, wh, sf_dir):
    root = new_scratch_path(spark, "raw")
    seg = wh.segments
    for ctype, name in ((C.INPATIENT, "inpatient"), (C.OUTPATIENT, "outpatient")):
        (seg.filter(F.col("CLAIM_TYPE") == ctype).drop("CLAIM_TYPE")
            .write.option("header", True).csv(f"{root}/{name}"))
    for y, df in zip(fixtures.BENEFICIARY_YEARS, fixtures.beneficiary_files(spark, sf_dir)):
        df.drop("SNAPSHOT_YEAR").write.option("header", True).csv(f"{root}/bene_{y}")
    fixtures.carc_lookup_raw(spark).coalesce(1).write.option("header", True).csv(f"{root}/carc")
    return root


def test_build_from_files_matches_in_memory(spark, wh, sf_dir):
    root = _write_raw(spark, wh, sf_dir)
    out = new_scratch_path(spark, "warehouse-out")
    built = jobs.build_warehouse(spark, f"{root}/inpatient", f"{root}/outpatient",
                                 root + "/bene_{year}", fixtures.BENEFICIARY_YEARS,
                                 f"{root}/carc", out)
    for f in (kpis.clean_claim_rate, kpis.header_cards):
        assert f(built.fact).collect() == f(wh.fact).collect()
    key = ["carc_code"]
    a = kpis.top_carc_denials(built.fact, built.dim_carc_denials, sort=False).orderBy(*key).collect()
    b = kpis.top_carc_denials(wh.fact, wh.dim_carc_denials, sort=False).orderBy(*key).collect()
    assert a == b
    for name in ("dim_patient", "dim_provider", "dim_diagnosis", "dim_carc_denials"):
        assert getattr(built, name).count() == getattr(wh, name).count(), name
    assert sorted(quality.dq_counts(built.fact, built.dim_patient, built.dim_diagnosis).collect()) == \
        sorted(quality.dq_counts(wh.fact, wh.dim_patient, wh.dim_diagnosis).collect())
    files = jobs.export_dashboard(built, f"{out}/dashboard")
    data = spark.read.json(files["data"]).collect()
    assert len(data) == 1 and set(data[0].asDict()) == {
        "header_cards", "clean_claim_rate", "top_carc_denials", "clean_claim_by_provider_worst10",
        "dq_orphaned_claims", "dq_duplicate_claim_ids", "dq_unmapped_diagnosis", "ar_matrix_top_providers"}


def test_csv_columns_are_bound_by_name(spark):
    from claimlens.sources.files import read_text_csv
    import pytest
    path = new_scratch_path(spark, "swapped")
    spark.createDataFrame([("b1", "a1")], "B string, A string").write.option("header", True).csv(path)
    assert [tuple(r) for r in read_text_csv(spark, path, ["A", "B"]).collect()] == [("a1", "b1")]
    with pytest.raises(ValueError, match="C"):
        read_text_csv(spark, path, ["A", "C"])
