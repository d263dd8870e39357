"""Data-quality models (Q1-Q7): referential checks, duplicate keys and the
declarative schema tests of the warehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators.aggregates import duplicate_keys
from claimlens.operators.joins import anti_join, anti_join_non_null
from claimlens.operators.quality import SchemaTest, test_report
from claimlens.plans import kpis


def orphaned_claims(fact: DataFrame, dim_patient: DataFrame) -> DataFrame:
    """Claims whose patient is not in the patient dimension (NULL too)."""
    return anti_join(fact.select("claim_id", "patient_id"), dim_patient, "patient_id").select("claim_id")


def duplicate_claim_ids(fact: DataFrame) -> DataFrame:
    """Claim ids present more than once, with their count."""
    return duplicate_keys(fact.select("claim_id"), "claim_id", "c")


def unmapped_diagnosis(fact: DataFrame, dim_diagnosis: DataFrame) -> DataFrame:
    """Claims with a non-NULL diagnosis code missing from the dimension."""
    return anti_join_non_null(fact.select("claim_id", "diagnosis_code"), dim_diagnosis,
                              "diagnosis_code").select("claim_id")


DQ_CHECKS = ("dq_orphaned_claims", "dq_duplicate_claim_ids", "dq_unmapped_diagnosis")


def dq_counts(fact: DataFrame, dim_patient: DataFrame, dim_diagnosis: DataFrame) -> DataFrame:
    """Q7: failing-row count per referential / key check, as ``(check, n_failing)``."""
    checks = {
        "dq_orphaned_claims": orphaned_claims(fact, dim_patient),
        "dq_duplicate_claim_ids": duplicate_claim_ids(fact),
        "dq_unmapped_diagnosis": unmapped_diagnosis(fact, dim_diagnosis),
    }
    out = None
    for name, df in checks.items():
        part = df.agg(F.count(F.lit(1)).alias("n_failing")).select(
            F.lit(name).alias("check"), "n_failing")
        out = part if out is None else out.unionByName(part)
    return out


# The warehouse's declarative tests: sources (loaded tables) and marts.
SCHEMA_TESTS = (
    SchemaTest("fact_claims_adjudication", "claim_id", "not_null"),
    SchemaTest("fact_claims_adjudication", "claim_id", "unique"),
    SchemaTest("fact_claims_adjudication", "patient_id", "not_null"),
    SchemaTest("dim_patient", "patient_id", "not_null"),
    SchemaTest("dim_patient", "patient_id", "unique"),
    SchemaTest("dim_provider", "provider_id", "not_null"),
    SchemaTest("dim_provider", "provider_id", "unique"),
    SchemaTest("dim_diagnosis", "diagnosis_code", "not_null"),
    SchemaTest("dim_diagnosis", "diagnosis_code", "unique"),
    SchemaTest("dim_carc_denials", "carc_code", "not_null"),
    SchemaTest("dim_carc_denials", "carc_code", "unique"),
    SchemaTest("kpi_clean_claim_rate_by_provider", "provider_id", "not_null"),
    SchemaTest("kpi_ar_aging_matrix", "provider_id", "not_null"),
    SchemaTest("kpi_ar_aging_matrix", "ar_aging_bucket", "accepted_values", C.AGING_BUCKETS),
    SchemaTest("kpi_top_carc_denials", "carc_code", "not_null"),
)


def schema_test_report(wh) -> DataFrame:
    """Q1-Q3: ``(relation, column, test, n_failing)`` for every declared test.

    ``wh`` should be materialised: each relation is then scanned once, and
    the marts come from the stored cells, not from the fact.
    """
    relations = {
        "fact_claims_adjudication": wh.fact,
        "dim_patient": wh.dim_patient,
        "dim_provider": wh.dim_provider,
        "dim_diagnosis": wh.dim_diagnosis,
        "dim_carc_denials": wh.dim_carc_denials,
        "kpi_clean_claim_rate_by_provider": kpis.clean_claim_rate_by_provider(wh.claim_cells, sort=False),
        "kpi_ar_aging_matrix": kpis.ar_aging_matrix(wh.claim_cells),
        "kpi_top_carc_denials": kpis.top_carc_denials(wh.claim_cells, wh.dim_carc_denials, sort=False),
    }
    return test_report(relations, SCHEMA_TESTS)
