"""Dimension models (M1-M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions.exprs import (
    age_approx, diagnosis_code_valid, flag_count, icd9_category, keyword_bucket,
    parse_yyyymmdd, sex_label,
)
from claimlens.operators.aggregates import columns_with_prefix, distinct_values
from claimlens.operators.ranking import latest_per_key
from claimlens.sources.files import clean_lookup, union_by_name


def beneficiaries(yearly: list[DataFrame]) -> DataFrame:
    """Yearly beneficiary files by name; columns a year lacks become NULL."""
    return union_by_name(yearly)


def latest_snapshot(bene: DataFrame) -> DataFrame:
    """Latest snapshot year per beneficiary.

    Ties within a year (D17) are broken by the birth-date text, then by every
    other column, so the choice is deterministic.
    """
    rest = sorted(c for c in bene.columns
                  if c not in ("DESYNPUF_ID", "SNAPSHOT_YEAR", "BENE_BIRTH_DT"))
    order = [F.col("SNAPSHOT_YEAR").desc(), F.col("BENE_BIRTH_DT").asc_nulls_last()]
    order += [F.col(c).asc_nulls_last() for c in rest]
    return latest_per_key(bene, "DESYNPUF_ID", order)


def dim_patient(bene: DataFrame, ref_year: int = C.AGE_REFERENCE_YEAR) -> DataFrame:
    """M1: one row per beneficiary from its latest snapshot.

    ``bene`` is the union of the yearly files (text columns + SNAPSHOT_YEAR).
    A flag column missing from a year counts as not set; one that no year has is an error.
    """
    missing = [c for c in C.CHRONIC_FLAGS if c not in bene.columns]
    if missing:
        raise ValueError(f"no year has the flag columns {missing}")
    flags = C.CHRONIC_FLAGS
    latest = latest_snapshot(bene)
    return latest.select(
        F.col("DESYNPUF_ID").alias("patient_id"),
        parse_yyyymmdd("BENE_BIRTH_DT").alias("birth_dt"),
        parse_yyyymmdd("BENE_DEATH_DT").alias("death_dt"),
        sex_label("BENE_SEX_IDENT_CD").alias("sex"),
        F.col("BENE_RACE_CD").alias("bene_race_cd"),
        F.col("SP_STATE_CODE").alias("sp_state_code"),
        age_approx("BENE_BIRTH_DT", ref_year).alias("age_approx"),
        flag_count(flags).alias("chronic_condition_count"),
        F.col("SNAPSHOT_YEAR").cast("int").alias("snapshot_year"),
    )


def dim_provider(segments: DataFrame) -> DataFrame:
    """M2: one row per provider number over all claim segments.

    ``claim_volume`` counts segment rows (D19); the attending NPI is the
    smallest non-NULL one (D7). Partial aggregation runs before the shuffle,
    so a provider holding a large share of segments costs one row per task.
    """
    return (segments.filter(F.col("PRVDR_NUM").isNotNull())
            .groupBy(F.col("PRVDR_NUM").alias("provider_id"))
            .agg(F.min("AT_PHYSN_NPI").alias("attending_npi"),
                 F.count(F.lit(1)).alias("claim_volume")))


def diagnosis_codes(segments: DataFrame, prefix: str = "ICD9_DGNS_CD_",
                    n_codes: int = 3) -> DataFrame:
    """Distinct valid codes from the first ``n_codes`` diagnosis columns."""
    columns = columns_with_prefix(segments, prefix, n_codes)
    return distinct_values(segments, columns, "diagnosis_code",
                           keep=diagnosis_code_valid("diagnosis_code"))


def dim_diagnosis(segments: DataFrame) -> DataFrame:
    """M3: one row per valid diagnosis code seen on any claim segment."""
    return diagnosis_codes(segments).select(
        "diagnosis_code",
        F.lit(C.CODE_SYSTEM).alias("code_system"),
        icd9_category("diagnosis_code").alias("diagnosis_category_approx"),
        F.lit(None).cast("string").alias("description"),
    )


def dim_carc_denials(lookup_raw: DataFrame) -> DataFrame:
    """M4: reason-code lookup with its preventability bucket."""
    lookup = clean_lookup(lookup_raw)
    return lookup.select("carc_code", "description",
                         keyword_bucket("description").alias("preventability_bucket"))
