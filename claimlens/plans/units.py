"""Single-operator queries: one query per operator of SURVEY section 2 that
the composite models do not already isolate. Each reads the test tables (or
frames Spark derives from them) so its work grows with the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens import jobs
from claimlens.functions.exprs import flag_count, hash32, keyword_bucket, money_avg
from claimlens.operators.aggregates import (
    columns_with_prefix, distinct_values, pivot_fixed, row_counts,
)
from claimlens.operators.joins import bounded_broadcast, inner_join, scalar
from claimlens.operators.quality import SchemaTest, test_report
from claimlens.plans import dashboard, dims, fact as factmod, kpis, quality, warehouse
from claimlens.session import new_scratch_path
from claimlens.sinks import materialize, replace_partitions, write_bucketed, write_json, write_lookup, write_parquet
from claimlens.sources import fixtures
from claimlens.sources.files import read_checked_csv, read_claim_files, read_lookup, read_yearly


# -- sources (S1-S3, S7, U1-U3) ------------------------------------------------

def csv_claim_files(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """Write segments as one header CSV per claim type, read both back.

    One distributed write (partitioned by claim type), then each folder is
    read as a raw all-text claim file and tagged with its type.
    """
    root = new_scratch_path(spark, "claims-csv")
    segments.write.mode("overwrite").option("header", True).partitionBy("CLAIM_TYPE").csv(root)
    cols = [c for c in fixtures.SEGMENT_COLUMNS if c != "CLAIM_TYPE"]
    return read_claim_files(spark, f"{root}/CLAIM_TYPE={C.INPATIENT}",
                            f"{root}/CLAIM_TYPE={C.OUTPATIENT}", cols)


def csv_yearly_files(spark: SparkSession, yearly: list[DataFrame]) -> DataFrame:
    """One header CSV per year, read back by a path template and
    unioned by name (a year missing a column gets NULL)."""
    root = new_scratch_path(spark, "bene-csv")
    for y, df in zip(fixtures.BENEFICIARY_YEARS, yearly):
        df.drop("SNAPSHOT_YEAR").write.mode("overwrite").option("header", True).csv(f"{root}/bene_{y}")
    return read_yearly(spark, root + "/bene_{year}", fixtures.BENEFICIARY_YEARS)


# -- sinks (K1-K7) -----------------------------------------------------------------

def parquet_roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """K2/K3: overwrite a Parquet table and read it back."""
    path = write_parquet(df, new_scratch_path(spark, "parquet"))
    return spark.read.parquet(path).select(*df.columns)


def partitioned_roundtrip(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """K4: the fact partitioned by claim type, all of it read back."""
    path = write_parquet(fact, new_scratch_path(spark, "fact-by-type"), partition_by="claim_type")
    return spark.read.parquet(path).select(*fact.columns)


def json_roundtrip(spark: SparkSession, df: DataFrame) -> DataFrame:
    """K6: JSON lines written in parallel and read back with the known schema."""
    path = write_json(df, new_scratch_path(spark, "json"))
    return spark.read.schema(df.schema).json(path).select(*df.columns)


def view_roundtrip(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """Staging view over the fact, read by name through SQL."""
    name = "stg_fact_claims_adjudication"
    materialize(factmod.stg_fact(fact), name, "view")
    return spark.sql(f"SELECT * FROM {name}")


# -- projections, filters (P5, P7, F1, F3, F4, X22) ------------------------------

def star_plus_expected(fact: DataFrame) -> DataFrame:
    """Every fact column plus the expected amount (the type's paid
    average for a denied claim); types without paid claims drop out."""
    avg = bounded_broadcast(kpis.avg_paid_by_type(fact))  # one row per claim type
    denied = F.col("adjudication_status") == C.DENIED
    return (inner_join(fact, avg, "claim_type")
            .withColumn("expected_amt", F.when(denied, F.col("avg_paid_amt"))
                        .otherwise(F.col("billed_paid_amt")))
            .drop("avg_paid_amt"))


def diagnosis_columns(segments: DataFrame) -> DataFrame:
    """The first three columns whose name starts with the diagnosis prefix."""
    return segments.select(*columns_with_prefix(segments, "ICD9_DGNS_CD_", 3))


def segments_with_provider(segments: DataFrame) -> DataFrame:
    """segment rows whose provider number is present."""
    return segments.filter(F.col("PRVDR_NUM").isNotNull()).select("CLM_ID", "PRVDR_NUM")


def all_diagnosis_codes(segments: DataFrame) -> DataFrame:
    """Distinct non-NULL codes of the three diagnosis columns."""
    return distinct_values(segments, columns_with_prefix(segments, "ICD9_DGNS_CD_", 3), "code")


def circulatory_codes(dim_diagnosis: DataFrame) -> DataFrame:
    """Codes whose three-digit prefix lies in 390..459."""
    prefix = F.left(F.col("diagnosis_code"), F.lit(3)).try_cast("int")
    return dim_diagnosis.filter(prefix.between(390, 459)).select("diagnosis_code")


# -- joins (J1, J3, J6) ---------------------------------------------------------

def adjudication_join(base: DataFrame, draws: DataFrame) -> DataFrame:
    """Claims joined 1:1 to their adjudication outcome on ``claim_id``.

    Pass a stored rollup: both sides then scan its columns, and the segments
    are not rolled up a second time.
    """
    outcome = factmod.fact_claims(base, draws).select("claim_id", "adjudication_status", "carc_code")
    return inner_join(base, outcome, "claim_id")


def denied_with_reason(fact: DataFrame, dim_carc: DataFrame) -> DataFrame:
    """Denied claims with their reason description and bucket; NULL or
    unmapped codes drop out. Spark's byte threshold decides on a broadcast."""
    return (fact.filter(F.col("adjudication_status") == C.DENIED)
            .select("claim_id", "carc_code")
            .join(dim_carc, "carc_code", "inner"))


def as_of(detail: DataFrame) -> DataFrame:
    """The as-of date as a one-row relation (no driver collect)."""
    return detail.agg(F.max("clm_thru_dt").alias("as_of"))


def as_of_days(fact_base: DataFrame, detail: DataFrame) -> DataFrame:
    """Days from each claim's start to the as-of date via a scalar subquery."""
    ref = scalar(detail.agg(F.max("clm_thru_dt")))
    return fact_base.select("claim_id", F.datediff(ref, F.col("clm_from_dt")).alias("days"))


# -- aggregates (A5, A14, A15) ------------------------------------------------

def source_row_counts(segments: DataFrame, fact: DataFrame) -> DataFrame:
    """Row counts of the two claim sources and of the fact."""
    return row_counts({
        "inpatient_segments": segments.filter(F.col("CLAIM_TYPE") == C.INPATIENT),
        "outpatient_segments": segments.filter(F.col("CLAIM_TYPE") == C.OUTPATIENT),
        "fact_claims": fact,
    })


def aging_pivot(matrix: DataFrame) -> DataFrame:
    """Provider rows x the four aging buckets (missing = 0) plus total."""
    return pivot_fixed(matrix, "provider_id", "ar_aging_bucket", C.AGING_BUCKETS,
                       "at_risk_amt_proxy", total_col="total")


def overall_avg_paid(fact: DataFrame) -> DataFrame:
    """A5 (global form): the overall first-pass paid average."""
    return (fact.filter(F.col("adjudication_status") == C.PAID_FIRST_PASS)
            .agg(money_avg("billed_paid_amt").alias("avg_paid_amt")))


# -- expressions (X9, X12, X18) ---------------------------------------------------

def weighted_codes(fact: DataFrame) -> DataFrame:
    """The hash slot and the reason code drawn for each denied claim."""
    return (fact.filter(F.col("adjudication_status") == C.DENIED)
            .select("claim_id", (hash32("claim_id") % 100).alias("slot"), "carc_code"))


def yearly_flag_counts(bene: DataFrame) -> DataFrame:
    """X12 over every yearly row (a missing flag column counts as unset)."""
    flags = [c for c in C.CHRONIC_FLAGS if c in bene.columns]
    return bene.select(F.col("DESYNPUF_ID").alias("patient_id"),
                       F.col("SNAPSHOT_YEAR").alias("snapshot_year"),
                       flag_count(flags).alias("chronic_condition_count"))


def document_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 on whole free texts: the preventability keyword rule applied to
    every document of the ``documents`` table."""
    docs = fixtures.table(spark, sf_dir, "documents")
    return docs.select("doc_id", keyword_bucket("text").alias("preventability_bucket"))


# -- whole paths: pools, lookups, files, named marts, the dashboard object ---------

def codes_from_large_pool(fact: DataFrame, weights: DataFrame) -> DataFrame:
    """X18/F8 with a pool of many codes, of which those of sizes divisible by 5 are not in the lookup."""
    size = F.element_at(F.split("carc_code", "-"), -1).cast("int")
    pool = factmod.carc_pool(weights, weights.filter(size % 5 != 0).select("carc_code"))
    return (fact.filter(F.col("adjudication_status") == C.DENIED)
            .select("claim_id", factmod.drawn_code("claim_id", factmod.carc_draws(pool)).alias("carc_code")))


def codes_from_heavy_pool(fact: DataFrame, weights: DataFrame) -> DataFrame:
    """Codes drawn from a pool as large as a table, of any weights."""
    denied = fact.filter(F.col("adjudication_status") == C.DENIED).select("claim_id")
    return factmod.draw_by_interval(denied, factmod.pool_intervals(weights), "claim_id")


def replaced_partition(spark: SparkSession, fact: DataFrame) -> DataFrame:
    """K4: the fact stored by claim type, then one type's rows replaced (without their reason codes), all read back."""
    path = write_parquet(fact, new_scratch_path(spark, "fact-replaced"), partition_by="claim_type")
    redone = fact.filter(F.col("claim_type") == C.INPATIENT).withColumn("carc_code", F.lit(None).cast("string"))
    replace_partitions(redone, path, "claim_type")
    return spark.read.parquet(path).select(*fact.columns)


def bucketed_claims(spark: SparkSession, base: DataFrame, draws: DataFrame, buckets: int = 8) -> DataFrame:
    """J1/A12 over co-bucketed tables: claims joined to their outcome, and how often the id occurs, without a shuffle."""
    root, name = new_scratch_path(spark, "bucketed"), f"b{uuid.uuid4().hex[:8]}"
    outcome = factmod.fact_claims(base, draws).select("claim_id", "adjudication_status", "carc_code")
    left = write_bucketed(base, f"{name}_base", f"{root}/base", "claim_id", buckets)
    right = write_bucketed(outcome, f"{name}_outcome", f"{root}/outcome", "claim_id", buckets)
    times = left.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n"))
    return inner_join(inner_join(left, right, "claim_id"), times, "claim_id")


def checked_claim_lines(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Lines of claim files of which some are ragged: the rejected ones, and how many rows were accepted of each flag."""
    root = new_scratch_path(spark, "ragged")
    lines.write.text(root)
    columns = ("CLM_ID", "SEGMENT", "PRVDR_NUM", "FLAG", "STATUS", "SHIP")
    rows, rejected = read_checked_csv(spark, root, columns, header=False)
    accepted = rows.groupBy("FLAG").agg(F.count(F.lit(1)).alias("n"))
    return accepted.select(F.lit("accepted").alias("kind"), F.col("FLAG").alias("line"), "n").unionByName(
        rejected.groupBy("line").agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("kind"), "line", "n"))


def lookup_roundtrip(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """A raw lookup written as Parquet, read by its reader, cleaned and bucketed."""
    path = write_lookup(raw, new_scratch_path(spark, "lookup"))
    return dims.dim_carc_denials(read_lookup(spark, path, "parquet"))


def fact_from_files(spark: SparkSession, segments: DataFrame, yearly: list[DataFrame], lookup: DataFrame) -> DataFrame:
    """The raw files as a user has them (two claim CSVs, one beneficiary CSV a year, a lookup CSV), then the fact."""
    root = new_scratch_path(spark, "raw")
    segments.write.option("header", True).partitionBy("CLAIM_TYPE").csv(f"{root}/claims")
    for year, df in zip(fixtures.BENEFICIARY_YEARS, yearly):
        df.drop("SNAPSHOT_YEAR").write.option("header", True).csv(f"{root}/bene_{year}")
    lookup.write.option("header", True).csv(f"{root}/carc")
    return warehouse.from_files(spark, f"{root}/claims/CLAIM_TYPE={C.INPATIENT}", f"{root}/claims/CLAIM_TYPE={C.OUTPATIENT}",
                                root + "/bene_{year}", fixtures.BENEFICIARY_YEARS, f"{root}/carc").fact


def raw_schema_tests(segments: DataFrame, orders: DataFrame) -> DataFrame:
    """Q1-Q3 on raw tables, where every kind of test has failures."""
    tests = (SchemaTest("segments", "CLM_ID", "unique"), SchemaTest("segments", "PRVDR_NUM", "unique"),
             SchemaTest("segments", "CLM_PMT_AMT", "not_null"),
             SchemaTest("orders", "o_orderpriority", "accepted_values", ("1-URGENT", "2-HIGH")),
             SchemaTest("orders", "o_orderpriority", "unique"))
    return test_report({"segments": segments, "orders": orders}, tests)


def repeated_segments(detail: DataFrame) -> DataFrame:
    """Q5/A12 before the rollup: claims of several segments, with their count."""
    return quality.duplicate_claim_ids(detail)


def marts_by_name(spark: SparkSession, wh) -> DataFrame:
    """Publish all marts, then another session reads some by their names: (mart, key, value)."""
    prefix = f"m{uuid.uuid4().hex[:8]}_"
    jobs.publish_marts(wh, new_scratch_path(spark, "marts"), prefix)
    other = spark.newSession()
    named = lambda name: other.table(prefix + name)
    return other.sql(f"""
        SELECT 'provider' AS mart, provider_id AS key, clean_claim_rate_pct AS value FROM {prefix}kpi_clean_claim_rate_by_provider
        UNION ALL SELECT 'reason', carc_code, estimated_financial_loss FROM {prefix}kpi_top_carc_denials
        UNION ALL SELECT 'type', claim_type, total_paid_amt FROM {prefix}kpi_claim_type_summary
        UNION ALL SELECT 'orphan', claim_id, 1.0D FROM {prefix}dq_orphaned_claims
        UNION ALL SELECT 'fact', claim_id, CAST(days_since_submission AS DOUBLE) FROM {prefix}stg_fact_claims_adjudication
    """).unionByName(named("kpi_ar_aging_matrix").select(
        F.lit("matrix").alias("mart"), F.concat_ws("/", F.coalesce("provider_id", F.lit("none")), "ar_aging_bucket").alias("key"),
        F.col("at_risk_amt_proxy").alias("value")))


def dashboard_roundtrip(spark: SparkSession, wh) -> DataFrame:
    """K6: the dashboard object written as JSON, read back as one object and flattened: (section, key, field, num)."""
    shape = dashboard.dashboard_object(wh)
    path = write_json(shape, new_scratch_path(spark, "dashboard"), single_file=True)
    data = spark.read.schema(shape.schema).json(path)

    def numbers(kind, at):
        return F.array(*[F.struct(F.lit(f.name).alias("field"), at.getField(f.name).cast("double").alias("num"))
                         for f in kind.fields if f.dataType.typeName() != "string"])

    parts = []
    for f in data.schema.fields:
        name = F.lit(f.name).alias("section")
        if f.dataType.typeName() == "struct":
            parts.append(data.select(name, F.lit(None).cast("string").alias("key"), F.inline(numbers(f.dataType, F.col(f.name)))))
        elif f.dataType.typeName() == "array":
            kind = f.dataType.elementType
            label = next(x.name for x in kind.fields if x.dataType.typeName() == "string")
            rows = data.select(F.explode(f.name).alias("row"))
            parts.append(rows.select(name, F.col("row").getField(label).alias("key"), F.inline(numbers(kind, F.col("row")))))
        else:
            parts.append(data.select(name, F.lit(None).cast("string").alias("key"), F.lit("n").alias("field"),
                                     F.col(f.name).cast("double").alias("num")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
