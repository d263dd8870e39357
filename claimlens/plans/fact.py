"""Claim detail, segment rollup and the adjudication fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from claimlens import constants as C
from claimlens.functions.exprs import (
    adjudication_status, aging_bucket, days_between, hash32, hash_bits, money_sum,
    parse_double, parse_yyyymmdd,
)
from claimlens.operators.joins import bounded_broadcast, scalar
from claimlens.sources.files import literal_table

FACT_COLUMNS = (
    "claim_id", "patient_id", "provider_id", "diagnosis_code", "carc_code", "claim_type",
    "clm_from_dt", "clm_thru_dt", "billed_paid_amt", "primary_pyr_pd_amt",
    "adjudication_status", "days_since_submission", "ar_aging_bucket",
)


def claim_detail(segments: DataFrame) -> DataFrame:
    """Typed claim-segment rows (one per raw segment row).

    ``segments`` holds the raw text columns plus CLAIM_TYPE (see
    ``sources.files.read_claim_files``). Dates and amounts that do not parse
    become NULL (D9).
    """
    return segments.select(
        F.col("CLM_ID").alias("claim_id"),
        F.col("DESYNPUF_ID").alias("patient_id"),
        F.col("PRVDR_NUM").alias("provider_id"),
        F.col("CLAIM_TYPE").alias("claim_type"),
        parse_yyyymmdd("CLM_FROM_DT").alias("clm_from_dt"),
        parse_yyyymmdd("CLM_THRU_DT").alias("clm_thru_dt"),
        parse_double("CLM_PMT_AMT").alias("clm_pmt_amt"),
        parse_double("NCH_PRMRY_PYR_CLM_PD_AMT").alias("primary_pyr_pd_amt"),
        F.col("ICD9_DGNS_CD_1").alias("primary_diagnosis_code"),
    )


def fact_base(detail: DataFrame) -> DataFrame:
    """M5/A2: one row per claim from its segments.

    Attributes take the smallest non-NULL value (a stable "any value", D7);
    dates span the segments; amounts are summed exactly (``money_sum``).
    One ``groupBy`` with partial aggregation: segments of one claim id, or of
    none, are combined map side first, so an id that holds a third of all
    rows (a placeholder, say, or NULL) is one row per task when the shuffle
    brings it together. Input that is already partitioned by claim id is
    not shuffled again.
    """
    return detail.groupBy("claim_id").agg(
        F.min("patient_id").alias("patient_id"),
        F.min("provider_id").alias("provider_id"),
        F.min("claim_type").alias("claim_type"),
        F.min("clm_from_dt").alias("clm_from_dt"),
        F.max("clm_thru_dt").alias("clm_thru_dt"),
        money_sum("clm_pmt_amt").alias("clm_pmt_amt"),
        money_sum("primary_pyr_pd_amt").alias("primary_pyr_pd_amt"),
        F.min("primary_diagnosis_code").alias("primary_diagnosis_code"),
    )


_WEIGHT_SCHEMA = StructType([
    StructField("ordinal", IntegerType(), False),
    StructField("carc_code", StringType(), False),
    StructField("weight", IntegerType(), False),
])


def carc_weights(spark: SparkSession, weights=C.CARC_WEIGHTS) -> DataFrame:
    """The weighted reason-code pool as a literal relation (ordinal, code, weight)."""
    rows = [(i, code, int(w)) for i, (code, w) in enumerate(weights, start=1)]
    return literal_table(spark, rows, _WEIGHT_SCHEMA)


def carc_pool(weights: DataFrame, dim_carc: DataFrame,
              fallback_count: int = C.CARC_FALLBACK_COUNT) -> DataFrame:
    """F8/D3: weighted codes that exist in the lookup; if none does, the
    first ``fallback_count`` lookup codes (by code) with equal weight.

    Both candidate sets are bounded (the weight table; a top-k of the
    lookup), so the choice between them is a window over at most
    ``len(weights) + fallback_count`` rows.
    """
    present = (weights.join(dim_carc.select("carc_code"), "carc_code", "left_semi")
               .withColumn("__tier", F.lit(0)))
    first_codes = (dim_carc.select("carc_code").filter(F.col("carc_code").isNotNull())
                   .distinct().orderBy("carc_code").limit(fallback_count))
    fallback = first_codes.select(F.lit(0).alias("ordinal"), "carc_code", F.lit(1).alias("weight"),
                                  F.lit(1).alias("__tier"))
    candidates = present.unionByName(fallback)
    everything = Window.partitionBy(F.lit(0))
    best = candidates.withColumn("__best", F.min("__tier").over(everything))
    ranked = Window.partitionBy(F.lit(0)).orderBy("ordinal", "carc_code")
    return (best.filter(F.col("__tier") == F.col("__best"))
            .select(F.row_number().over(ranked).alias("ordinal"), "carc_code", "weight"))


def carc_draws(pool: DataFrame) -> DataFrame:
    """One row, ``draws``: the codes of a bounded pool in order, and the ends of their shares of the weights.

    A hash h draws the first code whose end is over ``h % total``, so each code
    owns exactly its share of the total weight, (renormalised) over the codes
    of the pool, and every code can be drawn. The list has an entry per code,
    whatever the weights: for the literal pool and its fallback. A pool as
    large as a table is drawn from with ``draw_by_interval``.
    """
    entries = F.sort_array(F.collect_list(F.struct("ordinal", "carc_code", F.col("weight").cast("bigint").alias("weight"))))
    weights = F.transform(entries, lambda e: e["weight"])
    upto = lambda e, i: F.aggregate(F.slice(weights, 1, i + 1), F.lit(0).cast("bigint"), lambda a, w: a + w)
    return pool.agg(F.struct(F.transform(entries, lambda e: e["carc_code"]).alias("codes"),
                             F.transform(entries, upto).alias("ends")).alias("draws"))


def pool_intervals(pool: DataFrame, blocks: int | None = None) -> DataFrame:
    """The share of each code of a pool of any size: carc_code, start, end (a distributed prefix sum of the weights).

    The codes are range-partitioned in their order; the sums of the partitions,
    one row each, are added up by a window, and each partition adds up its own
    codes from there. Codes without a positive weight have no share.
    """
    some = pool.filter(F.col("weight") > 0)
    blocks = blocks or int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (some.repartitionByRange(blocks, "ordinal", "carc_code").withColumn("__block", F.spark_partition_id())
             .select("ordinal", "carc_code", F.col("weight").cast("bigint").alias("weight"), "__block"))
    before = Window.partitionBy(F.lit(0)).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("__block").agg(F.sum("weight").alias("__sum"))  # a row per partition
    sums = sums.select("__block", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__block").orderBy("ordinal", "carc_code").rowsBetween(Window.unboundedPreceding, 0)
    ends = dealt.join(bounded_broadcast(sums), "__block").withColumn("end", F.col("__before") + F.sum("weight").over(within))
    return ends.select("carc_code", (F.col("end") - F.col("weight")).alias("start"), "end")


def draw_by_interval(claims: DataFrame, intervals: DataFrame, key: str, name: str = "carc_code",
                     cells: int = 1 << 12) -> DataFrame:
    """X18/F8 for a pool of any size and weight: ``claims`` with the code that each key's hash draws.

    The hash (60 bits of the key's MD5) modulo the total weight is a point.
    The line of points is cut into ``cells`` of equal width; each cell gets
    the claims whose points lie in it and the intervals that touch it, and in
    the order of points every claim takes the last interval begun. So
    a claim moves once, no claim meets more than one interval, and points are spread evenly over the
    cells. An empty pool gives NULL codes.
    """
    total = scalar(intervals.agg(F.max("end").alias("total")))
    width = F.greatest(F.ceil(total / F.lit(cells)), F.lit(1)).cast("bigint")
    cell = lambda at: ((at - F.pmod(at, width)) / width).cast("bigint")
    rows = claims.withColumn("__at", F.pmod(hash_bits(key, 15), total))
    rows = rows.select(cell(F.col("__at")).alias("__cell"), "__at", F.lit(1).alias("__kind"),
                       F.struct(*[F.col(f"`{c}`") for c in claims.columns]).alias("__row"), F.lit(None).cast("string").alias("__code"))
    first, last = cell(F.col("start")), cell(F.col("end") - 1)
    begun = intervals.select(F.explode(F.sequence(first, last)).alias("__cell"), F.col("start").alias("__at"),
                             F.lit(0).alias("__kind"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"),
                             F.col("carc_code").alias("__code"))
    upto = Window.partitionBy("__cell").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    drawn = rows.unionByName(begun).withColumn("__drawn", F.last("__code", ignorenulls=True).over(upto))
    return drawn.filter("__kind = 1").select(*[F.col(f"__row.`{c}`").alias(c) for c in claims.columns],
                                             F.col("__drawn").alias(name))


def as_of_date(claims: DataFrame) -> Column:
    """The as-of date, the latest ``clm_thru_dt`` (a scalar subquery).

    Pass the claim detail rather than the rollup: the latest segment date is
    the latest claim date, and the subquery then needs no aggregation
    shuffle, only a one-column scan with a partial max per task.
    """
    return scalar(claims.agg(F.max("clm_thru_dt").alias("as_of")))


def drawn_code(key: str, draws: DataFrame) -> Column:
    """The code that the hash of ``key`` draws; the list is read by a scalar subquery.

    The point's place among the sorted ends is one more than the ends it has passed.
    """
    pool = scalar(draws)
    point = F.pmod(hash32(key), F.try_element_at(pool["ends"], F.lit(-1))) + F.lit(0.5)
    places = F.sort_array(F.array_append(pool["ends"].cast("array<double>"), point))
    return F.try_element_at(pool["codes"], F.array_position(places, point).cast("int"))


def fact_claims(base: DataFrame, draws: DataFrame,
                as_of: dt.date | str | Column | None = None,
                detail: DataFrame | None = None) -> DataFrame:
    """M6: one row per claim with status, reason code, age and aging bucket.

    A claim with NULL or zero payment is denied and draws its reason code
    by the md5 hash of its claim id. The draw is deterministic, so task
    retries and recomputation give the same code. It is a plain expression
    over the pool's list, so the fact needs no join, and a query that never
    reads ``carc_code`` prunes the draw entirely.
    """
    if as_of is None:
        as_of_col = as_of_date(detail if detail is not None else base)
    elif isinstance(as_of, Column):
        as_of_col = as_of
    else:
        as_of_col = F.lit(str(as_of)).cast("date")
    status = adjudication_status("clm_pmt_amt")
    f = (base.withColumn("adjudication_status", status)
             .withColumn("carc_code", F.when(F.col("adjudication_status") == C.DENIED,
                                             drawn_code("claim_id", draws))))
    # Days as a column first: the bucket then reads it instead of repeating
    # the date difference (and its subquery) in every branch.
    f = f.withColumn("days_since_submission", days_between("clm_from_dt", as_of_col))
    return f.select(
        "claim_id", "patient_id", "provider_id",
        F.col("primary_diagnosis_code").alias("diagnosis_code"),
        "carc_code", "claim_type", "clm_from_dt", "clm_thru_dt",
        F.col("clm_pmt_amt").alias("billed_paid_amt"),
        "primary_pyr_pd_amt", "adjudication_status", "days_since_submission",
        aging_bucket("days_since_submission").alias("ar_aging_bucket"),
    )


def stg_fact(fact: DataFrame) -> DataFrame:
    """Staging pass-through of the 13 fact columns."""
    return fact.select(*FACT_COLUMNS)
