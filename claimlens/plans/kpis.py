"""Revenue-cycle KPI models.

Every model takes the fact, or ``claim_cells``: its claims counted by all keys
that the models group by. A consumer of several models stores the cells
(one scan of the fact) and reads each model from them.

Plan shape: each KPI reads its input once. Per-claim-type averages are not
joined back onto the fact; they are derived from a small pre-aggregate
(grouped by the KPI's own keys plus ``claim_type``) and applied to that
pre-aggregate instead, so the fact is never shuffled for a join, only for a
partially aggregated ``groupBy``. Money is summed exactly (DECIMAL), and a
per-type average spread over n denied claims is applied as ``n * avg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions.exprs import money_parts, money_sum, money_value, more_parts, pct, round2
from claimlens.operators.aggregates import pivot_fixed
from claimlens.operators.joins import bounded_broadcast
from claimlens.operators.ranking import top_k, two_sided_extremes

def _count_all() -> Column:
    return F.count(F.lit(1))

def _is(status: str) -> Column:
    return F.col("adjudication_status") == F.lit(status)

CELL_KEYS = ("provider_id", "ar_aging_bucket", "claim_type", "carc_code", "adjudication_status")

def claim_cells(fact: DataFrame) -> DataFrame:
    """The fact by provider, bucket, type, reason code and status: claims, and the parts of their amounts.

    All but the provider are closed domains, so the cells of a provider
    are bounded however many claims it has.
    """
    return fact.groupBy(*CELL_KEYS).agg(
        _count_all().alias("cell_claims"), F.count("billed_paid_amt").alias("cell_amounts"),
        *money_parts("billed_paid_amt", "cell"))

def _claims(of: DataFrame, where: Column | None = None) -> Column:
    """How many claims (of ``where``) a group holds, of the fact or of its cells."""
    if "cell_claims" in of.columns:
        n = F.col("cell_claims")
        return F.coalesce(F.sum(n if where is None else F.when(where, n)), F.lit(0))
    return _count_all() if where is None else F.count_if(where)

def _billed_parts(of: DataFrame, name: str, where: Column | None = None) -> list[Column]:
    """The parts of the sum of amounts (of ``where``), of the fact or of its cells."""
    if "cell_claims" in of.columns:
        return more_parts("cell", where, name=name)
    return money_parts("billed_paid_amt", name, where)

def _paid_parts(of: DataFrame) -> list[Column]:
    """Sum and count of paid amounts: the parts of the paid average (both over non-NULL amounts)."""
    paid = _is(C.PAID_FIRST_PASS)
    if "cell_claims" in of.columns:
        n = F.coalesce(F.sum(F.when(paid, F.col("cell_amounts"))), F.lit(0))
    else:
        n = F.count(F.when(paid, F.col("billed_paid_amt")))
    return [*_billed_parts(of, "paid", paid), n.alias("paid_n")]

def _paid_avg() -> Column:
    return F.try_divide(money_value("paid"), F.col("paid_n").cast("double"))

# -- M7, M8, M15 ---------------------------------------------------------------

def clean_claim_rate(fact: DataFrame) -> DataFrame:
    """M7/A3: overall clean-claim rate with totals."""
    n = _claims(fact)
    return fact.agg(
        pct(_claims(fact, _is(C.PAID_FIRST_PASS)), n).alias("clean_claim_rate_pct"),
        n.alias("total_claims"),
        _claims(fact, _is(C.DENIED)).alias("denied_claims"),
    )

def clean_claim_rate_by_provider(fact: DataFrame, min_claims: int = C.MIN_CLAIMS_PER_PROVIDER,
                                 sort: bool = True) -> DataFrame:
    """Clean-claim rate per provider with at least ``min_claims``.

    The NULL provider stays a group (D23). Sorted by rate ascending, ties by
    provider (NULL last, D14).
    """
    n = _claims(fact)
    out = (fact.groupBy("provider_id")
           .agg(n.alias("total_claims"),
                pct(_claims(fact, _is(C.PAID_FIRST_PASS)), n).alias("clean_claim_rate_pct"))
           .filter(F.col("total_claims") >= min_claims))
    if sort:
        out = out.orderBy(F.col("clean_claim_rate_pct").asc_nulls_last(),
                          F.col("provider_id").asc_nulls_last())
    return out

def worst_providers(by_provider: DataFrame, k: int = C.WORST_PROVIDERS) -> DataFrame:
    """T4: the ``k`` providers with the lowest clean-claim rate."""
    return top_k(by_provider, [F.col("clean_claim_rate_pct").asc_nulls_last(),
                               F.col("provider_id").asc_nulls_last()], k)

def claim_type_summary(fact: DataFrame) -> DataFrame:
    """Volume, denials, rounded clean rate and paid total per claim type."""
    n = _claims(fact)
    by_type = fact.groupBy("claim_type").agg(
        n.alias("total_claims"),
        _claims(fact, _is(C.DENIED)).alias("denied_claims"),
        round2(pct(_claims(fact, _is(C.PAID_FIRST_PASS)), n)).alias("clean_claim_rate_pct"),
        *_billed_parts(fact, "billed"),
    )
    return by_type.select("claim_type", "total_claims", "denied_claims", "clean_claim_rate_pct",
                          round2(money_value("billed")).alias("total_paid_amt"))

# -- per-type paid averages ------------------------------------------------------

def avg_paid_by_type(fact: DataFrame) -> DataFrame:
    """A5: average paid amount of first-pass-paid claims per claim type."""
    return (fact.filter(_is(C.PAID_FIRST_PASS)).groupBy("claim_type")
            .agg(*_paid_parts(fact))
            .select("claim_type", _paid_avg().alias("avg_paid_amt")))

def _type_averages(parts: DataFrame) -> DataFrame:
    """Per-type average from a pre-aggregate holding paid_sum/paid_n per type.

    Types without a paid claim are absent, as with the inner join of the
    original models (D22). At most one row per claim type (closed domain).
    """
    return (parts.groupBy("claim_type")
            .agg(*more_parts("paid"), F.sum("paid_n").alias("paid_n"))
            .filter(F.col("paid_n") > 0)
            .select("claim_type", _paid_avg().alias("avg_paid_amt")))

# -- M9, M13, M16 ----------------------------------------------------------------

def ar_aging_matrix(fact: DataFrame) -> DataFrame:
    """Denied claims and the at-risk proxy per (provider, aging bucket).

    The proxy of a denied claim is the paid average of its claim type.
    """
    parts = (fact.groupBy("provider_id", "ar_aging_bucket", "claim_type")
             .agg(_claims(fact, _is(C.DENIED)).alias("n_denied"), *_paid_parts(fact)))
    # claim_type has a closed two-value domain: the average table is tiny.
    avg = bounded_broadcast(_type_averages(parts))
    return (parts.filter(F.col("n_denied") > 0)
            .join(avg, "claim_type", "inner")
            .groupBy("provider_id", "ar_aging_bucket")
            .agg(F.sum("n_denied").alias("claim_count"),
                 round2(F.sum(F.col("n_denied") * F.col("avg_paid_amt"))).alias("at_risk_amt_proxy")))

def ar_aging_totals(matrix: DataFrame) -> DataFrame:
    """The matrix re-aggregated per aging bucket."""
    return matrix.groupBy("ar_aging_bucket").agg(
        F.sum("claim_count").alias("claim_count"),
        money_sum("at_risk_amt_proxy").alias("at_risk_amt_proxy"))

def ar_matrix_top_providers(matrix: DataFrame, k: int = C.HEATMAP_PROVIDERS) -> DataFrame:
    """Provider x bucket heatmap, the ``k`` largest total exposures."""
    wide = pivot_fixed(matrix, "provider_id", "ar_aging_bucket", C.AGING_BUCKETS,
                       "at_risk_amt_proxy", total_col="total")
    wide = wide.withColumnRenamed("provider_id", "provider")
    return top_k(wide, [F.col("total").desc_nulls_last(), F.col("provider").asc_nulls_last()], k)

# -- M10, M12 --------------------------------------------------------------------

def top_carc_denials(fact: DataFrame, dim_carc: DataFrame, sort: bool = True) -> DataFrame:
    """Denials per reason code with an estimated loss.

    The loss proxy is the overall paid average (all types, D21). The fact
    is reduced to one row per reason code first (partial aggregation makes
    the NULL code of paid claims one row per task). That result is bounded
    by the reason-code domain (the codes of the weighted pool, plus NULL), so the overall average is a window over it: the fact is read in
    a single pass. The lookup joins only the small result, dropping NULL
    and unmapped codes.
    """
    parts = (fact.groupBy("carc_code")
             .agg(_claims(fact, _is(C.DENIED)).alias("n_denied"), *_paid_parts(fact)))
    every_code = Window.partitionBy(F.lit(0))  # at most one row per code
    every = parts.select("carc_code", "n_denied", *more_parts("paid", over=every_code),
                         F.sum("paid_n").over(every_code).alias("paid_n"))
    per_code = (every.withColumn("avg_paid", _paid_avg())
                .filter((F.col("n_denied") > 0) & F.col("carc_code").isNotNull()))
    out = (per_code.join(dim_carc, "carc_code", "inner")
           .select("carc_code", "description", "preventability_bucket",
                   F.col("n_denied").alias("denial_count"),
                   round2(F.col("n_denied") * F.col("avg_paid")).alias("estimated_financial_loss")))
    if sort:
        out = out.orderBy(F.col("estimated_financial_loss").desc_nulls_last(),
                          F.col("carc_code").asc_nulls_last())
    return out

def top_reasons(top_carc: DataFrame, k: int = C.TOP_REASONS) -> DataFrame:
    """The ``k`` reasons with the largest estimated loss."""
    return top_k(top_carc, [F.col("estimated_financial_loss").desc_nulls_last(),
                            F.col("carc_code").asc_nulls_last()], k)

def preventability_mix(top_carc: DataFrame) -> DataFrame:
    """Denials and loss per preventability bucket (sums rounded losses)."""
    return top_carc.groupBy("preventability_bucket").agg(
        F.sum("denial_count").alias("denial_count"),
        money_sum("estimated_financial_loss").alias("estimated_financial_loss"))

# -- M11 -------------------------------------------------------------------------

def header_cards(fact: DataFrame, scope: str = "all") -> DataFrame:
    """Expected revenue, net collection ratio, clean rate, overdue A/R.

    Expected amount: the type's paid average for a denied claim, the paid
    amount for any other status; claims of a type without paid claims (D22)
    or without a type drop out.
    ``scope="all"`` (default, D10/D11): the clean rate counts every claim and
    the overdue amount is rounded. ``scope="joined"`` is the warehouse-mart
    variant: the clean rate counts only claims of types with an average and
    the overdue amount is not rounded. With no overdue denial it is NULL.
    One pass: per-type parts, then a global aggregate over at most one row
    per claim type.
    """
    if scope not in ("all", "joined"):
        raise ValueError(f"unknown scope {scope!r}")
    paid, denied = _is(C.PAID_FIRST_PASS), _is(C.DENIED)
    t = fact.groupBy("claim_type").agg(
        _claims(fact).alias("n_all"),
        _claims(fact, paid).alias("n_paid"),
        _claims(fact, denied).alias("n_denied"),
        _claims(fact, denied & (F.col("ar_aging_bucket") == C.AGING_OVERFLOW)).alias("n_overdue"),
        *_billed_parts(fact, "billed"),
        *_billed_parts(fact, "kept", ~denied),
        *_paid_parts(fact),
    )
    joined = (F.col("paid_n") > 0) & F.col("claim_type").isNotNull()
    expected = F.coalesce(money_value("kept"), F.lit(0.0)) + F.col("n_denied") * _paid_avg()
    t = t.withColumn("expected", F.when(joined, expected)).withColumn("joined", joined)
    t = t.withColumn("overdue", F.when(joined & (F.col("n_overdue") > 0), F.col("n_overdue") * _paid_avg()))
    t = t.groupBy().agg(
        F.sum("expected").alias("expected"), F.sum("overdue").alias("overdue"), *more_parts("billed", F.col("joined")),
        F.sum("n_paid").alias("n_paid"), F.sum("n_all").alias("n_all"),
        F.sum(F.when(F.col("joined"), F.col("n_paid"))).alias("joined_paid"),
        F.sum(F.when(F.col("joined"), F.col("n_all"))).alias("joined_all"))
    overdue = F.col("overdue")
    if scope == "all":
        clean = pct("n_paid", "n_all")
        overdue = round2(overdue)
    else:
        clean = pct("joined_paid", "joined_all")
    return t.select(
        F.col("expected").alias("total_expected_revenue"),
        F.try_divide(money_value("billed") * F.lit(100.0), F.nullif(F.col("expected"), F.lit(0.0)))
        .alias("net_collection_ratio_pct"),
        clean.alias("clean_claim_rate_pct"),
        overdue.alias("overdue_ar_90plus"),
    )


# -- M14 -------------------------------------------------------------------------

def provider_extremes(by_provider: DataFrame, min_claims: int = C.MIN_CLAIMS_FOR_EXTREMES,
                      k: int = C.EXTREMES_SIZE) -> DataFrame:
    """Best and worst ``k`` providers by clean rate (at least ``min_claims``).

    Worst: rate ascending, volume descending; best: rate descending, volume
    descending; both end in the provider id (NULL last). A provider in both
    lists is labelled as bottom (D26).
    """
    base = by_provider.filter(F.col("total_claims") >= min_claims).select(
        "provider_id", "total_claims", "clean_claim_rate_pct")
    rate, vol, key = F.col("clean_claim_rate_pct"), F.col("total_claims"), F.col("provider_id")
    low = [rate.asc_nulls_last(), vol.desc_nulls_last(), key.asc_nulls_last()]
    high = [rate.desc_nulls_last(), vol.desc_nulls_last(), key.asc_nulls_last()]
    out = two_sided_extremes(base, low, high, k, C.RANK_BOTTOM, C.RANK_TOP)
    return out.orderBy(rate.asc_nulls_last(), vol.desc_nulls_last(), key.asc_nulls_last())
