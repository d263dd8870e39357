"""Dashboard extract.

The extract has bounded sections (header cards, top-k lists, DQ counts)
and one data-sized section (the full provider x bucket A/R matrix). As rows
it is a flat relation ``(section, key1, key2, field, num, txt)``; as files it
is one JSON object of the bounded sections, built by Spark, plus the matrix
as a distributed JSON-lines dataset. Nothing passes through the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.operators.joins import bounded_broadcast
from claimlens.plans import kpis, quality
from claimlens.sinks import write_json

FLAT_SCHEMA = ("section", "key1", "key2", "field", "num", "txt")


def _flat(df: DataFrame, section: str, num: Sequence[str], txt: Sequence[str] = (),
          key1: str | None = None, key2: str | None = None) -> DataFrame:
    """Unpivot named fields of ``df`` into flat dashboard rows."""
    def key(k: str | None) -> Column:
        return F.col(k).cast("string") if k else F.lit(None).cast("string")

    def q(name: str) -> Column:
        return F.col(f"`{name}`")

    entries = [F.struct(F.lit(f).alias("field"), q(f).cast("double").alias("num"),
                        F.lit(None).cast("string").alias("txt")) for f in num]
    entries += [F.struct(F.lit(f).alias("field"), F.lit(None).cast("double").alias("num"),
                         q(f).cast("string").alias("txt")) for f in txt]
    return df.select(F.lit(section).alias("section"), key(key1).alias("key1"),
                     key(key2).alias("key2"), F.inline(F.array(*entries)))


def sections(wh) -> dict[str, DataFrame]:
    """Each dashboard section as its own DataFrame (the original layout).

    All KPI sections read the claim cells, so over a stored warehouse the
    fact is scanned once for them, when the cells are written.
    """
    cells = wh.claim_cells
    by_provider = kpis.clean_claim_rate_by_provider(cells, sort=False)
    matrix = kpis.ar_aging_matrix(cells)
    top_carc = kpis.top_carc_denials(cells, wh.dim_carc_denials, sort=False)
    dq = quality.dq_counts(wh.fact, wh.dim_patient, wh.dim_diagnosis)
    return {
        "header_cards": kpis.header_cards(cells),
        "clean_claim_rate": kpis.clean_claim_rate(cells),
        "top_carc_denials": kpis.top_reasons(top_carc, C.TOP_REASONS),
        "ar_aging_matrix": matrix,
        "clean_claim_by_provider_worst10": kpis.worst_providers(by_provider, C.WORST_PROVIDERS),
        "dq": dq,
        "ar_matrix_top_providers": kpis.ar_matrix_top_providers(matrix, C.HEATMAP_PROVIDERS),
    }


def dashboard_rows(wh) -> DataFrame:
    """The whole extract as flat rows (one relation, one job)."""
    s = sections(wh)
    parts = [
        _flat(s["header_cards"], "header_cards",
              ["total_expected_revenue", "net_collection_ratio_pct", "clean_claim_rate_pct",
               "overdue_ar_90plus"]),
        _flat(s["clean_claim_rate"], "clean_claim_rate",
              ["clean_claim_rate_pct", "total_claims", "denied_claims"]),
        _flat(s["top_carc_denials"], "top_carc_denials",
              ["denial_count", "estimated_financial_loss"], ["description", "preventability_bucket"],
              key1="carc_code"),
        _flat(s["ar_aging_matrix"], "ar_aging_matrix", ["claim_count", "at_risk_amt_proxy"],
              key1="provider_id", key2="ar_aging_bucket"),
        _flat(s["clean_claim_by_provider_worst10"], "clean_claim_by_provider_worst10",
              ["total_claims", "clean_claim_rate_pct"], key1="provider_id"),
        s["dq"].select(F.col("check").alias("section"), F.lit(None).cast("string").alias("key1"),
                       F.lit(None).cast("string").alias("key2"), F.lit("n").alias("field"),
                       F.col("n_failing").cast("double").alias("num"),
                       F.lit(None).cast("string").alias("txt")),
        _flat(s["ar_matrix_top_providers"], "ar_matrix_top_providers",
              list(C.AGING_BUCKETS) + ["total"], key1="provider"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dashboard_object(wh) -> DataFrame:
    """K6: the bounded sections as one row that is one JSON object when written.

    Single-row sections are structs, the failing counts of the checks are
    numbers, the lists are arrays of structs in their order (at most a few
    rows each, by their top-k limits).
    """
    s = sections(wh)

    def struct(df: DataFrame) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in df.columns])

    def one(name: str) -> DataFrame:
        return s[name].select(struct(s[name]).alias(name))

    def rows(name: str, *order: tuple[str, int]) -> DataFrame:
        key = F.struct(*[(sign * F.col(f"`{c}`") if sign else F.col(c)).alias(f"k{i}") for i, (c, sign) in enumerate(order)])
        listed = F.sort_array(F.collect_list(F.struct(key.alias("key"), struct(s[name]).alias("row"))))
        return s[name].agg(F.transform(listed, lambda x: x["row"]).alias(name))

    checks = s["dq"].groupBy().pivot("check", list(quality.DQ_CHECKS)).agg(F.sum("n_failing"))
    parts = [
        one("clean_claim_rate"),
        rows("top_carc_denials", ("estimated_financial_loss", -1), ("carc_code", 0)),
        rows("clean_claim_by_provider_worst10", ("clean_claim_rate_pct", 1), ("provider_id", 0)),
        checks,
        rows("ar_matrix_top_providers", ("total", -1), ("provider", 0)),
    ]
    out = one("header_cards")
    for p in parts:  # each is one row
        out = out.join(bounded_broadcast(p), how="cross")
    return out


def write_dashboard(wh, path: str) -> dict[str, str]:
    """K6: ``path/data`` (one JSON object) and ``path/ar_aging_matrix`` (JSON lines, written in parallel)."""
    return {
        "data": write_json(dashboard_object(wh), f"{path}/data", single_file=True),
        "ar_aging_matrix": write_json(kpis.ar_aging_matrix(wh.claim_cells), f"{path}/ar_aging_matrix"),
    }
