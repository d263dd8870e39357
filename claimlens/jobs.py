"""The batch jobs of the warehouse, as functions (no argument parsing).

``build_warehouse``: raw files -> landed segments -> star schema as Parquet
under ``output`` (dims, fact partitioned by claim type).
``publish_marts``: star schema -> KPI and data-quality relations, stored and named.
``export_dashboard``: star schema -> dashboard extract under ``output``.
All paths should be on shared storage; nothing is collected to the driver.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import SparkSession

from claimlens.plans import dashboard, fact as factmod, kpis, quality, warehouse
from claimlens.sinks import publish, publish_view


def build_warehouse(spark: SparkSession, inpatient_path: str, outpatient_path: str,
                    beneficiary_template: str, years: Iterable[int], lookup_path: str,
                    output: str, lookup_format: str = "csv", as_of=None) -> warehouse.Warehouse:
    """Parse the raw files once (landing copy), then write every table."""
    wh = warehouse.from_files(spark, inpatient_path, outpatient_path, beneficiary_template,
                              list(years), lookup_path, lookup_format, as_of)
    return wh.materialize(output, land_segments=True)


def publish_marts(wh: warehouse.Warehouse, output: str, prefix: str = "") -> dict[str, str]:
    """Give every mart a name in the catalog: staging as a view, KPI and DQ relations as stored tables.

    ``wh`` must be stored (``materialize``) with its fact: the staging view reads
    that, the KPI marts its cells. Returns each relation's kind; every
    session can read them with ``spark.table(prefix + name)``, and running the
    job again replaces them one by one (``sinks.publish``).
    """
    if wh.root is None:
        raise ValueError("publish_marts needs a stored warehouse")
    cells = wh.claim_cells
    by_provider = kpis.clean_claim_rate_by_provider(cells, sort=False)
    matrix = kpis.ar_aging_matrix(cells)
    top_carc = kpis.top_carc_denials(cells, wh.dim_carc_denials, sort=False)
    tables = {
        "kpi_clean_claim_rate": kpis.clean_claim_rate(cells),
        "kpi_clean_claim_rate_by_provider": by_provider,
        "kpi_ar_aging_matrix": matrix,
        "kpi_top_carc_denials": top_carc,
        "kpi_header_cards": kpis.header_cards(cells),
        "kpi_preventability_mix": kpis.preventability_mix(top_carc),
        "kpi_ar_aging_totals": kpis.ar_aging_totals(matrix),
        "kpi_provider_extremes": kpis.provider_extremes(by_provider),
        "kpi_claim_type_summary": kpis.claim_type_summary(cells),
        "dq_orphaned_claims": quality.orphaned_claims(wh.fact, wh.dim_patient),
        "dq_duplicate_claim_ids": quality.duplicate_claim_ids(wh.fact),
        "dq_unmapped_diagnosis": quality.unmapped_diagnosis(wh.fact, wh.dim_diagnosis),
    }
    publish_view(wh.spark, f"{prefix}stg_fact_claims_adjudication", f"{wh.root}/fact", list(factmod.FACT_COLUMNS))
    for name, df in tables.items():
        publish(df, prefix + name, f"{output}/{name}")
    return {"stg_fact_claims_adjudication": "view"} | dict.fromkeys(tables, "table")


def export_dashboard(wh: warehouse.Warehouse, output: str) -> dict[str, str]:
    """Write the dashboard extract (one object of bounded sections + parallel A/R matrix)."""
    return dashboard.write_dashboard(wh, output)
