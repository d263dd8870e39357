"""The star schema as one object: raw inputs -> dims + fact (lazy), with an
option to materialise every relation as Parquet in the shared scratch folder
(the marts are then read from files, which also cuts the lineage).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from claimlens.plans import dims, fact as factmod, kpis
from claimlens.session import new_scratch_path
from claimlens.sinks import write_parquet
from claimlens.sources import fixtures
from claimlens.sources.files import read_claim_files, read_lookup, read_yearly


@dataclass
class Warehouse:
    spark: SparkSession
    segments: DataFrame
    beneficiaries: DataFrame
    carc_lookup_raw: DataFrame
    as_of: object = None
    root: str | None = None  # of the stored relations
    _cache: dict = field(default_factory=dict, repr=False)

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    # -- staging ---------------------------------------------------------------
    @property
    def claim_detail(self) -> DataFrame:
        return self._get("claim_detail", lambda: factmod.claim_detail(self.segments))

    @property
    def fact_base(self) -> DataFrame:
        return self._get("fact_base", lambda: factmod.fact_base(self.claim_detail))

    # -- dimensions ---------------------------------------------------------
    @property
    def dim_patient(self) -> DataFrame:
        return self._get("dim_patient", lambda: dims.dim_patient(self.beneficiaries))

    @property
    def dim_provider(self) -> DataFrame:
        return self._get("dim_provider", lambda: dims.dim_provider(self.segments))

    @property
    def dim_diagnosis(self) -> DataFrame:
        return self._get("dim_diagnosis", lambda: dims.dim_diagnosis(self.segments))

    @property
    def dim_carc_denials(self) -> DataFrame:
        return self._get("dim_carc_denials", lambda: dims.dim_carc_denials(self.carc_lookup_raw))

    # -- fact -----------------------------------------------------------------
    @property
    def carc_draws(self) -> DataFrame:
        """The reason-code pool as a list of draws (one row)."""
        def build():
            pool = factmod.carc_pool(factmod.carc_weights(self.spark), self.dim_carc_denials)
            return factmod.carc_draws(pool)
        return self._get("carc_draws", build)

    @property
    def as_of_date(self):
        """The as-of date: the given one, or the latest segment date as a lazy scalar subquery."""
        if self.as_of is not None:
            return self.as_of
        return self._get("as_of_date", lambda: factmod.as_of_date(self.claim_detail))

    @property
    def fact(self) -> DataFrame:
        return self._get("fact", lambda: factmod.fact_claims(self.fact_base, self.carc_draws,
                                                             self.as_of_date))

    @property
    def claim_cells(self) -> DataFrame:
        """The fact counted by all keys of the KPI models (``kpis.claim_cells``)."""
        return self._get("claim_cells", lambda: kpis.claim_cells(self.fact))

    TABLES = ("dim_patient", "dim_provider", "dim_diagnosis", "dim_carc_denials", "fact", "claim_cells")

    def land(self, root: str | None = None) -> "Warehouse":
        """Write the raw segments once as Parquet (the landing copy) and return
        a warehouse whose models all read that copy: the raw parse (or, for
        the test tables, the derivation join) runs once, and every later scan
        prunes columns and pushes filters."""
        root = root or new_scratch_path(self.spark, "landing")
        path = write_parquet(self.segments, f"{root}/claim_segments")
        segments = self.spark.read.parquet(path)
        return Warehouse(self.spark, segments, self.beneficiaries, self.carc_lookup_raw, self.as_of)

    def materialize(self, root: str | None = None,
                    tables: Sequence[str] = TABLES,
                    partition_fact_by: str | None = "claim_type",
                    land_segments: bool = False) -> "Warehouse":
        """Write the listed relations as Parquet and return a warehouse reading them.

        With ``land_segments`` the raw segments are landed first (see
        ``land``), so the dimensions and the fact share one parse of raw text
        files. The fact is partitioned by claim type (K4) like the original
        layout.
        """
        root = root or new_scratch_path(self.spark, "warehouse")
        if land_segments:
            return self.land(root).materialize(root, tables, partition_fact_by, land_segments=False)
        cache = dict(self._cache)
        for name in tables:
            path = f"{root}/{name}"
            part = partition_fact_by if name == "fact" else None
            stored_fact = name == "claim_cells" and "fact" in tables[:list(tables).index(name)]
            df = kpis.claim_cells(cache["fact"]) if stored_fact else getattr(self, name)
            if name == "fact":
                # Cluster each file by status (a per-task sort, no shuffle):
                # Parquet row-group statistics then let a pushed status filter
                # (denials are a few percent of claims) skip most row groups.
                df = df.sortWithinPartitions("adjudication_status")
            write_parquet(df, path, partition_by=part)
            df = self.spark.read.parquet(path)
            if name == "fact":
                df = df.select(*factmod.FACT_COLUMNS)
            cache[name] = df
        return replace(self, root=root, _cache=cache)


def from_raw(spark: SparkSession, segments: DataFrame, yearly_beneficiaries: list[DataFrame],
             carc_lookup_raw: DataFrame, as_of=None) -> Warehouse:
    return Warehouse(spark, segments, dims.beneficiaries(yearly_beneficiaries),
                     carc_lookup_raw, as_of)


def from_test_tables(spark: SparkSession, sf_dir: str, as_of=None, odd_amounts: bool = False) -> Warehouse:
    """Warehouse over claims-shaped frames derived from the test tables."""
    return from_raw(spark, fixtures.claim_segments(spark, sf_dir, odd_amounts),
                    fixtures.beneficiary_files(spark, sf_dir),
                    fixtures.carc_lookup_raw(spark), as_of)


def from_files(spark: SparkSession, inpatient_path: str, outpatient_path: str,
               beneficiary_template: str, years, lookup_path: str,
               lookup_format: str = "csv", as_of=None) -> Warehouse:
    """Warehouse over the raw files: two all-text claim CSVs, one beneficiary
    CSV per year (``beneficiary_template`` contains ``{year}``) and a
    two-column reason-code lookup (CSV with header, or Parquet)."""
    segments = read_claim_files(spark, inpatient_path, outpatient_path)
    bene = read_yearly(spark, beneficiary_template, years)
    lookup = read_lookup(spark, lookup_path, lookup_format)
    return Warehouse(spark, segments, bene, lookup, as_of)
