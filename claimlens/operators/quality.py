"""Declarative integrity tests (Q1-Q3) with the failing-row semantics of the
common warehouse test macros: a test passes when it returns no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows whose ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Q2: non-NULL values of ``column`` occurring more than once, with counts."""
    return (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Q3: values of ``column`` outside ``values`` (NULL passes), with counts."""
    return (df.filter(~F.col(column).isin(list(values)))
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


@dataclass(frozen=True)
class SchemaTest:
    relation: str
    column: str
    test: str
    values: tuple = ()

    def failures(self, df: DataFrame) -> DataFrame:
        if self.test == "not_null":
            return not_null_failures(df, self.column)
        if self.test == "unique":
            return unique_failures(df, self.column)
        if self.test == "accepted_values":
            return accepted_values_failures(df, self.column, self.values)
        raise ValueError(f"unknown test {self.test}")


def _relation_results(df: DataFrame, relation: str, tests: Sequence[SchemaTest]) -> DataFrame:
    """Failing counts of every test on one relation, in one pass.

    The tested columns are unpivoted to (column, value) and counted by value,
    partially aggregated before the shuffle, so a hot value costs one row per
    task; a second aggregation over the counts answers all tests at once.
    Of a column with ``not_null`` tests only, all present values are one.
    Values are compared as text.
    """
    kinds: dict[str, set[str]] = {}
    for t in tests:
        if t.test not in ("not_null", "unique", "accepted_values"):
            raise ValueError(f"unknown test {t.test}")
        kinds.setdefault(t.column, set()).add(t.test)
    cells = [F.struct(F.lit(i).alias("at"), (F.when(F.col(c).isNotNull(), "") if k == {"not_null"} else F.col(c).cast("string"))
                      .alias("v")) for i, (c, k) in enumerate(kinds.items())]
    per_value = df.select(F.inline(F.array(*cells))).groupBy("at", "v").agg(F.count(F.lit(1)).alias("n"))
    v, n, place = F.col("v"), F.col("n"), {c: i for i, c in enumerate(kinds)}
    counts = []
    for i, t in enumerate(tests):
        here = F.col("at") == place[t.column]
        if t.test == "not_null":
            failing = F.coalesce(F.sum(F.when(here & v.isNull(), n)), F.lit(0))
        elif t.test == "unique":
            failing = F.count_if(here & v.isNotNull() & (n > 1))
        else:
            failing = F.count_if(here & v.isNotNull() & ~v.isin([str(x) for x in t.values]))
        counts.append(failing.cast("long").alias(f"t{i}"))
    rows = [F.struct(F.lit(t.column).alias("column"), F.lit(t.test).alias("test"), F.col(f"t{i}").alias("n_failing"))
            for i, t in enumerate(tests)]
    return per_value.agg(*counts).select(F.lit(relation).alias("relation"), F.inline(F.array(*rows)))


def test_report(relations: dict[str, DataFrame], tests: Sequence[SchemaTest]) -> DataFrame:
    """Q7-style report: one row ``(relation, column, test, n_failing)`` per test.

    The failing count of a test equals the number of rows its failing-row
    query returns (``failures``); all tests of a relation share one scan.
    """
    groups: dict[str, list[SchemaTest]] = {}
    for t in tests:
        groups.setdefault(t.relation, []).append(t)
    out = None
    for relation, group in groups.items():
        part = _relation_results(relations[relation], relation, group)
        out = part if out is None else out.unionByName(part)
    return out
