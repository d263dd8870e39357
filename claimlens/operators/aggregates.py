"""Aggregation building blocks."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.exprs import money_parts, money_value, null_to_zero


def columns_with_prefix(df: DataFrame, prefix: str, limit: int | None = None) -> list[str]:
    """Column names starting with ``prefix`` in file order, the first ``limit``."""
    names = [c for c in df.columns if c.startswith(prefix)]
    return names if limit is None else names[:limit]


def distinct_values(df: DataFrame, columns: Sequence[str], name: str,
                    keep: Column | None = None) -> DataFrame:
    """Distinct non-NULL values found in any of ``columns``.

    One scan: the columns are unpivoted with ``explode(array(...))`` and
    partial aggregation collapses repeats per task first. The optional
    ``keep`` predicate (over column ``name``) is costly next to that, so it is
    tested once for each distinct value: it hangs on the group's count, below
    which Catalyst cannot push it.
    """
    values = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
    values = values.filter(F.col(name).isNotNull())
    if keep is None:
        return values.distinct()
    groups = values.groupBy(name).agg(F.count(F.lit(1)).alias("__n"))
    return groups.filter(F.when(F.col("__n") > 0, keep)).select(name)


def duplicate_keys(df: DataFrame, key: str, count_col: str = "n") -> DataFrame:
    """Keys occurring more than once, with their row count."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) > 1))


def row_count(df: DataFrame, label: str, label_col: str = "metric",
              count_col: str = "n") -> DataFrame:
    """One row ``(label, count)``."""
    return df.agg(F.count(F.lit(1)).alias(count_col)).select(
        F.lit(label).alias(label_col), F.col(count_col))


def row_counts(frames: dict[str, DataFrame], label_col: str = "metric",
               count_col: str = "n") -> DataFrame:
    """Several counts as rows of one relation."""
    out = None
    for label, df in frames.items():
        part = row_count(df, label, label_col, count_col)
        out = part if out is None else out.unionByName(part)
    return out


def pivot_fixed(df: DataFrame, key: str, pivot_col: str, values: Sequence[str],
                value_col: str, total_col: str | None = None) -> DataFrame:
    """One row per ``key``, one column per listed pivot value.

    The pivot values are given, so Spark needs no extra job to discover
    them; missing cells become 0 (X24). ``total_col`` adds the sum of the
    cells in the same aggregation (exact, see ``exprs.money_sum``).
    """
    cells = [F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(f"cell {i}")
             for i, v in enumerate(values)]
    listed = F.col(pivot_col).isin(*values)
    total = money_parts(value_col, "total", listed) if total_col else []
    wide = df.groupBy(key).agg(*cells, *total)
    out = [F.col(key), *[null_to_zero(F.col(f"`cell {i}`"), 0.0).alias(v) for i, v in enumerate(values)]]
    if total_col:
        out.append(F.coalesce(money_value("total"), F.lit(0.0)).alias(total_col))
    return wide.select(*out)
