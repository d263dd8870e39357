"""Join building blocks.

Broadcast hints are only placed on relations whose size is bounded by
construction (a grouping over a closed domain, a literal table). All other
joins leave the choice to Spark's byte threshold and to adaptive execution.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a relation whose row count is bounded by construction.

    Callers state the bound at the call site (closed domain, literal table,
    fixed slot count); this is never used on data-sized input.
    """
    return F.broadcast(df)


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner equi-join on shared key column(s)."""
    return left.join(right, on, "inner")


def anti_join(left: DataFrame, right: DataFrame, left_key: str,
              right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` whose key has no match in ``right``.

    Same result as a LEFT JOIN followed by ``right.key IS NULL`` (written as
    an anti join because Catalyst does not rewrite that form). A NULL key
    never matches, so NULL-keyed rows bypass the join: a NULL key holding a
    large share of the rows is never shuffled into one partition. A hot
    non-NULL key is left to AQE's skew-join split. Only the key column of
    ``right`` is read.
    """
    right_key = right_key or left_key
    keys = right.select(F.col(right_key).alias("__rk")).filter(F.col("__rk").isNotNull())
    present = left.filter(F.col(left_key).isNotNull())
    missing = present.join(keys, present[left_key] == keys["__rk"], "left_anti")
    return left.filter(F.col(left_key).isNull()).unionByName(missing)


def anti_join_non_null(left: DataFrame, right: DataFrame, left_key: str,
                       right_key: str | None = None) -> DataFrame:
    """Rows with a non-NULL key that has no match in ``right``."""
    right_key = right_key or left_key
    keys = right.select(F.col(right_key).alias("__rk")).filter(F.col("__rk").isNotNull())
    present = left.filter(F.col(left_key).isNotNull())
    return present.join(keys, present[left_key] == keys["__rk"], "left_anti")


def scalar(df: DataFrame) -> Column:
    """A one-row, one-column relation as an uncorrelated scalar subquery.

    Evaluated once by Spark and inlined; nothing is collected to the driver
    (replaces the collect-and-reinline pattern, J7).
    """
    return df.scalar()
