"""Sinks (K1-K7): views, Parquet tables, partitioned tables, JSON extracts.

All writes are distributed Spark writes into a shared folder; nothing is
collected to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def create_view(df: DataFrame, name: str) -> DataFrame:
    """K1: create-or-replace a temporary view; returns ``df``."""
    df.createOrReplaceTempView(name)
    return df


def write_parquet(df: DataFrame, path: str, partition_by: str | list[str] | None = None,
                  mode: str = "overwrite") -> str:
    """K2/K3/K4: write a Parquet table (optionally partitioned by column)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.parquet(path)
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: str | list[str]) -> str:
    """K4: overwrite only the partitions that ``df`` has rows of; all others keep their files."""
    keys = [partition_by] if isinstance(partition_by, str) else partition_by
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    return path


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """A catalog table of ``buckets`` files, dealt and sorted by ``key``; returns its scan.

    Tables of equal buckets join on the key, and group by it, without a
    shuffle. The rows are dealt as the buckets are, so each is one file.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)


def publish(df: DataFrame, name: str, path: str) -> str:
    """A relation in the catalog that every session reads by ``name``; returns its folder.

    Each call writes a folder of its own under ``path`` and then points the name
    at it, which is one catalog operation: readers see the old rows or the
    new ones, a write that fails leaves the old, and the columns may change.
    Folders of earlier versions stay for readers that have begun.
    """
    folder = f"{path}/v-{uuid.uuid4().hex[:12]}"
    write_parquet(df, folder, mode="errorifexists")
    publish_view(df.sparkSession, name, folder)
    return folder


def publish_view(spark: SparkSession, name: str, folder: str, columns: list[str] | None = None) -> None:
    """K1: a permanent view of (some columns of) a stored relation, replaced if it is there."""
    listed = ", ".join(f"`{c}`" for c in columns) if columns else "*"
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT {listed} FROM parquet.`{folder}`")


def write_lookup(df: DataFrame, path: str) -> str:
    """K5: small lookup written as a single Parquet file (bounded input only)."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path


def write_json(df: DataFrame, path: str, single_file: bool = False) -> str:
    """K6: JSON lines; ``single_file`` only for bounded results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").json(path)
    return path


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None,
                spark: SparkSession | None = None) -> DataFrame:
    """K7: ``view`` keeps the model lazy; ``table`` writes it and reads it back.

    Both names are this session's; ``publish`` gives one that all sessions read.
    """
    if kind == "view":
        return create_view(df, name)
    if kind != "table":
        raise ValueError(f"unknown materialisation {kind!r}")
    if path is None:
        raise ValueError("a table needs a path")
    spark = spark or df.sparkSession
    write_parquet(df, path)
    return create_view(spark.read.parquet(path), name)
