"""Raw file sources.

Raw claim and beneficiary files are header CSVs whose every column is text.
They are read by their header without ``inferSchema`` (no pass over the
data, every column text) and tagged with their source. For repeated queries convert
them once to Parquet (``sinks.write_parquet``): CSV cannot prune columns.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from claimlens.constants import INPATIENT, OUTPATIENT
from claimlens.functions.exprs import strip_text


def all_string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_text_csv(spark: SparkSession, path: str,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV, every column text, named by the file's own header.

    ``columns`` picks columns by name, whatever their order in the file; one
    that the header lacks is an error.
    """
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if columns is None:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


REJECTED_LINE = "_rejected_line"


def read_checked_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     header: bool = True) -> tuple[DataFrame, DataFrame]:
    """S1 with an account of malformed lines: (rows, rejected).

    A line is malformed if it has not as many fields as the header (or as
    ``columns``, for a file without one). ``rows`` are the well-formed ones,
    every column text; ``rejected`` has file and line of the others.
    ``read_text_csv`` by contrast takes what fits of such lines. Both results
    parse whole lines, without column pruning: land them before repeated use.
    """
    if header:
        names = spark.read.option("header", True).csv(path).columns
        missing = [c for c in columns or () if c not in names]
        if missing:
            raise ValueError(f"{path} has no columns {missing}")
    elif not columns:
        raise ValueError("a file without header needs its columns")
    else:
        names = list(columns)
    schema = StructType([*all_string_schema(names).fields, StructField(REJECTED_LINE, StringType(), True)])
    every = (spark.read.schema(schema).option("header", header).option("enforceSchema", True)
             .option("mode", "PERMISSIVE").option("columnPruning", False)
             .option("columnNameOfCorruptRecord", REJECTED_LINE).csv(path))
    # Spark refuses a scan of the malformed line alone, so a field is read beside it (its length is never under 0).
    every = every.filter(F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0)
    rows = every.filter(F.col(REJECTED_LINE).isNull()).select(*[F.col(f"`{c}`") for c in columns or names])
    rejected = every.filter(F.col(REJECTED_LINE).isNotNull())
    return rows, rejected.select(F.input_file_name().alias("file"), F.col(REJECTED_LINE).alias("line"))


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Malformed lines per file: file, n_rejected."""
    return rejected.groupBy("file").agg(F.count(F.lit(1)).alias("n_rejected"))


def tag_source(df: DataFrame, column: str, value) -> DataFrame:
    """S3: constant source tag column (e.g. the claim type of a file)."""
    return df.withColumn(column, F.lit(value))


def read_claim_files(spark: SparkSession, inpatient_path: str, outpatient_path: str,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """S1 + S3 + U3: both claim files, tagged with CLAIM_TYPE, unioned by name.

    Without ``columns`` each file keeps its own layout; a column that only one
    has is NULL in the other.
    """
    inpatient = tag_source(read_text_csv(spark, inpatient_path, columns), "CLAIM_TYPE", INPATIENT)
    outpatient = tag_source(read_text_csv(spark, outpatient_path, columns), "CLAIM_TYPE", OUTPATIENT)
    return inpatient.unionByName(outpatient, allowMissingColumns=True)


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column missing in a frame becomes NULL."""
    frames = list(frames)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_yearly(spark: SparkSession, path_template: str, years: Iterable[int],
                year_column: str = "SNAPSHOT_YEAR") -> DataFrame:
    """One text CSV per year (``path_template`` has ``{year}``), tagged and unioned."""
    frames = [tag_source(read_text_csv(spark, path_template.format(year=y)), year_column, int(y))
              for y in years]
    return union_by_name(frames)


def clean_lookup(df: DataFrame, code: str = "carc_code",
                 description: str = "description") -> DataFrame:
    """Two-column code lookup; rows without a code are dropped, codes stripped."""
    first, second = df.columns[0], df.columns[1]
    return (df.select(F.col(first).alias(code), F.col(second).cast("string").alias(description))
              .filter(F.col(code).isNotNull())
              .withColumn(code, strip_text(code)))


def read_lookup(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a (code, description) lookup from CSV (header) or Parquet."""
    if fmt == "csv":
        raw = read_text_csv(spark, path)
    else:
        raw = spark.read.format(fmt).load(path)
    return clean_lookup(raw)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """Literal rows as a small relation.

    Built as ``inline(array(struct(...)))`` over a one-row range, so the
    rows live in the plan itself: Catalyst sees a tiny relation (joins with
    it broadcast) and no Python RDD is created.
    """
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.range(1).select(F.inline(F.array(*structs)))


def lookup_from_rows(spark: SparkSession, rows: Sequence[tuple],
                     columns: Sequence[str] = ("carc_code", "description")) -> DataFrame:
    """Literal (code, description) rows as a small relation."""
    return literal_table(spark, rows, all_string_schema(columns))
