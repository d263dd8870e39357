"""Claims-shaped raw frames derived from the TPC-H-like test tables.

No claims data ships with the project, so the raw inputs are derived from
the test tables (see FIXTURES.md): ``lineitem`` joined to ``orders`` gives
claim segments, ``customer`` gives three yearly beneficiary files. Odd values
are planted by key arithmetic so that every engine sees the same rows. The
output has the raw layout (all text columns) that ``sources.files`` reads
from CSV, so every model downstream runs unchanged on real files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.sources.files import lookup_from_rows

SEGMENT_COLUMNS = (
    "CLM_ID", "DESYNPUF_ID", "PRVDR_NUM", "AT_PHYSN_NPI", "CLM_FROM_DT", "CLM_THRU_DT",
    "CLM_PMT_AMT", "NCH_PRMRY_PYR_CLM_PD_AMT", "ICD9_DGNS_CD_1", "ICD9_DGNS_CD_2",
    "ICD9_DGNS_CD_3", "CLAIM_TYPE",
)
BENEFICIARY_YEARS = (2008, 2009, 2010)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _digits(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def dx_code(n: Column) -> Column:
    """Synthetic ICD-9-like code for integer ``n`` (valid, invalid and NULL mixes)."""
    r = n % 20
    m = n % 1000
    return (F.when(r == 0, F.concat(F.lit("V"), _digits(m, 4)))
             .when(r == 1, F.concat(F.lit("E"), _digits(m, 4)))
             .when(r == 2, F.lit("OTHER"))
             .when(r == 3, F.lit(None).cast("string"))
             .when(r == 4, F.concat(F.lit("A"), _digits(m, 3)))
             .when(r == 5, F.lit("AB12"))
             .otherwise(F.concat(_digits((n * 7) % 1000, 3), (n % 10).cast("string"))))


def _amount_text(c: Column) -> Column:
    return c.cast("decimal(18,4)").cast("string")


def claim_segments(spark: SparkSession, sf_dir: str, odd_amounts: bool = False) -> DataFrame:
    """Raw claim segments (one row per line item), both claim types together.

    The lines are dealt by claim id first, as compact numeric columns: a test
    table is one row group, so its scan is one task, and formatting all text
    there would leave the other cores idle. The join and the rollup by claim id
    find the rows dealt as they need them. ``odd_amounts`` plants payments that a narrow
    decimal cannot hold: very large, very small and (Outpatient only) NaN.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    lines = li.select(F.col("l_orderkey").cast("string").alias("CLM_ID"), "l_orderkey", "l_partkey",
                      "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
                      "l_returnflag", "l_shipdate").repartition("CLM_ID")
    heads = orders.select(F.col("o_orderkey").cast("string").alias("CLM_ID"), "o_custkey",
                          "o_orderpriority")
    k = F.col("l_orderkey")
    line = F.col("l_linenumber")
    ship = F.date_format(F.col("l_shipdate"), "yyyyMMdd")
    inpatient = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    odd = F.when(F.lit(odd_amounts), F.when(k % 500 == 17, "200000000000000").when(k % 500 == 19, "0.00004")
                 .when((k % 500 == 23) & ~inpatient, "NaN"))
    return lines.join(heads, "CLM_ID", "inner").select(
        "CLM_ID",
        F.col("o_custkey").cast("string").alias("DESYNPUF_ID"),
        F.nullif(F.col("l_suppkey"), F.lit(0)).cast("string").alias("PRVDR_NUM"),
        F.when(line == 1, F.lit(None).cast("string"))
         .otherwise((F.lit(1000000000) + F.col("l_suppkey") * 10 + line).cast("string"))
         .alias("AT_PHYSN_NPI"),
        F.when(k % 1000 == 7, F.lit("20011399")).otherwise(ship).alias("CLM_FROM_DT"),
        ship.alias("CLM_THRU_DT"),
        F.when(odd.isNotNull(), odd).when(k % 500 == 3, F.lit(None).cast("string"))
         .when((k % 500 == 11) & (line == 1), F.lit("abc"))
         .when(F.col("l_returnflag") == "R", F.lit("0"))
         .otherwise(_amount_text(F.col("l_extendedprice") * (1 - F.col("l_discount"))))
         .alias("CLM_PMT_AMT"),
        _amount_text(F.col("l_tax") * 100).alias("NCH_PRMRY_PYR_CLM_PD_AMT"),
        dx_code(F.col("l_partkey")).alias("ICD9_DGNS_CD_1"),
        dx_code(F.col("l_partkey") + 1).alias("ICD9_DGNS_CD_2"),
        dx_code(F.col("l_partkey") + 2).alias("ICD9_DGNS_CD_3"),
        F.when(inpatient, F.lit(C.INPATIENT))
         .otherwise(F.lit(C.OUTPATIENT)).alias("CLAIM_TYPE"),
    )


def beneficiary_year(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """Raw beneficiary summary file of one year (2008 lacks the last flag)."""
    cust = table(spark, sf_dir, "customer")
    c = F.col("c_custkey")
    flags = C.CHRONIC_FLAGS if year != 2008 else C.CHRONIC_FLAGS[:-1]
    cols = [
        c.cast("string").alias("DESYNPUF_ID"),
        F.when(c % 50 == 0, F.lit("19201399"))
         .otherwise(F.concat((F.lit(1910) + c % 80).cast("string"), F.lit("0615")))
         .alias("BENE_BIRTH_DT"),
        F.when((c % 10 == 0) & F.lit(year == 2010), F.lit("20100301"))
         .otherwise(F.lit(None).cast("string")).alias("BENE_DEATH_DT"),
        F.when(c % 3 == 0, F.lit("1")).when(c % 3 == 1, F.lit("2"))
         .otherwise(F.lit(None).cast("string")).alias("BENE_SEX_IDENT_CD"),
        (c % 5 + 1).cast("string").alias("BENE_RACE_CD"),
        _digits(F.col("c_nationkey"), 2).alias("SP_STATE_CODE"),
    ]
    for i, name in enumerate(flags, start=1):
        cols.append(F.when((c * i + year) % 7 == 0, F.lit("1")).otherwise(F.lit("2")).alias(name))
    cols.append(F.lit(year).alias("SNAPSHOT_YEAR"))
    # Planted gaps, not sampling: every fourth customer-year has no snapshot
    # (so the latest year varies), and customers ending in 99 have none at
    # all (their claims become orphans for the referential check).
    return cust.filter(((c + year) % 4 != 0) & (c % 100 != 99)).select(*cols)


def beneficiary_files(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [beneficiary_year(spark, sf_dir, y) for y in BENEFICIARY_YEARS]


# Lookup rows of the test tables: the weighted reason codes with texts of our
# own that hit or miss the keywords, followed by edge rows (padded code,
# several keywords, NULL text, NULL code).
CARC_LOOKUP_ROWS = (
    ("18", "Same service billed twice (DUPLICATE)"),
    ("16", "Claim form incomplete"),
    ("197", "No prior authorization on file"),
    ("50", "Fails medical necessity, non-covered"),
    ("29", "Sent after the timely filing window"),
    ("27", "Eligibility had ended"),
    ("96", "Item is Non-Covered by plan"),
    ("119", "Yearly maximum used up"),
    ("109", "Send to another payer"),
    ("1", "Applied to deductible"),
    ("2", "Member coinsurance share"),
    (" 45 ", "Above the fee schedule"),
    ("A1", "duplicate, prior authorization also missing"),
    ("38", "PRIOR AUTHORIZATION expired"),
    ("31", "Member not found, check eligibility"),
    ("22", "Coordination of Benefits needed"),
    ("55", "Medical Necessity review failed"),
    ("ZZ", None),
    (None, "any"),
)


def carc_lookup_raw(spark: SparkSession) -> DataFrame:
    """Raw two-column reason-code lookup (header names as in the source sheet)."""
    return lookup_from_rows(spark, CARC_LOOKUP_ROWS, ("CARC Code", "Description"))


def lookup_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw lookup as large as ``part``: padded, no-break-space and NULL codes, texts with and without keywords."""
    k = F.col("p_partkey")
    code = F.concat(F.lit("P"), k.cast("string"))
    nbsp = "\u00a0"
    padded = (F.when(k % 5 == 0, F.concat(F.lit("  "), code, F.lit(" ")))
              .when(k % 5 == 1, F.concat(F.lit(nbsp), code, F.lit(nbsp + " ")))
              .when(k % 5 == 2, F.lit(None).cast("string")).otherwise(code))
    words = ("Duplicate", "past timely filing", "No PRIOR Authorization", "eligibility", "non-covered", "medical necessity",
             "coordination of benefits", "coinsurance", "deductible", "other")
    word = F.element_at(F.array(*[F.lit(w) for w in words]), (k % len(words)).cast("int") + 1)
    text = F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.concat_ws(" ", "p_name", word))
    return table(spark, sf_dir, "part").select(padded.alias("CARC Code"), text.alias("Description"))


def weights_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uneven weights for every (brand, size) of ``part``: a pool of many codes."""
    pairs = table(spark, sf_dir, "part").select("p_brand", "p_size").distinct()
    code = F.concat_ws("-", "p_brand", F.col("p_size").cast("string"))
    # One number per code, in text order of brand and then by size.
    digits = F.regexp_replace("p_brand", "[^0-9]", "").cast("int")
    return pairs.select((digits * 1000 + F.col("p_size")).cast("int").alias("ordinal"), code.alias("carc_code"),
                        (F.lit(1) + F.col("p_size") % 7).cast("int").alias("weight"))


def heavy_weights_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code for every ``part``, with weights from 0 to a million; one holds a third of them all."""
    k = F.col("p_partkey")
    weight = F.when(k % 9 == 0, 0).when(k == 1, 10 ** 9).otherwise((k * 7919) % 1_000_003)
    return table(spark, sf_dir, "part").select(k.cast("int").alias("ordinal"), F.concat(F.lit("H"), k.cast("string")).alias("carc_code"),
                                               weight.cast("bigint").alias("weight"))


def ragged_claim_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a claim file without header (one column ``value``): six fields, some lines short or with too many."""
    li = table(spark, sf_dir, "lineitem")
    k, fields = F.col("l_orderkey") + F.col("l_linenumber"), ("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                                                              "l_linestatus", "l_partkey")
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in fields])
    return li.select(F.when(k % 97 == 5, F.concat_ws(",", *[F.col(c).cast("string") for c in fields[:4]]))
                     .when(k % 89 == 7, F.concat(line, F.lit(",extra,more"))).otherwise(line).alias("value"))
