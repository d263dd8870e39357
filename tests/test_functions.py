"""Scalar expressions (X1-X24, F3) on hand-made values, including the
semantic decisions of SURVEY section 8."""

import datetime
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from claimlens import constants as C
from claimlens.functions import exprs as X


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("20100115", datetime.date(2010, 1, 15)),
    ("20011399", None),        # month 13 -> NULL, not an error (D9)
    ("abc", None),
    (None, None),
])
def test_parse_yyyymmdd(spark, text, expected):
    assert one(spark, X.parse_yyyymmdd, text) == expected


@pytest.mark.parametrize("text,expected", [("12.5", 12.5), ("abc", None), ("0", 0.0), (None, None)])
def test_parse_double(spark, text, expected):
    assert one(spark, X.parse_double, text) == expected


def test_strip_text(spark):
    assert one(spark, X.strip_text, "  45 \t") == "45"


@pytest.mark.parametrize("code,label", [("1", "Male"), ("2", "Female"), ("9", "Unknown"), (None, "Unknown")])
def test_sex_label(spark, code, label):
    assert one(spark, X.sex_label, code) == label


def test_flag_count_null_counts_zero(spark):
    df = spark.createDataFrame([("1", "2", None, "1")], "a string, b string, c string, d string")
    assert df.select(X.flag_count(["a", "b", "c", "d"]).alias("n")).first()["n"] == 2


def test_age_approx_uses_year_digits_even_for_bad_dates(spark):
    assert one(spark, X.age_approx, "19201399") == 90
    assert one(spark, X.age_approx, "abcd0101") is None


@pytest.mark.parametrize("days,bucket", [
    (-5, "0-30"), (0, "0-30"), (30, "0-30"), (31, "31-60"), (60, "31-60"),
    (61, "61-90"), (90, "61-90"), (91, "90+"), (None, "90+"),   # D16
])
def test_aging_bucket(spark, days, bucket):
    assert one(spark, X.aging_bucket, days, "int") == bucket


@pytest.mark.parametrize("amt,status", [
    (None, C.DENIED), (0.0, C.DENIED), (-3.0, C.PAID_FIRST_PASS), (10.0, C.PAID_FIRST_PASS),  # D1
])
def test_adjudication_status(spark, amt, status):
    assert one(spark, X.adjudication_status, amt, "double") == status


def test_hash32_is_md5_prefix(spark):
    import hashlib
    for key in ["1", "123", "99999", "abc"]:
        assert one(spark, X.hash32, key) == int(hashlib.md5(key.encode()).hexdigest()[:8], 16)


def test_strip_text_takes_no_break_spaces(spark):
    assert one(spark, X.strip_text, "\u00a0 A\u00a01 \t\u2003") == "A\u00a01"


@pytest.mark.parametrize("code,valid", [
    ("4280", True), ("V4501", True), ("E8889", True), ("A123", True),
    ("AB12", False),   # only the first letter is stripped (D6)
    ("OTHER", False), ("12.5", False),
])
def test_diagnosis_code_valid(spark, code, valid):
    assert one(spark, X.diagnosis_code_valid, code) is valid


@pytest.mark.parametrize("code,category", [
    ("V4501", "Supplemental/V-code"), ("E8889", "External cause/E-code"),
    ("4280", "Circulatory"), ("2500", "Endocrine/Metabolic"), ("4860", "Respiratory"),
    ("8000", "Injury/Poisoning"), ("0426", "Other"), ("A123", "Other"),
])
def test_icd9_category(spark, code, category):
    assert one(spark, X.icd9_category, code) == category


@pytest.mark.parametrize("desc,bucket", [
    ("exact duplicate", "Preventable - Process"),
    ("Past Timely Filing limit", "Preventable - Process"),
    ("Duplicate; prior authorization missing", "Preventable - Process"),  # first keyword wins
    ("Prior Authorization required", "Preventable - Front-End"),
    ("Eligibility not found", "Preventable - Front-End"),
    ("non-covered charges", "Non-Preventable - Coverage"),
    ("Medical necessity not met", "Non-Preventable - Clinical"),
    ("Coordination of benefits", "Preventable - Process"),
    ("coinsurance", "Non-Preventable - Patient Responsibility"),
    ("deductible", "Non-Preventable - Patient Responsibility"),
    ("lacks information", "Unclassified"), ("", "Unclassified"), (None, "Unclassified"),
])
def test_keyword_bucket(spark, desc, bucket):
    assert one(spark, X.keyword_bucket, desc) == bucket


def test_pct_is_double_and_zero_safe(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "n long, d long")
    out = [r["p"] for r in df.select(X.pct("n", "d").alias("p")).collect()]
    assert out[0] == pytest.approx(100.0 / 3) and isinstance(out[0], float)
    assert out[1] is None  # D15


def test_round2_half_up(spark):
    # Half-up on the decimal form (1.005 -> 1.01), unlike binary rounding
    assert one(spark, X.round2, 1.005, "double") == 1.01
    assert one(spark, X.round2, 2.675, "double") == 2.68


@pytest.mark.parametrize("values,total", [
    ((0.1, 0.2, 0.3), 0.6), ((2e14, 0.00004), 200000000000000.00004), ((1e300, 1.0), 1e300), ((None, 2.5), 2.5),
    ((None,), None), ((1e-300, 1e-300), 2e-300),
])
def test_money_sum_drops_and_rounds_nothing(spark, values, total):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(X.money_sum("v").alias("s")).first()["s"] == total
    parts = df.groupBy("v").agg(*X.money_parts("v", "x")).groupBy().agg(*X.more_parts("x"))
    assert parts.select(X.money_value("x").alias("s")).first()["s"] == total


def test_money_sum_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    s = df.agg(X.money_sum("v").alias("s")).first()["s"]
    assert s != s


def test_null_to_zero(spark):
    assert one(spark, X.null_to_zero, None, "int") == 0


def money_total(amounts):
    """The rule on its own: the sum of the decimals that the amounts print as, or the plain sum."""
    fixed = [Decimal(repr(a)).quantize(Decimal(1).scaleb(-10)) if abs(a) < 1e18 else None for a in amounts]
    if all(f is not None and float(f) == a for f, a in zip(fixed, amounts)):
        return float(sum(fixed))
    return sum(amounts)


def test_money_sums_are_exact(spark):
    rng = random.Random(7)
    groups = [[round(rng.uniform(-900, 900), 2) for _ in range(400)], [0.1] * 1000, [524287.99, 524288.01, -524288.0],
              [round(rng.uniform(0, 2e6), 4) for _ in range(300)], [1e15 + k for k in range(50)] + [0.01],
              [round(rng.uniform(-1e12, 1e12), 3) for _ in range(300)], [70368744177664.12, 1e-10, 2e14, -3.3],
              [0.0000000001] * 7, [1e-11, 5.0], [1234567.1234567, 7654321.7654321], [-0.0], [1e17, 0.5, -1e17]]
    rows = [(g, a) for g, amounts in enumerate(groups) for a in amounts]
    df = spark.createDataFrame(rows, "g int, a double").repartition(7)
    got = {r.g: r.s for r in df.groupBy("g").agg(X.money_sum("a").alias("s")).collect()}
    assert got == {g: money_total(a) for g, a in enumerate(groups)}
    parts = df.groupBy("g", F.spark_partition_id().alias("p")).agg(*X.money_parts("a", "x"))
    again = parts.groupBy("g").agg(*X.more_parts("x")).select("g", X.money_value("x").alias("s"))
    assert {r.g: r.s for r in again.collect()} == got


def test_money_totals_beyond_64_bits_fall_back(spark):
    big, nothing = [9e17] * 40, [None, None]
    rows = [(0, a) for a in big] + [(1, a) for a in nothing] + [(2, float("nan")), (2, 1.0)]
    df = spark.createDataFrame(rows, "g int, a double").repartition(5)
    got = {r.g: r.s for r in df.groupBy("g").agg(X.money_sum("a").alias("s")).collect()}
    assert got[0] == pytest.approx(3.6e19) and got[1] is None and math.isnan(got[2])
    parts = df.groupBy("g", F.spark_partition_id().alias("p")).agg(*X.money_parts("a", "x"))
    for _ in range(2):  # a fallback in a pre-aggregate stays one, however often it is added up
        parts = parts.groupBy("g").agg(*X.more_parts("x"))
    again = {r.g: r.s for r in parts.select("g", X.money_value("x").alias("s")).collect()}
    assert again[0] == pytest.approx(3.6e19) and again[1] is None and math.isnan(again[2])
