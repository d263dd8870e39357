"""Scalar column expressions of the claims models.

Every function maps Columns to a Column and stays inside Catalyst, so each
expression is code-generated and evaluated next to the scan; no Python runs
per row.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from claimlens import constants as C

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- parsing (X1-X4, X10) ----------------------------------------------------

def parse_yyyymmdd(c: ColumnOrName) -> Column:
    """``yyyyMMdd`` text to DATE; malformed text gives NULL."""
    return F.try_to_date(col(c), "yyyyMMdd")


def parse_double(c: ColumnOrName) -> Column:
    """Text to DOUBLE; malformed text gives NULL."""
    return col(c).try_cast("double")


def parse_int(c: ColumnOrName) -> Column:
    """Text to INT; malformed text gives NULL."""
    return col(c).try_cast("int")


def strip_text(c: ColumnOrName) -> Column:
    """Text of a value with surrounding white space removed, no-break spaces too."""
    return F.regexp_replace(col(c).cast("string"), r"(?U)^\s+|\s+$", "")


# -- beneficiary attributes (X5, X11-X13) ------------------------------------

def sex_label(code: ColumnOrName) -> Column:
    """X11: sex code to label, anything else (NULL too) is Unknown."""
    expr = None
    for value, label in C.SEX_LABELS:
        cond = col(code) == F.lit(value)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(C.SEX_UNKNOWN)


def flag_count(columns: Iterable[ColumnOrName], true_value: str = "1") -> Column:
    """Number of flag columns equal to ``true_value`` (NULL counts 0)."""
    terms = [F.when(col(c) == F.lit(true_value), 1).otherwise(0) for c in columns]
    return reduce(add, terms, F.lit(0))


def age_approx(birth_text: ColumnOrName, ref_year: int = C.AGE_REFERENCE_YEAR) -> Column:
    """``ref_year`` minus the year digits of a ``yyyyMMdd`` text."""
    return F.lit(ref_year) - parse_int(F.substring(col(birth_text), 1, 4))


# -- claim attributes (X14-X16, X18) -----------------------------------------

def days_between(start: ColumnOrName, as_of: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``as_of`` (negative if start is later)."""
    return F.datediff(col(as_of), col(start))


def aging_bucket(days: ColumnOrName) -> Column:
    """A/R aging bucket; NULL days fall into the overflow bucket."""
    expr = None
    for limit, label in C.AGING_LIMITS:
        cond = col(days) <= F.lit(limit)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(C.AGING_OVERFLOW)


def adjudication_status(paid_amount: ColumnOrName) -> Column:
    """NULL or zero payment is a denial, anything else paid."""
    amt = col(paid_amount)
    return F.when(amt.isNull() | (amt == F.lit(0.0)), C.DENIED).otherwise(C.PAID_FIRST_PASS)


def hash32(key: ColumnOrName) -> Column:
    """The first 32 bits of md5(key) as a whole number.

    Depends on the key alone, so a recomputed partition draws the same
    value (unlike ``rand``), and both SQL engines can evaluate it.
    """
    return hash_bits(key, 8)


def hash_bits(key: ColumnOrName, digits: int) -> Column:
    """The first ``digits`` hexadecimal digits of md5(key) as a whole number (15 at most)."""
    return F.conv(F.substring(F.md5(col(key).cast("string")), 1, digits), 16, 10).cast("bigint")


# -- diagnosis codes (F3, X6, X7, X17) ---------------------------------------

def strip_first_letter(code: ColumnOrName) -> Column:
    """Remove only the first ASCII letter of the text."""
    return F.regexp_replace(col(code), r"^([^A-Za-z]*)[A-Za-z]", "$1")


def diagnosis_code_valid(code: ColumnOrName) -> Column:
    """digits left after one letter is stripped parse as INT, or a V/E code."""
    return (parse_int(strip_first_letter(code)).isNotNull()
            | F.left(col(code), F.lit(1)).isin("V", "E"))


def icd9_category(code: ColumnOrName) -> Column:
    """Approximate ICD-9-CM chapter from the code prefix."""
    first = F.left(col(code), F.lit(1))
    prefix = parse_int(F.left(col(code), F.lit(3)))
    expr = F.when(first == "V", C.DX_V_CODE).when(first == "E", C.DX_E_CODE)
    for lo, hi, label in C.DX_RANGES:
        expr = expr.when(prefix.between(lo, hi), label)
    return expr.otherwise(C.DX_OTHER)


# -- reason codes (X9) ---------------------------------------------------------

def keyword_bucket(description: ColumnOrName) -> Column:
    """First preventability keyword contained in the lower-cased text.

    NULL or empty text is Unclassified. Works on the whole text.
    """
    d = F.lower(col(description))
    expr = F.when(d.isNull() | (d == F.lit("")), C.UNCLASSIFIED)
    for keyword, bucket in C.PREVENTABILITY_KEYWORDS:
        expr = expr.when(d.contains(keyword), bucket)
    return expr.otherwise(C.UNCLASSIFIED)


# -- arithmetic (X19-X21, X24) -----------------------------------------------

def pct(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """``numerator * 100 / denominator`` as DOUBLE; zero denominator gives NULL."""
    return F.try_divide(col(numerator).cast("double") * F.lit(100.0),
                        col(denominator).cast("double"))


def round2(c: ColumnOrName) -> Column:
    """Round half-up to 2 decimals."""
    return F.round(col(c), 2)


def null_to_zero(c: ColumnOrName, zero=0) -> Column:
    """NULL becomes zero."""
    return F.coalesce(col(c), F.lit(zero))


# -- exact money aggregation -------------------------------------------------

MONEY = DecimalType(C.MONEY_PRECISION, C.MONEY_SCALE)
# An amount is whole units and two limbs of its decimals, all 64-bit: no group of
# fewer than 9 * 10^13 rows can overflow the limbs, and the whole units only
# do where their total leaves 64 bits.
_LIMB = 10 ** (C.MONEY_SCALE // 2)
_UNIT = 10 ** C.MONEY_SCALE
_NARROW = float(1 << 19)  # below it a double holds at most one decimal of MONEY's scale
PARTS = ("whole", "mid", "low", "plain", "odd")


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _limbs(amount: Column) -> tuple[Column, Column, Column]:
    """The amount as whole units and two limbs, NULL where MONEY cannot hold its value.

    Usual amounts take double and long arithmetic: where the amount is the
    double nearest to n / 10^scale, n is its decimal form without the point.
    The others are cast to the wide decimal.
    """
    scaled = F.rint(amount * F.lit(float(_UNIT)))
    usual = (F.abs(amount) < F.lit(_NARROW)) & (scaled / F.lit(float(_UNIT)) == amount)
    n = F.when(usual, scaled.cast("bigint"))
    fixed = F.when(~usual, amount).try_cast(MONEY)
    fixed = F.when(fixed.cast("double") == amount, fixed)
    wide = fixed.cast("bigint")
    rest = ((fixed - wide) * _long(_UNIT)).cast("bigint")
    part = n % _long(_UNIT)
    whole = F.coalesce(((n - part) / _long(_UNIT)).cast("bigint"), wide)
    part = F.coalesce(part, rest)
    low = part % _long(_LIMB)
    return whole, ((part - low) / _long(_LIMB)).cast("bigint"), low


def money_parts(c: ColumnOrName, name: str, where: Column | None = None) -> list[Column]:
    """Aggregates that ``money_value`` turns into the sum of an amount.

    The exact sum as three 64-bit totals, the plain sum, and how many non-NULL
    amounts the exact one cannot hold (very large or small ones, NaN). Partial
    sums add up (``more_parts``), so pre-aggregates carry these columns.
    """
    amount = (col(c) if where is None else F.when(where, col(c))).cast("double")
    whole, mid, low = _limbs(amount)
    return [F.try_sum(whole).alias(f"{name}_whole"), F.sum(mid).alias(f"{name}_mid"), F.sum(low).alias(f"{name}_low"),
            F.sum(amount).alias(f"{name}_plain"), F.count_if(amount.isNotNull() & whole.isNull()).alias(f"{name}_odd")]


def more_parts(part: str, where: Column | None = None, over: WindowSpec | None = None,
               name: str | None = None) -> list[Column]:
    """The parts ``part`` of several groups' sums added up again (as those of ``name``).

    Whole units that left 64 bits stay NULL, which ``odd`` keeps: it counts one more.
    """
    def of(x: str) -> Column:
        c = F.col(f"{part}_{x}")
        if x == "odd":
            c = c + F.when(F.col(f"{part}_mid").isNotNull() & F.col(f"{part}_whole").isNull(), 1).otherwise(0)
        c = F.when(where, c) if where is not None else c
        c = F.try_sum(c) if x == "whole" else F.sum(c)
        return (c.over(over) if over is not None else c).alias(f"{name or part}_{x}")

    return [of(x) for x in PARTS]


def _total(whole: Column, mid: Column, low: Column, plain: Column, odd: Column) -> Column:
    """The sum that the parts hold, as DOUBLE; decided by the amounts alone.

    A total of fewer digits than a double holds exactly is one division of whole
    numbers, which rounds as the decimal would.
    """
    n = whole * _long(_UNIT) + mid * _long(_LIMB) + low
    short = (F.abs(whole) < F.lit(500_000)) & (F.abs(mid) < F.lit(10 ** 9)) & (F.abs(low) < F.lit(10 ** 9))
    as_decimal = [(c.cast("decimal(20,0)") * F.lit(f"1e-{places}").cast(DecimalType(places, places)) if places
                   else c.cast("decimal(20,0)")) for c, places in
                  ((whole, 0), (mid, C.MONEY_SCALE // 2), (low, C.MONEY_SCALE))]
    exact = F.when(short, n.cast("double") / F.lit(float(_UNIT))).otherwise(reduce(add, as_decimal).cast("double"))
    return F.when((F.coalesce(odd, F.lit(0)) == 0) & (whole.isNotNull() | mid.isNull()), exact).otherwise(plain)


def money_value(name: str) -> Column:
    """The sum that a row's parts hold, as DOUBLE."""
    return _total(*(F.col(f"{name}_{x}") for x in PARTS))


def money_sum(c: ColumnOrName, where: Column | None = None) -> Column:
    """SUM of amounts as DOUBLE (NULL when no value); no amount is dropped or rounded.

    Exact where every non-NULL amount of the group fits MONEY without loss
    and the total's whole units fit 64 bits, else the plain double sum (NaN stays NaN).
    """
    return _total(*money_parts(c, "x", where))


def money_avg(c: ColumnOrName) -> Column:
    """AVG of amounts over the rows that the sum holds: the non-NULL ones."""
    return F.try_divide(money_sum(c), F.count(col(c)).cast("double"))
