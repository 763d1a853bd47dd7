"""Column expressions with the reference's null / zero-division / text semantics.

Every helper returns a ``Column`` built from built-in functions only, so it
stays inside whole-stage codegen (no Python on the hot path).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money of a line is DECIMAL(18,4): sums are exact and order-independent.
MONEY = T.DecimalType(18, 4)
# Money that has been summed keeps room for the sum.
WIDE_MONEY = T.DecimalType(28, 4)
# Allocation shares are summed in re-rollups; a fixed-point type keeps those
# sums order-independent too (a share is large where weights nearly cancel).
SHARE = T.DecimalType(38, 12)

# Label for rows whose key could not be resolved (missing code, unallocated pool).
NA_CODE = "__NA__"
UNALLOCATED = "__UNALLOCATED__"

# Characters removed by a whitespace strip: every code point below U+3001 that
# Python's str.isspace() accepts (covers ASCII whitespace, NBSP, the Unicode
# space separators and the ideographic space U+3000).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Cast to the money type."""
    return col(c).cast(MONEY)


def dec(value: str) -> Column:
    """Exact decimal literal, e.g. ``dec('0.97')``."""
    return F.lit(Decimal(value))


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL so comparisons drop the row as pandas does (S10)."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def ratio(num: str | Column, den: str | Column, *, zero_den: str = "inf_to_zero",
          fill: float | None = None) -> Column:
    """Quotient as DOUBLE with explicit zero-division semantics.

    zero_den="inf_to_zero": x/0 -> 0 for x != 0, 0/0 -> NULL (pandas inf->0 replace, S6)
    zero_den="null":        any x/0 -> NULL (undefined ratio, S8/S9)
    ``fill`` replaces a NULL result (ratio taken before a fillna(0), S7).
    """
    n = col(num).cast("double")
    d = col(den).cast("double")
    if zero_den == "inf_to_zero":
        r = (F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
             .when(d != 0, F.try_divide(n, d))
             .when(n != 0, F.lit(0.0))
             .otherwise(F.lit(None).cast("double")))
    elif zero_den == "null":
        r = F.when(d != 0, F.try_divide(n, d)).otherwise(F.lit(None).cast("double"))
    else:
        raise ValueError(f"unknown zero_den mode {zero_den!r}")
    if fill is not None:
        r = F.coalesce(r, F.lit(float(fill)))
    return r


def conform_code(c: str | Column, na: str | None = NA_CODE) -> Column:
    """Code as trimmed string (S4, S5); a missing code becomes ``na`` so its
    money is kept under an explicit member instead of vanishing."""
    s = F.btrim(col(c).cast("string"), F.lit(WHITESPACE))
    if na is None:
        return s
    return F.coalesce(s, F.lit(na))


def conform_numeric_code(c: str | Column) -> Column:
    """Numeric code: NaN / +-inf / NULL -> 0, truncate to integer, then string (S16)."""
    d = col(c).try_cast("double")
    d = F.when(F.isnan(d) | (F.abs(d) == float("inf")), F.lit(None)).otherwise(d)
    return F.coalesce(d.try_cast("bigint"), F.lit(0).cast("bigint")).cast("string")


def matches_any(c: str | Column, pattern: str) -> Column:
    """Inclusion filter: text contains one of the alternatives; NULL text -> false."""
    return F.coalesce(col(c).rlike(pattern), F.lit(False))


def not_matching(c: str | Column, pattern: str) -> Column:
    """Exclusion filter that keeps rows whose text is NULL (S12)."""
    return ~F.coalesce(col(c).rlike(pattern), F.lit(False))


def pattern_match(text: str | Column, key: str | Column) -> Column:
    """Case-insensitive regex search where the pattern comes from a column (FLT-11).
    NULL text or key -> NULL."""
    return F.regexp_like(col(text), F.concat(F.lit("(?i)"), col(key)))


def round_half_even(c: str | Column, scale: int = 2) -> Column:
    """Half-even rounding of the printed value (S11).

    Decimals are rounded exactly; doubles are first taken at their shortest
    decimal representation (DECIMAL(38,10)) so 2.675 rounds like the text "2.675".
    Returns DOUBLE.
    """
    c = col(c)
    return F.bround(c.try_cast(T.DecimalType(38, 10)), scale).cast("double")
