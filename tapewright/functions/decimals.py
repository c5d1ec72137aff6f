"""Exact decimals: strict text, canonical text, loss-free rescaling and parts-per-million ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prices and quantities. Sums widen to decimal(38,8) and a product with 1,000,000 to decimal(36,8): both exact.
DECIMAL = "decimal(28,8)"

#: Fixed value: the accepted grammar, no exponent, no plus sign, no leading zero, at most 18 places.
GRAMMAR = r"^-?(0|[1-9][0-9]*)([.][0-9]{1,18})?$"


def decimal_reject(text: Column) -> Column:
    """Why text is no working decimal: grammar, range (more than 8 places or 20 digits before the point), or null if it is one."""
    exact = text.rlike(r"^-?[0-9]{1,20}([.][0-9]{1,8}0*)?$")
    return F.when(text.isNull(), "missing").when(~text.rlike(GRAMMAR), "grammar").when(~exact, "range")


def parse_decimal(text: Column) -> Column:
    """The working decimal of a strict text, null where decimal_reject names a reason."""
    return F.when(decimal_reject(text).isNull(), text.try_cast(DECIMAL))


def canonical_text(text: Column) -> Column:
    """Trailing zeros of the fraction and a bare point removed; a zero has no sign."""
    short = F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), "[.]$", "")).otherwise(text)
    return F.when(short == "-0", "0").otherwise(short)


def decimal_text(value: Column) -> Column:
    """Canonical text of a decimal column."""
    return canonical_text(value.cast("string"))


def rescale_exact(value: Column, precision: int, scale: int) -> Column:
    """value as decimal(precision, scale); an error where digits would be lost."""
    narrow = value.try_cast(f"decimal({precision},{scale})")
    lost = value.isNotNull() & (narrow.isNull() | (narrow != value))
    return F.when(lost, F.raise_error(F.lit("rescale loses digits")).cast(f"decimal({precision},{scale})")).otherwise(narrow)


def add(a: Column, b: Column) -> Column:
    return (a.cast(DECIMAL) + b.cast(DECIMAL)).cast("decimal(38,8)")


def subtract(a: Column, b: Column) -> Column:
    return (a.cast(DECIMAL) - b.cast(DECIMAL)).cast("decimal(38,8)")


def compare(a: Column, b: Column) -> Column:
    return F.when(a < b, -1).when(a > b, 1).when(a == b, 0)


def ratio_ppm(numerator: Column, denominator: Column, strict: bool = False) -> Column:
    """numerator / denominator in parts per million, cut towards zero; a denominator of 0 or less is null, or an error if strict."""
    scaled = numerator.cast(DECIMAL) * F.lit(1_000_000).cast("decimal(7,0)")
    whole = F.call_function("div", scaled, denominator.cast(DECIMAL))
    bad = F.raise_error(F.lit("denominator must be positive")).cast("bigint") if strict else F.lit(None).cast("bigint")
    return F.when(denominator > 0, whole).otherwise(bad)


def imbalance_ppm(a: Column, b: Column, strict: bool = False) -> Column:
    """(a - b) / (a + b) in parts per million."""
    return ratio_ppm(a - b, a + b, strict)
