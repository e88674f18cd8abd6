"""Column expressions shared by the queries. All of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseboard.functions.clock import bucket_minutes

# Upper bound (inclusive) and label of each age group.
AGE_GROUPS = ((20, "0-20"), (30, "21-30"), (40, "31-40"), (50, "41-50"), (60, "51-60"))
OLDEST_GROUP = "> 60"
UNKNOWN_GROUP = "unknown"


def ratio(numerator: Column, denominator: Column, zero: str = "ieee") -> Column:
    """``numerator / denominator``, defined for a zero denominator.

    ``zero="ieee"`` gives inf (nan for 0/0) as floating point division does;
    ``zero="null"`` gives NULL.
    """
    if zero == "null":
        return F.try_divide(numerator, denominator)
    if zero != "ieee":
        raise ValueError(f"zero must be 'ieee' or 'null', not {zero!r}")
    undefined = F.when(numerator == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    return F.when(denominator == 0, undefined).otherwise(numerator / denominator)


def half_even(column: Column, digits: int = 0) -> Column:
    """Round a float half to even by scaling it, as databases and numpy do.

    ``bround`` goes by the decimal digits instead: 19.275 is 1927.4999999999998 in
    hundredths, so it rounds to 19.27 here and to 19.28 there.
    """
    if digits == 0:
        return F.rint(column)
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def age_group(age: Column) -> Column:
    """Label of the age group; NULL is ``unknown``."""
    label = F.when(age < AGE_GROUPS[0][0] + 1, AGE_GROUPS[0][1])
    for upper, name in AGE_GROUPS[1:]:
        label = label.when(age < upper + 1, name)
    return label.when(age.isNotNull(), OLDEST_GROUP).otherwise(UNKNOWN_GROUP)


def quarter_hour(time: Column, minutes: int = 15) -> Column:
    """Start of the bucket ``time`` falls into."""
    return F.window(time, f"{bucket_minutes(minutes)} minutes").getField("start")


def number_text(column: Column) -> Column:
    """A float of at most two decimals as text: 1.0, 83.33, inf, nan."""
    plain = F.regexp_replace(F.format_string("%.2f", column), "0$", "")
    return (
        F.when(F.isnan(column), "nan")
        .when(column == float("inf"), "inf")
        .when(column == float("-inf"), "-inf")
        .when(column.isNotNull(), plain)
    )
