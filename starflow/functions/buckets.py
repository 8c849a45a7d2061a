"""Banding expressions (X9-X12): one generic ``bucketize`` instead of per-domain UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Band codes and their upper bounds, as the star schema defines them.
# Each entry is (code, upper bound, bound inclusive); values above the last bound get the top code.
# Age: CH under 12, TE 12-17, AD 18-65 (65 itself is adult), OA over 65, UN unknown.
AGE_BUCKETS = (("CH", 12, False), ("TE", 18, False), ("AD", 65, True))
AGE_TOP = "OA"
# Temperature (weekly mean, Celsius): VC under 5, CO 5-15, MI 15-25, HO 25-35, VH 35 and over, UN unknown.
TEMPERATURE_BUCKETS = (("VC", 5, False), ("CO", 15, False), ("MI", 25, False), ("HO", 35, False))
TEMPERATURE_TOP = "VH"
UNKNOWN = "UN"


def bucketize(value: Column | str, bounds: Sequence[tuple[str, float, bool]], top: str,
              default: str = UNKNOWN) -> Column:
    """Map a numeric column to band codes.

    ``bounds`` is ordered ascending; the first bound the value falls under
    wins. Null and NaN map to ``default`` (Spark orders NaN above every
    number, which would otherwise land it in the top band).
    """
    v = as_col(value).cast("double")
    expr = F.when(v.isNull() | F.isnan(v), F.lit(default))
    for code, upper, inclusive in bounds:
        expr = expr.when(v <= upper if inclusive else v < upper, F.lit(code))
    return expr.otherwise(F.lit(top))


def age_from_birth_year(event_date: Column | str, birth_year: Column | str) -> Column:
    """Age in whole years = year(event) - birth year (birth year arrives as double)."""
    return F.year(as_col(event_date)) - as_col(birth_year).try_cast("int")


def age_bucket(age: Column | str) -> Column:
    return bucketize(age, AGE_BUCKETS, AGE_TOP)


def temperature_bucket(mean_temperature: Column | str) -> Column:
    return bucketize(mean_temperature, TEMPERATURE_BUCKETS, TEMPERATURE_TOP)
