"""Dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_columns, norm_key
from ..operators import explode_lookup_collect, lookup_default, lookup_list, small_side
from ..sources import date_spine, date_spine_between

UNKNOWN_COUNTRY = "UNK"


def dim_date(spark: SparkSession, start: dt.date | None = None, end: dt.date | None = None,
             days: int = 3660, lead_days: int = 30) -> DataFrame:
    """One row per day; default window ends ``lead_days`` after today and spans ``days`` + 1 days."""
    end = end or (dt.date.today() + dt.timedelta(days=lead_days))
    start = start or (end - dt.timedelta(days=days))
    spine = date_spine(spark, start, end)
    return spine.select(*[c.alias(n) for n, c in date_columns("date").items()])


def dim_date_covering(facts_dates: DataFrame, date_col: str, days: int = 3660, lead_days: int = 30) -> DataFrame:
    """C9 widened to the data: the standard window, extended to every date in ``date_col``.

    The bounds are a one-row aggregate inside the plan (no collect), so a
    fact can never reference a day missing from the dimension.
    """
    end = dt.date.today() + dt.timedelta(days=lead_days)
    start = end - dt.timedelta(days=days)
    d = F.col(date_col).cast("date")
    bounds = facts_dates.agg(F.least(F.min(d), F.lit(str(start)).cast("date")).alias("s"),
                             F.greatest(F.max(d), F.lit(str(end)).cast("date")).alias("e"))
    return date_spine_between(bounds, "s", "e").select(*[c.alias(n) for n, c in date_columns("date").items()])


def dim_date_for_keys(spark: SparkSession, min_key: int | None, max_key: int | None, days: int = 3660,
                      lead_days: int = 30) -> DataFrame:
    """C9 widened to a known ``date_id`` range (e.g. observed while the fact was written)."""
    end = dt.date.today() + dt.timedelta(days=lead_days)
    start = end - dt.timedelta(days=days)

    def as_date(k: int) -> dt.date:
        try:
            return dt.date(k // 10000, k // 100 % 100, k % 100)
        except ValueError:
            raise ValueError(f"fact_ingress.date_id: {k} is no date") from None

    if min_key is not None:
        start = min(start, as_date(min_key))
    if max_key is not None:
        end = max(end, as_date(max_key))
    return dim_date(spark, start, end)


def dim_country(countries: DataFrame, languages: DataFrame, gdp: DataFrame, unknown_member: bool = False,
                small: bool = False, languages_as_map: bool = True) -> DataFrame:
    """country_id (alpha-3), name, language names joined by ',', GDP per capita (0 when missing).

    Languages are a code list and so one map value, by which the codes are
    replaced in place (``lookup_list``); without ``languages_as_map`` they are
    joined. A country with no language list stays, as ``Unknown`` (Q3). GDP joins case-insensitively
    (J2); it is first reduced to one row per name key so a duplicated name
    cannot duplicate a country. ``small`` hints the language list and the
    reduced GDP table for broadcasting (``small_side``).
    """
    listed = countries.select(F.col("alpha3").alias("country_id"), "name", "languages")
    if languages_as_map:
        langs = lookup_list(listed, "languages", languages, "alpha3", "name", "languages")
    else:
        langs = explode_lookup_collect(listed, key_cols=["country_id"], list_col="languages", lookup_df=languages, lookup_key="alpha3",
                                       lookup_value="name", out_col="languages", carry=["name"], small=small)
    g = gdp.groupBy(norm_key("country").alias("_gk")).agg(F.max("gdp_per_capita").alias("gdp_per_capita"))
    g = small_side(g, small)
    out = lookup_default(langs, g, ["name"], ["_gk"], {"gdp_per_capita": 0.0}, normalize=True) \
        .select("country_id", "name", "languages", F.col("gdp_per_capita").cast("double").alias("gdp_per_capita"))
    if unknown_member:
        spark = countries.sparkSession
        extra = spark.createDataFrame([(UNKNOWN_COUNTRY, "Unknown", "Unknown", 0.0)], out.schema)
        out = out.unionByName(extra)
    return out


def dim_airport(airports: DataFrame) -> DataFrame:
    """C11: the staged airports are the dimension."""
    return airports.select("airport_id", "name", "municipality", "state")
