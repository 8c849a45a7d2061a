"""Fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import iso_week, norm_key, random_id, stable_id
from ..operators import first_per_group, lookup, small_side
from .dims import UNKNOWN_COUNTRY

def port_airport_map(ports: DataFrame, airports: DataFrame) -> DataFrame:
    """J3+J4 pre-joined: port code -> airport, on (state, municipality) compared case-insensitively (Q21)."""
    p = ports.where(F.col("code").isNotNull())
    m = lookup(p, airports.select("airport_id", F.col("municipality").alias("a_municipality"),
                                  F.col("state").alias("a_state")),
               ["state", "municipality"], ["a_state", "a_municipality"], normalize=True)
    # A port listed twice on a page must not double its arrivals.
    return first_per_group(m.select("code", "airport_id", "municipality"), ["code"], ["airport_id"])


def origin_country_map(country_labels: DataFrame, countries: DataFrame) -> DataFrame:
    """J6+J7 pre-joined: origin code (int) -> country_id, labels matched to dimension names case-insensitively."""
    m = lookup(country_labels, countries.select("country_id", F.col("name").alias("c_name")),
               ["description"], ["c_name"], normalize=True)
    return first_per_group(m.select(F.col("value").alias("origin_code"), "country_id"), ["origin_code"], ["country_id"])


def fact_ingress(arrivals: DataFrame, ports: DataFrame, airports: DataFrame, temperatures: DataFrame,
                 country_labels: DataFrame, dim_country_df: DataFrame, unmatched: str = "drop",
                 id_columns: Sequence[str] | None = None, small: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Arrivals -> 7-column fact, and ``keep``, columns of the arrivals that go through (their extract).

    The three lookup maps are code lists, joined from small tables and unique
    on their keys, so no arrival is doubled. Spark broadcasts them by size, in
    which case the arrivals stream through once without a shuffle; ``small``
    hints them where their definition bounds them (``small_side``).
    ``unmatched="drop"`` drops arrivals whose origin has no country (as
    executed); ``"unknown"`` keeps them under ``UNK`` (needs the dimension
    built with ``unknown_member=True``). Countries come from the dimension
    itself, so the fact never references a missing dimension row (Q5).
    ``id_columns`` switches the random UUID to a repeatable ``stable_id``.
    """
    if unmatched not in ("drop", "unknown"):
        raise ValueError("unmatched must be 'drop' or 'unknown'")
    pa = small_side(port_airport_map(ports, airports), small)
    temps = small_side(temperatures.select(F.col("city").alias("t_city"), F.col("week_of_year").alias("t_week"),
                                           "temperature_bucket"), small)
    origin = small_side(origin_country_map(country_labels, dim_country_df), small)

    f = arrivals.join(pa, arrivals["i94port"] == pa["code"], "inner")
    f = f.join(temps, (norm_key(f["municipality"]) == temps["t_city"]) & (iso_week(f["arrdate"]) == temps["t_week"]),
               "left").withColumn("temperature_bucket", F.coalesce("temperature_bucket", F.lit("UN")))
    if unmatched == "drop":
        f = f.join(origin, f["i94cit"] == origin["origin_code"], "inner")
    else:
        f = f.join(origin, f["i94cit"] == origin["origin_code"], "left") \
            .withColumn("country_id", F.coalesce("country_id", F.lit(UNKNOWN_COUNTRY)))
    ident = stable_id(*id_columns) if id_columns else random_id()
    return f.select(ident.alias("ingress_id"), "date_id", "country_id", "airport_id", "gender", "age_bucket",
                    "temperature_bucket", *keep)
