"""Staging frames (C1-C8): typed, cleaned, filtered right after the scan so pushdown reaches the files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import (age_bucket, age_from_birth_year, clean_number, date_key, default_code, from_day_number,
                         norm_key, split_list, split_location, split_once, strip_literal, temperature_bucket)
from ..operators import first_per_group, trailing_years, union_all, weekly_mean
from ..sources import html_table_pairs, parse_label_text, read_csv, read_preamble_csv, scan
from .versions import EXTRACT

AIR = 1  # i94mode code for air travel


def stage_arrivals(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet",
                   options: dict[str, str] | None = None, repartition: bool = False) -> DataFrame:
    """Arrivals by air, decoded and banded.

    One scan over all extract files (S1), six columns read (P1), the mode
    filter pushed to the scan (F1). ``i94cit`` is cast to int here so the
    country join is int = int (Q11). Gender: null or blank -> ``U`` (Q19).
    No repartition by default: every later join is a broadcast lookup, so a
    hash shuffle of the biggest input would buy nothing (R1 kept optional).
    """
    raw = scan(spark, paths, fmt, columns=schemas.ARRIVAL_COLUMNS, options=options)
    df = clean_arrivals(raw)
    return df.repartition("year", "i94port") if repartition else df


def stage_extracts(spark: SparkSession, extracts: dict[str, str], fmt: str = "parquet",
                   options: dict[str, str] | None = None) -> DataFrame:
    """C1 for named extracts (id -> path or glob): the arrivals of all, each row with its ``extract_id``."""
    return union_all([stage_arrivals(spark, path, fmt, options).withColumn(EXTRACT, F.lit(name)) for name, path in extracts.items()])


def clean_arrivals(raw: DataFrame) -> DataFrame:
    """C1 without the scan: works on a batch or a streaming frame of raw extract rows."""
    arr = from_day_number(F.col("arrdate"))
    return raw.where(F.col("i94mode") == AIR).select(
        F.col("i94port"),
        F.col("i94cit").try_cast("int").alias("i94cit"),
        arr.alias("arrdate"),
        default_code("gender", "U").alias("gender"),
        F.year(arr).alias("year"),
        age_bucket(age_from_birth_year(arr, F.col("biryear"))).alias("age_bucket"),
        date_key(arr).alias("date_id"),
    )


def stage_country_labels(df: DataFrame) -> DataFrame:
    """(value int, description) from a CSV frame or from parsed label text.

    Non-numeric codes can never match an int origin code and are dropped.
    """
    if "list_name" in df.columns:
        df = df.where(F.col("list_name") == "i94cntyl").select(F.col("code").alias("value"),
                                                               F.col("label").alias("description"))
    out = df.select(F.col("value").try_cast("int").alias("value"), F.trim("description").alias("description"))
    return out.where(F.col("value").isNotNull())


def read_country_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    return stage_country_labels(read_csv(spark, path, schema=schemas.COUNTRY_LABELS_RAW))


def stage_ports(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Port codes scraped from HTML tables (S5), "City, ST" split."""
    pairs = html_table_pairs(pages, html_col, first_cell_pattern=r"^[A-Z]{3}$")
    city, state = split_location(F.col("location"))
    return pairs.select("code", city.alias("municipality"), state.alias("state"))


def ports_from_labels(labels: DataFrame, list_name: str = "i94prtl") -> DataFrame:
    """Ports from the label file's port block: split once on the first comma."""
    port, state = split_once(F.col("label"))
    return labels.where(F.col("list_name") == list_name).select("code", port.alias("port"), state.alias("state"))


def stage_temperatures(spark: SparkSession, path: str | Sequence[str], country: str = "United States",
                       years: int = 5) -> DataFrame:
    """C4: weekly temperature band per city over the last ``years`` years of data.

    Filter by country at the scan (F2), trailing window by scalar subquery
    (A3/F6), mean per (city, ISO week) (A4), band (X11). Cities are keyed by
    ``lower(trim(City))``: same-named cities merge (no state in the data,
    Q18) and the result has one row per join key, so the fact join cannot
    fan out.
    """
    raw = read_csv(spark, path, schema=schemas.TEMPERATURES_RAW)
    t = raw.where(F.col("Country") == country).select(
        F.try_to_timestamp(F.col("dt")).cast("date").alias("dt"),
        F.col("AverageTemperature").try_cast("double").alias("temp"),
        norm_key("City").alias("city"),
    )
    t = trailing_years(t, "dt", years)
    means = weekly_mean(t, ["city"], "dt", "temp", "mean_temp")
    return means.select("city", F.col("week_of_year").cast("int").alias("week_of_year"),
                        temperature_bucket("mean_temp").alias("temperature_bucket"))


def stage_gdp(spark: SparkSession, path: str | Sequence[str], year: int = schemas.GDP_YEAR,
              series: str = schemas.GDP_SERIES) -> DataFrame:
    """GDP per capita of countries (aggregate regions dropped) for one year.

    Preamble/latin-1 CSV (S4); NOT IN aggregate codes (F4); series (F2);
    year as int, not string-vs-int (F3); "10,000" -> 10000.0 (X16).
    """
    cols = [("code", "string"), ("country", "string"), ("year", "string"), ("series", "string"),
            ("value", "string"), ("footnotes", "string"), ("source", "string")]
    raw = read_preamble_csv(spark, path, ", ".join(f"{n} {t}" for n, t in cols), numeric_key="code")
    code = F.col("code").try_cast("int")
    return raw.where(~code.isin(list(schemas.GDP_AGGREGATE_CODES))) \
        .where(F.col("series") == series) \
        .where(F.col("year").try_cast("int") == year) \
        .select(F.trim("country").alias("country"), clean_number("value").alias("gdp_per_capita"))


def stage_airports(spark: SparkSession, path: str | Sequence[str], country: str = "US",
                   airport_type: str = "large_airport") -> DataFrame:
    """One large airport per (state, municipality): the lowest ident."""
    raw = read_csv(spark, path, schema=schemas.AIRPORTS_RAW)
    df = raw.where((F.col("iso_country") == country) & (F.col("type") == airport_type)
                   & F.col("iata_code").isNotNull()) \
        .select(F.col("ident").alias("airport_id"), "name", "municipality",
                strip_literal("iso_region", f"{country}-").alias("state"))
    # One airport per (state, municipality) compared case-insensitively, the way ports are matched (Q21),
    # so case variants of a city cannot both match a port and duplicate fact rows.
    keyed = df.withColumns({"_ks": norm_key("state"), "_km": norm_key("municipality")})
    return first_per_group(keyed, ["_ks", "_km"], ["airport_id"]).select("airport_id", "name", "municipality", "state")


def stage_countries(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Countries with an alpha-3 code; language list split into an array."""
    raw = read_csv(spark, path, schema=schemas.COUNTRIES_RAW)
    return raw.where(F.col("alpha3").isNotNull()) \
        .select("name", "alpha2", "alpha3", split_list("languages").alias("languages"))


def stage_languages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Language codes."""
    return read_csv(spark, path, schema=schemas.LANGUAGES_RAW).select("name", "alpha2", "alpha3")


def stage_labels(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """S6 over label files: (list_name, code, label), read line by line over file splits."""
    from ..sources import parse_label_lines
    return parse_label_lines(spark, paths)
