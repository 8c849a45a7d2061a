"""Declared schemas: raw inputs, staging frames, star tables, and load thresholds.

Each schema is declared once as a StructType; DDL and checks derive from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
D = T.DoubleType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# ---- raw inputs (as delivered) ---------------------------------------------------------------
ARRIVALS_RAW = _struct(("i94port", S), ("i94cit", D), ("arrdate", D), ("i94mode", D), ("biryear", D), ("gender", S))
ARRIVAL_COLUMNS = [f.name for f in ARRIVALS_RAW.fields]
COUNTRY_LABELS_RAW = _struct(("value", S), ("description", S))
TEMPERATURES_RAW = _struct(("dt", S), ("AverageTemperature", S), ("City", S), ("Country", S))
GDP_RAW = _struct(("code", S), ("country", S), ("year", S), ("series", S), ("value", S))
AIRPORTS_RAW = _struct(("ident", S), ("name", S), ("iso_country", S), ("iso_region", S), ("municipality", S),
                       ("type", S), ("iata_code", S))
COUNTRIES_RAW = _struct(("name", S), ("alpha2", S), ("alpha3", S), ("languages", S))
LANGUAGES_RAW = _struct(("name", S), ("alpha2", S), ("alpha3", S))

# ---- staging frames --------------------------------------------------------------------------
ARRIVALS = _struct(("i94port", S), ("i94cit", T.IntegerType()), ("arrdate", T.DateType()), ("gender", S),
                   ("year", T.IntegerType()), ("age_bucket", S), ("date_id", T.IntegerType()))
COUNTRY_LABELS = _struct(("value", T.IntegerType()), ("description", S))
PORTS = _struct(("code", S), ("municipality", S), ("state", S))
TEMPERATURES = _struct(("city", S), ("week_of_year", T.IntegerType()), ("temperature_bucket", S))
GDP = _struct(("country", S), ("gdp_per_capita", D))
AIRPORTS = _struct(("airport_id", S), ("name", S), ("municipality", S), ("state", S))
COUNTRIES = _struct(("name", S), ("alpha2", S), ("alpha3", S), ("languages", T.ArrayType(S)))
LANGUAGES = _struct(("name", S), ("alpha2", S), ("alpha3", S))

# ---- star tables -----------------------------------------------------------------------------
SH = T.ShortType()
DIM_DATE = _struct(("date_id", T.IntegerType()), ("year", SH), ("month", SH), ("day", SH), ("day_of_week", SH),
                   ("week_of_year", SH))
DIM_COUNTRY = _struct(("country_id", S), ("name", S), ("languages", S), ("gdp_per_capita", D))
DIM_AIRPORT = _struct(("airport_id", S), ("name", S), ("municipality", S), ("state", S))
FACT_INGRESS = _struct(("ingress_id", S), ("date_id", T.IntegerType()), ("country_id", S), ("airport_id", S),
                       ("gender", S), ("age_bucket", S), ("temperature_bucket", S))
# The fact is stored by load unit: the month of date_id (one extract holds one month), so that a load replaces
# exactly the months it holds. The contract columns stay the 7 above.
FACT_PARTITION = "month_id"

STAR_TABLES = {"dim_date": DIM_DATE, "dim_country": DIM_COUNTRY, "dim_airport": DIM_AIRPORT,
               "fact_ingress": FACT_INGRESS}
TABLE_KEYS = {"dim_date": "date_id", "dim_country": "country_id", "dim_airport": "airport_id",
              "fact_ingress": "ingress_id"}

# ---- code domains (fixed values) ---------------------------------------------------------------
GENDER_CODES = ("M", "F", "X", "U")
AGE_CODES = ("CH", "TE", "AD", "OA", "UN")
TEMPERATURE_CODES = ("VC", "CO", "MI", "HO", "VH", "UN")

# GDP "Region/Country/Area" codes of world/continent/region aggregates, dropped at staging.
GDP_AGGREGATE_CODES = (1, 2, 15, 202, 14, 17, 18, 11, 19, 21, 419, 29, 13, 5, 142, 143, 30, 35, 34, 145, 150,
                       151, 154, 39, 155, 9, 53, 54, 57, 61)
GDP_SERIES = "GDP per capita (US dollars)"
GDP_YEAR = 2017
# Must-have airports on dim_airport, and the busiest one checked on the fact.
MAJOR_AIRPORTS = ("KJFK", "KMIA", "KLAX", "KSFO", "PHNL")
BUSIEST_AIRPORT = "KJFK"

# ---- thresholds (fixed values; production defaults, tests pass their own) ----------------------
STAGING_MIN_ROWS = {"arrivals": 1_000_000, "temperatures": 100, "gdp": 100, "country_labels": 10, "ports": 10,
                    "airports": 10, "countries": 10, "languages": 10}
TABLE_MIN_ROWS = {"dim_country": 100, "dim_airport": 100, "dim_date": 100, "fact_ingress": 1_000_000}
LOADED_FACT_MIN_ROWS = 100_000
# Most characters of text columns, and columns that must not be null.
MAX_LENGTH = {"dim_airport": {"airport_id": 4, "name": 128, "municipality": 64, "state": 2},
              "dim_country": {"country_id": 3, "name": 128, "languages": 128},
              "dim_date": {},
              "fact_ingress": {"ingress_id": 36, "country_id": 3, "airport_id": 4, "gender": 1, "age_bucket": 2,
                               "temperature_bucket": 2}}
NOT_NULL = {"dim_airport": ["airport_id", "municipality", "state"], "dim_country": ["country_id", "languages"],
            "dim_date": ["date_id", "year", "month", "day", "day_of_week", "week_of_year"],
            "fact_ingress": ["date_id", "country_id", "airport_id", "gender", "age_bucket", "temperature_bucket"]}
BUSIEST_AIRPORT_MIN_ROWS = 100_000


#: Text columns of fixed width; other limited ones vary up to their limit.
FIXED_WIDTH = ("airport_id", "state", "country_id", "ingress_id", "gender", "age_bucket", "temperature_bucket")


def constraints(table: str) -> dict[str, tuple[int | None, bool]]:
    """Most characters (or None), and whether nulls are refused, for each column of a star table; keys are never null."""
    lengths = MAX_LENGTH[table]
    return {f.name: (lengths.get(f.name), f.name in NOT_NULL[table] or f.name == TABLE_KEYS[table]) for f in STAR_TABLES[table].fields}


def ddl_columns(schema: T.StructType, table: str | None = None) -> str:
    """Column list for CREATE TABLE derived from the StructType, with a star table's lengths and null rules."""
    rules, out = constraints(table) if table else {}, []
    for f in schema.fields:
        length, required = rules.get(f.name, (None, False))
        kind = f"{'char' if f.name in FIXED_WIDTH else 'varchar'}({length})" if length else f.dataType.simpleString()
        out.append(f"`{f.name}` {kind}{' NOT NULL' if required else ''}")
    return ", ".join(out)


def enforced(df: DataFrame, table: str) -> DataFrame:
    """The frame with a star table's column rules in its columns: the write of a null or a too long text fails."""
    def checked(name: str, length: int | None, required: bool) -> Column:
        value = c = F.col(name)
        if length:
            value = F.when(F.char_length(c) > length, F.raise_error(F.concat(F.lit(f"{table}.{name} is longer than {length}: "), c))).otherwise(value)
        if required:
            value = F.when(c.isNull(), F.raise_error(F.lit(f"{table}.{name} is null"))).otherwise(value)
        return value.alias(name)

    rules = constraints(table)
    return df.select(*[checked(c, *rules[c]) if c in rules else F.col(c) for c in df.columns])
