"""Driver queries for loads and whole runs (K1-K7, C3, C5, C7, C8, C11, C13-C17, V1-V11): raw inputs are written from the
driver tables under the shared folder, taken through the library's own pipeline, and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import date_key
from ..session import scratch_path
from . import pipeline, staging, versions, warehouse
from .query_helpers import _BIRTH_SQL, _age_case, _birth_year, _date_key_sql, _port_letters, _t, _temp_case, _written_csv


def rows_then_gone(df: DataFrame, *folders: str) -> DataFrame:
    """The few rows of ``df``, read before the folders that it reads go."""
    rows, schema = df.collect(), df.schema
    for folder in folders:
        versions.remove(df.sparkSession, folder)
    return df.sparkSession.createDataFrame(rows, schema)


# --------------------------------------------------------------------------- K7 C13
ORDER_FACT = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("date_id", T.IntegerType())])


def q_fact_incremental_load(spark, sf):
    """Orders loaded extract by extract. Extracts are quarters that end on the 10th, so each shares a month with the
    next; January 1995 comes in two halves, the first one short of its odd keys and later again in full; and a
    fourth of the quarters comes twice. No order is lost or doubled: counts per month, read back."""
    d = F.col("o_orderdate").cast("date")
    quarter = F.concat_ws("-q", F.year(F.date_sub(d, 10)), F.quarter(F.date_sub(d, 10)))
    half = F.when((F.year(d) == 1995) & (F.month(d) == 1), F.concat(F.lit("1995/1 "), F.when(F.dayofmonth(d) <= 15, "a").otherwise("b")))
    fact = warehouse.with_load_unit(_t(spark, sf, "orders").select("o_orderkey", date_key(d).alias("date_id"),
                                                                   F.coalesce(half, quarter).alias(versions.EXTRACT)))
    store = versions.Store(spark, scratch_path(spark, "extracts"), {"orders": ORDER_FACT}, {"orders": schemas.FACT_PARTITION})
    extract, share = F.col(versions.EXTRACT), F.pmod(F.crc32(versions.EXTRACT), F.lit(4))
    halves = extract.startswith("1995/1")
    loads = [~halves & (share == k) for k in (0, 1, 2, 3, 1)]
    loads[2:2] = [extract.endswith(" a") & (F.col("o_orderkey") % 2 == 0), extract.endswith(" b"), extract.endswith(" a")]
    for rows in loads:
        with store.begin() as draft:
            draft.load("orders", fact.where(rows))
    store.expire(1)
    counts = store.read("orders").groupBy(schemas.FACT_PARTITION).agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_keys"), F.count_distinct(extract).alias("n_extracts"))
    return rows_then_gone(counts, store.root)


SQL_FACT_INCREMENTAL_LOAD = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) - 10 AS e FROM orders)
SELECT CAST(year(d) * 100 + month(d) AS INTEGER) AS month_id, count(*) AS n, count(DISTINCT o_orderkey) AS n_keys,
       count(DISTINCT CASE WHEN year(d) = 1995 AND month(d) = 1 THEN CAST(day(d) <= 15 AS VARCHAR)
                           ELSE year(e) || '-' || quarter(e) END) AS n_extracts
FROM o GROUP BY 1
"""


# --------------------------------------------------------------------------- C15 C16 C17 and what they are made of
def _nations(spark, sf) -> DataFrame:
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "n_regionkey", "r_name")


def _ports_pages(nations: DataFrame) -> DataFrame:
    """A page of ports for each region: a header row, rows of one pair, unclosed cells, entities."""
    row = F.concat(F.lit("<tr><td>"), _port_letters("n_nationkey"), F.lit("</td><td><b>"), F.upper("n_name"),
                   F.lit("</b>&#44;&nbsp;"), F.upper(F.substring("r_name", 1, 2)), F.lit("</td></tr>\n"))
    rows = nations.where("r_name <> 'MIDDLE EAST'").groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    return rows.select(F.concat(F.lit("http://ports/"), "r_name").alias("url"),
                       F.concat(F.lit("<table><tr><th>Code</th><th>Place</th></tr>"), "rows", F.lit("</table>")).alias("html"))


def _countries(nations: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    title = F.when(F.col("r_name") == "EUROPE", F.concat(F.lit("?"), F.col("n_name"))).otherwise(F.initcap("n_name"))
    code = F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0"))
    return nations.select(title.alias("name"), F.substring(code, 1, 2).alias("alpha2"), F.when(k % 7 != 0, code).alias("alpha3"),
                          F.when(k % 3 != 0, F.concat(F.lit("L"), F.col("n_regionkey").cast("string"), F.lit(",L9,L0"))).alias("languages"))


def _languages(spark, sf) -> DataFrame:
    r = _t(spark, sf, "region")
    return r.select(F.col("r_name").alias("name"), F.lit("x").alias("alpha2"),
                    F.concat(F.lit("L"), F.col("r_regionkey").cast("string")).alias("alpha3"))


def _gdp(spark, sf) -> DataFrame:
    """Title line, header with a blank name, two series, two years, an aggregate region, a value with separators."""
    n, cols = _t(spark, sf, "nation"), "code string, country string, year string, series string, value string, footnotes string, source string"
    years = n.crossJoin(spark.createDataFrame([("2017", schemas.GDP_SERIES), ("2016", schemas.GDP_SERIES), ("2017", "other series")],
                                              "year string, series string"))   # three rows: a literal list
    rows = years.select((F.col("n_nationkey") + 500).cast("string"), F.upper("n_name"), "year", "series",
                        F.format_number(F.col("n_nationkey") * 1234.5, 2), F.lit(""), F.lit("é"))
    extra = spark.createDataFrame([("T13", "GDP per capita", None, None, None, None, None), ("Region/Country/Area", "", "Year", "Series", "Value", "Footnotes", "Source"),
                                   ("1", "World", "2017", schemas.GDP_SERIES, "9,999", "", "")], cols)
    return extra.unionAll(rows)


def _label_file(spark, sf, path: str) -> None:
    """The origin codes as a label file, with comments over several lines that hold what looks like entries."""
    entry = F.concat(F.lpad(F.col("n_nationkey").cast("string"), 6, " "), F.lit(" =  '"), F.upper("n_name"), F.lit("'"))
    body = _t(spark, sf, "nation").agg(F.array_join(F.array_sort(F.collect_list(entry)), "\n").alias("body"))
    text = F.concat(F.lit("/* codes\nvalue old\n 9 = 'gone' ;\n*/\nvalue i94cntyl\n /* first\n 77 = 'no' ; */\n"), "body", F.lit(" ;\n\nvalue other\n 1 = 'X'\n;\n"))
    body.select(text.alias("value")).write.text(path)


def _raw_arrivals(spark, sf) -> DataFrame:
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    status = F.col("o_orderstatus")
    return oc.select(
        _port_letters("c_nationkey").alias("i94port"), ((F.col("c_nationkey") + 3) % 25).cast("double").alias("i94cit"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double").alias("arrdate"),
        F.when(status == "P", 2.0).otherwise(1.0).alias("i94mode"), _birth_year().alias("biryear"),
        F.when(status == "F", "F").when(status == "O", "M").alias("gender"))


def _raw_temperatures(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    n = _t(spark, sf, "nation").select((F.col("n_nationkey")).alias("k"), "n_name")
    return o.join(n, o["o_custkey"] % 25 == n["k"]).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.when(F.col("o_orderkey") % 10 != 0, (F.col("o_custkey") % 40).cast("string")).alias("AverageTemperature"),
        F.initcap("n_name").alias("City"), F.lit("United States").alias("Country"))


def _raw_airports(nations: DataFrame) -> DataFrame:
    k = F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    return nations.select(F.concat(F.lit("K"), k).alias("ident"), F.concat(F.lit("Airport "), k).alias("name"), F.lit("US").alias("iso_country"),
                          F.concat(F.lit("US-"), F.upper(F.substring("r_name", 1, 2))).alias("iso_region"), F.lower("n_name").alias("municipality"),
                          F.lit("large_airport").alias("type"), F.lit("IAT").alias("iata_code"))


def _inputs(spark, sf, root: str) -> pipeline.Inputs:
    """All eight sources, written under ``root``; the arrivals as two extracts that share a month."""
    nations, arrivals = _nations(spark, sf), _raw_arrivals(spark, sf)
    paths = [f"{root}/arrivals_{k}" for k in (1, 2)]
    cut = F.col("arrdate") < (F.unix_date(F.lit("1995-01-20").cast("date")) + 3653)
    for path, rows in zip(paths, (arrivals.where(cut), arrivals.where(~cut))):
        rows.write.parquet(path)
    _ports_pages(nations).write.parquet(f"{root}/pages")
    _label_file(spark, sf, f"{root}/labels.sas")
    return pipeline.Inputs(arrivals=paths, extracts=["until 1995-01-19", "from 1995-01-20"], country_labels=f"{root}/labels.sas",
                           ports_pages=f"{root}/pages", temperatures=_written_csv(_raw_temperatures(spark, sf), "temperatures"),
                           gdp=_written_csv(_gdp(spark, sf), "gdp", header=False, encoding="ISO-8859-1"),
                           airports=_written_csv(_raw_airports(nations), "airports"), countries=_written_csv(_countries(nations), "countries"),
                           languages=_written_csv(_languages(spark, sf), "languages"))


#: The production thresholds are for full extracts; these tables hold at least so many rows at the smallest size.
THRESHOLDS = pipeline.Thresholds(staging=dict.fromkeys(schemas.STAGING_MIN_ROWS, 5), tables=dict.fromkeys(schemas.TABLE_MIN_ROWS, 5),
                                 major_airports=("K001", "K024"), busiest_airport="K001", busiest_airport_min_rows=1)


def _loaded(spark, database: str) -> DataFrame:
    """The star query over the catalog's tables, grouped."""
    t = {n: spark.table(f"`{database}`.`{n}`") for n in schemas.STAR_TABLES}
    star = warehouse.star_query(t["fact_ingress"], t["dim_date"], t["dim_country"], t["dim_airport"])
    return star.groupBy("country_name", "languages", "gdp_per_capita", "airport_name", "state", "gender", "age_bucket",
                        "temperature_bucket").agg(F.count("*").alias("n"), F.min("date_id").alias("first_day"), F.max("date_id").alias("last_day"),
                                                  F.count_distinct("extract_id").alias("n_extracts"))


def _whole_run(spark, sf, after: Callable[[str, str], None] = lambda root, database: None) -> DataFrame:
    root = scratch_path(spark, "run")
    database = f"starflow_{root.rsplit('-', 1)[-1]}"
    inputs = _inputs(spark, sf, root)
    try:
        pipeline.run(spark, inputs, f"{root}/star", THRESHOLDS, load_catalog=True, database=database)
        after(f"{root}/star", database)
        return rows_then_gone(_loaded(spark, database), root, inputs.temperatures, inputs.gdp, inputs.airports, inputs.countries, inputs.languages)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def q_whole_run(spark, sf):
    """C15 with C1-C14, C16, C17: eight written sources staged, checked, built, published, loaded into the catalog, and
    queried there."""
    return _whole_run(spark, sf)


def q_failed_load_kept(spark, sf):
    """After a whole run a load whose countries don't exist fails its checks; the catalog's tables are the run's."""
    def bad_load(root: str, database: str) -> None:
        written = pipeline.read_output(spark, root)
        written["fact_ingress"] = written["fact_ingress"].withColumns({"country_id": F.lit("ZZZ"), versions.EXTRACT: F.lit("bad")})
        written["dim_airport"] = written["dim_airport"].limit(0)
        try:
            pipeline.load(spark, written, f"{root}/warehouse", THRESHOLDS, database)
        except ValueError:
            return
        raise AssertionError("a load that fails its checks was let in")
    return _whole_run(spark, sf, bad_load)


_STAR_CTES = f"""
nr AS (SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
arr AS (SELECT c_nationkey AS port, (c_nationkey + 3) % 25 AS origin, CAST(o_orderdate AS DATE) AS d,
               CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M' ELSE 'U' END AS gender,
               {_age_case('(year(o_orderdate) - CAST(' + _BIRTH_SQL + ' AS INTEGER))')} AS age_bucket
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P'),
temps AS (SELECT o_custkey % 25 AS city, CAST(weekofyear(o_orderdate) AS INTEGER) AS w,
                 avg(CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey % 40 AS DOUBLE) END) AS m
          FROM orders WHERE year(o_orderdate) > (SELECT max(year(o_orderdate)) FROM orders) - 5 GROUP BY 1, 2),
country AS (SELECT n_nationkey, upper(n_name[1]) || lower(n_name[2:]) AS country_name,
                   CASE WHEN n_nationkey % 3 <> 0 THEN
                     (SELECT x.r_name FROM region x WHERE x.r_regionkey = n_regionkey) || ','
                     || (SELECT x.r_name FROM region x WHERE x.r_regionkey = 0)
                   ELSE 'Unknown' END AS languages, n_nationkey * 1234.5 AS gdp
            FROM nr WHERE r_name <> 'EUROPE' AND n_nationkey % 7 <> 0)
"""

SQL_WHOLE_RUN = f"""
WITH {_STAR_CTES}
SELECT c.country_name, c.languages, CAST(c.gdp AS DOUBLE) AS gdp_per_capita, 'Airport ' || lpad(CAST(a.n_nationkey AS VARCHAR), 3, '0') AS airport_name,
       upper(a.r_name[1:2]) AS state, gender, age_bucket, coalesce({_temp_case('t.m')}, 'UN') AS temperature_bucket, count(*) AS n,
       min({_date_key_sql('d')}) AS first_day, max({_date_key_sql('d')}) AS last_day, count(DISTINCT d < DATE '1995-01-20') AS n_extracts
FROM arr JOIN nr a ON a.n_nationkey = arr.port AND a.r_name <> 'MIDDLE EAST' JOIN country c ON c.n_nationkey = arr.origin
LEFT JOIN temps t ON t.city = arr.port AND t.w = CAST(weekofyear(d) AS INTEGER)
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8
"""


# --------------------------------------------------------------------------- C3 C5 C7 C8 by themselves
def q_stage_ports(spark, sf):
    """The ports of the regions' pages."""
    return staging.stage_ports(_ports_pages(_nations(spark, sf)))


SQL_STAGE_PORTS = """
SELECT chr(CAST(65 + n_nationkey // 676 AS INTEGER)) || chr(CAST(65 + n_nationkey // 26 AS INTEGER)) || chr(CAST(65 + n_nationkey % 26 AS INTEGER)) AS code,
       upper(n_name) AS municipality, upper(r_name[1:2]) AS state
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'MIDDLE EAST'
"""


def q_csv_stage_gdp(spark, sf):
    """GDP per country from a latin-1 CSV with a preamble; aggregate regions, other years and series dropped."""
    path = _written_csv(_gdp(spark, sf), "gdp", header=False, encoding="ISO-8859-1")
    return rows_then_gone(staging.stage_gdp(spark, path), path)


SQL_CSV_STAGE_GDP = "SELECT upper(n_name) AS country, CAST(n_nationkey * 1234.5 AS DOUBLE) AS gdp_per_capita FROM nation"


def q_csv_stage_countries(spark, sf):
    """Countries and languages from CSV, a row for each language of a country."""
    nations = _nations(spark, sf)
    paths = _written_csv(_countries(nations), "countries"), _written_csv(_languages(spark, sf), "languages")
    c = staging.stage_countries(spark, paths[0]).select("alpha3", "name", F.explode_outer("languages").alias("code"))
    names = staging.stage_languages(spark, paths[1]).select(F.col("alpha3").alias("code"), F.col("name").alias("language"))
    return rows_then_gone(c.join(names, "code", "left").select("alpha3", "name", "code", "language"), *paths)


SQL_CSV_STAGE_COUNTRIES = """
WITH c AS (SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS alpha3,
                  CASE WHEN r_name = 'EUROPE' THEN '?' || n_name ELSE upper(n_name[1]) || lower(n_name[2:]) END AS name,
                  unnest(CASE WHEN n_nationkey % 3 <> 0 THEN ['L' || n_regionkey, 'L9', 'L0'] ELSE [NULL] END) AS code
           FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 7 <> 0)
SELECT alpha3, name, code, r_name AS language FROM c LEFT JOIN region ON code = 'L' || r_regionkey
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fact_incremental_load": q_fact_incremental_load,
    "whole_run": q_whole_run,
    "failed_load_kept": q_failed_load_kept,
    "stage_ports": q_stage_ports,
    "csv_stage_gdp": q_csv_stage_gdp,
    "csv_stage_countries": q_csv_stage_countries,
}

ORACLE_SQL = {
    "fact_incremental_load": SQL_FACT_INCREMENTAL_LOAD,
    "whole_run": SQL_WHOLE_RUN,
    "failed_load_kept": SQL_WHOLE_RUN,
    "stage_ports": SQL_STAGE_PORTS,
    "csv_stage_gdp": SQL_CSV_STAGE_GDP,
    "csv_stage_countries": SQL_CSV_STAGE_COUNTRIES,
}
