"""Driver queries: each inventory operator run over the given TPC-H-ish tables, with a DuckDB twin.

Every query reads whole tables (no id subsets, no row caps; the one
``limit`` is the top-k feature itself). Computed columns carry the same
alias and type on both sides; averages that are banded use exact decimal
means so both engines land on the same side of a band edge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import (age_bucket, age_from_birth_year, clean_number, date_columns, date_key, default_code,
                         from_day_number, iso_week, norm_key, random_id, split_list, split_location, split_once,
                         stable_id, strip_literal, temperature_bucket)
from ..operators import (Expectation, check_table, distinct_values, duplicate_keys,
                         explode_lookup_collect, first_per_group, key_parts, lookup, lookup_default, lookup_list, profile,
                         top_k_counts, trailing_years, union_all, weekly_mean)
from ..session import exchanges_dropped, scratch_path
from ..sources import date_spine_between, html_links, html_table_pairs, parse_label_lines, parse_label_text, read_preamble_csv, scan
from . import dims, facts, load_queries, staging, versions, warehouse
from .query_helpers import _BIRTH_SQL, _age_case, _birth_year, _date_key_sql, _port_letters, _t, _table, _taken, _temp_case, _written_csv
from .staging import stage_country_labels

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")


# --------------------------------------------------------------------------- S8 / C9
def q_dim_date_spine(spark, sf):
    o = _t(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    bounds = o.agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    spine = date_spine_between(bounds, "lo", "hi")
    return spine.select(*[c.alias(n) for n, c in date_columns("date").items()])


SQL_DIM_DATE_SPINE = f"""
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
s AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM b)
SELECT {_date_key_sql('d')} AS date_id, CAST(year(d) AS SMALLINT) AS year, CAST(month(d) AS SMALLINT) AS month,
       CAST(day(d) AS SMALLINT) AS day, CAST(dayofweek(d) AS SMALLINT) AS day_of_week,
       CAST(weekofyear(d) AS SMALLINT) AS week_of_year
FROM s
"""


# --------------------------------------------------------------------------- X1 / X21
def q_day_number_decode(spark, sf):
    li = _t(spark, sf, "lineitem")
    days = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double")
    d = from_day_number(days)
    return li.select(d.alias("d"), "l_quantity").groupBy(
        F.year("d").alias("ship_year"), F.month("d").alias("ship_month")
    ).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


SQL_DAY_NUMBER_DECODE = """
WITH x AS (SELECT DATE '1960-01-01' + CAST(CAST(date_diff('day', DATE '1960-01-01', CAST(l_shipdate AS DATE))
                  AS DOUBLE) AS INTEGER) AS d, l_quantity FROM lineitem)
SELECT CAST(year(d) AS INTEGER) AS ship_year, CAST(month(d) AS INTEGER) AS ship_month, count(*) AS n,
       sum(l_quantity) AS qty
FROM x GROUP BY 1, 2
"""


# --------------------------------------------------------------------------- S1 U1 F1/F2 P1 P5
def q_air_only_filter_union(spark, sf):
    ev = scan(spark, [f"{sf.rstrip('/')}/events.parquet"], columns=["event_id", "ts", "user_id", "event_type", "value"])
    early = ev.where(F.dayofmonth("ts") <= 15)
    late = ev.where(F.dayofmonth("ts") > 15)
    u = union_all([early, late])
    return u.where(F.col("event_type") == "purchase").drop("event_type") \
        .select("event_id", "user_id", F.col("ts").cast("date").alias("event_date"), "value")


SQL_AIR_ONLY_FILTER_UNION = """
SELECT event_id, user_id, CAST(ts AS DATE) AS event_date, value FROM events WHERE event_type = 'purchase'
"""


# --------------------------------------------------------------------------- X9 X10 X12
def q_age_bucket_counts(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", _birth_year().alias("biryear"))
    o = _t(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    return j.groupBy(F.year("d").alias("order_year"),
                     age_bucket(age_from_birth_year("d", "biryear")).alias("age_bucket")) \
        .agg(F.count(F.lit(1)).alias("n"))


SQL_AGE_BUCKET_COUNTS = f"""
WITH c AS (SELECT c_custkey, {_BIRTH_SQL} AS biryear FROM customer),
a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year,
             year(o_orderdate) - CAST(biryear AS INTEGER) AS age
      FROM orders JOIN c ON o_custkey = c_custkey)
SELECT order_year, {_age_case('age')} AS age_bucket, count(*) AS n FROM a GROUP BY 1, 2
"""


# --------------------------------------------------------------------------- A4 X11 X5
def q_weekly_mean_bucket(spark, sf):
    ev = _t(spark, sf, "events").withColumn("v", F.col("value").cast("decimal(12,2)"))
    m = weekly_mean(ev, ["user_id"], "ts", "v", "mean_value")
    return m.select("user_id", F.col("week_of_year").cast("int").alias("week_of_year"),
                    temperature_bucket("mean_value").alias("temperature_bucket"))


SQL_WEEKLY_MEAN_BUCKET = f"""
WITH m AS (SELECT user_id, CAST(weekofyear(ts) AS INTEGER) AS week_of_year,
                  CAST(avg(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS mv
           FROM events GROUP BY 1, 2)
SELECT user_id, week_of_year, {_temp_case('mv')} AS temperature_bucket FROM m
"""


# --------------------------------------------------------------------------- A3 F6 J10
def q_trailing_years_mean(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_returnflag", "l_shipdate", "l_quantity")
    recent = trailing_years(li, "l_shipdate", 5).withColumn("d", F.col("l_shipdate").cast("date"))
    m = weekly_mean(recent, ["l_returnflag"], "d", "l_quantity", "mean_qty")
    return m.select("l_returnflag", F.col("week_of_year").cast("int").alias("week_of_year"), "mean_qty")


SQL_TRAILING_YEARS_MEAN = """
WITH l AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS d, l_quantity FROM lineitem),
m AS (SELECT max(year(d)) AS y FROM l)
SELECT l_returnflag, CAST(weekofyear(d) AS INTEGER) AS week_of_year, avg(l_quantity) AS mean_qty
FROM l, m WHERE year(d) > m.y - 5 AND year(d) <= m.y
GROUP BY 1, 2
"""


# --------------------------------------------------------------------------- W1 F8
def q_first_per_group(spark, sf):
    p = _t(spark, sf, "part").select("p_brand", "p_type", "p_partkey", "p_name", "p_size", "p_retailprice")
    return first_per_group(p, ["p_brand", "p_type"], ["p_partkey"])


SQL_FIRST_PER_GROUP = """
SELECT p_brand, p_type, p_partkey, p_name, p_size, p_retailprice FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey, p_name, p_size, p_retailprice) AS rn
  FROM part) WHERE rn = 1
"""


# --------------------------------------------------------------------------- X17 X18 X19 J1 A5
def _code_list():
    k = F.col("c_nationkey")
    listed = F.concat_ws(",", k.cast("string"), ((k + 7) % 25).cast("string"), (k + 30).cast("string"))
    return F.when(F.col("c_acctbal") >= 0, listed)


def q_explode_lookup_collect(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", split_list(_code_list()).alias("codes"))
    return explode_lookup_collect(c, ["c_custkey"], "codes", _t(spark, sf, "nation"), "n_nationkey", "n_name",
                                  "nation_names")


def q_lookup_list(spark, sf):
    """The same with the nations as one map value, in place."""
    c = _t(spark, sf, "customer").select("c_custkey", split_list(_code_list()).alias("codes"))
    return lookup_list(c, "codes", _t(spark, sf, "nation"), "n_nationkey", "n_name", "nation_names").drop("codes")


SQL_EXPLODE_LOOKUP_COLLECT = """
WITH c AS (SELECT c_custkey,
                  CASE WHEN c_acctbal >= 0 THEN concat_ws(',', CAST(c_nationkey AS VARCHAR),
                       CAST((c_nationkey + 7) % 25 AS VARCHAR), CAST(c_nationkey + 30 AS VARCHAR)) END AS codes
           FROM customer),
e AS (SELECT c_custkey, unnest(string_split(codes, ',')) AS code,
             unnest(range(len(string_split(codes, ',')))) AS pos
      FROM c WHERE codes IS NOT NULL)
SELECT c.c_custkey, coalesce(nullif(string_agg(n.n_name, ',' ORDER BY e.pos), ''), 'Unknown') AS nation_names
FROM c LEFT JOIN e ON c.c_custkey = e.c_custkey
LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = e.code
GROUP BY c.c_custkey
"""


# --------------------------------------------------------------------------- C10 (dims.dim_country)
def q_dim_country_build(spark, sf):
    """The country dimension composite over driver data: one "country" per customer, its language codes
    the nation list above, language names from nation, GDP from a per-name table of BUILDING customers."""
    c = _t(spark, sf, "customer")
    countries = c.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("alpha2"),
                         F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("alpha3"),
                         split_list(_code_list()).alias("languages"))
    languages = _t(spark, sf, "nation").select(F.col("n_name").alias("name"), F.lit(None).cast("string").alias("alpha2"),
                                              F.col("n_nationkey").cast("string").alias("alpha3"))
    known = F.when(F.col("c_mktsegment") == "BUILDING", F.upper("c_name")).otherwise(F.concat(F.lit("?"), F.col("c_name")))
    gdp = c.select(known.alias("country"), F.col("c_acctbal").alias("gdp_per_capita"))
    return dims.dim_country(countries, languages, gdp)


SQL_DIM_COUNTRY_BUILD = """
WITH c AS (SELECT c_custkey, c_name,
                  CASE WHEN c_acctbal >= 0 THEN concat_ws(',', CAST(c_nationkey AS VARCHAR),
                       CAST((c_nationkey + 7) % 25 AS VARCHAR), CAST(c_nationkey + 30 AS VARCHAR)) END AS codes
           FROM customer),
e AS (SELECT c_custkey, unnest(string_split(codes, ',')) AS code,
             unnest(range(len(string_split(codes, ',')))) AS pos
      FROM c WHERE codes IS NOT NULL),
l AS (SELECT c.c_custkey, c.c_name, coalesce(nullif(string_agg(n.n_name, ',' ORDER BY e.pos), ''), 'Unknown') AS languages
      FROM c LEFT JOIN e ON c.c_custkey = e.c_custkey
      LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = e.code
      GROUP BY c.c_custkey, c.c_name),
g AS (SELECT lower(trim(upper(c_name))) AS k, max(c_acctbal) AS gdp FROM customer WHERE c_mktsegment = 'BUILDING'
      GROUP BY 1)
SELECT 'C' || CAST(l.c_custkey AS VARCHAR) AS country_id, l.c_name AS name, l.languages,
       CAST(coalesce(g.gdp, 0.0) AS DOUBLE) AS gdp_per_capita
FROM l LEFT JOIN g ON lower(trim(l.c_name)) = g.k
"""


# --------------------------------------------------------------------------- J2 X12 X13
def q_left_join_default(spark, sf):
    s = _t(spark, sf, "supplier").select(
        "s_suppkey", F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("country"))
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    known = F.when(F.col("r_name") != "ASIA", F.upper("n_name")).otherwise(F.concat(F.lit("?"), F.col("n_name")))
    g = n.join(r, n["n_regionkey"] == r["r_regionkey"]) \
        .select(known.alias("gdp_country"),
                (F.col("n_nationkey") * 100 + F.col("n_regionkey")).cast("double").alias("gdp_per_capita"))
    out = lookup_default(s, g, ["country"], ["gdp_country"], {"gdp_per_capita": 0.0}, normalize=True)
    return out.select("s_suppkey", "country", "gdp_per_capita")


SQL_LEFT_JOIN_DEFAULT = """
WITH g AS (SELECT upper(n_name) AS gdp_country, CAST(n_nationkey * 100 + n_regionkey AS DOUBLE) AS gdp_per_capita
           FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'),
s AS (SELECT s_suppkey, 'nation_' || CAST(s_nationkey AS VARCHAR) AS country FROM supplier)
SELECT s_suppkey, country, coalesce(g.gdp_per_capita, 0.0) AS gdp_per_capita
FROM s LEFT JOIN g ON lower(trim(s.country)) = lower(trim(g.gdp_country))
"""


# --------------------------------------------------------------------------- J4 (through W1)
def q_composite_key_join(spark, sf):
    p = _t(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    reps = first_per_group(p, ["p_brand", "p_type"], ["p_partkey"]) \
        .select(F.col("p_brand").alias("r_brand"), F.col("p_type").alias("r_type"),
                F.col("p_partkey").alias("rep_partkey"))
    li = _t(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    lp = li.join(p, li["l_partkey"] == p["p_partkey"])
    j = lookup(lp, reps, ["p_brand", "p_type"], ["r_brand", "r_type"])
    return j.groupBy("rep_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


SQL_COMPOSITE_KEY_JOIN = """
WITH reps AS (SELECT p_brand AS r_brand, p_type AS r_type, min(p_partkey) AS rep_partkey FROM part GROUP BY 1, 2)
SELECT rep_partkey, count(*) AS n, sum(l_quantity) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN reps ON p_brand = r_brand AND p_type = r_type
GROUP BY rep_partkey
"""


# --------------------------------------------------------------------------- J5
def _week_bands(ev: DataFrame) -> DataFrame:
    """History: weekly band per event type (exact decimal means); late days of a month count under a key of their own."""
    early = F.when(F.dayofmonth("ts") <= 15, norm_key("event_type")).otherwise(F.lit("(late)"))
    hist = ev.withColumn("v", F.col("value").cast("decimal(12,2)"))
    m = weekly_mean(hist, [early.alias("k")], "ts", "v", "mean_value")
    return m.select("k", F.col("week_of_year").cast("int").alias("w"),
                    temperature_bucket(F.col("mean_value") - 40).alias("temperature_bucket"))


def q_week_enrichment_left(spark, sf):
    ev = _t(spark, sf, "events")
    bands = _week_bands(ev)
    left = ev.select("event_id", "event_type", "ts")
    out = lookup_default(left, bands, [norm_key("event_type"), iso_week("ts")], ["k", "w"],
                         {"temperature_bucket": "UN"})
    return out.select("event_id", iso_week("ts").alias("week_of_year"), "temperature_bucket")


SQL_WEEK_ENRICHMENT_LEFT = f"""
WITH b AS (SELECT lower(trim(event_type)) AS k, CAST(weekofyear(ts) AS INTEGER) AS w,
                  CAST(avg(CAST(value AS DECIMAL(12,2))) AS DOUBLE) - 40 AS m
           FROM events WHERE dayofmonth(ts) <= 15 GROUP BY 1, 2),
bb AS (SELECT k, w, {_temp_case('m')} AS temperature_bucket FROM b)
SELECT e.event_id, CAST(weekofyear(e.ts) AS INTEGER) AS week_of_year,
       coalesce(bb.temperature_bucket, 'UN') AS temperature_bucket
FROM events e LEFT JOIN bb ON lower(trim(e.event_type)) = bb.k AND CAST(weekofyear(e.ts) AS INTEGER) = bb.w
"""


# --------------------------------------------------------------------------- J6 X21
def _nation_labels(n: DataFrame) -> DataFrame:
    """Code-label pairs as a CSV would deliver them: padded numeric code text, upper-case label."""
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 3, " ").alias("value"),
                    F.col("n_name").alias("description"))


def q_cross_type_key_join(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("i94cit"))
    labels = stage_country_labels(_nation_labels(_t(spark, sf, "nation")))
    j = c.join(labels, c["i94cit"].try_cast("int") == labels["value"])
    return j.select("c_custkey", F.col("description").alias("n_name"))


SQL_CROSS_TYPE_KEY_JOIN = """
SELECT c_custkey, n_name FROM customer
JOIN nation ON CAST(CAST(c_nationkey AS DOUBLE) AS INTEGER) = TRY_CAST(lpad(CAST(n_nationkey AS VARCHAR), 3, ' ') AS INTEGER)
"""


# --------------------------------------------------------------------------- J7 J8
def q_label_chain_join(spark, sf):
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    shift = F.when(F.col("r_name") == "AFRICA", 1000).otherwise(0)  # codes that no customer has
    labels = stage_country_labels(nr.select((F.col("n_nationkey") + shift).cast("string").alias("value"),
                                            F.upper("n_name").alias("description")))
    countries = nr.select(
        F.when(F.col("r_name") == "EUROPE", F.concat(F.lit("?"), F.col("n_name"))).otherwise(F.lower("n_name")).alias("name"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("alpha3"))
    c = _t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("i94cit"))
    j = lookup(c, labels, [F.col("i94cit").try_cast("int")], ["value"], how="left")
    j = lookup(j, countries, ["description"], ["name"], how="left", normalize=True)
    return j.select("c_custkey", "description", F.col("alpha3").alias("country_id"))


SQL_LABEL_CHAIN_JOIN = """
WITH l AS (SELECT n_nationkey AS value, upper(n_name) AS description
           FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA'),
k AS (SELECT lower(n_name) AS name, 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS alpha3
      FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE')
SELECT c.c_custkey, l.description, k.alpha3 AS country_id
FROM customer c
LEFT JOIN l ON CAST(CAST(c.c_nationkey AS DOUBLE) AS INTEGER) = l.value
LEFT JOIN k ON lower(trim(l.description)) = lower(trim(k.name))
"""


# --------------------------------------------------------------------------- C12 J3-J7 X20
def build_fact(spark, sf, ship_from: str | None = None, ship_before: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Seven-column fact over lineitem: orders+customer joined first (the smaller pair), then lineitem once.

    ``ship_from`` and ``ship_before`` are a range on the stored ship date, so it reaches the scan of lineitem
    and only those line items meet the orders. All joins are left to Spark's sizes and skew handling.
    """
    customer = _t(spark, sf, "customer")
    orders = _t(spark, sf, "orders")
    c = customer.select("c_custkey", "c_nationkey", _birth_year().alias("biryear"))
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_date"))
    oc = o.join(cn, o["o_custkey"] == cn["c_custkey"])
    li = _t(spark, sf, "lineitem")
    for text, after in ((ship_from, True), (ship_before, False)):
        if text:
            bound = F.lit(text).cast(li.schema["l_shipdate"].dataType)
            li = li.where(F.col("l_shipdate") >= bound if after else F.col("l_shipdate") < bound)
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                   F.col("l_shipdate").cast("date").alias("ship_date"))
    f = li.join(oc, li["l_orderkey"] == oc["o_orderkey"])
    return f.select(
        *keep, stable_id("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("ingress_id"),
        date_key("ship_date").alias("date_id"),
        F.col("n_name").alias("country_id"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("airport_id"),
        default_code("o_orderstatus", "U").alias("gender"),
        age_bucket(age_from_birth_year("o_date", "biryear")).alias("age_bucket"),
        temperature_bucket("l_quantity").alias("temperature_bucket"),
    )


def q_fact_build(spark, sf):
    return build_fact(spark, sf)


def _md5_id_sql(expr: str) -> str:
    h = f"md5({expr})"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


SQL_FACT_CTE = f"""
f AS (
  SELECT {_md5_id_sql("concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
                      "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR))")} AS ingress_id,
         {_date_key_sql('CAST(l_shipdate AS DATE)')} AS date_id,
         n_name AS country_id,
         'S' || CAST(l_suppkey AS VARCHAR) AS airport_id,
         coalesce(nullif(trim(o_orderstatus), ''), 'U') AS gender,
         {_age_case('(year(o_orderdate) - CAST(' + _BIRTH_SQL + ' AS INTEGER))')} AS age_bucket,
         {_temp_case('l_quantity')} AS temperature_bucket
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)
"""

SQL_FACT_BUILD = f"WITH {SQL_FACT_CTE} SELECT * FROM f"


# --------------------------------------------------------------------------- C1 + C12 (staging.clean_arrivals, facts.fact_ingress)
def _nr(spark, sf) -> DataFrame:
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "n_regionkey", "r_name")


def _port_code(key: str):
    return F.concat(F.lit("P"), F.lpad(F.col(key).cast("string"), 2, "0"))


def q_fact_ingress_build(spark, sf):
    """The fact composite over driver data: every order is an arrival (mode from status), its port and
    origin from the customer's nation; ports/airports differ in letter case; temperature bands are trailing
    weekly means of order prices per nation; European origins have no country and are dropped."""
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    status = F.col("o_orderstatus")
    raw = oc.select(
        _port_code("c_nationkey").alias("i94port"),
        ((F.col("c_nationkey") + 3) % 25).cast("double").alias("i94cit"),
        F.datediff(F.col("o_orderdate").cast("date"), F.lit("1960-01-01").cast("date")).cast("double").alias("arrdate"),
        F.when(status == "P", 2.0).otherwise(1.0).alias("i94mode"),
        _birth_year().alias("biryear"),
        F.when(status == "F", "F").when(status == "O", "M").alias("gender"))
    arrivals = staging.clean_arrivals(raw)
    nr = _nr(spark, sf)
    state = F.upper(F.substring("r_name", 1, 2))
    place = F.when(F.col("r_name") == "MIDDLE EAST", F.lit("nowhere")).otherwise(F.upper("n_name"))
    ports = nr.select(_port_code("n_nationkey").alias("code"), place.alias("municipality"), state.alias("state"))
    s = _t(spark, sf, "supplier")
    airports = first_per_group(
        s.join(nr, s["s_nationkey"] == nr["n_nationkey"]).select(
            F.concat(F.lit("K"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0")).alias("airport_id"),
            F.col("s_name").alias("name"), F.initcap("n_name").alias("municipality"), state.alias("state")),
        ["state", "municipality"], ["airport_id"])
    hist = oc.join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        norm_key("n_name").alias("city"), F.col("o_orderdate").cast("date").alias("dt"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    means = weekly_mean(trailing_years(hist, "dt", 5), ["city"], "dt", "price", "m")
    temps = means.select("city", F.col("week_of_year").cast("int").alias("week_of_year"),
                         temperature_bucket(F.col("m") / 10000).alias("temperature_bucket"))
    labels = stage_country_labels(_nation_labels(_t(spark, sf, "nation")).select(
        "value", F.upper("description").alias("description")))
    title = F.when(F.col("r_name") == "EUROPE", F.concat(F.lit("?"), F.col("n_name"))).otherwise(F.initcap("n_name"))
    countries = nr.select(
        title.alias("name"), F.lit(None).cast("string").alias("alpha2"),
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("alpha3"),
        split_list(F.concat(F.col("n_regionkey").cast("string"), F.lit(",9"))).alias("languages"))
    languages = _t(spark, sf, "region").select(F.col("r_name").alias("name"), F.lit(None).cast("string").alias("alpha2"),
                                              F.col("r_regionkey").cast("string").alias("alpha3"))
    cn = c.join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    gdp = cn.groupBy(F.upper("n_name").alias("country")).agg(F.max("c_acctbal").alias("gdp_per_capita"))
    country = dims.dim_country(countries, languages, gdp)
    fact = facts.fact_ingress(arrivals, ports, airports, temps, labels, country)
    return fact.select("date_id", "country_id", "airport_id", "gender", "age_bucket", "temperature_bucket")


SQL_FACT_INGRESS_BUILD = f"""
WITH raw AS (
  SELECT 'P' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS i94port,
         CAST((c_nationkey + 3) % 25 AS DOUBLE) AS i94cit, CAST(o_orderdate AS DATE) AS arrdate,
         CASE WHEN o_orderstatus = 'P' THEN 2.0 ELSE 1.0 END AS i94mode, {_BIRTH_SQL} AS biryear,
         CASE WHEN o_orderstatus = 'F' THEN 'F' WHEN o_orderstatus = 'O' THEN 'M' END AS gender
  FROM orders JOIN customer ON o_custkey = c_custkey),
arr AS (
  SELECT i94port, CAST(i94cit AS INTEGER) AS i94cit, arrdate, coalesce(nullif(trim(gender), ''), 'U') AS gender,
         {_age_case('(year(arrdate) - CAST(biryear AS INTEGER))')} AS age_bucket, {_date_key_sql('arrdate')} AS date_id
  FROM raw WHERE i94mode = 1),
nr AS (SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
ports AS (SELECT 'P' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code, upper(n_name) AS municipality,
                 upper(substr(r_name, 1, 2)) AS state FROM nr WHERE r_name <> 'MIDDLE EAST'),
airports AS (
  SELECT min('K' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0')) AS airport_id, municipality, state
  FROM (SELECT s_suppkey, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS municipality,
               upper(substr(r_name, 1, 2)) AS state FROM supplier JOIN nr ON s_nationkey = n_nationkey)
  GROUP BY municipality, state),
pa AS (SELECT p.code, a.airport_id, p.municipality FROM ports p JOIN airports a
       ON lower(trim(p.state)) = lower(trim(a.state)) AND lower(trim(p.municipality)) = lower(trim(a.municipality))),
hist AS (SELECT lower(trim(n_name)) AS city, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(12,2)) AS price
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
mx AS (SELECT max(year(d)) AS y FROM hist),
tm AS (SELECT city, CAST(weekofyear(d) AS INTEGER) AS w, CAST(avg(price) AS DOUBLE) / 10000 AS m
       FROM hist, mx WHERE year(d) > mx.y - 5 AND year(d) <= mx.y GROUP BY 1, 2),
temps AS (SELECT city, w, {_temp_case('m')} AS temperature_bucket FROM tm),
labels AS (SELECT TRY_CAST(lpad(CAST(n_nationkey AS VARCHAR), 3, ' ') AS INTEGER) AS value,
                  trim(upper(n_name)) AS description FROM nation),
dimc AS (SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_id,
                upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS name FROM nr WHERE r_name <> 'EUROPE'),
origin AS (SELECT l.value AS origin_code, d.country_id FROM labels l
           JOIN dimc d ON lower(trim(l.description)) = lower(trim(d.name)))
SELECT a.date_id, o.country_id, pa.airport_id, a.gender, a.age_bucket,
       coalesce(t.temperature_bucket, 'UN') AS temperature_bucket
FROM arr a JOIN pa ON a.i94port = pa.code
LEFT JOIN temps t ON lower(trim(pa.municipality)) = t.city AND CAST(weekofyear(a.arrdate) AS INTEGER) = t.w
JOIN origin o ON a.i94cit = o.origin_code
"""


# --------------------------------------------------------------------------- C17 J9 F11
def _star_dims(spark, sf):
    dd = q_dim_date_spine(spark, sf)
    n, r = _t(spark, sf, "nation"), _t(spark, sf, "region")
    dc = n.select(F.col("n_name").alias("country_id"), F.initcap("n_name").alias("name"),
                  F.lit("Unknown").alias("languages"), F.col("n_nationkey").cast("double").alias("gdp_per_capita"))
    s = _t(spark, sf, "supplier")
    nr = n.join(r, n["n_regionkey"] == r["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    da = s.join(nr, s["s_nationkey"] == nr["n_nationkey"]).select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("airport_id"), F.col("s_name").alias("name"),
        F.col("n_name").alias("municipality"), F.col("r_name").alias("state"))
    return dd, dc, da


def q_star_query(spark, sf):
    # The filtered month as a range on the stored date: it prunes the scan before any join.
    fact = build_fact(spark, sf, "1997-04-01", "1997-05-01")
    dd, dc, da = _star_dims(spark, sf)
    j = warehouse.star_query(fact, dd, dc, da,
                             date_where=(F.col("year") == 1997) & (F.col("month") == 4),
                             airport_where=F.col("state") == "AMERICA")
    return j.groupBy("country_name", "age_bucket", "temperature_bucket").agg(F.count(F.lit(1)).alias("n"))


SQL_STAR_QUERY = f"""
WITH {SQL_FACT_CTE},
da AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS airport_id, r_name AS state
       FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
dc AS (SELECT n_name AS country_id, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS country_name
       FROM nation)
SELECT dc.country_name, f.age_bucket, f.temperature_bucket, count(*) AS n
FROM f JOIN da ON f.airport_id = da.airport_id JOIN dc ON f.country_id = dc.country_id
WHERE f.date_id BETWEEN 19970401 AND 19970430 AND da.state = 'AMERICA'
GROUP BY 1, 2, 3
"""


# --------------------------------------------------------------------------- C17 J9 on a stored fact
def _stored_star(spark, sf) -> tuple[DataFrame, versions.Store]:
    """The star query over a fact stored by year of delivery and month, in files ordered by airport, so that the month
    of the date dimension prunes partitions as the query runs, and an airport's rows lie together."""
    fact = warehouse.with_load_unit(build_fact(spark, sf)).withColumn(
        versions.EXTRACT, F.floor(F.col("date_id") / 10000).cast("string"))
    columns = T.StructType([f for f in fact.schema.fields if f.name not in (versions.EXTRACT, schemas.FACT_PARTITION)])
    store = versions.Store(spark, scratch_path(spark, "star"), {"fact": columns}, {"fact": schemas.FACT_PARTITION}, {"fact": ["airport_id", "date_id"]})
    with store.begin() as draft:
        draft.load("fact", fact)
    dd, dc, da = _star_dims(spark, sf)
    j = warehouse.star_query(store.read("fact"), dd, dc, da, date_where=(F.col("year") == 1997) & (F.col("month") == 4),
                             airport_where=F.col("state") == "AMERICA")
    return j.groupBy("country_name", "age_bucket", "temperature_bucket").agg(F.count(F.lit(1)).alias("n")), store


def q_star_query_stored(spark, sf):
    star, store = _stored_star(spark, sf)
    return load_queries.rows_then_gone(star, store.root)


# --------------------------------------------------------------------------- O1 O2 O4 on the star
def q_star_sorted_preview(spark, sf):
    """The star query's ORDER BY ... LIMIT: the most frequent groups, ties by name."""
    out = q_star_query(spark, sf)
    return out.orderBy(F.col("n").desc(), "country_name", "age_bucket", "temperature_bucket").limit(20)


SQL_STAR_SORTED_PREVIEW = f"SELECT * FROM ({SQL_STAR_QUERY}) ORDER BY n DESC, country_name, age_bucket, temperature_bucket LIMIT 20"


# --------------------------------------------------------------------------- A6 O3
def q_top_k_counts(spark, sf):
    return top_k_counts(_t(spark, sf, "events"), "user_id", 50, count_col="n")


SQL_TOP_K_COUNTS = """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 50
"""


# --------------------------------------------------------------------------- A2 F10 V12
def q_conditional_counts(spark, sf):
    c = _t(spark, sf, "customer")
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    return c.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(bal.isNull()).alias("null_acctbal"),
        F.count_if(bal == 0).alias("zero_acctbal"),
        F.count_if(bal < 0).alias("negative_acctbal"),
        F.count_if(F.isnan(bal)).alias("nan_acctbal"),
        F.count_if(seg.isNull() | (F.trim(seg) == "")).alias("blank_segment"),
    )


SQL_CONDITIONAL_COUNTS = """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE c_acctbal IS NULL) AS null_acctbal,
       count(*) FILTER (WHERE c_acctbal = 0) AS zero_acctbal,
       count(*) FILTER (WHERE c_acctbal < 0) AS negative_acctbal,
       count(*) FILTER (WHERE isnan(c_acctbal)) AS nan_acctbal,
       count(*) FILTER (WHERE c_mktsegment IS NULL OR trim(c_mktsegment) = '') AS blank_segment
FROM customer
"""


# --------------------------------------------------------------------------- A7
def q_distinct_values(spark, sf):
    return distinct_values(_t(spark, sf, "orders"), "o_orderstatus")


SQL_DISTINCT_VALUES = "SELECT DISTINCT o_orderstatus FROM orders"


# --------------------------------------------------------------------------- F7 A2
def q_date_range_count(spark, sf):
    o = _t(spark, sf, "orders")
    d = F.col("o_orderdate").cast("date")
    inside = (d >= F.lit("1996-01-01").cast("date")) & (d < F.lit("1997-01-01").cast("date"))
    return o.groupBy("o_orderpriority").agg(F.count_if(inside).alias("n_1996"), F.count(F.lit(1)).alias("n_all"))


SQL_DATE_RANGE_COUNT = """
SELECT o_orderpriority,
       count(*) FILTER (WHERE CAST(o_orderdate AS DATE) >= DATE '1996-01-01'
                          AND CAST(o_orderdate AS DATE) < DATE '1997-01-01') AS n_1996,
       count(*) AS n_all
FROM orders GROUP BY 1
"""


# --------------------------------------------------------------------------- F4 F3 F2
EXCLUDED_PRIORITY_CODES = (2, 4)


def q_not_in_filter(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderpriority", "o_orderstatus", F.date_format("o_orderdate", "yyyy").alias("year_text"),
        F.substring("o_orderpriority", 1, 1).alias("code"))
    kept = o.where(~F.col("code").try_cast("int").isin(list(EXCLUDED_PRIORITY_CODES))) \
        .where(F.col("o_orderstatus") == "F") \
        .where(F.col("year_text").try_cast("int") == 1997)
    return kept.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


SQL_NOT_IN_FILTER = """
SELECT o_orderpriority, count(*) AS n FROM orders
WHERE TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) NOT IN (2, 4)
  AND o_orderstatus = 'F'
  AND TRY_CAST(strftime(o_orderdate, '%Y') AS INTEGER) = 1997
GROUP BY 1
"""


# --------------------------------------------------------------------------- X16
def q_clean_number(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(F.format_number("o_totalprice", 2))
    return o.select("o_orderkey", text.alias("price_text")).select(
        "o_orderkey", "price_text", clean_number("price_text").alias("price"))


SQL_CLEAN_NUMBER = """
WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'n/a' ELSE format('{:,.2f}', o_totalprice) END
                  AS price_text FROM orders)
SELECT o_orderkey, price_text, TRY_CAST(replace(price_text, ',', '') AS DOUBLE) AS price FROM t
"""


# --------------------------------------------------------------------------- X14 S7
def _location():
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    return (F.when(F.col("c_acctbal") < 0, name)
            .when(seg == "BUILDING", F.concat(name, F.lit(", "), seg, F.lit(", EXTRA")))
            .otherwise(F.concat(name, F.lit(" , "), seg)))


def q_location_split(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", _location().alias("location"))
    city, state = split_location("location")
    head, rest = split_once("location")
    return c.select("c_custkey", city.alias("municipality"), state.alias("state"), head.alias("port"),
                    rest.alias("port_state"))


SQL_LOCATION_SPLIT = """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_name
                                  WHEN c_mktsegment = 'BUILDING' THEN c_name || ', ' || c_mktsegment || ', EXTRA'
                                  ELSE c_name || ' , ' || c_mktsegment END AS loc FROM customer)
SELECT c_custkey,
       CASE WHEN strpos(loc, ',') > 0 THEN trim(split_part(loc, ',', 1)) END AS municipality,
       CASE WHEN strpos(loc, ',') > 0 THEN trim(split_part(loc, ',', 2)) END AS state,
       trim(split_part(loc, ',', 1)) AS port,
       CASE WHEN strpos(loc, ',') > 0 THEN trim(substr(loc, strpos(loc, ',') + 1)) END AS port_state
FROM c
"""


# --------------------------------------------------------------------------- X15
def q_prefix_strip(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", strip_literal("c_name", "Customer#").alias("customer_code"))


SQL_PREFIX_STRIP = "SELECT c_custkey, replace(c_name, 'Customer#', '') AS customer_code FROM customer"


# --------------------------------------------------------------------------- S5 F9
LINK_TEXT = r"^[A-Za-z]+$"


def q_html_pairs(spark, sf):
    pages = _t(spark, sf, "pages")
    return html_links(pages, "html", text_pattern=LINK_TEXT, keep=["page_id"]) \
        .select("page_id", "link_pos", "href", "text")


#: The entities that the given pages hold, decoded by plain replacement.
_PAGE_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&middot;", "·"),
                  ("&copy;", "©"), ("&amp;", "&"))


def _unescape_sql(x: str) -> str:
    for entity, char in _PAGE_ENTITIES:
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def _sql_html_pairs() -> str:
    # Cut at "<a " and read each piece up to its "</a": no pattern shared with the operator.
    text = _unescape_sql("regexp_replace(substr(body, 1, strpos(body, '</a') - 1), '<[^>]*>', '', 'g')")
    return f"""
WITH p AS (SELECT page_id, unnest(string_split(html, '<a ')[2:]) AS a, unnest(range(len(string_split(html, '<a ')) - 1)) AS i FROM pages),
t AS (SELECT page_id, i, substr(a, 1, strpos(a, '>') - 1) AS attrs, substr(a, strpos(a, '>') + 1) AS body FROM p),
h AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS k FROM t WHERE strpos(attrs, 'href=') > 0 AND strpos(body, '</a') > 0),
z AS (SELECT page_id, CAST(k AS INTEGER) AS link_pos,
             {_unescape_sql("trim(split_part(attrs, 'href=', 2), chr(34))")} AS href, trim({text}) AS text FROM h)
SELECT * FROM z WHERE regexp_matches(text, '{LINK_TEXT}')
"""


def q_html_table_pairs(spark, sf):
    """A page per customer with a table of a header row, a row of two pairs and a row that is no pair; entities in
    each of their forms, attributes on tags, tags inside cells; a table inside an unclosed cell, unclosed itself."""
    # Dealt out before the pages are made: a file of few row groups would have them made and parsed in as few tasks.
    used = ["c_custkey", "c_name", "c_mktsegment"]
    c = _t(spark, sf, "customer").select(*used).repartition(3 * spark.sparkContext.defaultParallelism, *used)
    cell = lambda x: F.concat(F.lit("<TD class=x>"), x, F.lit("</td>"))
    code = _port_letters("c_custkey")
    one = F.concat(F.col("c_name"), F.lit(", A&amp;B &#233;&eacute;&#xE9; &amp;lt; &unknown; &lt;b&gt;"))
    two = F.concat(F.lit("<b>"), F.col("c_mktsegment"), F.lit("</b>&nbsp;&#39;x&#39; &middot;"))
    # A layout table of one unclosed cell for every second customer: inside it, unclosed cells and rows.
    inner = F.concat(F.lit("<table><tr><td>layout<table><tr><td>Q"), F.substring(code, 2, 2), F.lit("<td>"), F.col("c_name"),
                     F.lit(" <i>inner</i><tr><td>none<!-- <td>x --><td>AAA</table>"))
    html = F.concat(F.lit("<table><tr><th>Code</th><th>Place</th></tr>\n<tr id='1'>"), cell(code), cell(one), cell(F.reverse(code)),
                    cell(two), F.lit("</tr><tr><td>no code</td><td>none</td></tr></table>"), F.when(F.col("c_custkey") % 2 == 0, inner).otherwise(""))
    pages = c.select("c_custkey", html.alias("html"))
    return html_table_pairs(pages, "html", keep=["c_custkey"])


SQL_HTML_TABLE_PAIRS = """
WITH c AS (SELECT *, chr(CAST(65 + (c_custkey // 676) % 26 AS INTEGER)) || chr(CAST(65 + (c_custkey // 26) % 26 AS INTEGER))
                     || chr(CAST(65 + c_custkey % 26 AS INTEGER)) AS code FROM customer)
SELECT c_custkey, code, c_name || ', A&B ééé &lt; &unknown; <b>' AS location FROM c
UNION ALL SELECT c_custkey, reverse(code), c_mktsegment || ' ''x'' ·' FROM c
UNION ALL SELECT c_custkey, 'Q' || code[2:], c_name || ' inner' FROM c WHERE c_custkey % 2 = 0
"""


# --------------------------------------------------------------------------- S2 S3 S4 K8 X16
def q_preamble_csv(spark, sf):
    """Customers as latin-1 CSV with a title line, a header with a blank name, numbers with separators and quotes."""
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("k"), F.concat(F.lit("é \"q\", "), F.col("c_name")).alias("name"),
        F.format_number("c_acctbal", 2).alias("balance"))
    extra = c.limit(0).sparkSession.createDataFrame([("T1: é", None, None), ("Key", "", "Balance")], c.schema)
    path = _written_csv(extra.unionAll(c), "preamble", header=False, encoding="ISO-8859-1")
    back = read_preamble_csv(spark, path, "k string, name string, balance string", numeric_key="k")
    return back.select(F.col("k").cast("long").alias("c_custkey"), "name", clean_number("balance").alias("balance"))


SQL_PREAMBLE_CSV = """
SELECT c_custkey, 'é "q", ' || c_name AS name, TRY_CAST(replace(format('{:,.2f}', c_acctbal), ',', '') AS DOUBLE) AS balance FROM customer
"""


def q_csv_stage_airports(spark, sf):
    """Suppliers written as an airports CSV, staged: the lowest ident of each state and city, whatever their case."""
    s, n = _t(spark, sf, "supplier"), _t(spark, sf, "nation")
    k = F.col("s_suppkey")
    city = F.when(k % 2 == 0, F.upper("n_name")).otherwise(F.lower("n_name"))
    raw = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(
        F.concat(F.lit("K"), F.lpad(k.cast("string"), 7, "0")).alias("ident"), F.col("s_name").alias("name"),
        F.when(k % 7 == 0, "CA").otherwise("US").alias("iso_country"),
        F.concat(F.lit("US-"), F.lpad((k % 3).cast("string"), 2, "S")).alias("iso_region"), city.alias("municipality"),
        F.when(k % 5 == 0, "heliport").otherwise("large_airport").alias("type"), F.when(k % 11 != 0, "IAT").alias("iata_code"))
    out = staging.stage_airports(spark, _written_csv(raw, "airports"))
    return out.select("airport_id", F.lower("municipality").alias("municipality"), "state")


SQL_CSV_STAGE_AIRPORTS = """
SELECT 'K' || lpad(CAST(min(s_suppkey) AS VARCHAR), 7, '0') AS airport_id, lower(n_name) AS municipality,
       lpad(CAST(s_suppkey % 3 AS VARCHAR), 2, 'S') AS state
FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0 AND s_suppkey % 11 <> 0 GROUP BY s_suppkey % 3, n_name
"""


def q_csv_stage_temperatures(spark, sf):
    """C4: orders written as a temperatures CSV (some values missing), staged to weekly bands of the last five years."""
    o = _t(spark, sf, "orders")
    raw = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
                   F.when(F.col("o_orderkey") % 10 != 0, (F.col("o_custkey") % 40).cast("string")).alias("AverageTemperature"),
                   F.concat(F.lit(" City "), F.col("o_orderpriority")).alias("City"),
                   F.when(F.col("o_orderstatus") == "F", "Canada").otherwise("United States").alias("Country"))
    return staging.stage_temperatures(spark, _written_csv(raw, "temperatures"))


SQL_CSV_STAGE_TEMPERATURES = f"""
WITH t AS (SELECT CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey % 40 AS DOUBLE) END AS v,
                  lower(trim(' City ' || o_orderpriority)) AS city FROM orders WHERE o_orderstatus <> 'F'),
m AS (SELECT city, CAST(weekofyear(d) AS INTEGER) AS week_of_year, avg(v) AS mv FROM t
      WHERE year(d) > (SELECT max(year(d)) FROM t) - 5 GROUP BY 1, 2)
SELECT city, week_of_year, {_temp_case('mv')} AS temperature_bucket FROM m
"""


# --------------------------------------------------------------------------- S6 X24
def _label_docs(li: DataFrame) -> DataFrame:
    """One small code-label document per line item: two blocks, terminators on the entry line or alone, a doubled
    quote and a terminator sign inside labels, a padded label, comments (with a terminator sign, with what looks like a
    header and an entry over several lines, between two lines of an entry), blank lines."""
    n = F.col("l_linenumber")
    term = F.when(n % 2 == 0, F.lit(" ;")).otherwise(F.lit("\n;"))
    text = F.concat(
        F.lit("/* flags of this line; */\n  value flagl /* a; b */\n   'x;y' = 'A;''B' /* ; */\n   "), n.cast("string"),
        F.lit(" =  '"), F.col("l_returnflag"), F.lit("''s "), F.col("l_linestatus"), F.lit("' /* to be\n  9 = 'no' ;\nvalue gone\n 8='no'*/"), term,
        F.lit("\n\n/* shipping */\nvalue $shipl\n\t'Q"), F.col("l_quantity").cast("int").cast("string"),
        F.lit("'\t=\t'"), F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(", "), F.col("l_returnflag"),
        F.lit("     '\n;\n"))
    return li.select("l_orderkey", "l_linenumber", text.alias("text"))


def q_label_text_parse(spark, sf):
    docs = _label_docs(_t(spark, sf, "lineitem"))
    return parse_label_text(docs, "text", keep=["l_orderkey", "l_linenumber"])


SQL_LABEL_TEXT_PARSE = """
SELECT l_orderkey, l_linenumber, 'flagl' AS list_name, 'x;y' AS code, 'A;''B' AS label FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'flagl' AS list_name, CAST(l_linenumber AS VARCHAR) AS code,
       l_returnflag || '''s ' || l_linestatus AS label FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'shipl', 'Q' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
       strftime(l_shipdate, '%Y-%m-%d') || ', ' || l_returnflag FROM lineitem
"""


#: Documents a core that are written and parsed at one time: their text and the exchange of their lines take 0.4 kB each on disk.
LABEL_DOCS_A_CORE = 2_000_000


def q_label_file_parse(spark, sf):
    """S6 over files: the same documents written as text files under the shared folder (each document's
    lines stay together), then read back line by line over the file splits by ``parse_label_lines``.

    More documents than the cores take at one time are written and parsed in parts, one after the other: the entries of
    a part are stored, its text files and exchanges go before the next is written."""
    li = _t(spark, sf, "lineitem")
    parts = -(-li.count() // (LABEL_DOCS_A_CORE * spark.sparkContext.defaultParallelism)) or 1

    def written(rows):
        location = scratch_path(spark, "label_files")
        _label_docs(rows).select("text").write.mode("overwrite").text(location)
        return location

    if parts == 1:
        return parse_label_lines(spark, written(li))
    stored = scratch_path(spark, "label_entries")
    with exchanges_dropped(spark):
        for part in range(parts):
            # By place in its file: every row has one, whatever its keys, and the parts are of one size.
            location = written(li.where(F.col("_metadata.row_index") % parts == part))
            parse_label_lines(spark, location).write.parquet(f"{stored}/{part}")
            warehouse.remove(spark, location)
    return spark.read.parquet(*(f"{stored}/{part}" for part in range(parts)))


SQL_LABEL_FILE_PARSE = """
SELECT 'flagl' AS list_name, 'x;y' AS code, 'A;''B' AS label FROM lineitem
UNION ALL
SELECT 'flagl' AS list_name, CAST(l_linenumber AS VARCHAR) AS code, l_returnflag || '''s ' || l_linestatus AS label
FROM lineitem
UNION ALL
SELECT 'shipl', 'Q' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), strftime(l_shipdate, '%Y-%m-%d') || ', ' || l_returnflag
FROM lineitem
"""


# --------------------------------------------------------------------------- V6 F12
def q_duplicate_keys(spark, sf):
    return duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


SQL_DUPLICATE_KEYS = """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
"""


# --------------------------------------------------------------------------- V7 A8
REQUIRED_NATIONS = (1, 7, 13, 24, 99)


def q_required_keys(spark, sf):
    c = _t(spark, sf, "customer")
    return check_table(c, "customer", Expectation(min_rows=1000, required_values={"c_nationkey": REQUIRED_NATIONS}))


SQL_REQUIRED_KEYS = """
SELECT 'customer' AS table_name, 'row_count' AS check_name, count(*) AS observed, CAST(1000 AS BIGINT) AS threshold,
       count(*) >= 1000 AS passed FROM customer
UNION ALL
SELECT 'customer', 'required_c_nationkey',
       count(DISTINCT CASE WHEN c_nationkey IN (1, 7, 13, 24, 99) THEN c_nationkey END), CAST(5 AS BIGINT),
       count(DISTINCT CASE WHEN c_nationkey IN (1, 7, 13, 24, 99) THEN c_nationkey END) >= 5 FROM customer
"""


# --------------------------------------------------------------------------- V2 V9 V10
def q_fact_quality(spark, sf):
    # Unique by the four source keys that the id is made of: a narrow shuffle instead of one of every id.
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    fact = build_fact(spark, sf, keep=keys)
    exp = Expectation(min_rows=1000, not_null=["date_id", "country_id", "airport_id"],
                      min_rows_where=[("rows_S1", F.col("airport_id") == "S1", 100)])
    # The join's tasks are as large as adaptive execution merges them; the keys are counted in smaller ones.
    return check_table(fact, "fact_build", exp, key=keys, key_partitions=key_parts(spark))


SQL_FACT_QUALITY = f"""
WITH {SQL_FACT_CTE},
a AS (SELECT count(*) AS rows_total,
             count(*) FILTER (WHERE date_id IS NULL) AS nd, count(*) FILTER (WHERE country_id IS NULL) AS nc,
             count(*) FILTER (WHERE airport_id IS NULL) AS na, count(*) FILTER (WHERE airport_id = 'S1') AS s1
      FROM f),
d AS (SELECT count(*) AS dups FROM (SELECT ingress_id FROM f GROUP BY 1 HAVING count(*) > 1))
SELECT 'fact_build' AS table_name, 'row_count' AS check_name, rows_total AS observed, CAST(1000 AS BIGINT) AS threshold,
       rows_total >= 1000 AS passed FROM a
UNION ALL SELECT 'fact_build', 'null_date_id', nd, 0, nd = 0 FROM a
UNION ALL SELECT 'fact_build', 'null_country_id', nc, 0, nc = 0 FROM a
UNION ALL SELECT 'fact_build', 'null_airport_id', na, 0, na = 0 FROM a
UNION ALL SELECT 'fact_build', 'rows_S1', s1, 100, s1 >= 100 FROM a
UNION ALL SELECT 'fact_build', 'duplicate_keys', dups, 0, dups = 0 FROM d
"""


# --------------------------------------------------------------------------- V9
def q_orphan_keys(spark, sf):
    o, c = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    li, p, s = _t(spark, sf, "lineitem"), _t(spark, sf, "part"), _t(spark, sf, "supplier")

    def orphans(df, table, references):
        found = check_table(df, table, Expectation(), references=references).where(F.col("check_name").startswith("orphan_"))
        return found.select(F.replace("check_name", F.lit("orphan_"), F.lit(f"{table}.")).alias("check_name"), "observed")

    # One pass over each fact, whatever the number of its foreign keys.
    return union_all([orphans(o, "orders", {"o_custkey": (c, "c_custkey")}),
                      orphans(li, "lineitem", {"l_orderkey": (o, "o_orderkey"), "l_partkey": (p, "p_partkey"),
                                               "l_suppkey": (s, "s_suppkey")})])


SQL_ORPHAN_KEYS = """
SELECT 'orders.o_custkey' AS check_name, count(*) AS observed FROM orders
  WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'lineitem.l_orderkey', count(*) FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'lineitem.l_partkey', count(*) FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
UNION ALL SELECT 'lineitem.l_suppkey', count(*) FROM lineitem
  WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)
"""


# --------------------------------------------------------------------------- V12
def q_profile_table(spark, sf):
    return profile(_t(spark, sf, "customer"))


def _sql_profile() -> str:
    cols = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
            ("c_mktsegment", "string")]
    parts = []
    for name, typ in cols:
        nans = f"count(*) FILTER (WHERE isnan({name}))" if typ == "double" else "CAST(0 AS BIGINT)"
        blanks = f"count(*) FILTER (WHERE trim({name}) = '')" if typ == "string" else "CAST(0 AS BIGINT)"
        parts.append(f"SELECT '{name}' AS column_name, '{typ}' AS data_type, count(*) AS rows, "
                     f"count(*) FILTER (WHERE {name} IS NULL) AS nulls, count(DISTINCT {name}) AS distinct, "
                     f"{nans} AS nans, {blanks} AS blanks FROM customer")
    return "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- K4-K7 Q8
def _load_customer(spark, sf, mode: str, passes: int, partition: bool) -> DataFrame:
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    table, location = _table(spark, f"load_{mode}")
    warehouse.create_table_for(spark, table, c, location, ["c_mktsegment"] if partition else ())
    for _ in range(passes):
        warehouse.insert(spark, c, table, mode)
    counts = spark.table(table).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return _taken(spark, counts, {table: location})


def q_post_load_checks(spark, sf):
    """Customers and nations loaded into catalog tables and checked there, in one pass per table."""
    c, n = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    dim, dim_at = _table(spark, "nations")
    fact, fact_at = _table(spark, "customers")
    warehouse.create_table_for(spark, dim, n, dim_at)
    warehouse.create_table_for(spark, fact, c, fact_at)
    warehouse.insert(spark, n, dim, "overwrite")
    warehouse.insert(spark, c, fact, "overwrite")
    nations = spark.table(dim)
    checks = union_all([
        check_table(nations, "nation", Expectation(min_rows=25, not_null=["n_name"], max_length={"n_name": 8},
                                                   required_values={"n_nationkey": [0, 24, 99]}), key="n_nationkey"),
        check_table(spark.table(fact), "customer", Expectation(
            min_rows=100, not_null=["c_nationkey"], non_negative=["c_acctbal"], max_length={"c_name": 12},
            domain={"c_mktsegment": ["BUILDING", "MACHINERY"]}), references={"c_nationkey": (nations, "n_nationkey")})])
    return _taken(spark, checks, {dim: dim_at, fact: fact_at})


def _sql_post_load_checks() -> str:
    checks = [("nation", "row_count", "count(*)", 25, ">="), ("nation", "null_n_name", "count(*) FILTER (n_name IS NULL)", 0, "="),
              ("nation", "length_n_name", "count(*) FILTER (length(n_name) > 8)", 0, "="),
              ("nation", "required_n_nationkey", "count(DISTINCT n_nationkey) FILTER (n_nationkey IN (0, 24, 99))", 3, ">="),
              ("nation", "duplicate_keys", "count(*) - count(DISTINCT n_nationkey)", 0, "="),
              ("customer", "row_count", "count(*)", 100, ">="),
              ("customer", "null_c_nationkey", "count(*) FILTER (c_nationkey IS NULL)", 0, "="),
              ("customer", "invalid_c_acctbal", "count(*) FILTER (c_acctbal IS NULL OR c_acctbal < 0 OR isnan(c_acctbal))", 0, "="),
              ("customer", "length_c_name", "count(*) FILTER (length(c_name) > 12)", 0, "="),
              ("customer", "domain_c_mktsegment", "count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY'))", 0, "="),
              ("customer", "orphan_c_nationkey", "count(*) FILTER (c_nationkey IS NULL OR c_nationkey NOT IN (SELECT n_nationkey FROM nation))", 0, "=")]
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{name}' AS check_name, CAST({sql} AS BIGINT) AS observed, CAST({limit} AS BIGINT) AS threshold, "
        f"{sql} {op} {limit} AS passed FROM {t}" for t, name, sql, limit, op in checks)


def q_domain_checks(spark, sf):
    """V8 and column constraints: lengths, domains, null rules and non-negative measures of orders, in one pass."""
    o = _t(spark, sf, "orders")
    return check_table(o, "orders", Expectation(
        min_rows=1, not_null=["o_orderstatus"], non_negative=["o_totalprice"], max_length={"o_orderpriority": 6, "o_orderstatus": 1},
        domain={"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"]}))


SQL_DOMAIN_CHECKS = """
WITH a AS (SELECT count(*) AS n, count(*) FILTER (o_orderstatus IS NULL) AS n1,
                  count(*) FILTER (o_totalprice IS NULL OR o_totalprice < 0 OR isnan(o_totalprice)) AS n2,
                  count(*) FILTER (length(o_orderpriority) > 6) AS n3, count(*) FILTER (length(o_orderstatus) > 1) AS n4,
                  count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS n5,
                  count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) AS n6 FROM orders)
SELECT 'orders' AS table_name, 'row_count' AS check_name, n AS observed, CAST(1 AS BIGINT) AS threshold, n >= 1 AS passed FROM a
UNION ALL SELECT 'orders', 'null_o_orderstatus', n1, 0, n1 = 0 FROM a
UNION ALL SELECT 'orders', 'invalid_o_totalprice', n2, 0, n2 = 0 FROM a
UNION ALL SELECT 'orders', 'length_o_orderpriority', n3, 0, n3 = 0 FROM a
UNION ALL SELECT 'orders', 'length_o_orderstatus', n4, 0, n4 = 0 FROM a
UNION ALL SELECT 'orders', 'domain_o_orderstatus', n5, 0, n5 = 0 FROM a
UNION ALL SELECT 'orders', 'domain_o_orderpriority', n6, 0, n6 = 0 FROM a
"""


def q_full_refresh_load(spark, sf):
    return _load_customer(spark, sf, "overwrite", 2, partition=False)


def q_append_load(spark, sf):
    return _load_customer(spark, sf, "append", 2, partition=False)


def q_partition_overwrite_load(spark, sf):
    return _load_customer(spark, sf, "partition_overwrite", 2, partition=True)


SQL_FULL_REFRESH_LOAD = "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1"
SQL_APPEND_LOAD = "SELECT c_mktsegment, 2 * count(*) AS n FROM customer GROUP BY 1"


# --------------------------------------------------------------------------- X20 D10
def q_uuid_ids(spark, sf):
    """Random ids of all orders, by what holds for any: how many, how many distinct, how many well formed (version 4)."""
    ids = _t(spark, sf, "orders").select(random_id().alias("i"))
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return ids.agg(F.count("i").alias("n"), F.count_distinct("i").alias("n_distinct"),
                   F.count_if(F.length("i") == 36).alias("n_length"), F.count_if(F.col("i").rlike(form)).alias("n_form"))


SQL_UUID_IDS = "SELECT count(*) AS n, count(*) AS n_distinct, count(*) AS n_length, count(*) AS n_form FROM orders"


# --------------------------------------------------------------------------- registry
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dim_date_spine": q_dim_date_spine,
    "day_number_decode": q_day_number_decode,
    "air_only_filter_union": q_air_only_filter_union,
    "age_bucket_counts": q_age_bucket_counts,
    "weekly_mean_bucket": q_weekly_mean_bucket,
    "trailing_years_mean": q_trailing_years_mean,
    "first_per_group": q_first_per_group,
    "explode_lookup_collect": q_explode_lookup_collect,
    "lookup_list": q_lookup_list,
    "dim_country_build": q_dim_country_build,
    "left_join_default": q_left_join_default,
    "composite_key_join": q_composite_key_join,
    "week_enrichment_left": q_week_enrichment_left,
    "cross_type_key_join": q_cross_type_key_join,
    "label_chain_join": q_label_chain_join,
    "fact_build": q_fact_build,
    "fact_ingress_build": q_fact_ingress_build,
    "star_query": q_star_query,
    "star_query_stored": q_star_query_stored,
    "top_k_counts": q_top_k_counts,
    "conditional_counts": q_conditional_counts,
    "distinct_values": q_distinct_values,
    "date_range_count": q_date_range_count,
    "not_in_filter": q_not_in_filter,
    "clean_number": q_clean_number,
    "location_split": q_location_split,
    "prefix_strip": q_prefix_strip,
    "html_pairs": q_html_pairs,
    "label_text_parse": q_label_text_parse,
    "label_file_parse": q_label_file_parse,
    "duplicate_keys": q_duplicate_keys,
    "required_keys": q_required_keys,
    "fact_quality": q_fact_quality,
    "orphan_keys": q_orphan_keys,
    "profile_table": q_profile_table,
    "full_refresh_load": q_full_refresh_load,
    "append_load": q_append_load,
    "partition_overwrite_load": q_partition_overwrite_load,
    "uuid_ids": q_uuid_ids,
    "star_sorted_preview": q_star_sorted_preview,
    "html_table_pairs": q_html_table_pairs,
    "preamble_csv": q_preamble_csv,
    "csv_stage_airports": q_csv_stage_airports,
    "csv_stage_temperatures": q_csv_stage_temperatures,
    "post_load_checks": q_post_load_checks,
    "domain_checks": q_domain_checks,
} | load_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return {
        "dim_date_spine": SQL_DIM_DATE_SPINE,
        "day_number_decode": SQL_DAY_NUMBER_DECODE,
        "air_only_filter_union": SQL_AIR_ONLY_FILTER_UNION,
        "age_bucket_counts": SQL_AGE_BUCKET_COUNTS,
        "weekly_mean_bucket": SQL_WEEKLY_MEAN_BUCKET,
        "trailing_years_mean": SQL_TRAILING_YEARS_MEAN,
        "first_per_group": SQL_FIRST_PER_GROUP,
        "explode_lookup_collect": SQL_EXPLODE_LOOKUP_COLLECT,
        "lookup_list": SQL_EXPLODE_LOOKUP_COLLECT,
        "dim_country_build": SQL_DIM_COUNTRY_BUILD,
        "left_join_default": SQL_LEFT_JOIN_DEFAULT,
        "composite_key_join": SQL_COMPOSITE_KEY_JOIN,
        "week_enrichment_left": SQL_WEEK_ENRICHMENT_LEFT,
        "cross_type_key_join": SQL_CROSS_TYPE_KEY_JOIN,
        "label_chain_join": SQL_LABEL_CHAIN_JOIN,
        "fact_build": SQL_FACT_BUILD,
        "fact_ingress_build": SQL_FACT_INGRESS_BUILD,
        "star_query": SQL_STAR_QUERY,
        "star_query_stored": SQL_STAR_QUERY,
        "top_k_counts": SQL_TOP_K_COUNTS,
        "conditional_counts": SQL_CONDITIONAL_COUNTS,
        "distinct_values": SQL_DISTINCT_VALUES,
        "date_range_count": SQL_DATE_RANGE_COUNT,
        "not_in_filter": SQL_NOT_IN_FILTER,
        "clean_number": SQL_CLEAN_NUMBER,
        "location_split": SQL_LOCATION_SPLIT,
        "prefix_strip": SQL_PREFIX_STRIP,
        "html_pairs": _sql_html_pairs(),
        "label_text_parse": SQL_LABEL_TEXT_PARSE,
        "label_file_parse": SQL_LABEL_FILE_PARSE,
        "duplicate_keys": SQL_DUPLICATE_KEYS,
        "required_keys": SQL_REQUIRED_KEYS,
        "fact_quality": SQL_FACT_QUALITY,
        "orphan_keys": SQL_ORPHAN_KEYS,
        "profile_table": _sql_profile(),
        "full_refresh_load": SQL_FULL_REFRESH_LOAD,
        "append_load": SQL_APPEND_LOAD,
        "partition_overwrite_load": SQL_FULL_REFRESH_LOAD,
        "uuid_ids": SQL_UUID_IDS,
        "star_sorted_preview": SQL_STAR_SORTED_PREVIEW,
        "html_table_pairs": SQL_HTML_TABLE_PAIRS,
        "preamble_csv": SQL_PREAMBLE_CSV,
        "csv_stage_airports": SQL_CSV_STAGE_AIRPORTS,
        "csv_stage_temperatures": SQL_CSV_STAGE_TEMPERATURES,
        "post_load_checks": _sql_post_load_checks(),
        "domain_checks": SQL_DOMAIN_CHECKS,
    } | load_queries.ORACLE_SQL
