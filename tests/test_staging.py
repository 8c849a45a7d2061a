import datetime as dt

from pyspark.sql import functions as F

from starflow.operators import profile, union_all
from starflow.plans import dims, staging
from starflow.sources import read_csv


def test_stage_arrivals(spark, fixtures_dir):
    df = staging.stage_arrivals(spark, [f"{fixtures_dir}/arrivals_a.parquet", f"{fixtures_dir}/arrivals_b.parquet"])
    assert [f.name for f in df.schema.fields] == ["i94port", "i94cit", "arrdate", "gender", "year", "age_bucket",
                                                   "date_id"]
    rows = df.collect()
    assert len(rows) == 15                                       # modes 2, 3, 9 and null dropped
    by_age = sorted(r.age_bucket for r in rows)
    assert by_age.count("UN") == 3                               # null and NaN birth years, and the null date
    assert {r.gender for r in rows} == {"M", "F", "U", "X"}
    jan = [r for r in rows if r.arrdate == dt.date(2016, 1, 1)][0]
    assert jan.date_id == 20160101 and jan.year == 2016
    assert [r.date_id for r in rows if r.arrdate is None] == [None]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(i94mode,1.0)" in plan and "PythonUDF" not in plan
    assert "Exchange" not in staging.stage_arrivals(spark, f"{fixtures_dir}/arrivals_a.parquet") \
        ._jdf.queryExecution().executedPlan().toString()


def test_stage_temperatures(spark, fixtures_dir):
    t = {(r.city, r.week_of_year): r.temperature_bucket
         for r in staging.stage_temperatures(spark, f"{fixtures_dir}/temperatures.csv").collect()}
    assert t[("new york", 13)] == "VC"           # mean -1 over two years
    assert t[("new york", 1)] == "CO"            # exactly 5
    assert t[("miami", 13)] == "HO"              # 25 and 27; the 2006 value is outside the last 5 years
    assert t[("boston", 13)] == "MI"             # exactly 15
    assert t[("anchorage", 13)] == "UN"          # blank temperature
    assert t[("portland", 18)] == "HO"           # two same-named cities merge: mean of 35 and 15 is 25
    assert "paris" not in {c for c, _ in t}


def test_stage_airports_and_countries(spark, fixtures_dir):
    a = {r.airport_id: (r.municipality, r.state) for r in staging.stage_airports(spark, f"{fixtures_dir}/airports.csv")
         .collect()}
    assert a == {"KJFK": ("New York", "NY"), "KMIA": ("Miami", "FL"), "PANC": ("Anchorage", "AK")}
    c = {r.alpha3: r.languages for r in staging.stage_countries(spark, f"{fixtures_dir}/countries.csv").collect()}
    assert c == {"MEX": ["spa"], "FRA": ["fra", "eng"], "ESP": ["spa", "xxx"], "NLX": None}
    langs = staging.stage_languages(spark, f"{fixtures_dir}/languages.csv")
    d = {r.country_id: r.languages for r in dims.dim_country(
        staging.stage_countries(spark, f"{fixtures_dir}/countries.csv"), langs,
        staging.stage_gdp(spark, f"{fixtures_dir}/gdp.csv")).collect()}
    assert d == {"MEX": "Spanish", "FRA": "French,English", "ESP": "Spanish", "NLX": "Unknown"}


def test_read_csv_is_typed_and_permissive(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("a,b\n1,x\nbad,y\n3\n")
    df = read_csv(spark, str(p), schema="a int, b string")
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (None, "y"), (3, None)]
    strings = read_csv(spark, str(p))
    assert dict(strings.dtypes) == {"a": "string", "b": "string"}


def test_union_allow_missing(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([(2, "y")], "k int, v string")
    out = union_all([a, b], allow_missing=True)
    assert sorted(tuple(r) for r in out.collect()) == [(1, None), (2, "y")]


def test_profile_approx(spark):
    df = spark.range(0, 5000).select((F.col("id") % 1000).alias("k"), F.lit("x").alias("s"))
    got = {r.column_name: r.distinct for r in profile(df, approx=True).collect()}
    assert abs(got["k"] - 1000) <= 50 and got["s"] == 1
    assert "Expand" not in profile(df, approx=True)._jdf.queryExecution().executedPlan().toString()
