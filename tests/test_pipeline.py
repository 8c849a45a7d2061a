from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starflow.plans import facts, pipeline, staging, warehouse
from starflow.plans.pipeline import Inputs, Thresholds
from starflow.session import scratch_path

TH = Thresholds(staging={k: 1 for k in ("arrivals", "temperatures", "gdp", "country_labels", "ports", "airports",
                                         "countries", "languages")},
                tables={"dim_country": 1, "dim_airport": 1, "dim_date": 1, "fact_ingress": 1},
                major_airports=("KJFK", "KMIA"), busiest_airport="KJFK", busiest_airport_min_rows=1)


def make_inputs(d, arrivals=("arrivals_a",), labels="country_labels.csv"):
    return Inputs(arrivals=[f"{d}/{a}.parquet" for a in arrivals], country_labels=f"{d}/{labels}",
                  ports_pages=f"{d}/ports_pages.parquet", temperatures=f"{d}/temperatures.csv", gdp=f"{d}/gdp.csv",
                  airports=f"{d}/airports.csv", countries=f"{d}/countries.csv", languages=f"{d}/languages.csv")


EXPECTED_FACT = sorted([
    (20160401, "MEX", "KJFK", "M", "AD", "VC"),
    (20160401, "MEX", "KJFK", "F", "CH", "VC"),
    (20160401, "FRA", "KJFK", "U", "TE", "VC"),
    (20160401, "FRA", "KJFK", "U", "TE", "VC"),
    (20160401, "MEX", "KMIA", "X", "AD", "HO"),
    (20160401, "ESP", "KMIA", "F", "AD", "HO"),
    (20160401, "ESP", "KMIA", "M", "AD", "HO"),
    (20160401, "MEX", "KMIA", "M", "OA", "HO"),
])


def fact_rows(df):
    return sorted((r.date_id, r.country_id, r.airport_id, r.gender, r.age_bucket, r.temperature_bucket)
                  for r in df.collect())


@pytest.mark.parametrize("labels", ["country_labels.csv", "labels.sas"])
def test_full_run_on_fixtures(spark, fixtures_dir, labels):
    out = scratch_path(spark, "run")
    results = pipeline.run(spark, make_inputs(fixtures_dir, labels=labels), out, TH)
    assert all(r.passed for r in results)
    assert {r.table_name for r in results} >= {"arrivals", "ports", "dim_date", "fact_ingress"}
    fact = pipeline.read_output(spark, out)["fact_ingress"]
    assert fact_rows(fact) == EXPECTED_FACT
    assert {r.month_id for r in fact.select("month_id").distinct().collect()} == {201604}
    ids = [r.ingress_id for r in fact.collect()]
    assert len(set(ids)) == 8 and all(len(i) == 36 for i in ids)
    country = {r.country_id: (r.name, r.languages, r.gdp_per_capita)
               for r in pipeline.read_output(spark, out)["dim_country"].collect()}
    assert country == {"MEX": ("Mexico", "Spanish", 8910.0), "FRA": ("France", "French,English", 38000.0),
                       "ESP": ("Spain", "Spanish", 0.0), "NLX": ("Nolang", "Unknown", 0.0)}
    airport = {r.airport_id: (r.name, r.municipality, r.state)
               for r in pipeline.read_output(spark, out)["dim_airport"].collect()}
    assert airport == {"KJFK": ("John F Kennedy Intl", "New York", "NY"), "KMIA": ("Miami Intl", "Miami", "FL"),
                       "PANC": ("Anchorage Intl", "Anchorage", "AK")}
    dd = pipeline.read_output(spark, out)["dim_date"]
    assert dd.where("date_id = 20160401").collect()[0].asDict() == {
        "date_id": 20160401, "year": 2016, "month": 4, "day": 1, "day_of_week": 5, "week_of_year": 13}
    assert dd.count() >= 3661


def test_failed_checks_halt_the_run(spark, fixtures_dir):
    # arrivals_b carries an arrival with no date: its fact row has a null date_id, which the checks reject.
    with pytest.raises(ValueError, match="null_date_id"):
        pipeline.run(spark, make_inputs(fixtures_dir, ("arrivals_a", "arrivals_b")), scratch_path(spark, "bad"), TH)


def test_staging_minimum_rows_enforced(spark, fixtures_dir):
    th = Thresholds(staging={"arrivals": 1_000_000})
    with pytest.raises(ValueError, match="arrivals.min_rows"):
        pipeline.run(spark, make_inputs(fixtures_dir), scratch_path(spark, "small"), th)


def test_unknown_origin_kept_as_member(spark, fixtures_dir):
    frames = pipeline.stage_all(spark, make_inputs(fixtures_dir, ("arrivals_a", "arrivals_b")))
    built = pipeline.build(frames, spark, unmatched="unknown")
    fact = built["fact_ingress"]
    assert fact.where("country_id = 'UNK'").count() == 1
    assert built["dim_country"].where("country_id = 'UNK'").count() == 1


def test_fact_plan_is_broadcast_only_and_udf_free(spark, fixtures_dir):
    frames = pipeline.stage_all(spark, make_inputs(fixtures_dir))
    fact = pipeline.build(frames, spark)["fact_ingress"]
    assert len(fact.collect()) == 8  # adaptive execution settles the joins as it runs
    plan = fact._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "SortMergeJoin", "ShuffledHashJoin"):
        assert node not in plan
    assert plan.count("BroadcastHashJoin") >= 3


def test_catalog_load_rerun_safe(spark, fixtures_dir):
    out = scratch_path(spark, "load")
    db = "starflow_load_test"
    pipeline.run(spark, make_inputs(fixtures_dir), out, TH, load_catalog=True, database=db)
    pipeline.run(spark, make_inputs(fixtures_dir), out + "_2", TH, load_catalog=False)
    fact = pipeline.read_output(spark, out)["fact_ingress"].drop("month_id")
    # rerun of the same load: dims refreshed, fact partitions replaced, not duplicated
    warehouse.truncate_dimensions(spark, db)
    warehouse.load_dimensions(spark, {n: pipeline.read_output(spark, out)[n] for n in warehouse.DIMENSIONS}, db)
    warehouse.load_fact(spark, fact, database=db)
    assert spark.table(f"{db}.fact_ingress").count() == 8
    assert spark.table(f"{db}.dim_airport").count() == 3
    warehouse.load_fact(spark, fact, mode="append", database=db)
    assert spark.table(f"{db}.fact_ingress").count() == 16
    star = warehouse.star_query(spark.table(f"{db}.fact_ingress"), spark.table(f"{db}.dim_date"),
                                spark.table(f"{db}.dim_country"), spark.table(f"{db}.dim_airport"),
                                **warehouse.month_at_airport(2016, 4, "KJFK"))
    assert star.count() == 8
    assert len(star.columns) == len(set(star.columns))
    plan = star._jdf.queryExecution().executedPlan().toString().lower()
    assert "dynamicpruning" in plan or "partitionfilters: [isnotnull(month_id" in plan
    warehouse.drop_tables(spark, db)
    assert not [t for t in spark.catalog.listTables(db)]


def test_write_csv_and_views(spark, fixtures_dir):
    frames = pipeline.stage_all(spark, make_inputs(fixtures_dir))
    path = scratch_path(spark, "csv")
    warehouse.write_csv(frames["languages"], path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 4 and back.columns == ["name", "alpha2", "alpha3"]
    warehouse.register_views(spark, {"stg_ports": frames["ports"]})
    assert spark.sql("SELECT count(*) AS n FROM stg_ports WHERE state IS NOT NULL").collect()[0].n == 5


def _fact(spark, dates):
    rows = [(f"id{i}-{d}", d, "MEX", "KJFK", "M", "AD", "VC") for i, d in enumerate(dates)]
    return spark.createDataFrame(rows, "ingress_id string, date_id int, country_id string, airport_id string, gender string, "
                                       "age_bucket string, temperature_bucket string")


def _per_month(df):
    return {r.month_id: r.n for r in df.groupBy("month_id").agg(F.count("*").alias("n")).collect()}


def test_april_may_and_april_again_by_path_and_by_table(spark):
    path = scratch_path(spark, "fact")
    april, may = _fact(spark, [20160401, 20160402]), _fact(spark, [20160501, 20160502, 20160503])
    for part in (april, may, april):
        warehouse.write_fact(part, path)
    assert _per_month(spark.read.parquet(path)) == {201604: 2, 201605: 3}
    warehouse.write_fact(may, path, cluster=True, partitions=2)
    assert _per_month(spark.read.parquet(path)) == {201604: 2, 201605: 3}
    plan = spark.read.parquet(path).where("month_id = 201604")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_id" in plan
    db = "starflow_months"
    warehouse.create_tables(spark, scratch_path(spark, "months"), db)
    for part in (april, may, april):
        warehouse.load_fact(spark, part, database=db)
    assert _per_month(spark.table(f"{db}.fact_ingress")) == {201604: 2, 201605: 3}
    warehouse.drop_tables(spark, db)


def _files(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(Path(root).rglob("*")) if p.is_file()}


def test_failed_run_leaves_the_published_output(spark, fixtures_dir):
    out = scratch_path(spark, "kept")
    pipeline.run(spark, make_inputs(fixtures_dir), out, TH)
    before = _files(out)
    with pytest.raises(ValueError, match="null_date_id"):
        pipeline.run(spark, make_inputs(fixtures_dir, ("arrivals_a", "arrivals_b")), out, TH)
    assert before and _files(out) == before


def test_runs_of_other_years_into_one_root_and_one_catalog(spark, fixtures_dir, tmp_path):
    """A run's files are that run; the catalog holds every month loaded, and its calendar covers them all."""
    out, db = scratch_path(spark, "years"), "starflow_years"
    old = spark.read.parquet(f"{fixtures_dir}/arrivals_a.parquet").withColumn("arrdate", F.col("arrdate") - 2922)  # 2008
    old.write.parquet(str(tmp_path / "old.parquet"))
    first = make_inputs(fixtures_dir)
    first.arrivals = [str(tmp_path / "old.parquet")]
    pipeline.run(spark, first, out, TH, load_catalog=True, database=db)
    results = pipeline.run(spark, make_inputs(fixtures_dir), out, TH, load_catalog=True, database=db)
    assert _per_month(pipeline.read_output(spark, out)["fact_ingress"]) == {201604: 8}
    assert _per_month(spark.table(f"{db}.fact_ingress")) == {200803: 8, 201604: 8} or \
        _per_month(spark.table(f"{db}.fact_ingress")) == {200804: 8, 201604: 8}
    loaded = [r for r in results if r.table_name.startswith("loaded.")]
    assert {r.check_name for r in loaded} >= {"orphan_date_id", "orphan_country_id", "row_count"} and all(r.passed for r in loaded)
    warehouse.drop_tables(spark, db)


def test_ports_listed_twice_do_not_double_arrivals(spark):
    ports = spark.createDataFrame([("NYC", "New York", "NY")] * 2, "code string, municipality string, state string")
    airports = spark.createDataFrame([("KJFK", "JFK", "New York", "NY")], "airport_id string, name string, municipality string, state string")
    assert facts.port_airport_map(ports, airports).count() == 1


def test_catalog_partition_overwrite_leaves_session_alone(spark):
    location = scratch_path(spark, "po")
    table = f"po_{location.rsplit('-', 1)[-1]}"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    warehouse.create_table_for(spark, table, first, location, ["p"])
    warehouse.insert(spark, first, table, "overwrite")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    again = spark.createDataFrame([(3, "a"), (4, "c")], "k int, p string")
    for _ in range(2):                                    # rerun-safe: the second load changes nothing
        warehouse.insert(spark, again, table, "partition_overwrite")
        assert sorted(tuple(r) for r in spark.table(table).collect()) == [(2, "b"), (3, "a"), (4, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()} == {"p=a", "p=b", "p=c"}
