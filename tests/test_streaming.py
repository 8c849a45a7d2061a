import shutil

from starflow.plans import dims, pipeline
from starflow.session import scratch_path
from starflow.streaming import ingest_arrivals
from test_pipeline import make_inputs


def test_incremental_fact_exactly_once(spark, fixtures_dir):
    frames = pipeline.stage_all(spark, make_inputs(fixtures_dir))
    country = dims.dim_country(frames["countries"], frames["languages"], frames["gdp"])
    lookups = {k: frames[k] for k in ("ports", "airports", "temperatures", "country_labels")}
    lookups["dim_country"] = country
    landing = scratch_path(spark, "landing")
    out, ckpt = scratch_path(spark, "stream_out"), scratch_path(spark, "stream_ckpt")
    shutil.copytree(f"{fixtures_dir}/arrivals_a.parquet", f"{landing}/day1")

    q = ingest_arrivals(spark, landing + "/*", out, lookups, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 8

    # a rerun with nothing new adds nothing; a new extract is appended once
    q = ingest_arrivals(spark, landing + "/*", out, lookups, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 8
    shutil.copytree(f"{fixtures_dir}/arrivals_a.parquet", f"{landing}/day2")
    q = ingest_arrivals(spark, landing + "/*", out, lookups, checkpoint=ckpt)
    q.awaitTermination(120)
    fact = spark.read.parquet(out)
    assert fact.count() == 16
    assert {r.month_id for r in fact.select("month_id").distinct().collect()} == {201604}
