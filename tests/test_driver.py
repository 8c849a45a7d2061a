"""The driver contract: entry() smoke, every query runs on sf0.001 and matches its DuckDB twin."""

import hashlib
import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import DataFrameReader

from conftest import SF001
from __spark_entry__ import entry, oracle_sql as all_oracle_sql, queries as all_queries
from starflow.plans.driver_queries import QUERIES, oracle_sql

pytestmark = pytest.mark.skipif(not os.path.isdir(SF001), reason="driver test data not present")

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["country_name", "age_bucket", "temperature_bucket", "n"]
    assert df.count() > 0


def test_every_query_has_a_twin_and_is_registered():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(all_queries()) and set(oracle_sql()) <= set(all_oracle_sql()) <= set(all_queries())


def test_registry_without_the_llm_subpackage(tmp_path):
    """The entry file and its queries work from a copy without the subpackage and the pipeline."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "starflow", tmp_path / "starflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(QUERIES))] * 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_round_robin_and_no_python(spark, name):
    plan = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for node in ("RoundRobin", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert node not in plan


def test_building_a_plan_starts_no_job_but_schema_reads(spark):
    """Each read of a table looks at one file's schema; queries that write tables or files of their own aside."""
    tracker = spark.sparkContext.statusTracker()
    writes = {"full_refresh_load", "append_load", "partition_overwrite_load", "fact_incremental_load", "post_load_checks",
              "label_file_parse", "preamble_csv", "csv_stage_airports", "csv_stage_temperatures", "csv_stage_gdp", "csv_stage_countries",
              "whole_run", "failed_load_kept", "star_query_stored"}

    def jobs(group, build):
        spark.sparkContext.setJobGroup(group, group)
        build()
        found = len(tracker.getJobIdsForGroup(group))
        spark.sparkContext.setJobGroup("tests", "tests")
        return found

    per_read = jobs("one-read", lambda: spark.read.parquet(f"{SF001}/orders.parquet"))
    reads, original = [], DataFrameReader.parquet
    DataFrameReader.parquet = lambda self, *a, **k: reads.append(1) or original(self, *a, **k)
    DataFrameReader.load, load = (lambda self, *a, **k: reads.append(1) or load(self, *a, **k)), DataFrameReader.load
    try:
        for name in sorted(set(QUERIES) - writes):
            reads.clear()
            assert jobs(f"build-{name}", lambda: QUERIES[name](spark, SF001)) <= per_read * len(reads), name
    finally:
        DataFrameReader.parquet, DataFrameReader.load = original, load


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)


def test_star_query_reads_one_month_of_lineitem(spark):
    plan = QUERIES["star_query"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1997-04-01" in plan.replace("EqualTo", "Equal") \
        or "GreaterThanOrEqual(l_shipdate,1997-04-01" in plan


