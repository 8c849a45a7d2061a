"""The whole run (C15): stage -> check -> build -> write a version -> check it -> publish -> load the same way."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import CheckResult, Expectation, check_table, enforce, key_parts, schema_problems
from ..sources import read_csv
from . import dims, facts, staging, warehouse
from .versions import EXTRACT


@dataclass
class Inputs:
    arrivals: Sequence[str]
    country_labels: str          # CSV (value, description) or a label text file (.SAS/.txt)
    ports_pages: str             # parquet/json of (url, html)
    temperatures: str
    gdp: str
    airports: str
    countries: str
    languages: str
    arrivals_format: str = "parquet"
    extracts: Sequence[str] | None = None   # ids of the arrivals' extracts, one for each path; default: the paths
    ports_pages_format: str = "parquet"


@dataclass
class Thresholds:
    staging: dict[str, int] = field(default_factory=lambda: dict(schemas.STAGING_MIN_ROWS))
    tables: dict[str, int] = field(default_factory=lambda: dict(schemas.TABLE_MIN_ROWS))
    major_airports: Sequence[str] = schemas.MAJOR_AIRPORTS
    busiest_airport: str = schemas.BUSIEST_AIRPORT
    busiest_airport_min_rows: int = schemas.BUSIEST_AIRPORT_MIN_ROWS
    # Uniqueness of generated fact ids costs a shuffle of every id; dimensions are always checked.
    check_fact_ids: bool = False


def stage_all(spark: SparkSession, inputs: Inputs) -> dict[str, DataFrame]:
    """C1-C8. The small lookup frames are persisted: each feeds a check and a join."""
    if inputs.country_labels.lower().endswith((".sas", ".txt")):
        labels = staging.stage_country_labels(staging.stage_labels(spark, inputs.country_labels))
    else:
        labels = staging.stage_country_labels(read_csv(spark, inputs.country_labels,
                                                       schema=schemas.COUNTRY_LABELS_RAW))
    pages = spark.read.format(inputs.ports_pages_format).load(inputs.ports_pages)
    frames = {
        "arrivals": staging.stage_extracts(spark, dict(zip(inputs.extracts or inputs.arrivals, inputs.arrivals, strict=True)),
                                           inputs.arrivals_format),
        "country_labels": labels,
        "ports": staging.stage_ports(pages),
        "temperatures": staging.stage_temperatures(spark, inputs.temperatures),
        "gdp": staging.stage_gdp(spark, inputs.gdp),
        "airports": staging.stage_airports(spark, inputs.airports),
        "countries": staging.stage_countries(spark, inputs.countries),
        "languages": staging.stage_languages(spark, inputs.languages),
    }
    for name, df in frames.items():
        if name != "arrivals":
            df.persist(StorageLevel.MEMORY_AND_DISK)
    return frames


def staging_schemas(frames: dict[str, DataFrame]) -> None:
    """V1: a staged frame without its columns or types raises before anything is computed."""
    expected = {"arrivals": schemas.ARRIVALS, "country_labels": schemas.COUNTRY_LABELS, "ports": schemas.PORTS,
                "temperatures": schemas.TEMPERATURES, "gdp": schemas.GDP, "airports": schemas.AIRPORTS,
                "countries": schemas.COUNTRIES, "languages": schemas.LANGUAGES}
    for name, df in frames.items():
        problems = schema_problems(df, expected[name])
        if problems:
            raise ValueError(f"invalid schema on {name}: {problems}")


def staging_checks(frames: dict[str, DataFrame], th: Thresholds, arrivals: int | None = None) -> list[CheckResult]:
    """V1-V3: schemas, then every frame's exact row count against its minimum.

    ``arrivals`` is the count that the build pass observed, so the extracts are not read for it again; the
    lookup frames are persisted and counted.
    """
    staging_schemas(frames)
    results = []
    for name, df in frames.items():
        need = th.staging.get(name, 0)
        seen = arrivals if name == "arrivals" and arrivals is not None else df.count()
        results.append(CheckResult(name, "min_rows", seen, need, seen >= need))
    return results


def build(frames: dict[str, DataFrame], spark: SparkSession, unmatched: str = "drop") -> dict[str, DataFrame]:
    """C9-C12."""
    country = dims.dim_country(frames["countries"], frames["languages"], frames["gdp"],
                               unknown_member=(unmatched == "unknown"))
    return {
        "dim_country": country,
        "dim_airport": dims.dim_airport(frames["airports"]),
        "fact_ingress": facts.fact_ingress(frames["arrivals"], frames["ports"], frames["airports"],
                                           frames["temperatures"], frames["country_labels"], country,
                                           unmatched=unmatched, keep=[c for c in (EXTRACT,) if c in frames["arrivals"].columns]),
    }


def table_checks(tables: dict[str, DataFrame], th: Thresholds) -> DataFrame:
    """V4-V10 on *written* tables: one aggregate pass per table, lengths, domains and null rules included.

    The fact pass also carries the orphan checks (left joins to the dimension keys), so the fact is read once.
    """
    fact = tables["fact_ingress"]
    k = schemas.TABLE_KEYS

    def rules(name: str, **more) -> Expectation:
        return Expectation(min_rows=th.tables.get(name, 0), not_null=schemas.NOT_NULL[name],
                           max_length=schemas.MAX_LENGTH[name], **more)

    parts = [
        check_table(tables["dim_date"], "dim_date", rules("dim_date"), key=k["dim_date"]),
        check_table(tables["dim_country"], "dim_country", rules("dim_country", non_negative=["gdp_per_capita"]),
                    key=k["dim_country"]),
        check_table(tables["dim_airport"], "dim_airport",
                    rules("dim_airport", required_values={"airport_id": list(th.major_airports)}), key=k["dim_airport"]),
        check_table(fact, "fact_ingress", rules(
            "fact_ingress", domain={"gender": schemas.GENDER_CODES, "age_bucket": schemas.AGE_CODES,
                                    "temperature_bucket": schemas.TEMPERATURE_CODES},
            min_rows_where=[(f"rows_{th.busiest_airport}", F.col("airport_id") == th.busiest_airport,
                             th.busiest_airport_min_rows)]),
            key=k["fact_ingress"] if th.check_fact_ids else None, key_partitions=key_parts(fact.sparkSession),
            references={fk: (tables[dim], k[dim]) for fk, dim in
                        (("date_id", "dim_date"), ("country_id", "dim_country"), ("airport_id", "dim_airport"))}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run(spark: SparkSession, inputs: Inputs, output_root: str, thresholds: Thresholds | None = None,
        unmatched: str = "drop", load_catalog: bool = False, database: str | None = None) -> list:
    """Stage, check, build, write a new version, check what was written, publish it, optionally load the catalog.

    The output under ``output_root`` means "this run" (``read_output`` reads it): a checked run becomes the newest
    version of all four tables at once, and a run that fails a check leaves no trace. Catalog tables mean "all
    loads so far": dimensions are refreshed, the run's extracts replace their earlier loads, and ``dim_date``
    covers every date the fact then holds; that load too is checked before it is in.
    """
    th = thresholds or Thresholds()
    frames = stage_all(spark, inputs)
    store = warehouse.star_store(spark, output_root)
    try:
        staging_schemas(frames)
        results = enforce(staging_checks({n: df for n, df in frames.items() if n != "arrivals"}, th))
        # Row count and date range are observed while the fact is written: no pass of their own.
        staged, dates = Observation("staged_arrivals"), Observation("fact_dates")
        seen_frames = frames | {"arrivals": frames["arrivals"].observe(staged, F.count(F.lit(1)).alias("n"))}
        tables = build(seen_frames, spark, unmatched)
        fact = tables["fact_ingress"].observe(dates, F.min("date_id").alias("lo"), F.max("date_id").alias("hi"))
        with store.begin() as draft:
            draft.replace("fact_ingress", warehouse.with_load_unit(fact))
            results += enforce(staging_checks({"arrivals": frames["arrivals"]}, th, staged.get["n"]))
            seen = dates.get
            tables["dim_date"] = dims.dim_date_for_keys(spark, seen.get("lo"), seen.get("hi"))
            for name in warehouse.DIMENSIONS:
                draft.replace(name, tables[name].orderBy(schemas.TABLE_KEYS[name]))
            results += enforce(table_checks(draft.read_all(), th))
        store.expire()
    finally:
        for df in frames.values():
            df.unpersist()
    if load_catalog:
        results += load(spark, store.read_all(), f"{output_root}/warehouse", th, database)
    return results


def read_output(spark: SparkSession, output_root: str) -> dict[str, DataFrame]:
    """The star tables that the last checked run left, all of one version."""
    return warehouse.star_store(spark, output_root).read_all()


def load(spark: SparkSession, written: dict[str, DataFrame], root: str, th: Thresholds,
         database: str | None = None) -> list[CheckResult]:
    """Write the load, check the tables as they will be, and only then let the catalog see them."""
    warehouse.create_tables(spark, root, database)
    store = warehouse.catalog_store(spark, database)
    after = replace(th, tables=th.tables | {"fact_ingress": min(th.tables.get("fact_ingress", 0), schemas.LOADED_FACT_MIN_ROWS)})
    with store.begin() as draft:
        warehouse.add_extract(draft, written["fact_ingress"])
        span = draft.read("fact_ingress").agg(F.min("date_id").alias("lo"), F.max("date_id").alias("hi")).first()
        calendar = dims.dim_date_for_keys(spark, span["lo"], span["hi"])
        for name in warehouse.DIMENSIONS:
            draft.replace(name, calendar if name == "dim_date" else written[name])
        results = enforce(table_checks(draft.read_all(), after))
    warehouse.attach(spark, store, database)
    store.expire()
    return [replace(r, table_name=f"loaded.{r.table_name}") for r in results]
