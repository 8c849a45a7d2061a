"""Loads by extract, versions of all tables at once, and loads that fail or stop."""
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.plans import driver_queries, pipeline, versions, warehouse
from starflow.session import scratch_path
from test_pipeline import TH, make_inputs

DIM = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
FACT = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.IntegerType())])


def store_at(spark, name="store"):
    return versions.Store(spark, scratch_path(spark, name), {"a": DIM, "b": DIM, "fact": FACT}, {"fact": "month_id"}, {"fact": ["day"]})


def dim(spark, tag):
    return spark.createDataFrame([(1, tag), (2, tag)], DIM)


def fact(spark, extract, days, first=0):
    rows = [(first + i, d, d // 100, extract) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, "id long, day int, month_id int, extract_id string")


def ids(df):
    return sorted((r.extract_id, r.month_id, r.day) for r in df.collect())


def test_extracts_that_share_months_halves_and_repeats(spark):
    """April with a row of 1 May, then May, then April again; then two halves of June, one of them again."""
    store = store_at(spark)
    april, may = [20160429, 20160430, 20160501], [20160501 + i for i in range(10)]
    for name, days in (("april", april), ("may", may), ("april", april)):
        with store.begin() as draft:
            draft.load("fact", fact(spark, name, days))
    assert len(ids(store.read("fact"))) == 13
    assert store.read("fact").where("month_id = 201605").count() == 11
    for name, days in (("june/1", [20160601, 20160602]), ("june/2", [20160620]), ("june/1", [20160601, 20160602, 20160603])):
        with store.begin() as draft:
            draft.load("fact", fact(spark, name, days))
    assert store.read("fact").where("month_id = 201606").count() == 4
    # An extract that comes again without its row of May loses that row and no other.
    with store.begin() as draft:
        draft.load("fact", fact(spark, "april", april[:2]))
    got = ids(store.read("fact"))
    assert len([g for g in got if g[1] == 201605]) == 10 and len([g for g in got if g[0] == "april"]) == 2
    # An extract of no rows is in the ledger, and its earlier rows are gone.
    with store.begin() as draft:
        draft.load("fact", fact(spark, "may", may).limit(0), ["may"])
    assert {g[0] for g in ids(store.read("fact"))} == {"april", "june/1", "june/2"}
    ledger = {r.extract_id: r["rows"] for r in store.ledger().where("table_name = 'fact'").collect()}
    assert ledger == {"april": 2, "may": 0, "june/1": 3, "june/2": 1}
    plan = store.read("fact").where("month_id = 201606")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_id" in plan


def test_several_extracts_in_one_load_and_odd_names(spark):
    store = store_at(spark)
    names = ["a=b/c", "100%", "it's", "x y:z", "é[1]{2}*?#"]
    with store.begin() as draft:
        draft.load("fact", fact(spark, names[0], [20160101]).unionAll(fact(spark, names[1], [20160101, 20160201])))
    for name in names:
        with store.begin() as draft:
            draft.load("fact", fact(spark, name, [20160301]))
    assert ids(store.read("fact")) == sorted((n, 201603, 20160301) for n in names)


def test_unnamed_units_may_not_shrink(spark):
    store = store_at(spark)
    with store.begin() as draft:
        draft.load("fact", fact(spark, "m", [20160501, 20160502]), may_shrink=False)
    with pytest.raises(ValueError, match="holds 1 rows of 201605, 2 are in"):
        with store.begin() as draft:
            draft.load("fact", fact(spark, "m", [20160501, 20160601]), may_shrink=False)
    with pytest.raises(ValueError, match="rows without month_id"):
        with store.begin() as draft:
            draft.load("fact", fact(spark, "n", [20160501]).withColumn("month_id", F.lit(None).cast("int")))
    with pytest.raises(ValueError, match="rows without extract_id"):
        with store.begin() as draft:
            draft.load("fact", fact(spark, None, [20160501]))
    assert store.read("fact").count() == 2


def one_version(store):
    """The tag that every table of the store has, read as a reader would: all of one manifest."""
    tables = store.read_all()
    tags = {r.v for n in ("a", "b") for r in tables[n].collect()} | {r.extract_id for r in tables["fact"].collect()}
    assert len(tags) == 1 and tables["a"].count() == tables["b"].count() == 2 and tables["fact"].count() == 3
    return tags.pop()


class Stop(Exception):
    pass


def test_a_stop_after_any_step_leaves_one_whole_version(spark, monkeypatch):
    store = store_at(spark)

    def load(tag):
        draft = store.begin()     # no context manager: a killed driver discards nothing
        for name in ("a", "b"):
            draft.replace(name, dim(spark, tag))
        draft.replace("fact", fact(spark, tag, [20160101, 20160102, 20160201]))
        draft.publish()
        store.expire(1)

    load("first")
    steps = [(versions.Draft, "_write", k) for k in (1, 2, 3)] + [(versions.Store, "_put", 1), (versions, "remove", 1), (versions, "remove", 2)]
    for k, (owner, name, nth) in enumerate(steps):
        real, calls = getattr(owner, name), [0]

        def stopping(*args, real=real, calls=calls, nth=nth):
            out = real(*args)
            calls[0] += 1
            if calls[0] == nth:
                raise Stop
            return out

        before = one_version(store)
        with monkeypatch.context() as patch, pytest.raises(Stop):
            patch.setattr(owner, name, stopping)
            load(f"try-{k}")
        assert one_version(store) == (before if name == "_write" else f"try-{k}")
        # A manifest cut off half way is no version.
        number = store._numbers()[0] + 1
        Path(f"{store.root}/_manifests/{number:09d}.json").write_text('{"version": 99, "tab')
        assert one_version(store) == (before if name == "_write" else f"try-{k}")
        load(f"after-{k}")
        assert one_version(store) == f"after-{k}"
    store.expire(1)
    left = {p.parent.name for p in Path(store.root).glob("*/load_id=*/*")} | {p.name for p in Path(store.root).glob("*/load_id=*")}
    assert len([n for n in left if n.startswith("load_id=")]) == 3 and len(store.versions()) == 1


def test_failed_checks_discard_and_old_versions_come_back(spark):
    store = store_at(spark)
    for tag in ("one", "two"):
        with store.begin() as draft:
            for name in ("a", "b"):
                draft.replace(name, dim(spark, tag))
            draft.replace("fact", fact(spark, tag, [20160101, 20160102, 20160201]))
    files = sorted(str(p) for p in Path(store.root).rglob("*") if p.is_file())
    with pytest.raises(Stop):
        with store.begin() as draft:
            draft.replace("a", dim(spark, "bad"))
            draft.load("fact", fact(spark, "bad", [20160101]))
            assert draft.read("fact").count() == 4 and {r.v for r in draft.read("a").collect()} == {"bad"}
            raise Stop
    assert files == sorted(str(p) for p in Path(store.root).rglob("*") if p.is_file()) and one_version(store) == "two"
    store.rollback(store.versions()[1])
    assert one_version(store) == "one" and len(store.versions()) == 3
    with pytest.raises(ValueError, match="is not kept"):
        store.rollback(77)


def test_two_loads_at_once_do_not_lose_one_another(spark):
    store = store_at(spark)
    slow, quick = store.begin(), store.begin()
    slow.load("fact", fact(spark, "slow", [20160101]))
    quick.load("fact", fact(spark, "quick", [20160101]))
    quick.publish()
    with pytest.raises(versions.ConcurrentLoad):
        slow.publish()
    late = store.begin()
    late.load("fact", fact(spark, "late", [20160101]))
    store._put({"version": late.manifest["version"], "tables": late.base["tables"]})   # between its look and its file
    late.base["version"] = late.manifest["version"]
    with pytest.raises(versions.ConcurrentLoad):
        late.publish()
    assert ids(store.read("fact")) == [("quick", 201601, 20160101)]


def _star_fact(spark, dates, start=0, country="MEX"):
    rows = [(f"id{start + i}", d, country, "KJFK", "M", "AD", "VC") for i, d in enumerate(dates)]
    return spark.createDataFrame(rows, "ingress_id string, date_id int, country_id string, airport_id string, gender string, "
                                       "age_bucket string, temperature_bucket string")


def _months(df):
    return {r.month_id: r.n for r in df.groupBy("month_id").agg(F.count("*").alias("n")).collect()}


def test_catalog_loads_by_extract(spark):
    db, root = "starflow_extracts", scratch_path(spark, "extracts")
    warehouse.create_tables(spark, root, db)
    table = f"{db}.fact_ingress"
    april, may = _star_fact(spark, [20160430, 20160501]), _star_fact(spark, [20160501 + i for i in range(10)], 50)
    for name, part in (("it's april", april), ("may", may), ("it's april", april)):
        warehouse.load_fact(spark, part, database=db, extract=name)
    assert _months(spark.table(table)) == {201604: 1, 201605: 11}
    for half, days in (("1", [20160601, 20160602]), ("2", [20160603, 20160604, 20160605])):
        warehouse.load_fact(spark, _star_fact(spark, days, 90), database=db, extract=f"june-{half}")
    warehouse.load_fact(spark, _star_fact(spark, [20160430]), database=db, extract="it's april")   # its row of May is withdrawn
    assert _months(spark.table(table)) == {201604: 1, 201605: 10, 201606: 5}
    assert warehouse.catalog_store(spark, db).read("fact_ingress").count() == spark.table(table).count() == 16
    # Unnamed: months are taken as whole, and one that would lose rows is refused.
    warehouse.load_fact(spark, _star_fact(spark, [20160701, 20160702]), database=db)
    with pytest.raises(ValueError, match="name its extract"):
        warehouse.load_fact(spark, _star_fact(spark, [20160703]), database=db)
    assert spark.table(table).count() == 18
    # A catalog whose last version is kept no more is pointed anew.
    store = warehouse.catalog_store(spark, db)
    with store.begin() as draft:
        draft.replace("fact_ingress", warehouse.with_load_unit(_star_fact(spark, [20160801])).withColumn("extract_id", F.lit("all")))
    store.expire(1)
    warehouse.attach(spark, store, db)
    assert _months(spark.table(table)) == {201608: 1}
    warehouse.drop_tables(spark, db)


def test_plain_files_refuse_a_load_that_would_lose_rows(spark):
    path = scratch_path(spark, "plain")
    warehouse.write_fact(_star_fact(spark, [20160501 + i for i in range(10)]), path)
    with pytest.raises(ValueError, match="holds 1 rows of 201605, 10 are there"):
        warehouse.write_fact(_star_fact(spark, [20160430, 20160501]), path)
    assert _months(spark.read.parquet(path)) == {201605: 10}


def test_a_load_that_fails_its_checks_leaves_the_catalog_as_it_was(spark, fixtures_dir):
    out, db = scratch_path(spark, "halt"), "starflow_halt"
    pipeline.run(spark, make_inputs(fixtures_dir), out, TH, load_catalog=True, database=db)
    names = ("dim_date", "dim_country", "dim_airport", "fact_ingress")
    before = {n: sorted(map(tuple, spark.table(f"{db}.{n}").collect()), key=repr) for n in names}
    bad = pipeline.read_output(spark, out)
    bad["fact_ingress"] = bad["fact_ingress"].withColumns({"country_id": F.lit("ZZZ"), "extract_id": F.lit("next")})
    with pytest.raises(ValueError, match="orphan_country_id"):
        pipeline.load(spark, bad, f"{out}/warehouse", TH, db)
    assert {n: sorted(map(tuple, spark.table(f"{db}.{n}").collect()), key=repr) for n in names} == before
    assert before["fact_ingress"] and warehouse.catalog_store(spark, db).read("fact_ingress").count() == 8
    warehouse.drop_tables(spark, db)


def test_run_names_extracts_and_reruns_replace_them(spark, fixtures_dir):
    out, db = scratch_path(spark, "named"), "starflow_named"
    inputs = make_inputs(fixtures_dir)
    inputs.extracts = ["april"]
    for _ in range(2):
        pipeline.run(spark, inputs, out, TH, load_catalog=True, database=db)
    assert spark.table(f"{db}.fact_ingress").groupBy("extract_id").count().collect()[0].asDict() == {"extract_id": "april", "count": 8}
    twice = make_inputs(fixtures_dir, ("arrivals_a", "arrivals_a"))
    twice.extracts = ["april", "again"]
    pipeline.run(spark, twice, out, TH, load_catalog=True, database=db)
    assert {r["extract_id"]: r["count"] for r in spark.table(f"{db}.fact_ingress").groupBy("extract_id").count().collect()} == {"april": 8, "again": 8}
    warehouse.drop_tables(spark, db)


def test_column_rules_in_the_ddl_and_on_write(spark):
    db = "starflow_rules"
    warehouse.create_tables(spark, scratch_path(spark, "rules"), db)
    ddl = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE {db}.dim_airport").collect()}
    assert ddl == {"airport_id": "char(4)", "name": "varchar(128)", "municipality": "varchar(64)", "state": "char(2)"}
    fact_ddl = spark.sql(f"SHOW CREATE TABLE {db}.fact_ingress").collect()[0][0]
    assert "ingress_id CHAR(36)" in fact_ddl and "gender CHAR(1)" in fact_ddl
    good = ("KJFK", "Kennedy", "New York", "NY")
    schema = "airport_id string, name string, municipality string, state string"
    warehouse.load_dimensions(spark, {"dim_airport": spark.createDataFrame([good, ("KX", None, "é" * 64, "N")], schema)}, db)
    for bad, why in ((("KJFKX", "x", "x", "NY"), "airport_id is longer than 4"), ((None, "x", "x", "NY"), "airport_id is null"),
                     (("KMIA", "x" * 129, "x", "NY"), "name is longer than 128"), (("KMIA", "x", None, "NY"), "municipality is null")):
        with pytest.raises(Exception, match=why):
            warehouse.load_dimensions(spark, {"dim_airport": spark.createDataFrame([good, bad], schema)}, db)
    assert {r.airport_id.strip() for r in spark.table(f"{db}.dim_airport").collect()} == {"KJFK", "KX"}
    with pytest.raises(Exception, match="gender is longer than 1"):
        warehouse.load_fact(spark, _star_fact(spark, [20160401]).withColumn("gender", F.lit("MM")), database=db, extract="x")
    with pytest.raises(Exception, match="ingress_id is null"):
        warehouse.load_fact(spark, _star_fact(spark, [20160401]).withColumn("ingress_id", F.lit(None).cast("string")), database=db, extract="x")
    assert spark.table(f"{db}.fact_ingress").count() == 0
    warehouse.drop_tables(spark, db)


def test_star_query_prunes_a_stored_fact(spark):
    star, store = driver_queries._stored_star(spark, "/root/testdata/sf0.001")
    rows = star.collect()
    plan = star._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "ingress_id" not in line and "date_id" in line)
    assert rows and "dynamicpruning" in scan and "month_id" in scan.split("PartitionFilters")[1]
    months = store.read("fact").select("month_id").distinct().count()
    assert months > 50 and len(store.ledger().collect()) >= 6
