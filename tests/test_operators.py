import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from starflow.operators import (Expectation, check_table, distinct_values, duplicate_keys, enforce, small_side,
                                explode_lookup_collect, first_per_group, lookup, lookup_default, lookup_list,
                                orphan_keys, profile, schema_problems, top_k_counts, trailing_years,
                                union_all, weekly_mean)
from starflow import schemas
from starflow.plans.driver_queries import q_fact_quality


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_union_all_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "v string, k int")
    assert rows(union_all([a, b]), "k", "v") == [(1, "x"), (1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        union_all([])


def test_first_per_group_lowest_key_and_hot_group(spark):
    data = [("NY", "New York", "KLGA", "La Guardia"), ("NY", "New York", "KJFK", "JFK"),
            ("FL", "Miami", "KMIA", "Miami"), ("NY", None, "K2", "a"), ("NY", None, "K1", "b")]
    hot = [("TX", "Houston", f"K{i:05d}", "n") for i in range(3000)]
    df = spark.createDataFrame(data + hot, "state string, municipality string, ident string, name string")
    out = first_per_group(df, ["state", "municipality"], ["ident"])
    assert out.columns == df.columns
    got = {(r.state, r.municipality): (r.ident, r.name) for r in out.collect()}
    assert got[("NY", "New York")] == ("KJFK", "JFK")
    assert got[("NY", None)] == ("K1", "b")
    assert got[("TX", "Houston")] == ("K00000", "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan  # one row per task and group before the shuffle
    desc = first_per_group(df, ["state", "municipality"], ["ident"], descending=True)
    assert {(r.state, r.municipality): r.ident for r in desc.collect()}[("NY", "New York")] == "KLGA"


def test_top_k_counts_ties_by_key(spark):
    df = spark.createDataFrame([(k,) for k in ["b", "a", "c", "a", "b", "d"]], "k string")
    assert rows(top_k_counts(df, "k", 3, "n")) == [("a", 2), ("b", 2), ("c", 1)]


def test_distinct_values(spark):
    df = spark.createDataFrame([("F",), ("O",), ("F",), (None,)], "s string")
    assert sorted(rows(distinct_values(df, "s")), key=str) == sorted([("F",), ("O",), (None,)], key=str)


def test_trailing_years_scalar_subquery(spark):
    d = [(dt.date(y, 6, 1), float(y)) for y in range(2005, 2014)]
    df = spark.createDataFrame(d, "d date, v double")
    out = trailing_years(df, "d", 5)
    assert sorted(r.v for r in out.collect()) == [2009.0, 2010.0, 2011.0, 2012.0, 2013.0]
    assert "Subquery" in out._jdf.queryExecution().executedPlan().toString()


def test_weekly_mean(spark):
    d = [("a", dt.date(2016, 4, 1), 10.0), ("a", dt.date(2016, 3, 31), 20.0), ("a", dt.date(2016, 1, 1), 1.0),
         ("b", dt.date(2016, 4, 1), None)]
    out = weekly_mean(spark.createDataFrame(d, "k string, d date, v double"), ["k"], "d", "v", "m")
    assert rows(out, "k", "week_of_year") == [("a", 13, 15.0), ("a", 53, 1.0), ("b", 13, None)]


def test_explode_lookup_collect(spark):
    countries = spark.createDataFrame(
        [("FRA", "France", ["fra", "eng"]), ("ESP", "Spain", ["spa", "xxx"]), ("NLX", "Nolang", None),
         ("EMP", "Empty", []), ("ENG", "England", ["eng", "fra", "eng"])],
        "country_id string, name string, languages array<string>")
    langs = spark.createDataFrame([("French", "fra"), ("English", "eng"), ("Spanish", "spa")],
                                  "name string, alpha3 string")
    out = explode_lookup_collect(countries, ["country_id"], "languages", langs, "alpha3", "name", "languages",
                                 carry=["name"])
    got = {r.country_id: (r.name, r.languages) for r in out.collect()}
    assert got == {"FRA": ("France", "French,English"), "ESP": ("Spain", "Spanish"), "NLX": ("Nolang", "Unknown"),
                   "EMP": ("Empty", "Unknown"), "ENG": ("England", "English,French,English")}


def test_lookup_normalised_and_default(spark):
    left = spark.createDataFrame([(1, "Mexico"), (2, " FRANCE "), (3, "Atlantis")], "id int, name string")
    right = spark.createDataFrame([("mexico", 8910.0), ("France", 38000.0)], "country string, gdp double")
    out = lookup_default(left, right, ["name"], ["country"], {"gdp": 0.0}, normalize=True)
    assert rows(out.select("id", "gdp"), "id") == [(1, 8910.0), (2, 38000.0), (3, 0.0)]
    inner = lookup(left, right, ["name"], ["country"], normalize=True)
    assert inner.count() == 2 and not [c for c in inner.columns if c.startswith("_k")]


def test_small_side_hints_only_what_is_small_by_definition(spark):
    def hinted(df):
        return "broadcast" in spark.range(10).join(df, "id")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert hinted(small_side(spark.range(5000), True)) and not hinted(small_side(spark.range(3)))


def test_trailing_years_range_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(y, 1, 1), y) for y in range(2000, 2014)], "d date, y int")
    df.write.parquet(str(tmp_path / "t"))
    out = trailing_years(spark.read.parquet(str(tmp_path / "t")), "d", 5)
    assert sorted(r.y for r in out.collect()) == [2009, 2010, 2011, 2012, 2013]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters" in plan and "year(d" not in plan.split("DataFilters")[1].split("Format")[0]


def test_lengths_and_domains(spark):
    df = spark.createDataFrame([("KJFK", "M"), ("KJFKX", "Q"), (None, None)], "k string, g string")
    got = {r.check_name: r.observed for r in check_table(df, "t", Expectation(max_length={"k": 4}, domain={"g": ["M", "F"]})).collect()}
    assert got == {"row_count": 3, "length_k": 1, "domain_g": 1}


def test_check_table_single_pass_and_enforce(spark):
    df = spark.createDataFrame([("KJFK", 1.0), ("KMIA", -2.0), ("KJFK", None), (None, 3.0)], "k string, m double")
    exp = Expectation(min_rows=3, not_null=["k"], non_negative=["m"], required_values={"k": ["KJFK", "KLAX"]},
                      min_rows_where=[("rows_KJFK", F.col("k") == "KJFK", 2)])
    res = {r.check_name: (r.observed, r.threshold, r.passed) for r in check_table(df, "t", exp).collect()}
    assert res == {"row_count": (4, 3, True), "null_k": (1, 0, False), "invalid_m": (2, 0, False),
                   "required_k": (1, 2, False), "rows_KJFK": (2, 2, True)}
    keyed = {r.check_name: (r.observed, r.passed)
             for r in check_table(df, "t", Expectation(min_rows=1, not_null=["m"]), key="k").collect()}
    assert keyed == {"row_count": (4, True), "null_m": (1, False), "duplicate_keys": (1, False)}
    with pytest.raises(ValueError, match="null_k"):
        enforce(check_table(df, "t", exp))
    assert len(enforce(check_table(df, "t", Expectation(min_rows=1)))) == 1


def test_duplicate_and_orphan_keys(spark):
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "Z")], "id int, fk string")
    dim = spark.createDataFrame([("A",), ("B",), ("B",)], "pk string")
    assert rows(duplicate_keys(dim, "pk")) == [("B", 2)]
    assert sorted(r.id for r in orphan_keys(fact, dim, "fk", "pk").collect()) == [3, 4]


def test_profile_is_type_aware(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("", float("nan"), None), (None, None, 1)], "s string, d double, i int")
    got = {r.column_name: (r.data_type, r.rows, r.nulls, r.distinct, r.nans, r.blanks) for r in profile(df).collect()}
    assert got["s"] == ("string", 3, 1, 2, 0, 1)
    assert got["d"] == ("double", 3, 1, 2, 1, 0)
    assert got["i"] == ("int", 3, 1, 1, 0, 0)


def test_profile_counts_distinct_values_without_expand(spark):
    df = spark.range(0, 3000, 1, 4).select(
        (F.col("id") % 7 - 3).alias("column"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("v"),
        (F.col("id") % 3 * F.lit(-0.0)).alias("zero"), F.timestamp_seconds(F.col("id") % 11).alias("at"),
        (F.col("id") % 13).cast("decimal(30,4)").alias("h1"), F.array(F.col("id") % 2).alias("a.b"))
    out = profile(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert [r.column_name for r in out.collect()] == df.columns
    exact = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    assert {r.column_name: r.distinct for r in out.collect()} == exact.asDict()
    assert {(r.column_name, r.nulls) for r in out.collect() if r.nulls} == {("v", 600)}
    assert all(r.rows == 3000 for r in out.collect())
    none = profile(df.limit(0), columns=["v", "at"])
    assert [tuple(r)[2:] for r in none.collect()] == [(0, 0, 0, 0, 0)] * 2


def test_schema_problems(spark):
    df = spark.createDataFrame([(1, "x")], "value int, description string")
    assert schema_problems(df, schemas.COUNTRY_LABELS) == []
    bad = spark.createDataFrame([("1",)], "value string")
    probs = schema_problems(bad, schemas.COUNTRY_LABELS)
    assert "missing column description" in probs and any("value is string" in p for p in probs)
    assert schema_problems(df, ["value", "nope"]) == ["missing column nope"]


def test_check_table_references_in_same_pass(spark):
    fact = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "Z"), (5, "A")], "id int, fk string")
    dim = spark.createDataFrame([("A",), ("B",), ("B",)], "pk string")
    res = check_table(fact, "f", Expectation(min_rows=1), references={"fk": (dim, "pk")})
    got = {r.check_name: (r.observed, r.passed) for r in res.collect()}
    assert got == {"row_count": (5, True), "orphan_fk": (2, False)}
    plan = res._jdf.queryExecution().executedPlan().finalPhysicalPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    keyed = {r.check_name: r.observed
             for r in check_table(fact, "f", Expectation(), key="id", references={"fk": (dim, "pk")}).collect()}
    assert keyed == {"row_count": 5, "orphan_fk": 2, "duplicate_keys": 0}


def test_first_per_group_window_method(spark):
    data = [("NY", "KLGA", 2), ("NY", "KJFK", 1), ("FL", "KMIA", 5), ("FL", "KFLL", 5)]
    df = spark.createDataFrame(data, "state string, ident string, rank int")
    win = first_per_group(df, ["state"], [F.col("rank").desc(), F.col("ident").asc()], method="window")
    assert sorted(tuple(r) for r in win.collect()) == [("FL", "KFLL", 5), ("NY", "KLGA", 2)]
    agg = first_per_group(df, ["state"], ["ident"])
    win2 = first_per_group(df, ["state"], ["ident"], method="window")
    assert sorted(map(tuple, agg.collect())) == sorted(map(tuple, win2.collect()))
    assert "WindowGroupLimit" in win2._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        first_per_group(df, ["state"], [F.col("rank")])


def test_lookup_list_in_place(spark):
    rows = [(1, ["a", "b"]), (2, ["b", "zz", "a", "a"]), (3, None), (4, []), (5, [None, "zz"]), (1, ["c", "d"])]
    df = spark.createDataFrame(rows, "k int, codes array<string>")
    names = spark.createDataFrame([("a", "Alpha"), ("b", "Beta"), ("a", "Zeta"), ("c", None), (None, "None")], "code string, name string")
    out = lookup_list(df, "codes", names, "code", "name", "names")
    assert [r.names for r in out.collect()] == ["Alpha,Beta", "Beta,Alpha,Alpha", "Unknown", "Unknown", "Unknown", "Unknown"]
    assert out.columns == ["k", "codes", "names"]
    assert [r.codes for r in lookup_list(df, "codes", names.limit(0), "code", "name", "codes").collect()] == ["Unknown"] * 6
    main = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in main and "Generate" not in main and "Join" not in main


def test_keyed_check_dealt_by_key_before_it_counts(spark):
    """Null, repeated and hot keys come out the same; keys are counted after the deal only, in parts that stay apart."""
    rows = [(k % 40 if k % 7 else None, k % 3, float(k % 11) if k % 5 else None) for k in range(500)] + [(1, 1, 2.0)] * 200
    df = spark.createDataFrame(rows, "a int, b int, m double").repartition(6)
    exp = Expectation(min_rows=1, not_null=["a", "m"], min_rows_where=[("rows_b1", F.col("b") == 1, 5)])
    dealt = check_table(df, "t", exp, key=["a", "b"], key_partitions=13)
    assert sorted(dealt.collect()) == sorted(check_table(df, "t", exp, key=["a", "b"]).collect())
    empty = check_table(df.where("b > 9"), "t", exp, key=["a", "b"], key_partitions=13)
    assert sorted(empty.collect()) == sorted(check_table(df.where("b > 9"), "t", exp, key=["a", "b"]).collect())
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(a#\d+, b#\d+, 13\), REPARTITION_BY_NUM", plan)
    assert not re.search(r"Aggregate\(keys=\[a#", plan.split("REPARTITION_BY_NUM")[1].split("\n\n")[0])


def test_fact_quality_counts_keys_in_parts(spark, tmp_path):
    day = dt.datetime(1997, 3, 4)
    tables = {"customer": ([(1, 0)], "c_custkey long, c_nationkey int"), "nation": ([(0, "FRANCE")], "n_nationkey int, n_name string"),
              "orders": ([(k, 1, "F", day) for k in range(9)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"),
              "lineitem": ([(k % 9, 1, 1, k % 3, 5.0, day) for k in range(30)],
                           "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = q_fact_quality(spark, str(tmp_path))
    assert {r.check_name: r.observed for r in df.collect()} == {
        "row_count": 30, "null_date_id": 0, "null_country_id": 0, "null_airport_id": 0, "rows_S1": 30, "duplicate_keys": 9}
    assert re.search(r"hashpartitioning\(l_orderkey.*\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())
