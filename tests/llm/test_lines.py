from helpers import SF, collected, rows_of
from pyspark.sql import functions as F

from starflow.llm import lines
from starflow.llm.common import Scratch


def test_ratio_is_relative_to_the_host(spark):
    rows = [(i, "big", f"body {i}\n  Menu\t\n\nMenu") for i in range(30)] + [(100 + i, "big", f"other {i}") for i in range(70)]
    rows += [(200 + i, "small", f"Menu\nbody {i}") for i in range(9)]
    rows += [(300, None, "Menu"), (301, "big", None), (302, "big", ""), (303, "big", "Menu\n" * 20_000 + "end"), (0, "big", "body 0\nMenu")]
    df = spark.createDataFrame([(*r, "x", [1], "y") for r in rows], "doc_id long, source string, text string, b_host string, b_lines array<int>, _line_dedup string")
    found = lines.drop_boilerplate(df, Scratch(spark, "t"), F.col("source")).collect()
    assert len(found) == len(rows) and all(r["b_host"] == "x" and r["b_lines"] == [1] for r in found)
    out = {(r["doc_id"], r["source"]): r["text"] for r in found if r["doc_id"]}
    assert out[5, "big"] == "body 5\n" and out[150, "big"] == "other 50"
    assert out[205, "small"] == "body 5"  # the ratio decides on a host of nine pages too
    assert out[300, None] == "Menu" and out[301, "big"] is None and out[302, "big"] == "" and out[303, "big"] == "end"


def test_exactly_the_ratio_stays_and_repeated_rows_are_pages(spark):
    rows = [(1, "h", "L\nx")] * 9 + [(1, "h", "L\nx\n")] + [(2, "h", f"y{i}") for i in range(190)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = lines.drop_boilerplate(df, Scratch(spark, "t"), F.col("source")).filter("doc_id = 1").select("text").distinct().collect()
    assert sorted(r["text"] for r in kept) == ["L\nx", "L\nx\n"]  # 10 of 200 does not exceed 5 %
    more = df.unionAll(df.filter("doc_id = 1").limit(1))
    kept = lines.drop_boilerplate(more, Scratch(spark, "t"), F.col("source")).filter("doc_id = 1").select("text").distinct().collect()
    assert sorted(r["text"] for r in kept) == [""] * 2 or [r["text"] for r in kept] == [""]  # both lines are in 11 of 201


def test_stage_columns_host_and_native_plan(spark):
    df = spark.createDataFrame([(1, "a", "T", 1)], "doc_id long, source string, text string, n_chars int")
    out = lines.stage(spark, df, SF)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert lines.stage(spark, df.limit(0), SF).count() == 0
    urls = spark.createDataFrame([("https://WWW.A.org/x",), ("http://b.com:80/",), ("no url",), (None,)], "u string")
    assert [r[0] for r in urls.select(lines.host_of(F.col("u"))).collect()][:2] == ["a.org", "b.com"]


def test_query_matches_sql(spark):
    assert collected(lines.op4_lines(spark, SF)) == rows_of(lines.OP4_SQL)


def test_the_ratio_decides_on_small_hosts_in_the_pipeline(spark):
    rows = [(k, "nine", f"Footer\nbody {k}") for k in range(9)]
    rows += [(100 + k, "fifty", f"Footer\nbody {k}" if k < 9 else f"Rare\nbody {k}" if k < 11 else f"body {k}") for k in range(50)]
    rows += [(200, "copies", "Same\ntext")] * 4 + [(201, "copies", "other")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r["doc_id"]: r["text"] for r in lines.stage(spark, df, SF).collect()}
    assert out[5] == "body 5" and out[105] == "body 5" and out[140] == "body 40"
    assert out[110] == "Rare\nbody 10"  # on two pages only
    assert out[200] == "Same\ntext"  # copies of one page say nothing of the site
