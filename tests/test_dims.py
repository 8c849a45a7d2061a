import datetime as dt

from starflow.plans import dims


def test_default_window_is_3661_days(spark):
    d = dims.dim_date(spark)
    assert d.count() == 3661
    assert d.select("date_id").distinct().count() == 3661
    end = dt.date.today() + dt.timedelta(days=30)
    assert d.agg({"date_id": "max"}).collect()[0][0] == int(end.strftime("%Y%m%d"))


def test_window_widened_to_fact_dates(spark):
    d = dims.dim_date_for_keys(spark, 20160101, 20160403)
    keys = {r.date_id for r in d.select("date_id").collect()}
    assert 20160101 in keys and 20160403 in keys and 20151231 not in keys
    assert dims.dim_date_for_keys(spark, None, None).count() == 3661


def test_dim_date_covering_lazy_bounds(spark):
    facts = spark.createDataFrame([(dt.date(2001, 5, 6),), (None,)], "d date")
    d = dims.dim_date_covering(facts, "d")
    row = d.where("date_id = 20010506").collect()[0]
    assert (row.year, row.month, row.day, row.day_of_week, row.week_of_year) == (2001, 5, 6, 0, 18)
