"""Date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_spine_between(bounds: DataFrame, start: Column | str, end: Column | str, name: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, bounds read from a one-row frame.

    Date arithmetic (``interval 1 day``), not 86,400-second steps, so DST
    changes neither repeat nor skip a day. A decade is ~3,700 rows.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return bounds.select(F.explode(F.sequence(s.cast("date"), e.cast("date"), F.expr("interval 1 day"))).alias(name))


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str, name: str = "date") -> DataFrame:
    """S8 with literal bounds (the dimension window)."""
    one = spark.range(1).select(F.lit(str(start)).cast("date").alias("s"), F.lit(str(end)).cast("date").alias("e"))
    return date_spine_between(one, "s", "e", name)
