"""Aggregating operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_week
from ..functions.text import join_or_unknown
from .joins import small_side


def trailing_years(df: DataFrame, date_col: str, years: int) -> DataFrame:
    """Keep rows in the last ``years`` calendar years of the data.

    The latest date is a scalar subquery (``DataFrame.scalar()``), evaluated
    once by Spark: no driver ``collect()`` and no join against the aggregate.
    The rows are kept by a range on the column itself, so the range reaches
    the Parquet scan when ``date_col`` is a stored column.
    """
    kind = df.schema[date_col].dataType
    first = F.make_date(F.year(F.max(date_col)) - F.lit(years - 1), F.lit(1), F.lit(1)).cast(kind)
    return df.where(F.col(date_col) >= df.select(first).scalar())


def weekly_mean(df: DataFrame, keys: Sequence[str | Column], date_col: str, value_col: str,
                out: str = "mean_value") -> DataFrame:
    """A4: mean of a value per key x ISO week (partial aggregation map-side)."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    return df.groupBy(*keys, iso_week(date_col).alias("week_of_year")).agg(F.avg(value_col).alias(out))


def explode_lookup_collect(df: DataFrame, key_cols: Sequence[str], list_col: str, lookup_df: DataFrame,
                           lookup_key: str, lookup_value: str, out_col: str, carry: Sequence[str] = (),
                           sep: str = ",", default: str = "Unknown",
                           small: bool = False) -> DataFrame:
    """Explode a code list, look each code up, fold back into one string per key.

    * ``posexplode_outer`` keeps keys whose list is null or empty (they come
      out as ``default``) and remembers each code's position, so the result
      keeps the list order instead of the arbitrary order of ``collect_list``.
    * Unmatched codes are dropped from the list (left join, nulls skipped).
    * ``carry`` columns are functionally dependent on the key; ``min`` picks
      one deterministically when a key repeats.
    * The regroup is by the row key: with a unique key (one country per
      alpha-3 code) a group holds one row's list, bounded by the list and
      not by the table, and the partial aggregate folds a row's exploded
      codes back together before the shuffle. A key repeated across many
      rows would gather all their lists in one group, so pass a row key.
    * ``small`` follows ``small_side``.
    """
    codes = df.select(*key_cols, *carry, F.posexplode_outer(F.col(list_col)).alias("_pos", "_code"))
    right = lookup_df.select(F.col(lookup_key).cast("string").alias("_code"), F.col(lookup_value).alias("_val"))
    right = small_side(right, small)
    joined = codes.join(right, on="_code", how="left")
    item = F.when(F.col("_val").isNotNull(), F.struct(F.col("_pos"), F.col("_val")))
    agg = joined.groupBy(*key_cols).agg(
        *[F.min(c).alias(c) for c in carry],
        F.array_sort(F.collect_list(item)).alias("_items"),
    )
    return agg.select(*key_cols, *carry, join_or_unknown(F.col("_items._val"), sep, default).alias(out_col))


def lookup_list(df: DataFrame, list_col: str, lookup_df: DataFrame, lookup_key: str, lookup_value: str, out_col: str,
                sep: str = ",", default: str = "Unknown") -> DataFrame:
    """J1/A5/X18/X19 for a lookup that is a code list: each code of a list replaced in place, the names joined by ``sep``.

    The lookup is one map value, from a scalar subquery that Spark evaluates once; rows stay rows, so nothing of
    ``df`` is exploded or shuffled. A code is found by going through the map, and the map goes to every task, so
    this is for lists of some hundreds of codes; ``explode_lookup_collect`` joins larger ones. Codes that are not
    in the map (or have no value) are left out, a list without any becomes ``default``, repeated and null codes of
    the lookup give their least value and nothing. Rows are not merged by key, as ``explode_lookup_collect`` does.
    """
    pairs = lookup_df.select(F.col(lookup_key).cast("string").alias("k"), F.col(lookup_value).cast("string").alias("v")) \
        .where("k IS NOT NULL AND v IS NOT NULL").groupBy("k").agg(F.min("v").alias("v"))
    names = pairs.agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("m")).scalar()
    found = F.filter(F.transform(F.col(list_col), lambda c: F.try_element_at(F.col("_names"), c.cast("string"))), lambda v: v.isNotNull())
    # The subquery is a column first, as lambda functions may not hold one.
    return df.withColumn("_names", names).withColumn(out_col, join_or_unknown(found, sep, default)).drop("_names")
