"""Set, group-first, top-k operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_all(frames: Iterable[DataFrame], by_name: bool = True, allow_missing: bool = False) -> DataFrame:
    """UNION ALL of a list of frames (no dedup, no shuffle).

    By name by default, so extracts whose column order differs still line up.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    if by_name:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
    return reduce(DataFrame.union, frames)


def first_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column],
                    descending: bool = False, method: str = "aggregate") -> DataFrame:
    """The first row of each group by ``order_by``.

    ``aggregate`` (default): ``min(struct(order_by..., rest...))`` (``max``
    when ``descending``); ties are broken by the remaining columns, so the
    result is deterministic. A struct with strings cannot be a hash buffer, so
    Spark sorts each partition by key and aggregates the sorted runs, before
    and after the shuffle: a group holding a third of the table collapses to
    one row per task before the shuffle, and no task gathers a whole group.

    ``window``: ``row_number()`` over the group ordered by ``order_by`` (which
    may mix directions, e.g. ``F.col("a").desc()``), keeping ``rn = 1``;
    Catalyst plans a window group limit that also pre-filters map-side.
    """
    keys = list(keys)
    if method == "window":
        order = [F.col(c) if isinstance(c, str) else c for c in order_by]
        if descending:
            order = [c.desc() if isinstance(o, str) else c for o, c in zip(order_by, order)]
        rn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return df.withColumn("_rn", rn).where(F.col("_rn") == 1).drop("_rn")
    if method != "aggregate":
        raise ValueError("method must be 'aggregate' or 'window'")
    order_by = [c for c in order_by]
    if not all(isinstance(c, str) for c in order_by):
        raise ValueError("the aggregate method takes column names; use method='window' for expressions")
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    pick = (F.max if descending else F.min)(packed).alias("_first")
    return df.groupBy(*keys).agg(pick).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order_by + rest]) \
        .select(*df.columns)


def top_k_counts(df: DataFrame, key: str | Sequence[str], k: int, count_col: str = "count") -> DataFrame:
    """The k most frequent keys, ties broken by key (planned as TakeOrderedAndProject)."""
    keys = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.col(count_col).desc(), *[F.col(c).asc_nulls_last() for c in keys]).limit(k)


def distinct_values(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Distinct values (aggregate with map-side partial dedup)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.select(*cols).distinct()
