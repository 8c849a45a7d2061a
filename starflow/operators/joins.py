"""Lookup joins.

Broadcast policy: no job runs while a plan is built, and nothing is hinted by
row count. Spark's file sizes decide at planning and adaptive execution decides
from measured shuffle sizes; ``small=True`` hints a side only where its
definition bounds it (a literal code list, a calendar).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import norm_key

def small_side(df: DataFrame, small: bool = False) -> DataFrame:
    """The small side of a join: hinted when its definition bounds it, else left to Spark."""
    return F.broadcast(df) if small else df


def _key(c: str | Column, normalize: bool) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return norm_key(c) if normalize else c


def lookup(left: DataFrame, right: DataFrame, left_on: Sequence[str | Column], right_on: Sequence[str | Column],
           how: str = "inner", normalize: bool = False, small: bool = False,
           prefix: str = "_k") -> DataFrame:
    """Equi-join on (possibly derived) key expressions.

    Keys are materialised as helper columns on both sides first, so the
    join is a plain equi-join Catalyst can hash-partition or broadcast, and
    the helpers are dropped afterwards. ``normalize`` applies
    ``lower(trim())`` to both sides (case-insensitive text keys, J2/J5/J7).
    The right side is a lookup: keep it unique on its keys (a duplicated key
    repeats left rows, as any join does) and give its other columns names
    that differ from the left's. ``small`` follows ``small_side``.
    """
    if len(left_on) != len(right_on):
        raise ValueError("left_on and right_on differ in length")
    names = [f"{prefix}{i}" for i in range(len(left_on))]
    lk = left.withColumns({n: _key(c, normalize) for n, c in zip(names, left_on)})
    rk = right.withColumns({n: _key(c, normalize) for n, c in zip(names, right_on)})
    rk = small_side(rk, small)
    return lk.join(rk, on=names, how=how).drop(*names)


def lookup_default(left: DataFrame, right: DataFrame, left_on: Sequence[str | Column],
                   right_on: Sequence[str | Column], defaults: dict[str, object], normalize: bool = False,
                   small: bool = False) -> DataFrame:
    """Left lookup whose unmatched rows get a default per looked-up column."""
    joined = lookup(left, right, left_on, right_on, how="left", normalize=normalize, small=small)
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
