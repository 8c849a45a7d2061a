"""Row identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def stable_id(*cols: Column | str) -> Column:
    """Deterministic 36-char id (md5 of the key columns in 8-4-4-4-12 form).

    Reruns of a load produce the same ids, so a partition overwrite replaces
    rows instead of duplicating them. Nulls render as empty fields.
    """
    parts = [F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols]
    # The five substrings share one md5: whole-stage codegen eliminates the common subexpression.
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def random_id() -> Column:
    """Random UUID v4 string; generated once per row on the executors."""
    return F.uuid()
