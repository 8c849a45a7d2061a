"""Data-quality checks and profiling.

Checks are data, not control flow: ``check_table`` evaluates every
expectation of one table in a *single* aggregate pass and returns a small
result frame ``(table_name, check_name, observed, threshold, passed)``; ``enforce``
turns failures into a ``ValueError`` (the reference's halt-the-run rule).
Duplicate and orphan checks need their own shuffle and are separate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = "table_name string, check_name string, observed bigint, threshold bigint, passed boolean"


@dataclass(frozen=True)
class Expectation:
    """Expectations for one table.

    min_rows         V2/V3/V4/V5: at least this many rows
    not_null         V9: these columns have no nulls
    non_negative     V8: these measures are neither null nor negative
    required_values  V7: column -> values that must all be present
    min_rows_where   V10: (name, predicate, minimum) row counts under a predicate
    max_length       column -> most characters its values may have
    domain           column -> the only values it may have (nulls are left to not_null)
    """

    min_rows: int = 0
    not_null: Sequence[str] = ()
    non_negative: Sequence[str] = ()
    required_values: dict[str, Sequence[object]] = field(default_factory=dict)
    min_rows_where: Sequence[tuple[str, Column, int]] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    domain: dict[str, Sequence[object]] = field(default_factory=dict)


@dataclass(frozen=True)
class CheckResult:
    table_name: str
    check_name: str
    observed: int
    threshold: int
    passed: bool


def schema_problems(df: DataFrame, expected: T.StructType | Sequence[str]) -> list[str]:
    """V1: missing columns, and (for a StructType) columns of the wrong type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    if isinstance(expected, T.StructType):
        for f in expected.fields:
            if f.name not in have:
                problems.append(f"missing column {f.name}")
            elif have[f.name].simpleString() != f.dataType.simpleString():  # types, not nullability
                problems.append(f"column {f.name} is {have[f.name].simpleString()}, "
                                f"expected {f.dataType.simpleString()}")
    else:
        problems += [f"missing column {c}" for c in expected if c not in have]
    return problems


def key_parts(spark: SparkSession) -> int:
    """Parts for ``check_table`` of a large table with a key of its own per row: several a core, the session's at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)


def check_table(df: DataFrame, table: str, exp: Expectation, key: str | Sequence[str] | None = None,
                references: dict[str, tuple[DataFrame, str]] | None = None, key_partitions: int | None = None) -> DataFrame:
    """Evaluate all expectations of one table in one aggregate pass.

    With ``key``, the key-uniqueness check (V6) joins the same pass: rows are
    first counted per key (partial aggregation map-side, so a hot key costs
    one row per task), then one final aggregate sums the per-key counts and
    counts keys seen more than once. ``required_values`` must then be on key
    columns. Where nearly every row has a key of its own, counting before the
    shuffle only fills memory: ``key_partitions`` then deals narrow rows (key
    and predicates) into this many parts first, which adaptive execution does
    not merge, and a task counts the keys of one part (a hot key's rows all
    meet in its part).

    ``references`` maps a foreign-key column to ``(dimension, key column)``;
    each gets an ``orphan_<fk>`` check (null keys count as orphans) in the
    same pass: the distinct dimension keys are left-joined, and Spark
    broadcasts those of a dimension by its measured size.
    """
    refs = references or {}
    for i, (fk, (dim, pk)) in enumerate(refs.items()):
        keys_df = dim.select(F.col(pk).alias(f"_ref{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        df = df.join(keys_df, F.col(fk) == F.col(f"_ref{i}"), "left")
    # (name, per-row predicate or None, final aggregate builder, threshold, op)
    row_preds: list[tuple[str, Column, int, str]] = []
    for c in exp.not_null:
        row_preds.append((f"null_{c}", F.col(c).isNull(), 0, "=="))
    for c in exp.non_negative:
        row_preds.append((f"invalid_{c}", F.col(c).isNull() | (F.col(c) < 0) | F.isnan(F.col(c)), 0, "=="))
    for c, most in exp.max_length.items():
        row_preds.append((f"length_{c}", F.coalesce(F.length(F.col(c)) > most, F.lit(False)), 0, "=="))
    for c, allowed in exp.domain.items():
        row_preds.append((f"domain_{c}", F.coalesce(~F.col(c).isin(list(allowed)), F.lit(False)), 0, "=="))
    for name, pred, minimum in exp.min_rows_where:
        row_preds.append((name, pred, minimum, ">="))
    for i, fk in enumerate(refs):
        row_preds.append((f"orphan_{fk}", F.col(f"_hit{i}").isNull(), 0, "=="))

    checks: list[tuple[str, Column, int, str]] = []
    if key is None:
        checks.append(("row_count", F.count(F.lit(1)), exp.min_rows, ">="))
        checks += [(n, F.count_if(p), t, op) for n, p, t, op in row_preds]
        for c, values in exp.required_values.items():
            present = F.count_distinct(F.when(F.col(c).isin(list(values)), F.col(c)))
            checks.append((f"required_{c}", present, len(set(values)), ">="))
        row = df.agg(*[a.cast("long").alias(f"_c{i}") for i, (_, a, _, _) in enumerate(checks)])
    else:
        keys = [key] if isinstance(key, str) else list(key)
        bad = [c for c in exp.required_values if c not in keys]
        if bad:
            raise ValueError(f"required_values on non-key columns {bad} cannot share the keyed pass")
        facts = df.select(*keys, *[p.alias(f"_p{i}") for i, (_, p, _, _) in enumerate(row_preds)])
        if key_partitions:
            facts = facts.repartition(key_partitions, *keys)
        per_key = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                           *[F.count_if(f"_p{i}").alias(f"_p{i}") for i in range(len(row_preds))])
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        checks.append(("row_count", total("_n"), exp.min_rows, ">="))
        checks += [(n, total(f"_p{i}"), t, op) for i, (n, _, t, op) in enumerate(row_preds)]
        for c, values in exp.required_values.items():
            checks.append((f"required_{c}", F.count_if(F.col(c).isin(list(values))), len(set(values)), ">="))
        checks.append(("duplicate_keys", F.count_if(F.col("_n") > 1), 0, "=="))
        row = per_key.agg(*[a.cast("long").alias(f"_c{i}") for i, (_, a, _, _) in enumerate(checks)])
    # Unpivot the one-row result into (check, observed) rows without another pass.
    stacked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"_c{i}").alias("observed"),
                 F.lit(threshold).cast("long").alias("threshold"), F.lit(op).alias("op"))
        for i, (name, _, threshold, op) in enumerate(checks)
    ])).alias("r")
    out = row.select(stacked).select("r.*")
    passed = F.when(F.col("op") == ">=", F.col("observed") >= F.col("threshold")) \
        .otherwise(F.col("observed") == F.col("threshold"))
    return out.select(F.lit(table).alias("table_name"), "check_name", "observed", "threshold", passed.alias("passed"))


def duplicate_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their counts (partial aggregation map-side)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """V9: fact rows whose foreign key has no dimension row (left anti join; null keys count as orphans)."""
    d = dim.select(F.col(dim_key).alias("_dk")).distinct()
    return fact.join(d, fact[fact_key] == d["_dk"], "left_anti")


def enforce(results: DataFrame | Sequence[CheckResult]) -> list[CheckResult]:
    """Raise ``ValueError`` listing every failed check; returns all results otherwise.

    The result frame has one row per check (a handful), so collecting it is bounded.
    """
    if isinstance(results, DataFrame):
        rows = [CheckResult(**r.asDict()) for r in results.collect()]
    else:
        rows = list(results)
    failed = [r for r in rows if not r.passed]
    if failed:
        lines = ", ".join(f"{r.table_name}.{r.check_name}: observed {r.observed}, threshold {r.threshold}" for r in failed)
        raise ValueError(f"data quality checks failed: {lines}")
    return rows


def _value_facts(f: T.StructField, number: int, approx: bool) -> Column:
    """What the profile counts of one value: its column's number, two hashes, and whether it is null, NaN or blank."""
    c = F.col(f"`{f.name}`")
    nan = F.isnan(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.lit(False)
    blank = F.trim(c) == "" if isinstance(f.dataType, T.StringType) else F.lit(False)
    hashes = [F.xxhash64(c).alias("h1"), (F.lit(0) if approx else F.xxhash64(F.lit(number), c)).cast("long").alias("h2")]
    return F.struct(F.lit(number).alias("column"), *hashes, c.isNull().alias("is_null"),
                    F.coalesce(nan, F.lit(False)).alias("is_nan"), F.coalesce(blank, F.lit(False)).alias("is_blank"))


def profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Per-column null / distinct / NaN / blank counts, one row per column in schema order.

    Every row is unpivoted once to (column, hash, hash) and counted per value before the shuffle, so rows stay
    narrow however many columns there are, all aggregates are hash aggregates on fixed-width keys, and the table is
    read once. Two 64-bit hashes with different seeds stand for a value: exact for numbers, dates and timestamps
    (a hash of eight bytes is one-to-one), and for texts but for a chance below 1e-14 at 10^12 distinct values.
    ``approx=True`` sketches the first hash instead (~1% error) and shuffles a few rows per column and task.
    Type-aware: NaN is only tested on floating columns and blanks only on strings. An empty table gives zeros.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    facts = F.array(*[_value_facts(f, i, approx) for i, f in enumerate(fields)])
    values = df.select(F.explode(facts).alias("v")).select("v.*")
    ones = {"n": F.count(F.lit(1)), "nans": F.count_if("is_nan"), "blanks": F.count_if("is_blank"),
            "nulls": F.count_if("is_null")}
    if approx:
        distinct = F.approx_count_distinct(F.when(~F.col("is_null"), F.col("h1")), 0.01)
        found = values.groupBy("column").agg(*[c.alias(k) for k, c in ones.items()], distinct.alias("distinct"))
    else:
        each = values.groupBy("column", "h1", "h2", "is_null").agg(
            *[c.alias(k) for k, c in ones.items() if k != "nulls"])
        found = each.groupBy("column").agg(
            *[F.sum(k).alias(k) for k in ("n", "nans", "blanks")],
            F.sum(F.when(F.col("is_null"), F.col("n")).otherwise(0)).alias("nulls"),
            F.count_if(~F.col("is_null")).alias("distinct"))
    named = df.sparkSession.range(1).select(F.posexplode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
        for f in fields])).alias("column", "f"))
    # One row per column on both sides.
    joined = named.join(F.broadcast(found), "column", "left").coalesce(1).sortWithinPartitions("column")
    return joined.select("f.column_name", "f.data_type", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(a) for c, a in (
        ("n", "rows"), ("nulls", "nulls"), ("distinct", "distinct"), ("nans", "nans"), ("blanks", "blanks"))])
