"""File scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, paths: str | Sequence[str], fmt: str = "parquet", columns: Sequence[str] | None = None,
         schema: T.StructType | str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """One scan over many files (a path list or glob), pruned to ``columns``.

    A single multi-path read gives Spark one file index to split and prune,
    instead of a union of per-file plans built on the driver.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(paths)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
             header: bool = True, mode: str = "PERMISSIVE", encoding: str | None = None,
             options: dict[str, str] | None = None) -> DataFrame:
    """Delimited files with a header and an explicit schema (no inference pass).

    Without a schema every column is read as string, as the sources deliver
    them; typing happens on purpose afterwards with ``try_cast``.
    """
    opts = {"header": str(header).lower(), "mode": mode}
    if encoding:
        opts["encoding"] = encoding
    opts.update(options or {})
    return scan(spark, paths, "csv", schema=schema, options=opts)


def read_preamble_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str,
                      numeric_key: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """CSV with a title line above the header, latin-1, a blank header name.

    Read header-less with the schema given positionally; both the preamble and
    the header line fail ``try_cast(numeric_key as int)`` and drop out. The
    file stays splittable (no driver-side line skipping).
    """
    df = read_csv(spark, paths, schema=schema, header=False, encoding=encoding)
    return df.where(F.col(numeric_key).try_cast("int").isNotNull())
