"""Shared pieces: tables, scratch tables in the shared folder, running totals.

Lineage is cut by writing Parquet under the folder named by
``spark.checkpoint.dir`` and reading it back, so a lost executor costs a
re-read, never a recomputation of the whole plan or a lost result.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.session import shared_dir

#: Fixed by the data contracts: what separates words.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark send this package to the Python workers, once per application, wherever the driver found it."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        made = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(made)
        _SHIPPED.add(app)


class Scratch:
    """Written intermediate tables of one operator run, under the shared folder.

    ``drop`` removes a table as soon as a later written table replaces it;
    what a returned DataFrame still reads stays until the folder is cleared.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.base = f"{shared_dir(spark)}/starflow/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a DataFrame that reads the written rows."""
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            where = jvm.org.apache.hadoop.fs.Path(self.path(name))
            where.getFileSystem(conf).delete(where, True)


def running_totals(df: DataFrame, order: list[Column], value: str, scratch: Scratch, name: str) -> DataFrame:
    """``df`` (written first by the caller, as range partitioning reads it twice) with two more columns.

    ``rank`` is the row's place and ``before`` the sum of ``value`` over all rows ahead of it, in the
    order of ``order``, both from 0. One range shuffle; each task adds up its own sorted range, and only
    one row per task is summed over all tasks.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(c, T.LongType()) for c in ("part", "rank", "before")])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, rank, before = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            v = pc.fill_null(b.column(b.schema.get_field_index(value)).cast(pa.int64()), 0)
            total = pc.cumulative_sum(v)
            n = b.num_rows
            start = pc.add(pc.subtract(total, v), before)
            ranks = pa.array(range(rank, rank + n), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * n, pa.int64()), ranks, start],
                                             names=[*b.schema.names, "part", "rank", "before"])
            rank += n
            before += total[-1].as_py() if n else 0

    local = scratch.store(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(add_up, schema), name)
    parts = local.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.coalesce(F.col(value), F.lit(0))).alias("v"))
    # One row per partition of the table above, however large the input.
    bounds = {r["part"]: (r["n"], r["v"]) for r in parts.collect()}
    ahead, n, v = [], 0, 0
    for p in sorted(bounds):
        ahead.append((p, n, v))
        n, v = n + bounds[p][0], v + bounds[p][1]
    offsets = df.sparkSession.createDataFrame(ahead, "part long, n_ahead long, v_ahead long")
    return (local.join(F.broadcast(offsets), "part")
            .withColumns({"rank": F.col("rank") + F.col("n_ahead"), "before": F.col("before") + F.col("v_ahead")})
            .drop("part", "n_ahead", "v_ahead"))


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows, so that what a task makes of their texts stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
