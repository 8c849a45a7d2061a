"""Append newly landed arrival extracts to the fact table (the daily run)."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans import facts, staging, warehouse
from ..session import shared_dir


def ingest_arrivals(spark: SparkSession, source_dir: str, output: str, lookups: dict[str, DataFrame],
                    checkpoint: str | None = None, fmt: str = "parquet", available_now: bool = True,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start a stream that turns every new extract under ``source_dir`` into fact rows under ``output``.

    ``lookups`` holds the staged ``ports``, ``airports``, ``temperatures``,
    ``country_labels`` and the built ``dim_country`` (static frames; they are
    joined to every micro-batch). Output is Parquet
    partitioned by load unit, the same layout ``warehouse.write_fact`` produces.
    ``available_now`` processes what has landed and stops (a scheduled daily
    run); otherwise the query keeps running. The checkpoint defaults to
    a folder of this source and output under ``spark.checkpoint.dir``. Nothing else may write to ``output``.
    """
    reader = spark.readStream.format(fmt).schema(schemas.ARRIVALS_RAW)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(source_dir)
    fact = facts.fact_ingress(staging.clean_arrivals(raw), lookups["ports"], lookups["airports"],
                              lookups["temperatures"], lookups["country_labels"], lookups["dim_country"])
    pair = hashlib.sha256(f"{source_dir}\n{output}".encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{shared_dir(spark)}/starflow/streams/fact_ingress-{pair}"
    writer = (warehouse.with_load_unit(fact).writeStream.format("parquet")
              .option("checkpointLocation", ckpt).partitionBy(schemas.FACT_PARTITION).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(output)
