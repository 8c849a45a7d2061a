"""The corpus pipeline: documents through five of the subpackage's operators, stage by stage.

1. ``quality``: documents that the weakly supervised rules reject go.
2. ``lines``: boilerplate lines of a document's source go.
3. ``near_duplicates``: one document of each group of near duplicates stays.
4. ``decontaminate``: documents that overlap a benchmark item go.
5. ``pack``: what is left is packed into windows of token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``docs`` is what the stage before it
wrote. All but the last return the columns of ``documents``. Null texts go in the first stage; empty
tables pass through every stage; each operator's module says what it does with other odd input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starflow.llm import decontaminate, lines, minhash, packing, quality
from starflow.llm.common import Scratch, table

STAGES = [
    ("quality", quality.stage),
    ("lines", lines.stage),
    ("near_duplicates", minhash.stage),
    ("decontaminate", decontaminate.stage),
    ("pack", packing.stage),
]

#: Expectation-maximisation, MinHash links and token ids are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order, each written as Parquet in the shared folder and read again as the next one's input."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), f"{k}_{name}")
    return docs
