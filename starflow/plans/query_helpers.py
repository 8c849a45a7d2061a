"""What the driver queries share: table scans, derived columns and their SQL, written inputs, passing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import warehouse


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A fresh scan of one driver table."""
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _birth_year(custkey: str = "c_custkey"):
    """Synthetic birth year (double, some null) derived from the customer key: ages span -14..81."""
    k = F.col(custkey)
    return F.when(k % 23 == 0, F.lit(None)).otherwise(F.lit(1920) + k % 90).cast("double")


_BIRTH_SQL = "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(1920 + c_custkey % 90 AS DOUBLE) END"


def _age_case(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'UN' WHEN {x} < 12 THEN 'CH' WHEN {x} < 18 THEN 'TE' "
            f"WHEN {x} <= 65 THEN 'AD' ELSE 'OA' END")


def _temp_case(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'UN' WHEN {x} < 5 THEN 'VC' WHEN {x} < 15 THEN 'CO' "
            f"WHEN {x} < 25 THEN 'MI' WHEN {x} < 35 THEN 'HO' ELSE 'VH' END")


def _date_key_sql(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def _port_letters(key: str):
    k = F.col(key)
    return F.concat(*(F.char((F.floor(k / step) % 26 + 65).cast("int")) for step in (676, 26, 1)))


def _written_csv(df: DataFrame, name: str, header: bool = True, encoding: str = "UTF-8") -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", header).option("encoding", encoding).csv(path)
    return path


def _table(spark, kind: str) -> tuple[str, str]:
    location = scratch_path(spark, kind)
    return f"starflow_{kind}_{location.rsplit('-', 1)[-1]}", location


def _taken(spark, df: DataFrame, tables: dict[str, str]) -> DataFrame:
    """The few rows of ``df``, read before its tables and their folders go."""
    rows, schema = df.collect(), df.schema
    for name, location in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        warehouse.remove(spark, location)
    return spark.createDataFrame(rows, schema)
