"""Sinks, catalog tables, loads and the star query (K1-K9, C13, C16, C17); ``versions`` holds what loads are made of."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.joins import small_side
from .versions import EXTRACT, Draft, Store, filesystem, remove

DIMENSIONS = ("dim_airport", "dim_country", "dim_date")
FACT = "fact_ingress"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                  dynamic: bool = False) -> None:
    """K1/K2/K3: Parquet write straight to the target URI (executors write, nothing via the driver).

    ``dynamic`` overwrites only the partitions present in ``df`` (rerun-safe fact loads, Q8).
    """
    w = df.write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_dimension(df: DataFrame, path: str, key: str | None = None) -> None:
    """O1: rows ordered by key (a range sort, so no task holds the whole dimension)."""
    write_parquet(df.orderBy(key) if key else df, path)


def with_load_unit(fact: DataFrame) -> DataFrame:
    """The fact with its load unit, the month of ``date_id``."""
    return fact.withColumn(schemas.FACT_PARTITION, F.floor(F.col("date_id") / 100).cast("int"))


def write_fact(fact: DataFrame, path: str, mode: str = "overwrite", dynamic: bool = True,
               cluster: bool = False, partitions: int | None = None, max_records_per_file: int = 0) -> None:
    """K1 for the fact as plain files: partitioned by load unit, rows ordered by ``date_id`` inside each file (Q6).

    With ``dynamic`` (default) a write replaces the months it holds and leaves all others. It must hold them
    whole: into a folder that has rows already the load is written aside first, and if it has fewer rows of a
    month than are there, nothing is replaced and an error says so. Loads that share months go to a store
    (``star_store``), by extract.

    Default: no shuffle. Arrival extracts arrive date-clustered (one month per
    file), so each scan split writes about one file per month, sorted by
    ``date_id`` for min/max skipping. ``cluster=True`` range-partitions on
    (date_id, ingress_id) first, for inputs that are not date-clustered; the
    id in the range key splits a hot day across tasks. Range partitioning
    samples its input in a separate job, so the fact is computed twice then:
    use it on a written or checkpointed fact, not on the raw join.
    """
    df = with_load_unit(fact)
    spark, month = df.sparkSession, schemas.FACT_PARTITION
    if mode == "overwrite" and dynamic and _has_rows(spark, path):
        aside = f"{path.rstrip('/')}/_aside-{uuid.uuid4().hex[:12]}"   # hidden from readers by its first character
        try:
            _write_by_month(df, aside, "errorifexists", False, False, None, max_records_per_file)
            new = spark.read.schema(df.schema).parquet(aside)
            there = spark.read.parquet(path).groupBy(month).agg(F.count("*").alias("there"))
            less = new.groupBy(month).agg(F.count("*").alias("n")).join(there, month).where("n < there").collect()
            if less:
                raise ValueError(f"{path}: the load holds {less[0]['n']} rows of {less[0][month]}, {less[0]['there']} are there")
            _write_by_month(new, path, mode, True, cluster, partitions, max_records_per_file)
        finally:
            remove(spark, aside)
    else:
        _write_by_month(df, path, mode, dynamic, cluster, partitions, max_records_per_file)


def _has_rows(spark: SparkSession, path: str) -> bool:
    fs, where = filesystem(spark, path)
    return fs.exists(where) and any(s.getPath().getName().startswith(f"{schemas.FACT_PARTITION}=") for s in fs.listStatus(where))


def _write_by_month(df: DataFrame, path: str, mode: str, dynamic: bool, cluster: bool, partitions: int | None,
                    max_records_per_file: int) -> None:
    if cluster:
        n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, "date_id", "ingress_id")
    df = df.sortWithinPartitions(schemas.FACT_PARTITION, "date_id")
    w = df.write.mode(mode).partitionBy(schemas.FACT_PARTITION)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K8: CSV with header."""
    df.write.mode(mode).option("header", True).csv(path)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """K9: temp views for ad-hoc SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def _qual(name: str, database: str | None) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def star_store(spark: SparkSession, root: str, **options) -> Store:
    """The star tables under ``root``: dimensions replaced by each load, the fact loaded by extract and month."""
    return Store(spark, root, schemas.STAR_TABLES, {FACT: schemas.FACT_PARTITION},
                 {FACT: ["date_id"], **{d: [schemas.TABLE_KEYS[d]] for d in DIMENSIONS}}, **options)


def create_tables(spark: SparkSession, root: str, database: str | None = None) -> None:
    """Create the star tables if missing, as Parquet tables under ``root``.

    The DDL has their widths and null rules (``schemas.constraints``). Loads write files, not rows through the
    catalog, so the store that writes them holds the same rules (``catalog_store``).
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, schema in schemas.STAR_TABLES.items():
        cols = schemas.ddl_columns(schema, name)
        part = ""
        if name == FACT:
            cols += f", `{EXTRACT}` string, `{schemas.FACT_PARTITION}` int"
            part = f" PARTITIONED BY (`{EXTRACT}`, `{schemas.FACT_PARTITION}`)"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_qual(name, database)} ({cols}) USING parquet{part} "
                  f"LOCATION '{root}/{name}' TBLPROPERTIES ('{_ROOT}' = '{root}', '{_VERSION}' = '0')")


_ROOT, _VERSION = "starflow.root", "starflow.version"


def _property(spark: SparkSession, table: str, key: str) -> str:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}[key]


def catalog_store(spark: SparkSession, database: str | None = None) -> Store:
    """The store behind the catalog's star tables: it refuses nulls and texts that their DDL refuses."""
    return star_store(spark, _property(spark, _qual(FACT, database), _ROOT), rules=schemas.enforced)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def attach(spark: SparkSession, store: Store, database: str | None = None) -> None:
    """Point the catalog's star tables at the store's newest version; only locations change, no file does.

    The fact's partitions of unchanged extracts stay as they are; changed ones get their new folders, new
    ones are added, and gone ones are dropped last. Each table changes by itself: a reader that needs all four
    of one version takes them from ``store.read_all()``.
    """
    now, fact = store.current(), _qual(FACT, database)
    for name in DIMENSIONS:
        for part in now["tables"].get(name, []):
            spark.sql(f"ALTER TABLE {_qual(name, database)} SET LOCATION {_literal(store.folder(name, part))}")
    seen = int(_property(spark, fact, _VERSION))
    old = (store._manifest(seen) if seen in store._numbers() else None) or {"tables": {}}

    def folders(manifest: dict) -> dict[tuple[str, str], str]:
        return {(p["extract"], unit): f"{store.folder(FACT, p)}/{schemas.FACT_PARTITION}={unit}"
                for p in manifest["tables"].get(FACT, []) for unit in p["units"]}

    spec = lambda key: f"PARTITION ({EXTRACT} = {_literal(key[0])}, {schemas.FACT_PARTITION} = {int(key[1])})"
    before, after = folders(old), folders(now)
    if not old["tables"]:   # what was attached is not known any more
        for r in spark.sql(f"SHOW PARTITIONS {fact}").collect():
            extract, unit = r["partition"].rsplit("/", 1)
            unescape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
            before[unescape(extract.split("=", 1)[1]), unit.split("=")[1]] = ""
    for key, folder in after.items():
        if key not in before:
            spark.sql(f"ALTER TABLE {fact} ADD IF NOT EXISTS {spec(key)} LOCATION {_literal(folder)}")
        elif before[key] != folder:
            spark.sql(f"ALTER TABLE {fact} {spec(key)} SET LOCATION {_literal(folder)}")
    for key in before.keys() - after.keys():
        spark.sql(f"ALTER TABLE {fact} DROP IF EXISTS {spec(key)}")
    spark.sql(f"ALTER TABLE {fact} SET TBLPROPERTIES ('{_VERSION}' = '{now['version']}')")
    for name in (*DIMENSIONS, FACT):
        spark.catalog.refreshTable(_qual(name, database))


def truncate_dimensions(spark: SparkSession, database: str | None = None) -> None:
    """K5: empty the dimensions (never the fact)."""
    load_dimensions(spark, {n: spark.createDataFrame([], schemas.STAR_TABLES[n]) for n in DIMENSIONS}, database)


def drop_tables(spark: SparkSession, database: str | None = None) -> None:
    """K6: drop all four tables (each its own name)."""
    for name in (*DIMENSIONS, FACT):
        spark.sql(f"DROP TABLE IF EXISTS {_qual(name, database)}")


def create_table_for(spark: SparkSession, table: str, df: DataFrame, location: str,
                     partition_by: Sequence[str] = ()) -> None:
    """K4 for any frame: ``CREATE TABLE IF NOT EXISTS`` with the frame's schema, Parquet at ``location``."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet{part} LOCATION '{location}'")


_FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro")


def insert(spark: SparkSession, df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """K7: load a frame into a catalog table.

    ``overwrite``            full refresh (the table's files are replaced; readers should wait for it)
    ``append``               add rows (a rerun duplicates them)
    ``partition_overwrite``  replace only the partitions present in ``df`` (rerun-safe)

    ``insertInto`` is positional, so the frame is first put in table column order.
    """
    ordered = df.select(*[F.col(c) for c in spark.table(table).columns])
    if mode == "append":
        ordered.write.insertInto(table, overwrite=False)
    elif mode == "overwrite":
        ordered.write.insertInto(table, overwrite=True)
    elif mode == "partition_overwrite":
        parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
        info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        provider, location = (info.get("Provider") or "").lower(), info.get("Location")
        if parts and location and provider in _FILE_FORMATS:
            # insertInto ignores a per-write partitionOverwriteMode option, but a write to the table's
            # location honours it: only the partitions present in the frame are replaced, then the new
            # partition folders are registered in the catalog. The session's settings are left alone.
            ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy(*parts).format(provider).save(location)
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
            spark.catalog.refreshTable(table)
        else:
            raise ValueError(f"{table} is no partitioned table of files")
    else:
        raise ValueError("mode must be overwrite, append or partition_overwrite")


def load_dimensions(spark: SparkSession, dims: dict[str, DataFrame], database: str | None = None) -> None:
    """Full refresh of each dimension, all of them in one version."""
    store = catalog_store(spark, database)
    with store.begin() as draft:
        for name, df in dims.items():
            draft.replace(name, df)
    attach(spark, store, database)


def load_fact(spark: SparkSession, fact: DataFrame, mode: str = "partition_overwrite",
              database: str | None = None, extract: str | None = None) -> None:
    """K7/C13 for the fact: an extract replaces its own earlier load, and nothing else (Q8).

    The extract's id is ``extract``, or the rows carry theirs in ``extract_id``. Rows without either are taken
    as whole months, each an extract of its own; a load that would leave a month with fewer rows raises, as
    it may not hold the month whole. ``append`` adds the rows as an extract of a new id, as the original load did.
    """
    if mode not in ("append", "partition_overwrite"):
        raise ValueError("mode must be append or partition_overwrite")
    store = catalog_store(spark, database)
    with store.begin() as draft:
        add_extract(draft, fact, f"append-{uuid.uuid4().hex[:12]}" if mode == "append" else extract)
    attach(spark, store, database)


def add_extract(draft: Draft, fact: DataFrame, extract: str | None = None) -> None:
    """Put the fact rows of one extract, or of those that the rows name, into a load."""
    rows = with_load_unit(fact)
    named = extract is not None or EXTRACT in fact.columns
    if extract is not None:
        rows = rows.withColumn(EXTRACT, F.lit(extract))
    elif not named:
        rows = rows.withColumn(EXTRACT, F.concat(F.lit("month-"), F.coalesce(F.col(schemas.FACT_PARTITION).cast("string"), F.lit("none"))))
    draft.load(FACT, rows, [extract] if extract is not None else (), may_shrink=named)


def star_query(fact: DataFrame, dim_date_df: DataFrame, dim_country_df: DataFrame, dim_airport_df: DataFrame,
               date_where: Column | None = None, airport_where: Column | None = None,
               country_where: Column | None = None) -> DataFrame:
    """The fact joined to its three dimensions, each dimension filtered first.

    The date dimension (usually the most selective filter) joins first, so
    later joins see fewer rows; a calendar is small by definition and is
    hinted, the other dimensions are left to Spark's sizes. A fact stored by
    load unit also joins on it, so the date filter prunes its partitions.
    Join keys appear once (no ``SELECT *`` duplicates).
    """
    d = dim_date_df if date_where is None else dim_date_df.where(date_where)
    a = dim_airport_df if airport_where is None else dim_airport_df.where(airport_where)
    c = dim_country_df if country_where is None else dim_country_df.where(country_where)
    a = a.select("airport_id", F.col("name").alias("airport_name"), "municipality", "state")
    c = c.select("country_id", F.col("name").alias("country_name"), "languages", "gdp_per_capita")
    date_keys = ["date_id"]
    if schemas.FACT_PARTITION in fact.columns:
        d, date_keys = with_load_unit(d), ["date_id", schemas.FACT_PARTITION]
    j = fact.join(small_side(d, True), date_keys).drop(*date_keys[1:])
    return j.join(a, "airport_id").join(c, "country_id")


def month_at_airport(year: int, month: int, airport_id: str) -> dict[str, Column]:
    """The reference's star-query filter: one month at one airport."""
    return {"date_where": (F.col("year") == year) & (F.col("month") == month),
            "airport_where": F.col("airport_id") == airport_id}
