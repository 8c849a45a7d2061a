"""Site-relative line deduplication, in DataFrame expressions only.

Within a host, a line is boilerplate if more than a given share of the host's
pages hold it: the ratio decides, on hosts of every size. Two pages say nothing
yet, and copies of one page say nothing of the site, so three pages must hold the
line, and two different texts. Lines are compared without white space around them, by a 64-bit
hash; blank lines are never dropped. A page counts once for each line, however
often it holds it.

A host's boilerplate lines are few whatever its size: their shares add up to at
most the mean number of lines on a page, so there are at most that mean over the
ratio. They can therefore be joined to the pages as one array per host, and
texts are filtered where they are.

Defined results. A null text stays null and counts as a page. A page without a
host is on no site and stays as it is. Repeated rows are pages of their own. An
empty table gives an empty result. Very long texts are taken whole. Other columns go through unchanged, whatever
their names; the operator's own are in one struct (``RESULT``), which replaces a column of that very name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm.common import SPACES, Scratch, fresh, table

#: A line in more than this share of a host's pages is boilerplate, if so many pages hold it and not all are copies of one text.
MAX_RATIO = 0.05
MIN_PAGES = 3
RESULT = "_line_dedup"


def host_of(url: Column) -> Column:
    """The host of a url, in lower case and without ``www.``; null where there is none."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), "^www[.]", "")


def _key(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def boilerplate(docs: DataFrame, host: Column, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """Per host with boilerplate: ``b_host`` and ``b_lines``, the hashes of its lines above the ratio."""
    pages = docs.select(host.cast("string").alias("b_host"), F.col(text).alias("text")).filter("b_host IS NOT NULL")
    totals = pages.groupBy("b_host").agg(F.count("*").alias("pages"))
    own = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: _key(x) != ""),
                                       lambda x: F.xxhash64(_key(x))))
    held = pages.select("b_host", F.xxhash64("text").alias("page"), F.explode(own).alias("line"))
    counts = held.groupBy("b_host", "line").agg(F.count("*").alias("n"), F.min("page").alias("a"), F.max("page").alias("b"))
    return (counts.filter((F.col("n") >= min_pages) & (F.col("a") < F.col("b")))
            .join(totals, "b_host").filter(F.col("n") > F.col("pages") * max_ratio)
            .groupBy("b_host").agg(F.collect_list("line").alias("b_lines")))


def drop_boilerplate(docs: DataFrame, scratch: Scratch, host: Column, text: str = "text",
                     max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``docs`` without boilerplate lines in ``text``; the struct column ``RESULT`` has n_lines and n_dropped."""
    docs = docs.drop(RESULT)
    found = scratch.store(boilerplate(docs, host, text, max_ratio, min_pages), "boilerplate")
    at, held = fresh(docs, "b_host"), fresh(docs, "b_lines")
    found = found.withColumnsRenamed({"b_host": at, "b_lines": held})
    lines = F.split(F.col(text), "\n")
    kept = F.when(F.col(held).isNull(), lines).otherwise(F.filter(
        lines, lambda x: (_key(x) == "") | ~F.array_contains(F.col(held), F.xxhash64(_key(x)))))
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")  # noqa: E731  size of null is null
    return (docs.join(found, host.cast("string") == found[at], "left")
            .withColumn(RESULT, F.struct(F.when(F.col(text).isNotNull(), n(lines)).otherwise(0).alias("n_lines"),
                                         F.when(F.col(text).isNotNull(), n(lines) - n(kept)).otherwise(0).alias("n_dropped")))
            .withColumn(text, F.array_join(kept, "\n")).drop(at, held))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, lines dropped as boilerplate of its source, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = drop_boilerplate(docs, Scratch(spark, "lines"), F.col("source"))
    return out.select("doc_id", F.col(f"{RESULT}.n_lines").alias("n_lines"), F.col(f"{RESULT}.n_dropped").alias("n_dropped"),
                      F.octet_length("text").cast("long").alias("kept_bytes"), F.md5("text").alias("kept_md5"))


def _blank(line: str) -> str:
    spaces = " || ".join(f"chr({ord(c)})" for c in SPACES)
    return f"trim({line}, {spaces})"


#: Common table expressions over any relation ``src`` with doc_id, source and text.
STEPS_SQL = f"""
  pages AS (SELECT row_number() OVER () AS page, * FROM {{src}}),
  totals AS (SELECT source, count(*) AS pages FROM pages WHERE source IS NOT NULL GROUP BY source),
  found AS (SELECT DISTINCT page, source, text, {_blank("line")} AS line
            FROM (SELECT page, source, text, unnest(string_split(text, chr(10))) AS line FROM pages)),
  boiler AS (SELECT source, line FROM found JOIN totals USING (source) WHERE line <> ''
             GROUP BY source, line, pages HAVING count(*) >= {MIN_PAGES} AND min(text) < max(text)
             AND count(*) > pages * {MAX_RATIO}),
  held AS (SELECT source, list(line) AS lines FROM boiler GROUP BY source),
  cut AS (SELECT p.* EXCLUDE (text), p.text AS old_text,
                 array_to_string(list_filter(string_split(p.text, chr(10)),
                   lambda x: h.lines IS NULL OR NOT list_contains(h.lines, {_blank("x")})), chr(10)) AS text
          FROM pages p LEFT JOIN held h ON p.source = h.source)
"""

OP4_SQL = f"""
WITH {STEPS_SQL.format(src="documents")}
SELECT doc_id, CAST(coalesce(len(string_split(old_text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(old_text, chr(10))), 0) - coalesce(len(list_filter(string_split(old_text, chr(10)),
         lambda x: h.lines IS NULL OR NOT list_contains(h.lines, {_blank("x")}))), 0) AS BIGINT) AS n_dropped,
       CAST(strlen(text) AS BIGINT) AS kept_bytes, md5(text) AS kept_md5
FROM cut LEFT JOIN held h ON cut.source = h.source
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without their source's boilerplate lines; n_chars, where there is one, follows the text."""
    out = drop_boilerplate(docs, Scratch(spark, "lines-stage"), F.col("source")).select(*docs.columns)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))
    return out
