"""HTML extraction.

Runs inside Spark over a ``(…, html)`` frame: one row per page, so pages are parsed in parallel and nothing
passes through the driver.

Tables are read as the HTML standard has them: a cell ends at the next cell, row or table tag whether it is
closed or not, a row at the next row or table tag, cells outside of a row make one of their own. In a page
with tables inside of cells, its tag tokens are folded over a stack of open tables; such an inner table's rows
are rows of their own, and its text is also part of the cell that holds it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.text import unescape_html

COMMENT = r"(?s)<!--.*?(?:-->|\z)"
#: Tags that end a row, and a cell up to the next tag that ends it.
ROW_TAGS = r"(?i)</?(?:tr|table)(?:[\s/][^>]*)?>"
CELL = r"(?is)<td(?:[\s/][^>]*)?>(.*?)(?=</?t[dh][\s/>]|\z)"
#: A tag of a table with the text up to the next one; and a table that begins within an open cell.
TOKEN = r"(?is)</?(?:table|tr|td|th)(?:[\s/][^>]*)?>.*?(?=</?(?:table|tr|td|th)[\s/>]|\z)"
NESTED = r"(?i)<t[dh](?=[\s/>])(?:[^<]|<(?!/?(?:t[dh]|tr|table)[\s/>]))*+<table[\s/>]"


def _clean(x: Column) -> Column:
    return F.trim(unescape_html(F.when(F.contains(x, F.lit("<")), F.regexp_replace(x, r"<[^>]*>", "")).otherwise(x)))


def _plain_rows(html: Column) -> Column:
    """Rows of a page without tables inside tables: an array of inner cell texts for each."""
    return F.transform(F.split(html, ROW_TAGS), lambda row: F.regexp_extract_all(row, F.lit(CELL), 1))


def _nested_rows(html: Column) -> Column:
    """The same for any page, by a fold over its tag tokens.

    Tags are known by two letters. The state is the rows so far and one entry for each open table: the cells of its open row, and the kind
    (``d``, ``h`` or none) and the text of its open cell. Text goes to the open cells of all open tables.
    """
    entry = "array<struct<cells:array<string>,kind:string,text:string>>"
    tokens = F.transform(F.regexp_extract_all(html, F.lit(TOKEN), 0), lambda t: F.struct(
        F.lower(F.substring(F.ltrim(t, F.lit("</")), 1, 2)).alias("tag"), F.startswith(t, F.lit("</")).alias("end"),
        F.substring(t, F.instr(t, ">") + 1, F.length(t)).alias("text")))
    none = F.array().cast("array<string>")
    new = F.struct(none.alias("cells"), F.lit("").alias("kind"), F.lit("").alias("text"))

    def with_cell(top: Column) -> Column:
        return F.when(top["kind"] == "d", F.concat(top["cells"], F.array(top["text"]))).otherwise(top["cells"])

    def step(state: Column, t: Column) -> Column:
        stack, tag = state["stack"], t["tag"]
        below, top = F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))), F.element_at(stack, -1)
        inner = (tag == "ta") & ~t["end"] & (top["kind"] != "")   # a table within an open cell
        cell = tag.isin("td", "th")
        done = with_cell(top)
        opened = F.struct(done.alias("cells"), F.when(t["end"], F.lit("")).otherwise(F.substring(tag, 2, 1)).alias("kind"), F.lit("").alias("text"))
        stack2 = F.when(inner, F.concat(stack, F.array(new))) \
            .when(cell, F.concat(below, F.array(opened))) \
            .when((tag == "ta") & t["end"] & (F.size(stack) > 1), below) \
            .otherwise(F.concat(below, F.array(new)))
        rows = F.when(inner | cell | (F.size(done) == 0), state["rows"]).otherwise(F.concat(state["rows"], F.array(done)))
        told = F.transform(stack2, lambda e: F.struct(e["cells"].alias("cells"), e["kind"].alias("kind"),
                                                      F.when(e["kind"] == "", "").otherwise(F.concat(e["text"], t["text"])).alias("text")))
        return F.struct(told.cast(entry).alias("stack"), rows.alias("rows"))

    # The first entry is the page outside of any table, where loose rows and cells are read too.
    start = F.struct(F.array(new).cast(entry).alias("stack"), F.array().cast("array<array<string>>").alias("rows"))
    left_open = lambda state: F.filter(F.transform(state["stack"], with_cell), lambda cells: F.size(cells) > 0)
    return F.aggregate(tokens, start, step, lambda state: F.concat(state["rows"], left_open(state)))


def html_rows(html: Column | str) -> Column:
    """Rows of every table of a page, in each the inner HTML of its ``<td>`` cells. ``<th>`` cells are not cells."""
    page = as_col(html)
    page = F.when(F.contains(page, F.lit("<!--")), F.regexp_replace(page, COMMENT, "")).otherwise(page)
    return F.when(page.rlike(NESTED), _nested_rows(page)).otherwise(_plain_rows(page))


def html_table_pairs(df: DataFrame, html_col: str = "html", first_cell_pattern: str = r"^[A-Z]{3}$",
                     keep: Sequence[str] = (), key: str = "code", value: str = "location",
                     rebalance_rows: bool = False) -> DataFrame:
    """Table rows whose first cell matches a pattern, cells regrouped in (key, value) pairs.

    A row may carry several pairs side by side (code, place, code, place);
    pairs are formed within a row, and header rows of ``<th>`` (no cells)
    are skipped rather than failing. Cells are text: tags stripped, entities
    decoded, trimmed. Rows are independent once cut out of
    their page, so ``rebalance_rows`` spreads them round-robin before the
    cells are cleaned: one very large page then no longer sits in one task
    (it costs a shuffle of the row texts, so it is off by default).
    """
    rows = df.select(*keep, F.explode(html_rows(html_col)).alias("_raw")).where(F.size("_raw") > 0)
    if rebalance_rows:
        rows = rows.repartition(df.sparkSession.sparkContext.defaultParallelism)
    # The first cell decides before the others are cleaned.
    kept = rows.where(_clean(F.get("_raw", 0)).rlike(first_cell_pattern)).select(*keep, F.transform("_raw", _clean).alias("_cells"))
    pairs = kept.select(*keep, "_cells", F.explode(F.sequence(F.lit(0), F.size("_cells") - 1, F.lit(2))).alias("_i"))
    return pairs.select(*keep, F.get("_cells", F.col("_i")).alias(key), F.get("_cells", F.col("_i") + 1).alias(value))


# The attribute's value in double quotes, in single quotes, or bare.
HREF = r"""href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
LINK = rf"(?is)<a\s(?:[^>]*?\s)?{HREF}[^>]*>(.*?)</a\s*>"


def html_links(df: DataFrame, html_col: str = "html", text_pattern: str | None = None,
               keep: Sequence[str] = ()) -> DataFrame:
    """S5 on anchors: (href, text) of every ``<a href=…>``, entities decoded in both, optionally filtered by a text regex."""
    # One scan of the page finds every anchor; one more over each (short) match takes it apart.
    anchors = F.regexp_extract_all(F.col(html_col), F.lit(LINK), 0)
    parts = F.split(F.regexp_replace("_a", LINK, "$1$2$3\u0001$4"), "\u0001", 2)
    out = df.select(*keep, F.posexplode(anchors).alias("link_pos", "_a")).select(*keep, "link_pos", parts.alias("_p")) \
        .select(*keep, "link_pos", unescape_html(F.get("_p", 0)).alias("href"), _clean(F.get("_p", 1)).alias("text"))
    return out.where(F.col("text").rlike(text_pattern)) if text_pattern else out
