"""Code-label text files (S6, X24): blocks ``value NAME`` … ``code = 'label'`` … ``;``.

Two readers with the same result:

* ``parse_label_lines`` (files): line by line over Spark's file splits, so a
  large file is read by many tasks and no task holds a whole file.
* ``parse_label_text`` (a text column): regex functions over each document,
  for label documents that already sit one per row in a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A file is cut into blocks at every line that starts with "value"; a block ends at its first ';' outside of
# quoted strings and comments (it may sit on the last entry line or on its own line). (?d): lines end at \n only.
BLOCK_START = r"(?imd)^[ \t]*value[ \t]+"
# A quoted string within one line (a doubled quote is an escaped quote), or a comment, over any number of
# lines; one that is never closed runs to the end.
QUOTED = r"'(?:[^'\n]|'')*+'"
COMMENT = r"/\*(?s:.*?)(?:\*/|\z)"
CLOSED_COMMENT = r"/\*(?s:.*?)\*/"
# From the start of a text to its first line end outside of comments.
LINE = rf"^(?:{QUOTED}|{COMMENT}|[^'/\n]++|['/])*+\n?"
# Everything up to the first ';' that ends a block; a quote without its pair is an ordinary character.
BODY = rf"^((?:[^';]++|{QUOTED}|')*+)"
NAME = r"^\$?(\w+)"
# An entry line: 'code' or digits, '=', 'label'; a doubled quote is an escaped quote.
# Unrolled quoted-string form ([^']*(?:''[^']*)*): linear, no per-character backtracking.
# Multiline and confined to one line, so all entries of a block come out of one scan.
ENTRY = r"(?md)^[ \t]*(?:'([^'\n]*(?:''[^'\n]*)*)'|(-?\d+))[ \t]*=[ \t]*'([^'\n]*(?:''[^'\n]*)*)'"

#: Lines of a file split are put together in stretches of 2 to the power of this many.
STRETCH_BITS = 13


def _without_comments(c: Column, comment: str = COMMENT) -> Column:
    """Text without comments; what looks like one inside a quoted string stays."""
    return F.when(F.contains(c, F.lit("/*")), F.regexp_replace(c, rf"({QUOTED})|{comment}", "$1")).otherwise(c)


def _before_end(c: Column) -> Column:
    """The part before the ``;`` that ends a block."""
    return F.when(F.contains(c, F.lit(";")), F.regexp_extract(c, BODY, 1)).otherwise(c)


def _code_and_label(entry: Column) -> tuple[Column, Column]:
    """Of an entry: its code and its label, unescaped and trimmed."""
    # One pass; exactly one of the two code groups takes part in a match, the other adds nothing.
    parts = F.split(F.regexp_replace(entry, ENTRY, "$1$2\u0001$3"), "\u0001", 2)
    clean = lambda k: F.trim(F.replace(F.get(parts, k), F.lit("''"), F.lit("'")))
    return clean(0), clean(1)


def _state_before(const: Column, turns: Column) -> Column:
    """Whether a stretch begins inside a comment, from what the stretches before it do; outside at the first.

    Each is a function from (inside a comment?) before it to after it: constant, identity, or a turn.
    Composed: the last constant, turned as often as there were turns since.
    """
    return F.coalesce(const["v"] != ((turns - const["t"]) % 2 == 1), turns % 2 == 1)


def parse_label_lines(spark: SparkSession, paths: str | Sequence[str], lists: Sequence[str] | None = None,
                      with_path: bool = False) -> DataFrame:
    """S6 over label files, splittable: ``([path,] list_name, code, label)``.

    Same result as ``parse_label_text(read_label_files(...))`` without reading a file as one row. Lines carry
    their file, the start of the file split they were read from, and a position that grows within the split
    (lines of one split are read in order by one task). Those that can matter are put together again in
    stretches of a bounded number of lines: the one exchange of text. Each stretch settles what it can by
    itself; what it does to the next is one short row, and these rows are scanned per file:

    1. comments: a stretch maps "inside a comment or not" at its start to the same at its end. Composed over
       the file, this tells each stretch how it begins, and so what is left of it without comments;
    2. a line that a comment joins over an end of a stretch is put together in the stretch where it begins;
    3. blocks: the list that is open at the start of a stretch, unless a ``;`` has closed it.

    Blocks and entries are then cut out of the stretches with the same patterns as out of whole texts.
    Compressed files cannot be split, so each is one task; unpack large ones first.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    name, line, text = F.col("_metadata.file_path"), F.col("value"), F.col("_t")
    raw = spark.read.text(paths).select(
        F.xxhash64(name).alias("_file"), F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_pos"),
        "value", *([name.alias("path")] if with_path else []))
    shown = ["path"] if with_path else []
    # What an entry, the end of a block, a comment or a header cannot do without; the patterns run once, on stretches.
    signs = [F.contains(line, F.lit(x)) for x in ("=", ";", "/*", "*/")]
    kept = raw.where(signs[0] | signs[1] | signs[2] | signs[3] | F.startswith(F.lower(F.ltrim(line, F.lit(" \t"))), F.lit("value")))
    order = ["_at", "_stretch"]
    keys = ["_file", *order]
    stretches = kept.withColumn("_stretch", F.shiftright("_pos", STRETCH_BITS)).groupBy(*keys, *shown).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_pos", "value")))["value"], "\n").alias("_t"))
    # Once more by hash, as whole strings: each reader below then takes them as they are, and none puts lines together again.
    stretches = stretches.repartition(*reversed(keys))

    by_file = Window.partitionBy("_file").orderBy(*order)
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    upto = by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # 1. Comments: does the stretch end inside of one, if it begins outside (n) or inside (c)? Only what follows the last
    # end of a comment can tell that one is open: it begins there, with that end's slash, or with its star (/*/).
    rest = F.expr("substring(_t, instr(_t, '*/') + 2)")
    closes = F.contains(text, F.lit("*/"))
    tail = F.col("_tail")
    line_end = F.substring_index(tail, "\n", 1)

    def ends_inside(x: Column) -> Column:
        return _without_comments(x, CLOSED_COMMENT) != _without_comments(x)

    # At the first line end after the last end of a comment none is open and no string either, if none begins before it.
    plain = ~(F.contains(line_end, F.lit("/*")) | F.startswith(tail, F.lit("*")) | F.contains(text, F.lit("/*/")))
    lines_left = F.expr("substring(_tail, length(substring_index(_tail, '\n', 1)) + 2)")
    does = stretches.select(*keys, "_t", closes.alias("_closes"), F.substring_index(text, "*/", -1).alias("_tail")).select(
        *keys, "_t", "_closes", F.when(plain, F.contains(tail, F.lit("/*")) & ends_inside(lines_left)).alias("_open"))
    # If it begins inside, what comes before its first line end outside of comments belongs to an earlier line.
    does = does.select(
        *keys, F.coalesce("_open", ends_inside(text)).alias("n"), F.when(F.col("_closes"), F.coalesce("_open", ends_inside(rest))).otherwise(True).alias("c"),
        F.when(F.col("_closes"), F.instr(text, "*/") + 1).alias("_skip"), F.when(F.col("_closes"), F.regexp_extract(rest, LINE, 0)).alias("_line"))
    does = does.select(*keys, "n", "c", (F.col("_skip") + F.length("_line")).alias("_skip"), F.endswith("_line", F.lit("\n")).alias("_ends"),
                       _without_comments(F.col("_line")).alias("_line"))
    turn = (F.col("n") & ~F.col("c")).cast("int")
    does = does.withColumn("t", F.sum(turn).over(upto))
    const = F.when(F.col("n") == F.col("c"), F.struct(F.col("n").alias("v"), "t"))
    does = does.withColumn("_in", _state_before(F.last(const, ignorenulls=True).over(before), F.col("t") - turn))

    # 2. A stretch that has no line of its own gives all it has to the one where its line begins.
    out = F.when(F.col("_in"), F.col("c")).otherwise(F.col("n"))
    own = (~F.col("_in") | F.coalesce("_ends", F.lit(False))).cast("int")
    first = F.when(F.col("_in"), F.concat("_line", F.when(F.col("_ends") | F.col("c"), "").otherwise("\n")))
    heads = does.select(*keys, out.alias("_out"), F.when(F.col("_in"), F.col("_skip")).otherwise(0).alias("_skip"),
                        first.alias("_first"), own.alias("own")).withColumn("g", F.sum("own").over(upto))
    # One grouping for both: what a stretch is, by its own number, and what it gives, by the number of the one it goes to.
    is_own = F.when(F.col("own") == 1, F.struct(*order, "_skip", "_out"))
    gives = F.when(F.col("_first") != "", F.struct(*order, "_first"))
    both = heads.select("_file", F.explode(F.array(F.struct(F.col("g"), is_own.alias("o"), F.lit(None).cast("struct<_at:bigint,_stretch:bigint,_first:string>").alias("f")),
                                                   F.struct((F.col("g") - F.col("own")).alias("g"), F.lit(None).cast("struct<_at:bigint,_stretch:bigint,_skip:int,_out:boolean>").alias("o"),
                                                            gives.alias("f")))).alias("r")).select("_file", "r.*")
    begins = both.where("o is not null or f is not null").groupBy("_file", "g").agg(
        F.max("o").alias("o"), F.array_join(F.array_sort(F.collect_list("f"))["_first"], "").alias("_more")) \
        .where("o is not null").select("_file", "o.*", "_more")
    # Hashed on the side of one short row a stretch: texts are never sorted or sent about again.
    left = F.when(F.col("_skip") == 0, text).otherwise(F.expr("substring(_t, _skip + 1)"))
    whole = stretches.join(begins.hint("shuffle_hash"), keys).select(*keys, *shown, F.concat(
        _without_comments(left), F.when(F.col("_out"), "").otherwise("\n"), F.col("_more")).alias("_t"))

    # 3. Blocks: the first piece of a stretch belongs to the block that is open at its start.
    cut = whole.select(*keys, F.split("_t", BLOCK_START).alias("_pieces"))
    ended = lambda piece: (_before_end(piece) != piece)
    last = F.element_at("_pieces", -1)
    open_at_end = cut.select(*keys, (F.size("_pieces") > 1).alias("head"), F.lower(F.regexp_extract(last, NAME, 1)).alias("name"),
                             ended(last).alias("closed"), ended(F.get("_pieces", 0)).cast("int").alias("ends"))
    open_at_end = open_at_end.withColumn("ends_upto", F.sum("ends").over(upto))
    latest = F.last(F.when(F.col("head"), F.struct("name", "closed", "ends_upto")), ignorenulls=True).over(before)
    carry = open_at_end.withColumn("l", latest).select(
        *keys, F.when(~(F.col("l.closed") | (F.col("ends_upto") - F.col("ends") > F.col("l.ends_upto"))), F.col("l.name")).alias("_open"))
    # The text is cut within the explode: over a column of pieces, an inferred filter (not empty) would cut it twice.
    pieces = whole.join(carry.hint("shuffle_hash"), keys).select(*shown, "_open", F.posexplode(F.split("_t", BLOCK_START)).alias("_i", "_b"))
    pieces = pieces.where((F.col("_i") > 0) | F.col("_open").isNotNull())
    named = pieces.select(*shown, F.when(F.col("_i") == 0, F.col("_open")).otherwise(F.lower(F.regexp_extract("_b", NAME, 1))).alias("list_name"),
                          _before_end(F.col("_b")).alias("_body"))
    return _entries(named, shown, lists)


def _entries(named: DataFrame, keep: Sequence[str], lists: Sequence[str] | None) -> DataFrame:
    """The entries of blocks (list_name, _body)."""
    if lists is not None:
        named = named.where(F.col("list_name").isin([x.lower() for x in lists]))
    # One scan of the block finds every entry; each (short) entry is then split into its parts.
    entries = named.select(*keep, "list_name", F.explode(F.regexp_extract_all("_body", F.lit(ENTRY), 0)).alias("_e"))
    code, label = _code_and_label(F.col("_e"))
    return entries.select(*keep, "list_name", code.alias("code"), label.alias("label"))


def read_label_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole label files as rows ``(path, text)``: for small files only, as a file is one row of one task."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def parse_label_text(df: DataFrame, text_col: str = "text", keep: Sequence[str] = (),
                     lists: Sequence[str] | None = None) -> DataFrame:
    """``(keep…, list_name, code, label)`` for every entry of every block.

    The entry on the terminator line (``996 = '…' ;``) is kept, doubled
    quotes are unescaped, code and label are trimmed. ``lists`` restricts to
    some block names (lower case, without ``$``).
    """
    # Line ends as \n, as a reader of lines has them.
    text = F.when(F.contains(F.col(text_col), F.lit("\r")), F.regexp_replace(text_col, r"\r\n?", "\n")).otherwise(F.col(text_col))
    pieces = df.select(*keep, F.posexplode(F.split(_without_comments(text), BLOCK_START)).alias("_i", "_b")).where(F.col("_i") > 0)
    named = pieces.select(*keep, F.lower(F.regexp_extract("_b", NAME, 1)).alias("list_name"),
                          _before_end(F.col("_b")).alias("_body"))
    return _entries(named, keep, lists)
