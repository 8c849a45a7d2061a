"""String cleaning expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def norm_key(c: Column | str) -> Column:
    """Join key normalisation, used on both sides of text joins."""
    return F.lower(F.trim(as_col(c)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def default_code(c: Column | str, default: str) -> Column:
    """Null *or blank* -> default code."""
    return F.coalesce(blank_to_null(c), F.lit(default))


def split_location(location: Column | str, sep: str = ",") -> tuple[Column, Column]:
    """X14: "City, ST" -> (city, state), trimmed; both null when there is no separator.

    With more than one separator the state is the second field only, as the
    staging rule takes field 0 and field 1.
    """
    s = as_col(location)
    parts = F.split(s, sep)
    has = F.instr(s, sep) > 0
    return (F.when(has, F.trim(F.get(parts, 0))), F.when(has, F.trim(F.get(parts, 1))))


def split_once(s: Column | str, sep: str = ",") -> tuple[Column, Column]:
    """Split once on the first separator -> (head, rest); rest null when absent."""
    parts = F.split(as_col(s), sep, 2)
    return F.trim(F.get(parts, 0)), F.trim(F.get(parts, 1))


def strip_literal(c: Column | str, literal: str) -> Column:
    """Remove every occurrence of a literal (e.g. the ``US-`` region prefix)."""
    return F.replace(as_col(c), F.lit(literal), F.lit(""))


def clean_number(c: Column | str) -> Column:
    """X16: "10,000.5" -> 10000.5; junk -> null instead of a failed job."""
    return F.replace(as_col(c), F.lit(","), F.lit("")).try_cast("double")


def split_list(c: Column | str, sep: str = ",") -> Column:
    """Comma list -> array<string>; null stays null."""
    return F.split(as_col(c), sep)


def join_or_unknown(arr: Column | str, sep: str = ",", default: str = "Unknown") -> Column:
    """Array -> "a,b"; empty or null array -> default."""
    return F.coalesce(F.nullif(F.concat_ws(sep, as_col(arr)), F.lit("")), F.lit(default))


def unescape_html(c: Column | str) -> Column:
    """Decode every entity once, as an HTML reader does: decimal, hexadecimal, and named ones.

    Names come from the standard library's table; unknown names and impossible numbers stay as they are, and
    ``&nbsp;`` counts as a plain space. The text is cut at each ``&``, and each piece is looked at once.
    """
    text = as_col(c)
    named = F.create_map(*(F.lit(x) for name, code in sorted(name2codepoint.items())
                           for x in (name, " " if name == "nbsp" else chr(code))))

    def decoded(piece: Column) -> Column:
        body = F.substring_index(piece, ";", 1)
        number = F.when(body.rlike("^#[0-9]{1,7}$"), F.substring(body, 2, 7)) \
            .when(body.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(F.substring(body, 3, 6), 16, 10)).try_cast("int")
        real = (number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)) & (number != 160)
        char = F.when(real, F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32")).when(number == 160, " ")
        found = F.when(F.contains(piece, F.lit(";")), F.when(F.startswith(body, F.lit("#")), char)
                       .when(body == "amp", "&").when(body == "lt", "<").when(body == "gt", ">").when(body == "nbsp", " ")   # most are one of these
                       .otherwise(F.try_element_at(named, body)))
        return F.coalesce(F.concat(found, F.substring(piece, F.length(body) + 2, F.length(piece))), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    whole = F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)
