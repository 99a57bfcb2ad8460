"""Text and cell-array expressions shared by every parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode calls White_Space (what `\s` means in the report rules) ...
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ... and the four separators that stripping removes as well.
STRIPPED = WHITE_SPACE + "\x1c\x1d\x1e\x1f"
TOTAL_MARK = "итого"


def strip(text: Column) -> Column:
    """Remove whitespace of any kind (tabs, no-break spaces ...) from both ends."""
    return F.btrim(text, F.lit(STRIPPED))


def is_blank(text: Column) -> Column:
    """Nothing but whitespace. Trimming on the left alone decides it, and stops at the first other character."""
    return F.ltrim(text, F.lit(STRIPPED)) == ""


def is_filled(text: Column) -> Column:
    return F.ltrim(text, F.lit(STRIPPED)) != ""


def without_spaces(text: Column) -> Column:
    return F.translate(text, WHITE_SPACE, "")


def one_space(text: Column) -> Column:
    """Every run of whitespace becomes a single space."""
    return F.regexp_replace(text, r"(?U)\s+", " ")


def replace_first(text: Column, old: str, new: str) -> Column:
    """Replace the first occurrence only (``regexp_replace`` and ``replace`` take all of them)."""
    at = F.locate(old, text)
    return F.when(at > 0, F.overlay(text, F.lit(new), at, F.lit(len(old)))).otherwise(text)


def starts_total(first_cell: Column) -> Column:
    """A totals line: its first cell, stripped and lower-cased, starts with the totals word."""
    return F.startswith(F.lower(F.ltrim(first_cell, F.lit(STRIPPED))), F.lit(TOTAL_MARK))


def empty_to_null(text: Column) -> Column:
    """Only the exactly empty string becomes NULL; blanks survive."""
    return F.when(text != "", text)


def leading_filled(cells: Column, limit: Column) -> Column:
    """How many cells from the left are filled before the first blank one, within ``limit`` cells."""
    blank_at = F.nullif(F.array_position(F.transform(F.slice(cells, F.lit(1), limit), is_blank), True), F.lit(0))
    return F.coalesce(blank_at - 1, F.least(limit, F.size(cells))).cast("int")


def last_filled(cells: Column) -> Column:
    """Index of the last filled cell, -1 when every cell is blank."""
    from_right = F.array_position(F.transform(F.reverse(cells), is_filled), True)
    return F.when(from_right == 0, -1).otherwise(F.size(cells) - from_right).cast("int")


def fit_width(cells: Column, width: Column) -> Column:
    """Pad a short row with empty cells and cut a long one."""
    missing = F.greatest(width - F.size(cells), F.lit(0))
    return F.slice(F.concat(cells, F.array_repeat(F.lit(""), missing)), F.lit(1), width)


def unquote(cell: Column) -> Column:
    """A cell that is one quoted string loses its quotes; doubled quotes inside become single."""
    quoted = F.rlike(cell, F.lit(r'(?s)^"[^"]*+(?:""[^"]*+)*+"$'))
    inner = F.substring(cell, F.lit(2), F.length(cell) - 2)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(cell)


def quote_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """A column by its exact name: report headers hold dots, spaces and backticks."""
    return F.col(quote_name(name))
