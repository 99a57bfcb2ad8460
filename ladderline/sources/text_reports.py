"""Text report scan (S1, S2, P8) and the row form every parser shares."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderline.functions.text import is_filled, starts_total

REPORT_SUFFIX = r"(?i)\.(txt|mxl)$"
TEXT_SUFFIX = r"(?i)\.txt$"
SHEET_SUFFIX = r"(?i)\.mxl$"
BLOCK_BITS, TASK_BITS = 16, 33
"""A block has 2**16 lines at most; ``monotonically_increasing_id`` counts a task's rows in its low 33 bits."""


def is_report(path: Column) -> Column:
    """The watched file types, whatever the case of the extension."""
    return F.rlike(path, F.lit(REPORT_SUFFIX))


def report_name(path: Column) -> Column:
    """File name without folder and extension; ``.txt`` and ``.mxl`` of one report share it."""
    return F.regexp_extract(path, r"([^/\\]+)\.[^./\\]+$", 1)


def decoded_path(path: Column) -> Column:
    """Spark lists files as URIs; undo the percent encoding of spaces and Cyrillic letters."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path to read as it is: characters that path patterns give a meaning are escaped."""
    return re.sub(r"([\\\[\]{}*?^])", r"\\\1", path)


def read_text_lines(
    spark: SparkSession, directory: str | list[str], fallback_encoding: str | None = None
) -> DataFrame:
    """All lines of all ``.txt`` files below ``directory``:
    ``(path, mtime, block, line_no, line)``.

    The scan splits large files, so no file is bound to one task. A split is cut into blocks of at most 65,536
    lines, so what is gathered by block stays small however long the splits are: ``block`` is the split's offset in
    its file plus the number of the cut, which is below the split's length, and ``line_no`` rises inside it, so
    ``(block, line_no)`` is the file's line order. Line ends are
    ``\\n``, ``\\r\\n`` or ``\\r``, the byte order mark is dropped, and bytes that are not UTF-8 are left
    out. With ``fallback_encoding="windows-1251"``, files that are not valid UTF-8 are read in that
    encoding instead.
    """
    scan = (
        spark.read.option("recursiveFileLookup", "true")
        .text(directory)
        .select(
            decoded_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_modification_time").alias("mtime"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line_no"),
            "value",
        )
        .filter(F.rlike("path", F.lit(TEXT_SUFFIX)))
        .withColumn("block", F.col("block") + F.shiftright(F.col("line_no").bitwiseAND((1 << TASK_BITS) - 1), BLOCK_BITS))
    )
    if fallback_encoding is None:
        return scan.select("path", "mtime", "block", "line_no", _drop_invalid(F.col("value")).alias("line"))
    if fallback_encoding.lower() not in ("windows-1251", "cp1251"):
        raise ValueError(f"unsupported fallback encoding: {fallback_encoding}")
    # A file is UTF-8 only if every line is. Flags are aggregated map-side and joined by block, so that a
    # file with a large share of all lines is not one join task.
    per_block = scan.groupBy("path", "block").agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    per_file = per_block.groupBy("path").agg(F.bool_and("valid").alias("is_utf8"))
    flags = per_block.select("path", "block").join(per_file, "path")
    raw = F.col("value").cast("binary")
    line = F.when(F.col("is_utf8"), F.col("value")).otherwise(decode_cp1251(raw))
    return scan.join(flags, ["path", "block"]).select("path", "mtime", "block", "line_no", line.alias("line"))


def _drop_invalid(value: Column) -> Column:
    repaired = F.replace(F.make_valid_utf8(value), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)


def decode_cp1251(raw: Column) -> Column:
    """Windows-1251 bytes to text: Latin-1 gives one character per byte, then the upper half is mapped."""
    upper = bytes(range(128, 256))
    return F.translate(
        F.decode(raw, "ISO-8859-1"), upper.decode("latin-1"), upper.decode("cp1251", errors="replace")
    )


def split_lines(texts: DataFrame, text: str = "text", rows_per_block: int = 1 << 16) -> DataFrame:
    """Lines of texts that already are rows: ``(..., block, line_no, line)`` replaces the text column."""
    kept = [c for c in texts.columns if c != text]
    unified = F.regexp_replace(F.col(text), "\r\n?", "\n")
    exploded = texts.select(*kept, F.posexplode(F.split(unified, "\n")).alias("line_no", "line"))
    return exploded.withColumn("line_no", F.col("line_no").cast("bigint")).withColumn(
        "block", F.floor(F.col("line_no") / rows_per_block).cast("bigint")
    )


def as_rows(lines: DataFrame) -> DataFrame:
    """Lines as report rows, the form layouts and flattening work on.

    Adds ``cells`` and three row-local facts: ``opens`` (may be the first table line: two tabs or more),
    ``kept`` (a table line: not blank, has a tab, not a totals line) and ``used`` (its number of cells).
    """
    cells = F.split(F.col("line"), "\t", -1)
    # a filter on ``kept`` is tested before anything else, so it does without the cells
    first_cell = F.substring_index("line", "\t", 1)
    tabbed = F.contains(F.col("line"), F.lit("\t"))
    return lines.select(
        "path",
        "block",
        "line_no",
        "line",
        cells.alias("cells"),
        (F.size(cells) >= 3).alias("opens"),
        (tabbed & is_filled(F.col("line")) & ~starts_total(first_cell)).alias("kept"),
        F.size(cells).alias("used"),
        F.lit("txt").alias("format"),
    )
