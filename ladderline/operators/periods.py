"""Header text and reporting period of every file (H1-H4 over DataFrames)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderline.functions.periods import complete_end, extract_period, found_on_line, has_time, missing_bounds, parse_moment
from ladderline.functions.text import is_filled
from ladderline.operators.layout import first_openings, table_starts
from ladderline.session import stage


CHUNK_LINES, LINES_OF_A_MATCH = 1 << 16, 6
"""Line numbers of a block that are searched together, and the most lines that a match can take: a colon, two dates with
their times and a dash may each stand on a line of their own."""


def title_lines(rows: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """``(path, block, line_no, line)``: the filled lines before the table, of files that have a table; and in
    ``files (path)`` those files. Rows meet their file's table start by ``(path, block)`` and only in the
    blocks up to it, so a large file costs no more than a small one. A known ``layout`` saves finding the
    starts."""
    return _lines_before(rows, _title_blocks(rows, layout))


def _lines_before(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    before = (F.col("block") < F.col("start_block")) | (
        (F.col("block") == F.col("start_block")) & (F.col("line_no") < F.col("start_line"))
    )
    lines = rows.select("path", "block", "line_no", "line").filter(is_filled(F.col("line")))
    return lines.join(blocks.filter("block <= start_block"), ["path", "block"]).filter(before).drop("start_block", "start_line")


def _title_blocks(rows: DataFrame, layout: DataFrame | None) -> DataFrame:
    if layout is not None:
        return layout.filter(F.col("start_block").isNotNull()).select("path", "block", "start_block", "start_line")
    return _placed(table_starts(rows))


def _placed(found: DataFrame) -> DataFrame:
    return found.select("path", "block").join(first_openings(found), "path")


def header_texts(rows: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """``(path, header)``: the lines before the table, in order, one text per file that has a table.

    Blank lines are left out: the period patterns treat them as whitespace. This gathers the title block of a file;
    ``header_periods`` does not."""
    ordered = F.array_sort(F.collect_list(F.struct("block", "line_no", "line")))
    title = title_lines(rows, layout)
    gathered = title.groupBy("path").agg(F.array_join(F.transform(ordered, lambda r: r["line"]), "\n").alias("header"))
    files = _title_blocks(rows, layout).filter("block = start_block").select("path")
    return files.join(gathered, "path", "left").select("path", F.coalesce("header", F.lit("")).alias("header"))


def header_periods(rows: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """``(path, start_raw, end_raw, pattern)``: what ``extract_period`` finds in a file's title, however long it is.

    A match begins on a line with a colon and takes few lines, so each such line is searched with the few behind it. Lines
    see each other within a chunk of a block; only the last ones of a chunk are searched again, with the first ones of the
    next chunks. Whether a range counts hangs on one thing before it, the first line that names the parameters: a chunk
    says where it names them first and what it finds anywhere and behind that, and the chunks of a file, one row each, are
    put together in order."""
    blocks = _title_blocks(rows, layout) if layout is not None else _placed(stage(table_starts(rows), "title-blocks"))
    more = LINES_OF_A_MATCH - 1
    keys = ["path", "block", "chunk"]
    title = _lines_before(rows, blocks).withColumn("chunk", F.expr(f"line_no div {CHUNK_LINES}"))
    in_chunk = Window.partitionBy(*keys).orderBy("line_no")
    behind = F.array_compact(F.array(*[F.lead("line", i).over(in_chunk) for i in range(1, more + 1)]))
    lines = title.select(*keys, "line_no", "line", behind.alias("behind"), (F.row_number().over(in_chunk) <= more).alias("head"))
    lines = lines.withColumn("tail", F.size("behind") < more)
    lines = lines.withColumn("found", F.when(F.contains("line", F.lit(":")) & ~F.col("tail"), found_on_line(F.col("line"), F.col("behind"))))
    lines = lines.filter(F.col("head") | F.col("tail") | _any_found(F.col("found")))
    found = stage(lines.select(*keys, "line_no", F.when(F.col("head") | F.col("tail"), F.col("line")).alias("line"), "head", "tail", "found"), "title-found")
    hits = found.select(*keys, "line_no", "found").unionByName(_found_at_ends(found, keys, more)).filter(_any_found(F.col("found")))
    files = blocks.filter("block = start_block").select("path")
    return files.join(_first_hits(hits, keys), "path", "left").select("path", "hit.found.start_raw", "hit.found.end_raw", "hit.pattern")


def _any_found(found: Column) -> Column:
    return F.coalesce(found["named"] | found["range"].isNotNull() | found["two"].isNotNull() | found["only"].isNotNull(), F.lit(False))


def _found_at_ends(found: DataFrame, keys: list[str], more: int) -> DataFrame:
    """What begins on the last lines of chunks, whose matches may reach into the next ones; every chunk has a line."""
    entry = F.struct("line_no", "line")
    gathered = lambda flag: F.array_sort(F.collect_list(F.when(F.col(flag), entry)))
    ends = found.filter(F.col("head") | F.col("tail")).groupBy(*keys).agg(gathered("head").alias("heads"), gathered("tail").alias("tails"))
    following = F.flatten(F.collect_list("heads").over(Window.partitionBy("path").orderBy("block", "chunk").rowsBetween(1, more)))
    ends = ends.select(*keys, "tails", F.concat("tails", F.slice(following, 1, more)).alias("all"))
    placed = ends.select(*keys, "all", F.posexplode("tails").alias("at", "own"))
    behind = F.transform(F.slice("all", F.col("at") + 2, F.lit(more)), lambda r: r["line"])
    return placed.filter(F.contains("own.line", F.lit(":"))).select(*keys, "own.line_no", found_on_line(F.col("own.line"), behind).alias("found"))


def _first_hits(hits: DataFrame, keys: list[str]) -> DataFrame:
    """``(path, hit)``: per file, the first match of the first pattern that has one."""
    line, found = F.col("line_no"), F.col("found")
    at = F.min(F.when(found["named"], line)).over(Window.partitionBy(*keys))
    first = lambda part: F.min(F.when(part.isNotNull(), F.struct(line.alias("line_no"), part.alias("found"))))
    behind = F.when(line > F.col("at"), found["range"]).when(line == F.col("at"), found["behind"])
    chunks = hits.withColumn("at", at).groupBy(*keys).agg(
        F.min("at").alias("at"), first(behind).alias("behind"), first(found["range"]).alias("range"), first(found["two"]).alias("two"), first(found["only"]).alias("only")
    )
    place = F.struct("block", "chunk")
    named = F.min(F.when(F.col("at").isNotNull(), place)).over(Window.partitionBy("path"))
    chunks = chunks.withColumn("place", place).withColumn("named", named)
    in_range = F.when(F.col("place") == F.col("named"), F.col("behind")).when(F.col("place") > F.col("named"), F.col("range"))
    of = lambda number, part: F.when(part.isNotNull(), F.struct(F.lit(number).alias("pattern"), "place", part["line_no"].alias("line_no"), part["found"].alias("found")))
    hit = F.coalesce(of(1, in_range), of(2, F.col("two")), of(3, F.col("only")))
    return chunks.select("path", hit.alias("hit")).groupBy("path").agg(F.min("hit").alias("hit"))


def report_periods(headers: DataFrame, event_time: Column) -> DataFrame:
    """``(..., start_raw, end_raw, pattern, start, start_has_time, end, missing)`` from header texts, or from what
    ``header_periods`` found.

    ``event_time`` is the contract's event column: it decides whether a missing end is completed and
    whether a missing start is an error (``missing`` is then not empty)."""
    found = headers
    if "header" in headers.columns:
        found = headers.withColumn("found", extract_period(F.col("header"))).select("*", "found.*").drop("found")
    parsed = found.select(
        "*",
        parse_moment(F.col("start_raw")).alias("start"),
        has_time(F.col("start_raw")).alias("start_has_time"),
        parse_moment(F.col("end_raw")).alias("__end"),
    )
    end = complete_end(event_time, F.col("start"), F.col("start_has_time"), F.col("__end"))
    return parsed.select(
        *[c for c in parsed.columns if c != "__end"],
        end.alias("end"),
        missing_bounds(event_time, F.col("start"), end).alias("missing"),
    )
