"""Layout detection (G1-G3): one row per report file that says how to flatten it.

The staircase header of a grouped report is found from its first few table lines, so only those lines
travel: a map-side aggregate per block finds where each table starts, and a window limited to the first
lines of the blocks at the table's head collects them. No file is gathered whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderline.functions.text import fit_width, leading_filled, strip, unquote
from ladderline.session import stage

HEAD_LINES = 4
BOUND_STEP = 16


def table_starts(rows: DataFrame) -> DataFrame:
    """Per block: ``(path, block, opens_at, kept, used)``; ``opens_at`` is its first opening line.

    A file has one format. It is a key here, as the greatest text of a group would make Spark sort all rows."""
    found = rows.groupBy("path", "block", "format").agg(
        F.min(F.when(F.col("opens"), F.col("line_no"))).alias("opens_at"),
        F.count_if("kept").alias("kept"),
        F.max("used").alias("used"),
    )
    return found.select("path", "block", "opens_at", "kept", "used", "format")


def first_openings(blocks: DataFrame) -> DataFrame:
    """Per file, the block and line where its table starts; files without a table have none."""
    start = F.min(F.struct(F.col("block").alias("start_block"), F.col("opens_at").alias("start_line")))
    return (
        blocks.filter(F.col("opens_at").isNotNull()).groupBy("path").agg(start.alias("s")).select("path", "s.*")
    )


def _limits(blocks: DataFrame) -> DataFrame:
    """``(path, limit, bound)``: how many of a file's first table lines can matter, and the power of ``BOUND_STEP`` above.

    A grouped header has at most one line per dimension column and one detail line, so the file's widest line limits it."""
    limit = F.greatest(F.max("used") + 2, F.lit(HEAD_LINES)).cast("int")
    powers = [F.lit(BOUND_STEP**k) for k in range(1, 9)]
    limits = blocks.groupBy("path").agg(limit.alias("limit"))
    bound = F.filter(F.array(*powers), lambda p: p >= F.col("limit"))
    return limits.withColumn("bound", F.coalesce(F.get(bound, F.lit(0)), F.lit(2**31 - 1)))


def _head_rows(rows: DataFrame, blocks: DataFrame, limits: DataFrame) -> DataFrame:
    """The first ``limit`` table lines of every file, numbered from 0 in ``at``.

    Files are taken by the bound of their limit, a number in the plan, so that each map task hands on no more lines of a
    file than its bound: a very wide file does not make narrow ones gather more of theirs."""
    over = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(F.col("block") > F.col("start_block"), F.col("kept"))).over(over), F.lit(0))
    placed = blocks.join(first_openings(blocks), "path").filter(F.col("block") >= F.col("start_block")).withColumn("before", before)
    head_blocks = placed.join(limits, "path").filter(F.col("before") < F.col("limit")).select("path", "block", "start_block", "start_line", "limit", "bound")
    head_blocks = stage(head_blocks, "head-blocks")
    in_block = Window.partitionBy("path", "block").orderBy("line_no")
    in_file = Window.partitionBy("path").orderBy("block", "line_no")
    parts = []
    bounds = head_blocks.groupBy("bound").agg(F.min("block"), F.max("block"))  # nine at most
    for bound, lowest, highest in sorted(map(tuple, bounds.collect())) or [(HEAD_LINES, 0, 0)]:
        # the range of these blocks spares most rows everything else
        first = (
            rows.filter(F.col("block").between(lowest, highest))
            .filter("kept")
            .join(head_blocks.filter(F.col("bound") == bound), ["path", "block"])
            .filter((F.col("block") > F.col("start_block")) | (F.col("line_no") >= F.col("start_line")))
            .select("path", "block", "line_no", "cells", "used", "format", "limit")
            .withColumn("at", F.row_number().over(in_block))
            .filter(F.col("at") <= bound)
            .filter(F.col("at") <= F.col("limit"))
            .withColumn("at", F.row_number().over(in_file) - 1)
        )
        parts.append(first.filter(F.col("at") < bound).filter(F.col("at") < F.col("limit")).drop("limit"))
    return reduce(DataFrame.unionByName, parts)


def detect_layout(rows: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """One staged row per file and block (the block list the flattening joins on):

    ``(path, block, kept, file, kind, format, width, measure_start, height, spans, detail_cols, detail_only, names,
    picks, start_block, start_line, head_block, head_line, reason)``.

    ``kind`` is ``grouped``, ``flat`` or ``rejected`` (then ``reason`` says why); ``names`` are the output
    columns and ``picks`` the positions their values come from (NULL: in order); ``(start_block,
    start_line)`` is the first table line and ``(head_block, head_line)`` the last header line. ``kept`` counts the block's
    table lines, and ``file`` is a number for the path, which takes less room in rows that are sorted. ``merges`` (``path, r1, c1, r2, c2``) lets sheets state their header height.
    """
    blocks = stage(table_starts(rows), "blocks")
    limits = _limits(blocks)
    heads = _head_rows(rows, blocks, limits)
    head = F.array_sort(F.collect_list(F.struct("at", "block", "line_no", "cells", "used")))
    files = blocks.groupBy("path").agg(
        F.max("format").alias("format"), F.count("opens_at").alias("openings")
    )
    layouts = _find_measures(files.join(heads.groupBy("path").agg(head.alias("head")), "path", "left").join(limits, "path", "left"))
    if merges is None:
        layouts = layouts.withColumn("merge_height", F.lit(None).cast("int"))
    else:
        first_row = F.get("head", F.lit(0))["line_no"].alias("table_row")
        tables = layouts.select("path", first_row, "measure_start", "width")
        layouts = layouts.join(header_heights(tables, merges), "path", "left")
    # numbers given out over a table come out the same however often a task is repeated
    described = stage(_describe(layouts), "described").withColumn("file", F.monotonically_increasing_id())
    placed = blocks.select("path", "block", "kept").join(first_openings(blocks), "path", "left")
    return stage(placed.join(described, "path"), "layout")


def header_heights(tables: DataFrame, merges: DataFrame) -> DataFrame:
    """``(path, merge_height)``, the height that all vertical merges over a table's measures share.

    ``tables`` is ``(path, table_row, measure_start, width)`` with absolute row numbers. A merge counts
    when it starts on the table's first row and lies within the measure columns."""
    over_measures = (F.col("c1") >= F.col("measure_start")) & (F.col("c2") < F.col("width"))
    vertical = (F.col("r1") == F.col("table_row")) & (F.col("r2") > F.col("r1")) & over_measures
    height = (F.col("r2") - F.col("r1") + 1).cast("int")
    heights = (
        merges.join(tables, "path").filter(vertical).groupBy("path").agg(F.min(height).alias("low"), F.max(height).alias("high"))
    )
    return heights.filter(F.col("low") == F.col("high")).select("path", F.col("low").alias("merge_height"))


def _find_measures(layouts: DataFrame) -> DataFrame:
    """Table width, stripped head lines and the first measure column.

    That column is the first one (from the second on) that is filled on the first line and empty on the
    second."""
    head = F.col("head")
    width = F.array_max(F.transform(F.slice(head, 1, HEAD_LINES), lambda r: r["used"]))
    d = layouts.withColumn("width", F.coalesce(width, F.lit(0)))
    is_text = F.col("format") == "txt"
    d = d.withColumn(
        "grid",
        F.transform(head, lambda r: F.transform(fit_or_longer(r["cells"], F.col("width"), is_text), strip)),
    )
    line = lambda i: F.get(F.col("grid"), F.lit(i))
    starts = F.filter(
        F.sequence(F.lit(0), F.col("width") - 1),
        lambda j: (j >= 1) & (F.get(line(0), j) != "") & (F.get(line(1), j) == ""),
    )
    found = F.when((F.size("grid") >= 2) & (F.col("width") > 0), F.get(starts, F.lit(0)))
    return d.withColumn("measure_start", found)


def _describe(layouts: DataFrame) -> DataFrame:
    """The staircase rules as array expressions over the head lines of a file."""
    is_text = F.col("format") == "txt"
    head = F.col("head")
    line = lambda i: F.get(F.col("grid"), F.lit(i))
    indexes = F.sequence(F.lit(0), F.col("width") - 1)
    d = layouts
    top_measures = F.slice(line(0), F.col("measure_start") + 1, F.col("width"))
    d = d.withColumn(
        "measures_named", F.coalesce(F.forall(top_measures, lambda name: name != ""), F.lit(False))
    )

    # Height: lines up to the first one (from the third on) with any measure.
    has_measure = lambda cells: F.exists(
        F.slice(cells, F.col("measure_start") + 1, F.greatest(F.col("width") - F.col("measure_start"), F.lit(0))),
        lambda x: x != "",
    )
    body_at = F.array_position(F.transform(F.slice(F.col("grid"), 3, F.size("grid")), has_measure), True)
    by_lines = F.when(body_at > 0, body_at + 1).otherwise(F.size("grid")).cast("int")
    by_merges = F.col("merge_height")
    usable = (by_merges >= 2) & (by_merges < F.size("grid"))
    d = d.withColumn("height", F.when(F.col("measures_named"), F.when(usable, by_merges).otherwise(by_lines)))

    dims = F.col("measure_start")
    upper = F.slice(F.col("grid"), F.lit(1), F.greatest(F.col("height") - 1, F.lit(0)))
    d = d.withColumn("spans", F.transform(upper, lambda cells: leading_filled(cells, dims)))
    bottom = F.get(F.col("grid"), F.col("height") - 1)
    d = d.withColumn(
        "detail_cols", F.filter(indexes, lambda j: (j < dims) & (F.get(bottom, j) != ""))
    )
    span = F.get(F.col("spans"), F.size("spans") - 1)
    rising = F.forall(
        F.sequence(F.lit(0), F.size("spans") - 1),
        lambda i: F.get(F.col("spans"), i) > F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("spans"), i - 1)),
    )
    # When every one of ``limit`` lines still is header, it is higher than a staircase can be.
    complete = (F.col("height") < F.size("grid")) | (F.size("grid") < F.col("limit"))
    grouped = F.coalesce(
        F.col("measures_named")
        & complete
        & (F.size("spans") >= 1)
        & rising
        & (span < dims)
        & (F.size("detail_cols") > span),
        F.lit(False),
    )
    d = d.withColumn("is_grouped", grouped)
    beyond = F.filter(F.col("detail_cols"), lambda j: j >= span)
    d = d.withColumn("detail_only", F.when(F.size(beyond) > 0, beyond).otherwise(F.col("detail_cols")))

    # Output columns of a grouped report: group headers by level, detail headers, measures.
    level_names = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size("spans") - 1),
            lambda r: F.slice(F.get(F.col("grid"), r), F.lit(1), F.get(F.col("spans"), r)),
        )
    )
    detail_names = F.transform(F.col("detail_cols"), lambda j: F.get(bottom, j))
    header = F.get(head, F.lit(0))
    flat_names = F.when(is_text, _numbered(F.transform(header["cells"], lambda c: strip(unquote(c))))).otherwise(
        F.slice(line(0), F.lit(1), F.col("width"))
    )
    all_names = F.when(
        F.col("is_grouped"), F.concat(level_names, detail_names, top_measures)
    ).otherwise(flat_names)
    d = d.withColumn("width", F.when(~F.col("is_grouped") & is_text, header["used"]).otherwise(F.col("width")))
    d = d.withColumn("all_names", all_names).withColumn("names", F.array_distinct("all_names"))
    # A repeated name keeps its first position and takes its last value.
    last_of_each = F.transform(
        F.col("names"),
        lambda n: (F.size("all_names") - F.array_position(F.reverse(F.col("all_names")), n)).cast("int"),
    )
    d = d.withColumn("picks", F.when(~_all_differ(F.col("all_names")), last_of_each))
    reason = (
        F.when(F.col("openings") == 0, "no table body")
        .when(F.coalesce(F.size("head"), F.lit(0)) < 2, "fewer than two table lines")
    )
    last_header = F.get(head, F.when(F.col("is_grouped"), F.col("height") - 1).otherwise(F.lit(0)))
    kind = F.when(reason.isNotNull(), "rejected").when(F.col("is_grouped"), "grouped").otherwise("flat")
    return d.select(
        "path",
        kind.alias("kind"),
        "format",
        "width",
        *[F.when(F.col("is_grouped"), F.col(c)).alias(c) for c in ("measure_start", "height", "spans")],
        *[F.when(F.col("is_grouped"), F.col(c)).alias(c) for c in ("detail_cols", "detail_only")],
        "names",
        "picks",
        last_header["block"].alias("head_block"),
        last_header["line_no"].alias("head_line"),
        reason.alias("reason"),
    )


def _numbered(names: Column) -> Column:
    """Repeated headers of a flat text table get a ``_duplicated_<n>`` ending."""
    earlier = lambda n, i: F.size(F.filter(F.slice(names, F.lit(1), i), lambda x: x == n))
    numbered = F.transform(
        names,
        lambda n, i: F.when(
            earlier(n, i) > 0, F.concat(n, F.lit("_duplicated_"), (earlier(n, i) - 1).cast("string"))
        ).otherwise(n),
    )
    return F.when(_all_differ(names), names).otherwise(numbered)


def _all_differ(names: Column) -> Column:
    return F.size(F.array_distinct(names)) == F.size(names)


def fit_or_longer(cells: Column, width: Column, is_text: Column) -> Column:
    """Sheet rows are cut to the table width, text lines only padded."""
    padded = fit_width(cells, F.greatest(width, F.size(cells)))
    return F.when(is_text, padded).otherwise(fit_width(cells, width))


def layouts_by_file(layout: DataFrame) -> DataFrame:
    """The layout table with one row per file."""
    first = layout.groupBy("path").agg(F.min("block").alias("block"))
    return layout.join(first, ["path", "block"]).drop("block")


def rejected_files(layout: DataFrame) -> DataFrame:
    return layouts_by_file(layout).filter(F.col("kind") == "rejected").select("path", "reason")

