"""Flattening of report rows (G4-G8, S5): group values move into every detail row.

A sequential reader would keep a stack of group values. Here a subtotal row becomes, for each level, either a
value (its own level) or a reset (every deeper level), and a detail row takes the latest of these markers
per level. A reset is a non-NULL struct holding NULL, so "latest marker" needs no state beyond
``plans.ordered.running``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderline.functions.text import empty_to_null, is_filled, leading_filled, strip, unquote
from ladderline.plans.ordered import Running, running

ROW_FIELDS = ("kind", "width", "measure_start", "spans", "detail_cols", "detail_only", "head_block", "head_line")
FILE_FIELDS = ("path", "kind", "spans", "names", "picks")
ROWS_PER_TASK = 100_000
"""Rows that are put in order by one task: shuffled bytes, which Spark sizes tasks by, say little of them, as lines of a
report are much alike and shrink to a small part."""


def table_rows(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """The data rows of every accepted file, with their layout: header lines and other text are gone.

    The layout is joined by ``(path, block)``: a broadcast while it is small (Spark checks its size at run
    time). It brings the number of the file, by which the flattening windows go."""
    accepted = layout.filter(F.col("kind") != "rejected").select("path", "block", "file", *ROW_FIELDS)
    after_head = (F.col("block") > F.col("head_block")) | (
        (F.col("block") == F.col("head_block")) & (F.col("line_no") > F.col("head_line"))
    )
    return rows.filter("kept").join(accepted, ["path", "block"]).filter(after_head)


def classify_rows(data: DataFrame) -> DataFrame:
    """G4/G7 for grouped files: ``class`` is ``detail``, ``subtotal``, ``ragged`` or ``other``.

    ``level`` is the 1-based group level of a subtotal, else 0; ``resized`` is -1 for a flat row that is too short, 1 for one
    that is too long, else 0. A text line with too many cells is ragged;
    a sheet row is cut to the width instead. Rows of flat files are details."""
    grouped = F.col("kind") == "grouped"
    cells = F.col("cells")
    ragged = grouped & (F.col("format") == "txt") & (F.size(cells) > F.col("width"))
    # Cells a short row lacks read as NULL, which counts as blank; nothing has to be padded.
    is_detail = F.exists("detail_only", lambda j: F.coalesce(is_filled(F.get(cells, j)), F.lit(False)))
    level = F.array_position("spans", leading_filled(cells, F.col("measure_start"))).cast("int")
    step = F.when(~grouped, -1).when(ragged, 0).when(is_detail, -1).otherwise(level)
    names = F.when(F.col("step") < 0, "detail").when(F.col("step") > 0, "subtotal").when(ragged, "ragged")
    flat = F.col("kind") == "flat"
    resized = F.when(flat & (F.col("used") < F.col("width")), -1).when(flat & (F.col("used") > F.col("width")), 1).otherwise(0)
    return data.withColumn("step", step).withColumns(
        {"class": names.otherwise("other"), "level": F.greatest("step", F.lit(0)), "resized": resized}
    )


def depth_of(layout: DataFrame) -> int:
    """The most group levels any file has: one number from the (small) layout table."""
    return max(layout.agg(F.max(F.size("spans"))).first()[0] or 0, 0)


def _dealt(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """Rows by file and block, to as many tasks as their number asks for; few rows are left to adaptive execution."""
    tasks = (layout.agg(F.sum("kept")).first()[0] or 0) // ROWS_PER_TASK
    return rows.repartition(tasks, "file", "block") if tasks > rows.sparkSession.sparkContext.defaultParallelism else rows


def flatten(rows: DataFrame, layout: DataFrame, depth: int | None = None) -> DataFrame:
    """All detail rows of all files: ``(path, block, line_no, names, values)``.

    ``depth`` is the number of group levels; it is read from the layout when not given."""
    details = _details(rows, layout, depth)
    chosen = F.transform(F.col("picks"), lambda i: F.get(F.col("source"), i))
    values = F.when(F.col("picks").isNull(), F.col("source")).otherwise(chosen)
    return details.select("path", "block", "line_no", "names", values.alias("values"))


def flatten_tagged(rows: DataFrame, layout: DataFrame, depth: int | None = None) -> DataFrame:
    """Every table row of all files, once: ``(path, block, line_no, class, resized, names, values)``.

    Details carry their values as ``flatten`` gives them, the other rows none; ``resized`` is -1 for a flat row that was
    padded, 1 for one that was cut, else 0. Rows and counters of a load are both taken from this one pass."""
    details = _details(rows, layout, depth, ("class", "resized"))
    chosen = F.transform(F.col("picks"), lambda i: F.get(F.col("source"), i))
    values = F.when(F.col("class") == "detail", F.when(F.col("picks").isNull(), F.col("source")).otherwise(chosen))
    names = F.when(F.col("class") == "detail", F.col("names"))
    return details.select("path", "block", "line_no", "class", "resized", names.alias("names"), values.alias("values"))


def tagged_counts(tagged: DataFrame) -> DataFrame:
    """``row_counts`` from the rows of ``flatten_tagged``: sums by file, combined map-side."""
    classes = [F.count_if(F.col("class") == c).alias(f"{c}_rows") for c in ("detail", "subtotal", "ragged", "other")]
    return tagged.groupBy("path").agg(*classes, F.count_if(F.col("resized") < 0).alias("padded_rows"), F.count_if(F.col("resized") > 0).alias("cut_rows"))


def flatten_columns(
    rows: DataFrame,
    layout: DataFrame,
    names: list[str],
    keep: tuple[str, ...] = ("path", "line_no"),
    depth: int | None = None,
) -> DataFrame:
    """All detail rows with one string column per name, NULL where a file has no such column.

    Where each column is found is worked out once per file, on the layout, not once per row."""
    wanted = F.array(*[F.lit(n) for n in names])
    at = lambda n: F.array_position(F.col("names"), n).cast("int") - 1
    source_of = F.transform(wanted, lambda n: F.when(F.col("picks").isNull(), at(n)).otherwise(F.get(F.col("picks"), at(n))))
    details = _details(rows, layout.withColumn("picks", source_of), depth)
    place = lambda k: F.get(F.col("picks"), F.lit(k))
    return details.select(*keep, *[F.get(F.col("source"), place(k)).alias(n) for k, n in enumerate(names)])


def _details(rows: DataFrame, layout: DataFrame, depth: int | None, tags: tuple[str, ...] = ()) -> DataFrame:
    """Detail rows as ``(path, block, line_no, names, picks, source)``, ``source`` being group values by
    level and then the row's own cells. With ``tags``, columns of ``classify_rows``, the other rows as well.

    Only positions, levels and cells that end up in the result are shuffled, with a number for their file; what the layout
    knows about a file, its path included, joins them again together with the inherited group values."""
    if depth is None:
        depth = depth_of(layout)
    classified = classify_rows(table_rows(rows, layout))
    slim = classified.select("file", "block", "line_no", "step", *tags, _own_cells().alias("own"))
    if depth == 0:
        carried = slim.join(layout.select("file", "block", *FILE_FIELDS), ["file", "block"])
    else:
        markers = {f"level_{r}": Running("last", _marker(r)) for r in range(1, depth + 1)}
        carried = running(
            slim, ["file"], "line_no", markers, blocks=layout, facts=FILE_FIELDS, setters=F.col("step") > 0, deal=lambda d: _dealt(d, layout)
        )
    details = carried if tags else carried.filter(F.col("step") < 0)
    own = F.transform("own", empty_to_null)
    return details.select("path", "block", "line_no", *tags, "names", "picks", _source(depth, own).alias("source"))


def _own_cells() -> Column:
    """What a row contributes: details their dimensions and measures, subtotals their group's values (empty ones NULL).

    Where every dimension has a name, a detail row is the table's width of its cells, which takes no look at each."""
    cells = F.col("cells")
    dims = F.transform(F.col("detail_cols"), lambda j: F.get(cells, j))
    measures = F.slice(cells, F.col("measure_start") + 1, F.greatest(F.col("width") - F.col("measure_start"), F.lit(0)))
    in_line = (F.size("detail_cols") == F.col("measure_start")) & (F.size(cells) >= F.col("measure_start"))
    detail = F.when(in_line, F.slice(cells, F.lit(1), F.greatest("width", "measure_start"))).otherwise(F.concat(dims, measures))
    group = F.transform(F.slice(cells, F.lit(1), F.get(F.col("spans"), F.col("step") - 1)), strip)
    flat = F.when(F.col("format") == "txt", F.transform(cells, unquote)).otherwise(cells)
    return (
        F.when(F.col("kind") != "grouped", flat)
        .when(F.col("step") < 0, detail)
        .when(F.col("step") > 0, F.transform(group, empty_to_null))
    )


def _marker(r: int) -> Column:
    """What a row says about level ``r``: its own values, a reset from a shallower level, or nothing."""
    step = F.col("step")
    return F.when((step > 0) & (step <= r), F.struct(F.when(step == r, F.col("own")).alias("group")))


def _source(depth: int, own: Column) -> Column:
    span = lambda r: F.coalesce(F.get(F.col("spans"), F.lit(r - 1)), F.lit(0))
    missing = lambda r: F.array_repeat(F.lit(None).cast("string"), span(r))
    levels = [F.coalesce(F.col(f"level_{r}")["group"], missing(r)) for r in range(1, depth + 1)]
    return F.concat(*levels, own)


def row_counts(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """Per file, how many rows fell into each class, and how many flat rows were padded or cut."""
    return tagged_counts(classify_rows(table_rows(rows, layout)))


def to_columns(flat: DataFrame, names: list[str], keep: tuple[str, ...] = ("path", "line_no")) -> DataFrame:
    """One string column per name, NULL where a file has no such column."""
    value = lambda n: F.get(F.col("values"), F.array_position(F.col("names"), n).cast("int") - 1)
    return flat.select(*keep, *[value(n).alias(n) for n in names])


def to_cells(flat: DataFrame) -> DataFrame:
    """Long form ``(path, block, line_no, ord, name, value)`` for files with different columns."""
    pairs = F.posexplode(F.arrays_zip(F.col("names").alias("name"), F.col("values").alias("value")))
    return flat.select("path", "block", "line_no", pairs.alias("ord", "cell")).select(
        "path", "block", "line_no", "ord", "cell.name", "cell.value"
    )

