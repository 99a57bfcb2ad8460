"""Spreadsheet sources: cells, merged areas, dense grids, tables, rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderline.functions.casts import to_float, to_int
from ladderline.operators.flatten import flatten_columns
from ladderline.operators.layout import detect_layout, header_heights
from ladderline.operators.periods import header_texts, report_periods
from ladderline.operators.quality import reconcile
from ladderline.session import stage
from ladderline.sources.sheets import Sheets, densify, parse_sheet_lines, parse_sheets, sheet_rows
from ladderline.sources.text_reports import as_rows, split_lines
from workload.base import query, table

# Parts are numbered densely; so many rows make one sheet file.
SHEET_ROWS = 500
FIRST_ROW = 4
SIGNATURE = "4D4F5843454C000000000000EFBBBF"


def _cell(text: Column, number: int) -> Column:
    """A cell record; every other one has a details list before its text."""
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    content = F.when(text == "", F.lit("{1,0}")).otherwise(F.concat(F.lit('{1,1,{"#",'), quoted, F.lit("}}")))
    before = '{"#",4d6f-1,{2}},' if number % 2 else ""
    return F.concat(F.lit("{16,%d,%s" % (number, before)), content, F.lit(",0}"))


def _row(cells: list[Column], row: Column) -> Column:
    """A row's records: cells with their columns in between, then the row marker and formats."""
    parts: list[Column] = [_cell(cells[0], 0)]
    for i, text in enumerate(cells[1:], 1):
        parts += [F.lit(str(i)), _cell(text, i)]
    return F.concat_ws(",", *parts, (row + 1).cast("string"), F.lit("0"), F.lit("7"))


def _parts(spark, sf_dir) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    number = F.expr(f"p_partkey div {SHEET_ROWS}")
    return parts.select(
        "*",
        F.concat(F.lit("parts "), number.cast("string"), F.lit(".mxl")).alias("path"),
        (F.col("p_partkey") - number * SHEET_ROWS + FIRST_ROW).alias("row"),
    )


def _part_cells() -> list[Column]:
    quoted_type = F.concat(F.lit('"'), F.col("p_type"), F.lit('", {x}'))
    brand = F.when(F.col("p_size") > 10, F.col("p_brand")).otherwise("")
    return [F.col("p_partkey").cast("string"), F.col("p_name"), brand, quoted_type, F.col("p_size").cast("string")]


def _sheet_files(spark, sf_dir) -> DataFrame:
    """Parts as sheet files: a title, a period line, a header over two rows with merged areas, part rows.

    A file is bounded to ``SHEET_ROWS`` parts, so gathering its rows is bounded too."""
    parts = _parts(spark, sf_dir)
    body = parts.select("path", F.col("row"), _row(_part_cells(), F.col("row")).alias("text"))
    texts = lambda *cells: [F.lit(c) for c in cells]
    head_rows = [
        (0, ["Отчёт"]), (1, ["Параметры:", "Период: 01.03.2024 - 31.03.2024"]),
        (2, ["part", "", "", "", "size"]), (3, ["", "", "", "", ""]),
    ]
    entries = [F.struct(F.lit(r).cast("bigint").alias("row"), _row(texts(*c), F.lit(r)).alias("text")) for r, c in head_rows]
    head = parts.select("path").distinct().select("path", F.inline(F.array(*entries)))
    lines = F.array_sort(F.collect_list(F.struct("row", "text")))
    joined = head.unionByName(body).groupBy("path").agg(F.array_join(F.transform(lines, lambda x: x["text"]), ",\r\n").alias("rows"))
    start = '{8,1,12,{"ru",{3,0}},{0,0},{16,9,{1,1,{"#","page"}},0},0,'
    end = ',{2,{0,2,3,2,0},{4,2,4,3,0}},{16,3,{1,1,{"#","behind"}},0},5}'
    text = F.concat(F.lit(start), F.col("rows"), F.lit(end))
    spread = joined.repartition(joined.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.select("path", F.concat(F.unhex(F.lit(SIGNATURE)), F.encode(text, "UTF-8")).alias("content"))


def _sheets(spark, sf_dir) -> Sheets:
    return parse_sheets(_sheet_files(spark, sf_dir))


PART_SQL = f"""
WITH p AS (
    SELECT *, 'parts ' || CAST(p_partkey // {SHEET_ROWS} AS VARCHAR) || '.mxl' AS path,
        p_partkey % {SHEET_ROWS} + {FIRST_ROW} AS row, CASE WHEN p_size > 10 THEN p_brand ELSE '' END AS brand
    FROM part
), f AS (SELECT DISTINCT path FROM p)
"""
CELL_SQL = PART_SQL + """, c AS (
    SELECT path, row, CAST(0 AS BIGINT) AS col, CAST(p_partkey AS VARCHAR) AS text FROM p
    UNION ALL SELECT path, row, 1, p_name FROM p
    UNION ALL SELECT path, row, 2, brand FROM p
    UNION ALL SELECT path, row, 3, '"' || p_type || '", {x}' FROM p
    UNION ALL SELECT path, row, 4, CAST(p_size AS VARCHAR) FROM p
    UNION ALL SELECT path, r, k, t FROM f, (VALUES (0, 0, 'Отчёт'), (1, 0, 'Параметры:'), (1, 1, 'Период: 01.03.2024 - 31.03.2024'),
        (2, 0, 'part'), (2, 1, ''), (2, 2, ''), (2, 3, ''), (2, 4, 'size'),
        (3, 0, ''), (3, 1, ''), (3, 2, ''), (3, 3, ''), (3, 4, '')) h(r, k, t)
)
"""


@query(CELL_SQL + "SELECT path, row, col, text FROM c")
def sheet_cells(spark, sf_dir):
    """Every cell of every sheet file with its position."""
    return _sheets(spark, sf_dir).cells


@query(CELL_SQL + """
SELECT path, row, string_agg(text, '|' ORDER BY col) || CASE row WHEN 0 THEN '||||' WHEN 1 THEN '|||' ELSE '' END AS line
FROM c GROUP BY path, row
""")
def sheet_dense(spark, sf_dir):
    """Dense rows, all as wide as their sheet, blank inner rows included."""
    dense = densify(_sheets(spark, sf_dir).cells)
    return dense.select("path", "row", F.array_join("cells", "|").alias("line"))


@query(PART_SQL + """
SELECT path, CAST(r1 AS BIGINT) AS r1, CAST(c1 AS BIGINT) AS c1, CAST(r2 AS BIGINT) AS r2, CAST(c2 AS BIGINT) AS c2
FROM f, (VALUES (2, 0, 2, 3), (2, 4, 3, 4)) m(r1, c1, r2, c2)
""")
def sheet_merges(spark, sf_dir):
    """Merged areas of every sheet file."""
    return _sheets(spark, sf_dir).merges


@query(PART_SQL + """
SELECT path, p_partkey AS part, CAST(p_size AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS start_raw FROM p WHERE false
UNION ALL SELECT path, p_partkey, p_size, '01.03.2024' FROM p
""")
def sheet_table(spark, sf_dir):
    """Sheets as tables: rows by header name with the period of the title block.

    The first table row that reaches the third column is the header; the blank second header row goes."""
    rows = sheet_rows(_sheets(spark, sf_dir).cells)
    wide = flatten_columns(rows, detect_layout(rows), ["part", "size"], ("path",))
    periods = report_periods(header_texts(rows), F.lit("sale_date")).select("path", "start_raw")
    typed = wide.select("path", to_int(F.col("part")).alias("part"), to_int(F.col("size")).alias("size"))
    return typed.join(periods, "path")


LINES_PER_ROW = 32


@query("""
SELECT 'all parts.mxl' AS path, CAST(p_partkey + 1 AS BIGINT) AS row, CAST(c AS BIGINT) AS col,
    CASE c WHEN 0 THEN CAST(p_partkey AS VARCHAR) WHEN 1 THEN p_name || chr(10) || '"' || p_brand || '"' || chr(13) || chr(10) || '{16,0,'
        ELSE CASE WHEN p_size > 10 THEN p_type ELSE '' END END AS text
FROM part, (VALUES (0), (1), (2)) v(c)
UNION ALL SELECT 'all parts.mxl', 0, c, t FROM (VALUES (0, 'Отчёт'), (1, 'all'), (2, 'parts')) h(c, t)
""")
def sheet_split(spark, sf_dir):
    """All parts as one sheet that comes line by line, as a split scan gives it, and is never one value.

    Texts of cells go on over several lines, with quotes and braces in them."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size")
    named = F.concat("p_name", F.lit('\n"'), "p_brand", F.lit('"\r\n{16,0,'))
    cells = [F.col("p_partkey").cast("string"), named, F.when(F.col("p_size") > 10, F.col("p_type")).otherwise("")]
    number = F.col("p_partkey") + 1
    body = parts.select(number.alias("row"), F.concat(_row(cells, number), F.lit(",")).alias("text"))
    head = _row([F.lit("Отчёт"), F.lit("all"), F.lit("parts")], F.lit(0))
    first = F.concat(F.unhex(F.lit(SIGNATURE)).cast("string"), F.lit('{8,1,12,{"ru",{3,0}},{0,0},{16,9,{1,1,{"#","page"}},0},0,\n'), head, F.lit(","))
    edges = parts.agg((F.max("p_partkey") + 2).alias("last")).select(
        F.inline(F.array(
            F.struct(F.lit(0).cast("bigint").alias("row"), first.alias("text")),
            F.struct(F.col("last").alias("row"), F.lit("{0},5}").alias("text")),
        ))
    )
    cut = edges.unionByName(body).select("row", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    line_no = F.col("row") * LINES_PER_ROW + F.col("i")
    blocked = cut.select(F.lit("all parts.mxl").alias("path"), F.expr("row div 1000").alias("block"), line_no.alias("line_no"), "line")
    return parse_sheet_lines(blocked).cells


@query("""
SELECT p_brand AS path, CAST(min(h) AS INTEGER) AS merge_height
FROM (SELECT p_brand, p_size AS c1, p_size + 1 AS c2, p_partkey % 2 AS r1,
        CASE WHEN p_size > 35 THEN 3 ELSE p_partkey % 2 + 1 + CAST(substr(p_brand, 7) AS INTEGER) % 3 END AS r2,
        r2 - r1 + 1 AS h FROM part)
WHERE r1 = 0 AND r2 > r1 AND c1 >= 20 AND c2 < 45
GROUP BY p_brand HAVING min(h) = max(h)
""")
def header_height(spark, sf_dir):
    """Header heights from merged areas: only those over the measures count, and they must agree."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    r1 = F.col("p_partkey") % 2
    r2 = F.when(F.col("p_size") > 35, 3).otherwise(r1 + 1 + F.substring("p_brand", 7, 3).cast("int") % 3)
    merges = parts.select(
        F.col("p_brand").alias("path"), r1.alias("r1"), F.col("p_size").alias("c1"), r2.alias("r2"), (F.col("p_size") + 1).alias("c2")
    )
    tables = parts.select(
        F.col("p_brand").alias("path"), F.lit(0).alias("table_row"), F.lit(20).alias("measure_start"), F.lit(45).alias("width")
    ).distinct()
    return header_heights(tables, merges)


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS path, CASE s_nationkey % 5 WHEN 0 THEN 'not a sheet: signature missing'
    WHEN 1 THEN 'unfinished structure' WHEN 2 THEN 'column does not increase' WHEN 3 THEN 'expected a position after a cell' END AS reason
FROM supplier WHERE s_nationkey % 5 <> 4
""")
def sheet_rejects(spark, sf_dir):
    """Damaged sheet files are listed with a reason, the sound ones are read."""
    suppliers = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    kind = F.col("s_nationkey") % 5
    name = _cell(F.col("s_name"), 0)
    good = F.concat(F.lit("{8,"), name, F.lit(",1,"), _cell(F.lit("b"), 1), F.lit(",2,"), _cell(F.lit("c"), 2), F.lit(",1,0}"))
    text = (
        F.when(kind == 1, F.concat(F.lit("{8,"), name, F.lit(",1,0")))
        .when(kind == 2, F.concat(F.lit("{8,"), name, F.lit(",2,"), _cell(F.lit("b"), 1), F.lit(",1,"), _cell(F.lit("c"), 2), F.lit(",1,0}")))
        .when(kind == 3, F.concat(F.lit("{8,"), name, F.lit(',"x",1,0}')))
        .otherwise(good)
    )
    content = F.when(kind == 0, F.encode(F.col("s_name"), "UTF-8")).otherwise(F.concat(F.unhex(F.lit(SIGNATURE)), F.encode(text, "UTF-8")))
    return parse_sheets(suppliers.select(F.col("s_suppkey").cast("string").alias("path"), content.alias("content"))).rejects


@query(PART_SQL + """
SELECT path, CAST(p_partkey AS VARCHAR) AS part, CAST(p_size AS VARCHAR) AS size, CAST(1 AS BIGINT) AS surplus
FROM p WHERE p_type = 'PROMO'
""")
def reconcile_exports(spark, sf_dir):
    """The sheet export against a text export of the same parts that lacks the PROMO ones."""
    sheet = sheet_rows(_sheets(spark, sf_dir).cells)
    from_sheet = flatten_columns(sheet, detect_layout(sheet), ["part", "size"], ("path",))
    parts = _parts(spark, sf_dir).filter(F.col("p_type") != "PROMO")
    lines = parts.select("path", F.concat_ws("\t", *_part_cells()).alias("line"), F.col("row"))
    gathered = F.array_sort(F.collect_list(F.struct("row", "line")))
    texts = lines.groupBy("path").agg(
        F.concat(F.lit("Отчёт\npart\t\t\t\tsize\n"), F.array_join(F.transform(gathered, lambda r: r["line"]), "\n")).alias("text")
    )
    text_rows = as_rows(split_lines(texts))
    from_text = flatten_columns(text_rows, detect_layout(text_rows), ["part", "size"], ("path",))
    return reconcile(from_sheet, from_text)


def _grouped_sheet_files(spark, sf_dir) -> DataFrame:
    """Parts under brand and under type with size class, as sheets whose header is three rows high.

    Only the merged areas over the measures say so: the first group rows have no measure, so by its lines the header
    would go on. A file is bounded to ``SHEET_ROWS`` parts."""
    number = F.expr(f"p_partkey div {SHEET_ROWS}").cast("string")
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size").select(
        "*", F.concat(F.lit("groups "), number, F.lit(".mxl")).alias("path"), F.when(F.col("p_size") > 25, "big").otherwise("small").alias("class")
    )
    empty = F.lit("")
    note = F.when(F.col("p_size") % 3 == 0, "").otherwise(F.concat(F.lit("n"), F.col("p_size").cast("string")))
    key = lambda *cols: F.array(*[F.col(c).cast("string") if isinstance(c, str) else c for c in cols])
    brands = parts.select("path", "p_brand").distinct().select("path", key("p_brand").alias("key"), F.array("p_brand", empty, empty, empty, empty).alias("cells"))
    types = parts.groupBy("path", "p_brand", "p_type", "class").agg(F.sum("p_size").cast("string").alias("size")).select(
        "path", key("p_brand", "p_type", "class").alias("key"), F.array("p_type", "class", empty, "size", empty).alias("cells")
    )
    number_text = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    price = F.concat(F.col("p_partkey").cast("string"), F.lit(",5"))
    details = parts.select(
        "path", key("p_brand", "p_type", "class", number_text).alias("key"),
        F.array(F.col("p_partkey").cast("string"), note, F.col("p_name"), F.col("p_size").cast("string"), price).alias("cells"),
    )
    order = Window.partitionBy("path").orderBy("key")
    numbered = brands.unionByName(types).unionByName(details).withColumn("row", (F.row_number().over(order) + 4).cast("bigint"))
    body = numbered.select("path", "row", _row([F.get("cells", F.lit(i)) for i in range(5)], F.col("row")).alias("text"))
    head_rows = [
        ["Отчёт"], ["Параметры:", "Период: 01.03.2024 - 31.03.2024"], ["brand", "", "", "size", "price"],
        ["type", "class", "", "", ""], ["part", "note", "name", "", ""],
    ]
    entries = [F.struct(F.lit(r).cast("bigint").alias("row"), _row([F.lit(c) for c in cells], F.lit(r)).alias("text")) for r, cells in enumerate(head_rows)]
    head = parts.select("path").distinct().select("path", F.inline(F.array(*entries)))
    lines = F.array_sort(F.collect_list(F.struct("row", "text")))
    joined = head.unionByName(body).groupBy("path").agg(F.array_join(F.transform(lines, lambda x: x["text"]), ",\r\n").alias("rows"))
    text = F.concat(F.lit("{8,1,12,"), F.col("rows"), F.lit(",{2,{3,2,3,4,0},{4,2,4,4,0}},5}"))
    spread = joined.repartition(joined.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.select("path", F.concat(F.unhex(F.lit(SIGNATURE)), F.encode(text, "UTF-8")).alias("content"))


@query(f"""
SELECT 'groups ' || CAST(p_partkey // {SHEET_ROWS} AS VARCHAR) || '.mxl' AS path, p_brand AS brand, p_type AS type,
    CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END AS class, CAST(p_partkey AS BIGINT) AS part,
    CASE WHEN p_size % 3 <> 0 THEN 'n' || CAST(p_size AS VARCHAR) END AS note, p_name AS name, CAST(p_size AS BIGINT) AS size,
    p_partkey + 0.5::DOUBLE AS price
FROM part
""")
def sheet_grouped(spark, sf_dir):
    """Grouped sheets flattened to typed rows; merged areas give the height of their header."""
    sheets = parse_sheets(_grouped_sheet_files(spark, sf_dir))
    rows = stage(sheet_rows(sheets.cells), "sheet-rows")
    names = ["brand", "type", "class", "part", "note", "name", "size", "price"]
    wide = flatten_columns(rows, detect_layout(rows, sheets.merges), names, ("path",))
    typed = {"part": to_int, "size": to_int, "price": to_float}
    return wide.select("path", *[typed.get(n, lambda c: c)(F.col(n)).alias(n) for n in names])
