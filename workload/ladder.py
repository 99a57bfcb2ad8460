"""Grouped reports: flattening, resets, ragged rows, row classes, mixed layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderline.functions.casts import to_date, to_float, to_int
from ladderline.operators.flatten import flatten, flatten_columns, row_counts, to_cells
from ladderline.operators.layout import detect_layout, layouts_by_file
from ladderline.plans.ordered import with_blocks
from ladderline.sources.text_reports import as_rows
from workload.base import day_text, fixed_lines, line_of, money_text, query, table, written

# The rendered lines are written to a table first: they stand for the report files a scan would read.
# Positions leave room for every order key below its group's subtotal, so no global sort is needed.
GROUP_SHIFT = 40


def _position(group: Column, key: Column | int) -> Column:
    low = F.lit(key) if isinstance(key, int) else key
    return F.shiftleft(group.cast("bigint"), GROUP_SHIFT) + low.cast("bigint")


def _status_no() -> Column:
    return F.instr(F.lit("FOP"), F.col("o_orderstatus"))


def _priority_no() -> Column:
    return F.left("o_orderpriority", F.lit(1)).cast("int")


ORDER_HEAD = [
    "Отчёт по заказам",
    "Параметры:\tПериод: 01.01.1995 - 31.12.2001",
    "status\t\t\t\ttotal",
    "priority\trank\t\t\t",
    "order_key\tcustomer\tday\tnote\t",
]


def order_lines(orders: DataFrame, path: Column, withheld: Column | None = None, extra: Column | None = None) -> DataFrame:
    """Orders as grouped reports: status, then priority and rank, then the order.

    ``withheld`` leaves out priority subtotals, ``extra`` adds a surplus cell to order lines."""
    o = orders.withColumn("path", path)
    groups = o.select("path", "o_orderstatus", "o_orderpriority").distinct()
    statuses = groups.select("path", "o_orderstatus").distinct()
    status_lines = statuses.select(
        "path", _position(_status_no() * 8, 0).alias("line_no"),
        line_of(F.concat(F.lit(" "), F.col("o_orderstatus")), "", "", "", "1,00").alias("line"),
    )
    shown = groups.filter(~withheld) if withheld is not None else groups
    priority_lines = shown.select(
        "path", _position(_status_no() * 8 + _priority_no(), 0).alias("line_no"),
        line_of(F.col("o_orderpriority"), _priority_no(), "", "", "1,00").alias("line"),
    )
    note = F.when(F.col("o_custkey") > 500, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    cells = [F.col("o_orderkey"), F.col("o_custkey"), day_text(F.col("o_orderdate")), note, money_text(F.col("o_totalprice"))]
    line = line_of(*cells)
    if extra is not None:
        line = F.when(extra, F.concat(line, F.lit("\tsurplus"))).otherwise(line)
    details = o.select(
        "path", _position(_status_no() * 8 + _priority_no(), F.col("o_orderkey") + 1).alias("line_no"), line.alias("line")
    )
    head = fixed_lines(o.select("path").distinct(), ORDER_HEAD)
    total = o.select("path").distinct().select("path", _position(F.lit(99), 0).alias("line_no"), F.lit("Итого\t\t\t\t9,00").alias("line"))
    lines = head.unionByName(status_lines).unionByName(priority_lines).unionByName(details).unionByName(total)
    return with_blocks(lines)


def _order_year() -> Column:
    return F.concat(F.year("o_orderdate").cast("string"), F.lit(".txt"))


def _typed_orders(rows: DataFrame) -> DataFrame:
    names = ["status", "priority", "rank", "order_key", "customer", "day", "note", "total"]
    wide = flatten_columns(rows, detect_layout(rows), names, ("path",))
    typed = {"rank": to_int, "order_key": to_int, "customer": to_int, "day": to_date, "total": to_float}
    return wide.select("path", *[typed.get(n, lambda c: c)(F.col(n)).alias(n) for n in names])


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
ORDER_SQL = """
    o_orderstatus AS status, {priority} AS priority, {rank} AS rank, o_orderkey AS order_key,
    o_custkey AS customer, CAST(o_orderdate AS DATE) AS day,
    CASE WHEN o_custkey > 500 THEN 'c' || CAST(o_custkey AS VARCHAR) END AS note,
    CAST(round(o_totalprice * 100) AS BIGINT) / 100.0::DOUBLE AS total
"""
PLAIN_ORDER = ORDER_SQL.format(priority="o_orderpriority", rank="CAST(left(o_orderpriority, 1) AS BIGINT)")


@query(f"SELECT CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS path, {PLAIN_ORDER} FROM orders")
def ladder_2level(spark, sf_dir):
    """Yearly order reports, flattened and typed: every order with its status and priority."""
    rows = as_rows(written(order_lines(table(spark, sf_dir, "orders", *ORDER_COLUMNS), _order_year())))
    return _typed_orders(rows)


ITEM_HEAD = [
    "flag\t\t\t\tquantity\tprice",
    "status\tmode\t\t\t\t",
    "priority\tclass\tlane\t\t\t",
    "order_key\tline\tpart\tsupplier\t\t",
]


def item_lines(items: DataFrame, path: Column) -> DataFrame:
    """Line items under three group levels: flag, status and mode, priority with class and lane."""
    flag = F.instr(F.lit("ANR"), F.col("l_returnflag"))
    status = F.instr(F.lit("FO"), F.col("l_linestatus"))
    rank = F.left("o_orderpriority", F.lit(1)).cast("int")
    i = items.withColumn("path", path)
    groups = i.select("path", "l_returnflag", "l_linestatus", "o_orderpriority").distinct()
    by_flag = groups.select("path", "l_returnflag").distinct().select(
        "path", _position(flag * 64, 0).alias("line_no"), line_of(F.col("l_returnflag"), "", "", "", "0", "0").alias("line")
    )
    by_status = groups.select("path", "l_returnflag", "l_linestatus").distinct().select(
        "path", _position(flag * 64 + status * 16, 0).alias("line_no"),
        line_of(F.col("l_linestatus"), F.concat(F.lit("m"), status), "", "", "0", "0").alias("line"),
    )
    by_priority = groups.select(
        "path", _position(flag * 64 + status * 16 + rank, 0).alias("line_no"),
        line_of(F.col("o_orderpriority"), rank, F.concat(F.lit("lane "), rank), "", "0", "0").alias("line"),
    )
    details = i.select(
        "path", _position(flag * 64 + status * 16 + rank, F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"),
        line_of(
            F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
            F.col("l_quantity").cast("bigint"), money_text(F.col("l_extendedprice"), "\xa0"),
        ).alias("line"),
    )
    head = fixed_lines(i.select("path").distinct(), ITEM_HEAD)
    return head.unionByName(by_flag).unionByName(by_status).unionByName(by_priority).unionByName(details)


def _items(spark, sf_dir) -> DataFrame:
    items = table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _typed_items(rows: DataFrame) -> DataFrame:
    texts = ["flag", "status", "mode", "priority", "lane"]
    whole = ["class", "order_key", "line", "part", "supplier", "quantity"]
    wide = flatten_columns(rows, detect_layout(rows), [*texts, *whole, "price"], ("path",))
    return wide.select("path", *texts, *[to_int(F.col(n)).alias(n) for n in whole], to_float(F.col("price")).alias("price"))


ITEM_SQL = """
SELECT {path} AS path, l_returnflag AS flag, l_linestatus AS status,
    'm' || CASE l_linestatus WHEN 'F' THEN '1' ELSE '2' END AS mode, o_orderpriority AS priority,
    'lane ' || left(o_orderpriority, 1) AS lane, CAST(left(o_orderpriority, 1) AS BIGINT) AS class,
    l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part, l_suppkey AS supplier,
    CAST(l_quantity AS BIGINT) AS quantity, CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0::DOUBLE AS price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


@query(ITEM_SQL.format(path="CAST(year(l_shipdate) AS VARCHAR)"))
def ladder_3level(spark, sf_dir):
    """Line items of each year under a four-line staircase header."""
    rows = as_rows(written(with_blocks(item_lines(_items(spark, sf_dir), F.year("l_shipdate").cast("string")))))
    return _typed_items(rows)


@query(ITEM_SQL.format(path="'all items'"))
def ladder_two_phase(spark, sf_dir):
    """All line items as one single report: group values cross many block borders."""
    rows = as_rows(written(with_blocks(item_lines(_items(spark, sf_dir), F.lit("all items")), 4096)))
    return _typed_items(rows)


def _is_withheld() -> Column:
    return F.substring("path", 4, 1).cast("int") % 5 + 1 == _priority_no()


RESET_SQL = f"""
WITH o AS (
    SELECT *, CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS path, CAST(left(o_orderpriority, 1) AS INTEGER) AS pno
    FROM orders
), shown AS (
    SELECT DISTINCT path, o_orderstatus AS st, pno, o_orderpriority AS pr FROM o
    WHERE CAST(substr(path, 4, 1) AS INTEGER) % 5 + 1 <> pno
), latest AS (
    SELECT k.path, k.o_orderstatus, k.pno, max(s.pno) AS seen, arg_max(s.pr, s.pno) AS seen_name
    FROM (SELECT DISTINCT path, o_orderstatus, pno FROM o) k
    LEFT JOIN shown s ON s.path = k.path AND s.st = k.o_orderstatus AND s.pno <= k.pno
    GROUP BY ALL
)
SELECT o.path, {ORDER_SQL.format(priority="seen_name", rank="CAST(coalesce(seen, 0) AS BIGINT)")}
FROM o JOIN latest ON latest.path = o.path AND latest.o_orderstatus = o.o_orderstatus AND latest.pno = o.pno
""".replace("o_orderstatus AS status", "o.o_orderstatus AS status")


@query(RESET_SQL)
def ladder_reset(spark, sf_dir):
    """A status subtotal clears the priority: orders whose priority subtotal is missing take the one before
    it in the same status, or none."""
    orders = table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    rows = as_rows(written(order_lines(orders, _order_year(), withheld=_is_withheld())))
    return _typed_orders(rows)


@query(f"""
SELECT CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS path, {PLAIN_ORDER} FROM orders WHERE o_totalprice <= 250000
""")
def ladder_ragged(spark, sf_dir):
    """Order lines with a surplus cell (the expensive orders) are skipped, all others stay."""
    orders = table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    rows = as_rows(written(order_lines(orders, _order_year(), extra=F.col("o_totalprice") > 250000)))
    return _typed_orders(rows)


@query("""
WITH o AS (SELECT *, CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS path FROM orders)
SELECT path, count(*) FILTER (o_totalprice <= 250000) AS detail_rows,
    count(DISTINCT o_orderstatus) + count(DISTINCT o_orderstatus || o_orderpriority) AS subtotal_rows,
    count(*) FILTER (o_totalprice > 250000) AS ragged_rows, CAST(0 AS BIGINT) AS other_rows
FROM o GROUP BY path
""")
def row_classes(spark, sf_dir):
    """How many detail, subtotal, ragged and other rows each report has."""
    orders = table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    rows = as_rows(written(order_lines(orders, _order_year(), extra=F.col("o_totalprice") > 250000)))
    return row_counts(rows, detect_layout(rows)).drop("padded_rows", "cut_rows")


@query("""
SELECT CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS path, 'grouped' AS kind, CAST(5 AS BIGINT) AS width,
    CAST(4 AS BIGINT) AS measure_start, CAST(3 AS BIGINT) AS height, '1,2' AS spans,
    'status,priority,rank,order_key,customer,day,note,total' AS names
FROM orders GROUP BY ALL
UNION ALL SELECT DISTINCT CAST(year(l_shipdate) AS VARCHAR), 'grouped', 6, 4, 4, '1,2,3',
    'flag,status,mode,priority,class,lane,order_key,line,part,supplier,quantity,price'
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def layout_detection(spark, sf_dir):
    """Layouts of order and line-item reports found in one pass over both."""
    orders = order_lines(table(spark, sf_dir, "orders", *ORDER_COLUMNS), _order_year())
    items = with_blocks(item_lines(_items(spark, sf_dir), F.year("l_shipdate").cast("string")))
    found = layouts_by_file(detect_layout(as_rows(written(orders.unionByName(items)))))
    whole = [F.col(c).cast("bigint").alias(c) for c in ("width", "measure_start", "height")]
    listed = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("spans", "names")]
    return found.select("path", "kind", *whole, *listed)


@query("""
WITH c AS (
    SELECT CAST(year(o_orderdate) AS VARCHAR) || '.txt' AS path, 'order_key' AS name, CAST(o_orderkey AS VARCHAR) AS value
    FROM orders
    UNION ALL SELECT CAST(year(o_orderdate) AS VARCHAR) || '.txt', 'status', o_orderstatus FROM orders
    UNION ALL SELECT CAST(year(o_orderdate) AS VARCHAR) || '.txt', 'priority', o_orderpriority FROM orders
    UNION ALL SELECT CAST(year(l_shipdate) AS VARCHAR), 'order_key', CAST(l_orderkey AS VARCHAR)
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT CAST(year(l_shipdate) AS VARCHAR), 'status', l_linestatus
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT CAST(year(l_shipdate) AS VARCHAR), 'priority', o_orderpriority
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)
SELECT path, name, value, count(*) AS n FROM c GROUP BY ALL
""")
def ladder_mixed(spark, sf_dir):
    """Reports with different layouts flattened together, as long cells."""
    orders = order_lines(table(spark, sf_dir, "orders", *ORDER_COLUMNS), _order_year())
    items = with_blocks(item_lines(_items(spark, sf_dir), F.year("l_shipdate").cast("string")))
    rows = as_rows(written(orders.unionByName(items)))
    cells = to_cells(flatten(rows, detect_layout(rows)))
    shared = cells.filter(F.col("name").isin("order_key", "status", "priority"))
    return shared.groupBy("path", "name", "value").agg(F.count(F.lit(1)).alias("n"))
