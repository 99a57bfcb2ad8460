"""Reporting periods of report headers (H1-H4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.functions.periods import missing_bounds
from ladderline.operators.periods import header_periods, header_texts, report_periods
from ladderline.plans.ordered import with_blocks
from ladderline.session import stage
from ladderline.sources.text_reports import as_rows
from workload.base import query, table


def _customer_headers(spark, sf_dir) -> DataFrame:
    """One report per customer and priority: a title block in one of five forms and a first table line."""
    orders = table(spark, sf_dir, "orders", "o_custkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    reports = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last")
    )
    day = lambda c: F.date_format(c, "dd.MM.yyyy")
    late = lambda c: F.date_format(c, "dd.MM.yyyy 23:59:59")
    early = lambda c: F.date_format(c, "dd.MM.yyyy 0:00:00")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    form = F.left("o_orderpriority", F.lit(1))
    title = (
        F.when(form == "1", F.array(text("ПАРАМЕТРЫ:\tПериод: ", day("first"), " - ", day("last"))))
        .when(form == "2", F.array(F.lit("Параметры:\tСклад: Север"), text("Период: ", early("first"), "\xa0-", late("last"))))
        .when(form == "3", F.array(text("Начало периода: ", early("first")), F.lit(" "), text("\tКонец периода: ", late("last"))))
        .when(form == "4", F.array(text("параметры:\tНа дату: ", early("first")), text("Отбор: ", F.lit("нет"))))
        .otherwise(F.array(text("Параметры:\tНа дату: ", day("last"))))
    )
    body = F.concat(F.array(F.lit("Отчёт"), F.lit("")), title, F.array(F.lit(""), F.lit("Дата\tТовар\tСумма")))
    path = F.concat_ws("/", F.col("o_custkey").cast("string"), F.concat(F.col("o_orderpriority"), F.lit(".txt")))
    lines = reports.select(path.alias("path"), F.posexplode(body).alias("line_no", "line"))
    return lines.select("path", F.lit(0).cast("bigint").alias("block"), F.col("line_no").cast("bigint").alias("line_no"), "line")


PERIOD_SQL = """
WITH r AS (
    SELECT CAST(o_custkey AS VARCHAR) || '/' || o_orderpriority || '.txt' AS path, left(o_orderpriority, 1) AS form,
        min(o_orderdate) AS a, max(o_orderdate) AS b
    FROM orders GROUP BY o_custkey, o_orderpriority
)
"""


@query(PERIOD_SQL + """
SELECT path,
    CASE WHEN form = '5' THEN strftime(b, '%d.%m.%Y') ELSE strftime(a, '%d.%m.%Y') END
        || CASE WHEN form IN ('2', '3', '4') THEN ' 0:00:00' ELSE '' END AS start_raw,
    CASE WHEN form IN ('1', '2', '3') THEN strftime(b, '%d.%m.%Y') END
        || CASE WHEN form IN ('2', '3') THEN ' 23:59:59' ELSE '' END AS end_raw,
    CASE form WHEN '1' THEN 1 WHEN '2' THEN 1 WHEN '3' THEN 2 ELSE 3 END AS pattern
FROM r
""")
def period_extract(spark, sf_dir):
    """The period text of every header, in all spellings."""
    headers = header_texts(as_rows(_customer_headers(spark, sf_dir)))
    return report_periods(headers, F.lit("sale_date")).select("path", "start_raw", "end_raw", "pattern")


@query(PERIOD_SQL + """
SELECT path, form IN ('2', '3', '4') AS start_has_time,
    CASE WHEN form = '5' THEN b ELSE a END AS start,
    CASE WHEN form = '1' THEN b WHEN form IN ('2', '3') THEN b + INTERVAL 86399 SECOND
        WHEN form = '4' THEN a + INTERVAL 86399 SECOND ELSE b END AS "end"
FROM r
""")
def period_complete(spark, sf_dir):
    """Start and end of every report; a missing end is completed from the start."""
    headers = header_texts(as_rows(_customer_headers(spark, sf_dir)))
    return report_periods(headers, F.lit("sale_date")).select("path", "start", "start_has_time", "end")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_returnflag <> 'N' THEN '' WHEN l_tax = 0 AND l_discount = 0 THEN 'start_period,end_period'
        WHEN l_tax = 0 THEN 'start_period' ELSE '' END AS missing
FROM lineitem
""")
def period_missing(spark, sf_dir):
    """Which required bounds a load lacks; only the event time ``period`` requires them."""
    items = table(spark, sf_dir, "lineitem")
    event_time = F.when(F.col("l_returnflag") == "N", " Period").when(F.col("l_returnflag") == "A", "sale_date")
    start = F.when(F.col("l_tax") != 0, F.col("l_shipdate"))
    end = F.when(F.col("l_discount") != 0, F.col("l_shipdate"))
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array_join(missing_bounds(event_time, start, end), ",").alias("missing"),
    )


@query("""
WITH l AS (
    SELECT l_returnflag AS path, l_orderkey * 8 + l_linenumber AS k, l_orderkey % 89 = 7 AND l_linenumber = 1 AS dated,
        l_orderkey % 97 = 5 AS named, min(l_shipdate) AS day FROM lineitem GROUP BY ALL
), p AS (SELECT path, min(k) AS first FROM l WHERE path <> 'A' AND named AND NOT dated GROUP BY path),
d AS (SELECT l.path, arg_min(day, k) AS day FROM l LEFT JOIN p USING (path) WHERE dated AND (l.path = 'A' OR k > first) GROUP BY l.path)
SELECT f.path, strftime(day, '%d.%m.%Y') AS start_raw, strftime(day + INTERVAL 30 DAY, '%d.%m.%Y') AS end_raw,
    CASE WHEN day IS NOT NULL THEN CASE WHEN f.path = 'A' THEN 2 ELSE 1 END END::INTEGER AS pattern
FROM (SELECT DISTINCT path FROM l) f LEFT JOIN d USING (path)
""")
def period_long_preamble(spark, sf_dir):
    """The period of reports whose titles have as many lines as there are line items, many of them with dates."""
    items = table(spark, sf_dir, "lineitem", "l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate")
    dated = (F.col("l_orderkey") % 89 == 7) & (F.col("l_linenumber") == 1)
    keyed = items.groupBy(
        F.col("l_returnflag").alias("path"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line_no"),
        dated.alias("dated"), (F.col("l_orderkey") % 97 == 5).alias("named"),
    ).agg(F.min("l_shipdate").alias("day"))
    first, last = F.date_format("day", "dd.MM.yyyy"), F.date_format(F.date_add("day", 30), "dd.MM.yyyy")
    two_names = F.concat(F.lit("Начало: "), first, F.lit(" Конец: "), last)
    line = (
        F.when(F.col("dated") & (F.col("path") == "A"), two_names)
        .when(F.col("dated"), F.concat(F.lit("Период: "), first, F.lit(" - "), last))
        .when(F.col("named") & (F.col("path") != "A"), F.lit("Параметры:"))
        .otherwise(F.concat(F.lit("Заметка "), F.col("line_no").cast("string")))
    )
    title = stage(keyed.select("path", F.col("line_no").cast("bigint").alias("line_no"), line.alias("line")), "lines")
    behind = title.groupBy("path").agg(F.max("line_no").alias("last"))
    head = behind.select("path", (F.col("last") + 1).alias("line_no"), F.lit("a\tb\tc").alias("line"))
    body = behind.select("path", (F.col("last") + 2).alias("line_no"), F.lit("1\t2\t3").alias("line"))
    rows = as_rows(with_blocks(title.unionByName(head).unionByName(body)))
    return header_periods(rows).select("path", "start_raw", "end_raw", "pattern")
