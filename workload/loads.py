"""Loads and table maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.operators.evolution import evolve, resolve_names, schema_diff, with_surrogate_id
from ladderline.operators.contracts import IndexSpec
from ladderline.operators.loading import SEQ, PeriodTable, append_counts, key_layout as clustered, key_ranges, period_counts, replace_period, surviving_rows, unique_violations
from ladderline.plans.ordered import with_blocks
from ladderline.session import shared_dir, stage
from workload.base import cents, query, table

QUARTER = ("1997-04-01 00:00:00", "1997-06-30 23:59:59")
ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _orders_with_gaps(spark, sf_dir) -> DataFrame:
    """Orders as whole cents; small customers' orders have no date."""
    orders = table(spark, sf_dir, "orders", *ORDERS)
    date = F.when(F.col("o_custkey") >= 50, F.col("o_orderdate").cast("timestamp_ntz"))
    return orders.select("o_orderkey", "o_orderstatus", cents(F.col("o_totalprice")).alias("price"), date.alias("o_orderdate"))


def _corrected(old: DataFrame) -> DataFrame:
    """A new export of the quarter: pending orders are gone, prices changed, one stray date outside."""
    quarter = old.filter(F.col("o_orderdate").between(*map(_moment, QUARTER)) & (F.col("o_orderstatus") != "P"))
    return quarter.withColumn("price", F.col("price") + 100)


OLD_SQL = """
WITH o AS (
    SELECT o_orderkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS price,
        CASE WHEN o_custkey >= 50 THEN o_orderdate END AS o_orderdate
    FROM orders
), n AS (
    SELECT o_orderkey, o_orderstatus, price + 100 AS price, o_orderdate FROM o
    WHERE o_orderdate BETWEEN '1997-04-01' AND '1997-06-30 23:59:59' AND o_orderstatus <> 'P'
)
"""


@query(OLD_SQL + """
SELECT * FROM o WHERE NOT coalesce(o_orderdate BETWEEN '1997-04-01' AND '1997-06-30 23:59:59', false) UNION ALL SELECT * FROM n
""")
def period_replace(spark, sf_dir):
    """A quarter replaced by its new export; rows without a date stay."""
    old = _orders_with_gaps(spark, sf_dir)
    return replace_period(old, _corrected(old), "o_orderdate", *map(_moment, QUARTER))


@query(OLD_SQL + """
SELECT o_orderkey, o_orderstatus, price, strftime(o_orderdate, '%d.%m.%Y') || ' 0:00:00' AS o_orderdate FROM o
WHERE NOT coalesce(o_orderdate BETWEEN '1997-04-01' AND '1997-06-30', false)
UNION ALL SELECT o_orderkey, o_orderstatus, price, strftime(o_orderdate, '%d.%m.%Y') || ' 0:00:00' FROM n
""")
def period_replace_text(spark, sf_dir):
    """The same with dates as report text: compared by day, not by spelling."""
    old = _orders_with_gaps(spark, sf_dir)
    as_text = lambda df: df.withColumn("o_orderdate", F.date_format("o_orderdate", "dd.MM.yyyy 0:00:00"))
    return replace_period(as_text(old), as_text(_corrected(old)), "o_orderdate", *map(_moment, QUARTER))


@query(OLD_SQL + """
SELECT count(*) AS total, count(*) FILTER (o_orderdate BETWEEN '1997-04-01' AND '1997-06-30 23:59:59') AS in_period FROM o
""")
def period_count(spark, sf_dir):
    """The dry run: how many rows a period delete would touch."""
    return period_counts(_orders_with_gaps(spark, sf_dir), "o_orderdate", *map(_moment, QUARTER))


@query("""
WITH b AS (SELECT event_id, user_id, event_type, CASE WHEN user_id >= 10 THEN ts END AS ts,
        CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 END AS seq FROM events),
d AS (SELECT min(CAST(ts AS DATE)) AS first FROM events),
l AS (
    SELECT 1 AS seq, first::TIMESTAMP AS a, first::TIMESTAMP + INTERVAL 20 DAY AS b FROM d
    UNION ALL SELECT 2, first::TIMESTAMP + INTERVAL 5 DAY, first::TIMESTAMP + INTERVAL 9 DAY + INTERVAL 86399 SECOND FROM d
    UNION ALL SELECT 3, first::TIMESTAMP + INTERVAL 8 DAY + INTERVAL 12 HOUR, first::TIMESTAMP + INTERVAL 8 DAY + INTERVAL 18 HOUR FROM d
)
SELECT event_id, user_id, event_type, ts FROM b
WHERE NOT EXISTS (SELECT 1 FROM l WHERE (b.seq IS NULL OR l.seq > b.seq) AND b.ts BETWEEN l.a AND l.b)
""")
def batch_period_replace(spark, sf_dir):
    """Three overlapping period loads on top of old events, in one pass; the later load wins."""
    events = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts")
    seq = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "view", 2).when(F.col("event_type") == "purchase", 3)
    ts = F.when(F.col("user_id") >= 10, F.col("ts").cast("timestamp_ntz"))
    rows = events.select("event_id", "user_id", "event_type", ts.alias("ts"), seq.alias("seq"))
    first = events.agg(F.min("ts").cast("date").cast("timestamp_ntz").alias("first"))
    after = lambda text: (F.col("first") + F.expr(f"INTERVAL '{text}' DAY TO SECOND")).cast("timestamp_ntz")
    periods = [("0 00:00:00", "20 00:00:00"), ("5 00:00:00", "9 23:59:59"), ("8 12:00:00", "8 18:00:00")]
    entries = [F.struct(F.lit(i).alias("seq"), after(a).alias("start"), after(b).alias("end")) for i, (a, b) in enumerate(periods, 1)]
    loads = first.select(F.inline(F.array(*entries)))
    return surviving_rows(rows, loads, "ts").drop("seq")


@query("""
SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
    CASE WHEN s_nationkey % 2 = 0 THEN s_nationkey / 2 END::DOUBLE AS half, CAST(NULL AS DATE) AS since
FROM supplier
""")
def table_evolution(spark, sf_dir):
    """A table in its new schema: one column retyped, one read from text, one added, two dropped."""
    suppliers = table(spark, sf_dir, "supplier")
    half = F.when(F.col("s_nationkey") % 2 == 0, (F.col("s_nationkey") / 2).cast("string")).otherwise("odd")
    target = T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.StringType()),
        T.StructField("half", T.DoubleType()), T.StructField("since", T.DateType()),
    ])
    return evolve(suppliers.withColumn("half", half), target, strict=False)


def _long_name(number):
    """Column names beyond 63 bytes for some numbers, short ones for others."""
    return F.when(number % 2 == 0, F.concat(F.lit("Остаток на начало периода, количество "), number.cast("string"))).otherwise(
        F.concat(F.lit("col_"), number.cast("string"))
    )


NAME_SQL = "CASE WHEN {n} % 2 = 0 THEN 'Остаток на начало периода, количество ' || CAST({n} AS VARCHAR) ELSE 'col_' || CAST({n} AS VARCHAR) END"
SCHEMAS_SQL = f"""
WITH have AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS table_name,
        CASE WHEN l_linenumber % 2 = 0 THEN left({NAME_SQL.format(n='l_linenumber')}, 34) ELSE {NAME_SQL.format(n='l_linenumber')} END AS name,
        max(CASE l_returnflag WHEN 'A' THEN 'integer' WHEN 'N' THEN 'character varying' ELSE 'numeric' END) AS type
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL
), want AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS table_name, {NAME_SQL.format(n='l_linenumber')} AS name,
        max(CASE l_returnflag WHEN 'A' THEN 'BIGINT' WHEN 'N' THEN 'TEXT' ELSE 'DOUBLE PRECISION' END) AS type
    FROM lineitem WHERE (l_discount < 0.05 OR l_linestatus = 'O') GROUP BY ALL
), resolved AS (
    SELECT w.table_name, w.name, w.type, coalesce(e.name, c.name) AS actual FROM want w
    LEFT JOIN have e ON e.table_name = w.table_name AND e.name = w.name
    LEFT JOIN have c ON c.table_name = w.table_name
        AND c.name = left(w.name, CAST(list_max([i FOR i IN range(0, 64) IF octet_length(encode(left(w.name, i))) <= 63]) AS INTEGER))
)
"""


def _schemas(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """One table per order: stored columns (long names cut) and expected columns."""
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_discount")
    name = _long_name(F.col("l_linenumber"))
    flag = F.col("l_returnflag")
    stored = F.when(F.col("l_linenumber") % 2 == 0, F.left(name, F.lit(34))).otherwise(name)
    keyed = lambda n: (F.col("l_orderkey").cast("string").alias("table_name"), n.alias("name"))
    have = items.filter("l_linestatus = 'F'").groupBy(*keyed(stored)).agg(
        F.max(F.when(flag == "A", "integer").when(flag == "N", "character varying").otherwise("numeric")).alias("type")
    )
    want = items.filter("l_discount < 0.05 OR l_linestatus = 'O'").groupBy(*keyed(name)).agg(
        F.max(F.when(flag == "A", "BIGINT").when(flag == "N", "TEXT").otherwise("DOUBLE PRECISION")).alias("type")
    )
    return have, want


@query(SCHEMAS_SQL + "SELECT table_name, name, actual FROM resolved")
def name_resolution(spark, sf_dir):
    """Expected columns and the stored ones they are: by name, or by the name cut to 63 bytes."""
    have, want = _schemas(spark, sf_dir)
    return resolve_names(have, want.select("table_name", "name"))


@query(SCHEMAS_SQL + """
, f AS (
    SELECT coalesce(r.table_name, h.table_name) AS table_name, coalesce(r.actual, h.name, r.name) AS name,
        h.name AS have, r.name AS want, h.type AS from_type, r.type AS to_type,
        CASE h.type WHEN 'integer' THEN 'BIGINT' WHEN 'numeric' THEN 'DOUBLE PRECISION' WHEN 'character varying' THEN 'TEXT' END AS family
    FROM resolved r FULL JOIN have h ON h.table_name = r.table_name AND h.name = r.actual
)
SELECT table_name, name, CASE WHEN have IS NULL THEN 'add' WHEN want IS NULL THEN 'drop' WHEN family = to_type THEN 'keep' ELSE 'retype' END AS action,
    from_type, to_type FROM f
""")
def schema_difference(spark, sf_dir):
    """What has to change in every table's schema."""
    return schema_diff(*_schemas(spark, sf_dir))


@query("SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def unique_audit(spark, sf_dir):
    """Keys a unique index would reject."""
    return unique_violations(table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders")
def surrogate_id(spark, sf_dir):
    """Dense ids that continue after the table's last one, without a global sort."""
    orders = table(spark, sf_dir, "orders", "o_orderkey")
    return with_surrogate_id(with_blocks(orders, 4096, "o_orderkey"), "o_orderkey", start=1000).select("o_orderkey", "id")


@query("""
SELECT count(*) FILTER (o_orderstatus = 'P') AS planned, count(*) FILTER (o_orderstatus = 'P') AS loaded, count(*) AS actual FROM orders
""")
def append_count(spark, sf_dir):
    """Planned, loaded and actual rows of an append to a written table."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    planned = orders.filter("o_orderstatus = 'P'")
    existing = stage(orders.filter("o_orderstatus <> 'P'"), "target")
    loaded = stage(planned, "loaded")
    return append_counts(planned, loaded, existing.unionByName(loaded))


@query("""
WITH o AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS price,
        CASE WHEN o_custkey >= 50 THEN o_orderdate::TIMESTAMP END AS o_orderdate
    FROM orders
), d AS (
    SELECT *, coalesce(o_orderdate BETWEEN '1997-04-01' AND '1997-06-30 23:59:59', false) AS quarter,
        coalesce(o_orderdate BETWEEN '1997-05-15' AND '1997-05-31 23:59:59', false) AS fortnight,
        coalesce(o_orderdate BETWEEN '1997-04-01' AND '1997-05-20 23:59:59', false) AS corrected,
        coalesce(o_orderdate BETWEEN '1996-02-01' AND '1996-02-03 23:59:59', false) AS emptied FROM o
)
SELECT o_orderkey, o_orderstatus, price, o_orderdate, 'base' AS origin FROM d WHERE NOT quarter AND NOT emptied
UNION ALL SELECT o_orderkey, o_orderstatus, price + 100, o_orderdate, 'quarter' FROM d
    WHERE quarter AND o_orderstatus <> 'P' AND NOT fortnight AND NOT corrected
UNION ALL SELECT o_orderkey, o_orderstatus, price + 200, o_orderdate, 'fortnight' FROM d WHERE fortnight AND o_orderstatus = 'O' AND NOT corrected
UNION ALL SELECT o_orderkey, o_orderstatus, price + 300, o_orderdate, 'corrected' FROM d WHERE corrected AND o_custkey % 2 = 0
""")
def period_table_reload(spark, sf_dir):
    """A filled table with undated rows, loaded again: overlapping periods, days that become empty, loads that are repeated,
    and a file that came in once more with another content. Every load is one commit."""
    old = _orders_with_gaps(spark, sf_dir).join(table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"), "o_orderkey")
    old = stage(old, "orders")
    run = f"reload_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {run} LOCATION '{shared_dir(spark)}/{run}'")
    target = PeriodTable(spark, f"{run}.orders", "o_orderdate", "month")
    columns = ("o_orderkey", "o_orderstatus", "price", "o_orderdate")
    rows = lambda df, more, origin: df.withColumn("price", F.col("price") + more).select(*columns, F.lit(origin).alias("origin"))
    target.load(rows(old, 0, "base"), load_id="base")
    within = lambda a, b: F.col("o_orderdate").between(_moment(a), _moment(b))
    fortnight, corrected, emptied = ("1997-05-15 00:00:00", "1997-05-31 23:59:59"), ("1997-04-01 00:00:00", "1997-05-20 23:59:59"), ("1996-02-01 00:00:00", "1996-02-03 23:59:59")
    first = rows(old.filter(within(*QUARTER) & (F.col("o_orderstatus") != "P")), 100, "quarter").withColumn(SEQ, F.lit(1))
    second = rows(old.filter(within(*fortnight) & (F.col("o_orderstatus") == "O")), 200, "fortnight").withColumn(SEQ, F.lit(2))
    periods = [(i, *map(_moment, p), name) for i, p, name in ((1, QUARTER, "a"), (2, fortnight, "b"), (3, emptied, "c"))]
    loads = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(i).alias("seq"), a.alias("start"), b.alias("end"), F.lit(n).alias("load_id")) for i, a, b, n in periods])))
    for _ in range(2):  # the second time all of them are known
        target.load_many(first.unionByName(second), loads.select("seq", "start", "end"), loads.select("seq", "load_id"))
    target.load(rows(old.filter(within(*corrected) & (F.col("o_custkey") % 2 == 0)), 300, "corrected"), *corrected, load_id="a, changed")
    target.vacuum()
    return target.read()


@query("SELECT count(*) AS rows, count(DISTINCT o_custkey) AS keys, min(o_custkey) AS least, max(o_custkey) AS greatest, 0::BIGINT AS shared FROM orders")
def key_layout(spark, sf_dir):
    """Orders written in key order: no two files share a customer, so a read of one opens one file."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    written = stage(clustered(orders, (IndexSpec("by_customer", ("o_custkey",), True),), 16), "by-customer")
    in_order = Window.partitionBy(F.lit(0)).orderBy("least", "greatest")  # one row per file
    ranges = key_ranges(written, "o_custkey").withColumn("before", F.max("greatest").over(in_order.rowsBetween(Window.unboundedPreceding, -1)))
    keys = written.select("o_custkey").distinct().agg(F.count(F.lit(1))).first()[0]
    shared = F.count_if(F.col("before") >= F.col("least")).alias("shared")
    return ranges.agg(F.sum("rows").alias("rows"), F.lit(keys).cast("bigint").alias("keys"), F.min("least").alias("least"), F.max("greatest").alias("greatest"), shared)
