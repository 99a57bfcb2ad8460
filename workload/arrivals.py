"""File arrivals and load status."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.operators.contracts import Contract, ContractColumn
from ladderline.session import shared_dir
from ladderline.sources.changed_files import changed_files
from ladderline.streaming.arrivals import (
    accepted_starts,
    distinct_versions,
    guarded_starts,
    load_status,
    load_summary,
    new_versions,
    recent_changes,
)
from ladderline.streaming.ingest import Ingest, until_all_are_loaded, watch_directory
from workload.base import day_text, line_of, money_text, query, table
from workload.ladder import ORDER_COLUMNS, order_lines


def _sightings(spark, sf_dir):
    """Users as files, the day of an event as the file's version."""
    events = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return events.select(F.col("user_id").cast("string").alias("path"), day.alias("mtime"), F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "event_type")


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS path, date_trunc('day', ts)::TIMESTAMP AS mtime FROM events")
def file_version_dedup(spark, sf_dir):
    """Each version of a file once, whoever reported it."""
    return distinct_versions(_sightings(spark, sf_dir))


@query("""
WITH e AS (SELECT CAST(user_id AS VARCHAR) AS path, date_trunc('day', ts)::TIMESTAMP AS mtime, ts, event_type FROM events),
cur AS (SELECT path, max(mtime) AS mtime FROM e GROUP BY path),
led AS (SELECT path, arg_max(mtime, ts) AS done FROM e WHERE event_type = 'signup' GROUP BY path)
SELECT cur.path, cur.mtime FROM cur LEFT JOIN led ON led.path = cur.path WHERE done IS NULL OR done <> mtime
""")
def new_file_versions(spark, sf_dir):
    """Versions not in the ledger (here: signups are the loads done so far)."""
    seen = _sightings(spark, sf_dir)
    ledger = seen.filter("event_type = 'signup'").select("path", "mtime", F.col("ts").alias("started"))
    return new_versions(seen, ledger)


@query("""
WITH e AS (
    SELECT event_id, CAST(user_id AS VARCHAR) AS path, epoch_us(ts) // 1000000 AS seen,
        epoch_us(date_trunc('hour', ts)) // 1000000 + CASE WHEN event_type = 'view' THEN 3600 ELSE 0 END AS mtime
    FROM events
), p AS (SELECT *, lag(mtime) OVER (PARTITION BY path ORDER BY event_id) AS previous FROM e)
SELECT event_id, path, seen, mtime FROM p WHERE (previous IS NULL OR abs(mtime - previous) >= 0.1) AND seen - mtime <= 1800
""")
def recency(spark, sf_dir):
    """Sightings of files that changed since they were last seen and whose change is recent."""
    events = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    seconds = lambda c: F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01', cast({c} as timestamp_ntz))")
    mtime = seconds("date_trunc('hour', ts)") + F.when(F.col("event_type") == "view", 3600).otherwise(0)
    seen = events.select(
        "event_id", F.col("user_id").cast("string").alias("path"), seconds("ts").alias("seen"), mtime.alias("mtime"),
        F.expr("event_id div 2048").alias("block"),
    )
    return recent_changes(seen, "event_id", recent=1800.0).select("event_id", "path", "seen", "mtime")


@query("""
WITH RECURSIVE e AS (
    SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
), nxt AS (
    SELECT user_id, rn, min(rn) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 1800 SECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS next_rn
    FROM e
), walk AS (
    SELECT user_id, CAST(1 AS BIGINT) AS rn FROM e WHERE rn = 1
    UNION ALL SELECT w.user_id, n.next_rn FROM walk w JOIN nxt n ON n.user_id = w.user_id AND n.rn = w.rn
    WHERE n.next_rn IS NOT NULL
)
SELECT CAST(e.user_id AS VARCHAR) AS path, e.ts, e.event_id FROM walk JOIN e ON e.user_id = walk.user_id AND e.rn = walk.rn
""")
def stale_guard(spark, sf_dir):
    """Events that start processing while the ones before are still running, until they are stale."""
    return accepted_starts(_sightings(spark, sf_dir).select("path", "ts", "event_id"))


LOG_SQL = """
WITH l AS (
    SELECT 'f' || CAST(user_id AS VARCHAR) || '.txt' AS file, ts,
        CASE WHEN event_type = 'error' THEN 'ERROR: ' || props ELSE strftime(ts, '%Y-%m-%d') END AS status FROM events
), s AS (SELECT file, count(*) AS processed, max(ts) AS last_ts, arg_max(status, ts) AS status FROM l GROUP BY file)
"""


def _log(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", F.concat(F.lit("ERROR: "), F.col("props"))).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    file = F.concat(F.lit("f"), F.col("user_id").cast("string"), F.lit(".txt"))
    return events.select(file.alias("file"), F.col("ts").cast("timestamp_ntz").alias("ts"), status.alias("status"))


@query(LOG_SQL + "SELECT file, processed, status, last_ts FROM s")
def file_status(spark, sf_dir):
    """Latest status and number of loads per file."""
    return load_status(_log(spark, sf_dir))


@query(LOG_SQL + """
SELECT CAST(sum(processed) AS BIGINT) AS processed_files, count(*) AS files, count(*) FILTER (starts_with(status, 'ERROR')) AS failed_files,
    arg_max(file, last_ts) AS last_processed FROM s
""")
def status_summary(spark, sf_dir):
    """The monitor's summary line."""
    return load_summary(_log(spark, sf_dir))


ORDER_CONTRACT = Contract(
    report="orders",
    use=True,
    table_name="loaded_orders",
    event_time="order_day",
    columns=(
        ContractColumn("status"),
        ContractColumn("priority", "order_priority"),
        ContractColumn("order_key", "order_key", "int"),
        ContractColumn("day", "order_day", "date"),
        ContractColumn("total", "total", "float64"),
    ),
)


@query("""
SELECT o_orderstatus AS status, o_orderpriority AS order_priority, o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_day,
    CAST(round(o_totalprice * 100) AS BIGINT) / 100.0::DOUBLE AS total
FROM orders
""")
def stream_ingest(spark, sf_dir):
    """Yearly order reports written as files, picked up by a stream and loaded into a table by contract."""
    year = F.year("o_orderdate").cast("string")
    lines = order_lines(table(spark, sf_dir, "orders", *ORDER_COLUMNS), year)
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/ingest-{run}"
    own_period = F.concat(F.lit("Параметры:\tПериод: 01.01."), F.col("path"), F.lit(" - 31.12."), F.col("path"))
    line = F.when(F.startswith("line", F.lit("Параметры")), own_period).otherwise(F.col("line"))
    # The year is a number: the writer would sort text partition values again and mix up the lines.
    files = lines.select(F.col("path").cast("int").alias("year"), "block", "line_no", line.alias("line"))
    in_order = files.repartition("year").sortWithinPartitions("year", "block", "line_no")
    in_order.select("year", F.col("line").alias("value")).write.partitionBy("year").text(f"{root}/files/report=orders")
    spark.sql(f"CREATE DATABASE ingest_{run} LOCATION '{root}/tables'")
    by_folder = lambda path: F.regexp_extract(path, "report=([^/]+)/", 1)
    database = f"ingest_{run}"
    ingest = Ingest(
        spark, [ORDER_CONTRACT], f"{database}.load_log", database, with_ids=False, report_of=by_folder, partition_unit="year"
    )
    query = ingest.stream(watch_directory(spark, f"{root}/files"), f"{root}/progress")
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    columns = [c.output for c in ORDER_CONTRACT.columns]
    return spark.table(f"{database}.loaded_orders").select(*columns)


@query("""
WITH RECURSIVE e AS (
    SELECT user_id, ts, event_id, event_type = 'purchase' AS ends, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
), f AS (
    SELECT *, min(CASE WHEN ends THEN rn END) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_end,
        min(CASE WHEN NOT ends THEN rn END) OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_event,
        min(CASE WHEN NOT ends THEN rn END) OVER (PARTITION BY user_id ORDER BY ts
            RANGE BETWEEN INTERVAL 1800 SECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS next_stale
    FROM e
), nxt AS (
    SELECT f.user_id, f.rn, least(f.next_stale, g.next_event) AS next_rn FROM f LEFT JOIN f g ON g.user_id = f.user_id AND g.rn = f.next_end
), walk AS (
    SELECT user_id, min(rn) AS rn FROM e WHERE NOT ends GROUP BY user_id
    UNION ALL SELECT w.user_id, n.next_rn FROM walk w JOIN nxt n ON n.user_id = w.user_id AND n.rn = w.rn WHERE n.next_rn IS NOT NULL
)
SELECT CAST(e.user_id AS VARCHAR) AS path, e.ts, e.event_id FROM walk JOIN e ON e.user_id = walk.user_id AND e.rn = walk.rn
""")
def stale_guard_finish(spark, sf_dir):
    """Events that start processing while the ones before are still running, until those finish or are stale."""
    kind = F.when(F.col("event_type") == "purchase", "finish").otherwise("event")
    return guarded_starts(_sightings(spark, sf_dir).withColumn("kind", kind).select("path", "ts", "event_id", "kind"))


def _report_files(lines, folder: str) -> None:
    """Report lines ``(year, block, line_no, line)`` as one text file per year."""
    in_order = lines.repartition("year").sortWithinPartitions("year", "block", "line_no")
    in_order.select("year", F.col("line").alias("value")).write.partitionBy("year").text(folder)


def _yearly(orders, **how):
    """Grouped order reports, each with its own year as the period."""
    lines = order_lines(orders, F.year("o_orderdate").cast("string"), **how)
    own_period = F.concat(F.lit("Параметры:\tПериод: 01.01."), F.col("path"), F.lit(" - 31.12."), F.col("path"))
    line = F.when(F.startswith("line", F.lit("Параметры")), own_period).otherwise(F.col("line"))
    # The year is a number: the writer would sort text partition values again and mix up the lines.
    return lines.select(F.col("path").cast("int").alias("year"), "block", "line_no", line.alias("line"))


def _flat_lines(orders):
    """Flat order reports by year: some lines lack their last cell, some have one more, some totals are no numbers."""
    year = F.year("o_orderdate")
    total = F.when(F.col("o_orderkey") % 10 == 2, "bad").otherwise(money_text(F.col("o_totalprice")))
    cells = [F.col("o_orderkey"), F.col("o_orderstatus"), day_text(F.col("o_orderdate"))]
    line = F.when(F.col("o_orderkey") % 10 == 0, line_of(*cells)).when(F.col("o_orderkey") % 10 == 1, line_of(*cells, total, "more")).otherwise(line_of(*cells, total))
    details = orders.select(year.alias("year"), F.lit(1).cast("bigint").alias("block"), F.col("o_orderkey").alias("line_no"), line.alias("line"))
    heads = details.select("year").distinct()
    period = F.concat(F.lit("Параметры:\tПериод: 01.01."), F.col("year").cast("string"), F.lit(" - 31.12."), F.col("year").cast("string"))
    head = lambda n, text: heads.select("year", F.lit(0).cast("bigint").alias("block"), F.lit(n).cast("bigint").alias("line_no"), text.alias("line"))
    return head(0, period).unionByName(head(1, F.lit("Ключ\tСтатус\tДень\tСумма"))).unionByName(details)


NOTED_CONTRACT = replace(
    ORDER_CONTRACT, report="grouped", table_name="grouped_orders", columns=(*ORDER_CONTRACT.columns, ContractColumn("note", "note", "int"))
)
FLAT_CONTRACT = Contract(
    report="flat", use=True, table_name="flat_orders", event_time="order_day",
    columns=(
        ContractColumn("Ключ", "order_key", "int"), ContractColumn("День", "order_day", "date"),
        ContractColumn("Сумма", "total", "float"), ContractColumn("Нет", "absent"),
    ),
)
DOUBLED_CONTRACT = replace(
    FLAT_CONTRACT, report="doubled", table_name="doubled_orders",
    columns=(*FLAT_CONTRACT.columns[:2], ContractColumn("Сумма", "order_day", "float")),
)


@query("""
WITH o AS (SELECT *, CAST(year(o_orderdate) AS VARCHAR) AS year FROM orders),
flat AS (
    SELECT year, count(*) AS details, count(*) FILTER (o_orderkey % 10 = 0) AS padded, count(*) FILTER (o_orderkey % 10 = 1) AS cut,
        count(*) FILTER (o_orderkey % 10 = 2) AS bad FROM o GROUP BY year
)
SELECT 'grouped' AS report, year, 'grouped' AS kind, count(*) FILTER (o_custkey % 7 <> 0) AS detail_rows,
    count(DISTINCT o_orderstatus) + count(DISTINCT o_orderstatus || o_orderpriority) AS subtotal_rows, count(*) FILTER (o_custkey % 7 = 0) AS ragged_rows,
    0::BIGINT AS other_rows, 0::BIGINT AS padded_rows, 0::BIGINT AS cut_rows, count(*) FILTER (o_custkey % 7 <> 0 AND o_custkey > 500) AS unreadable_cells,
    'status,priority,order_key,day,note,total' AS kept, '' AS missing, 'rank,customer' AS dropped, NULL::VARCHAR AS error
FROM o GROUP BY year
UNION ALL SELECT 'flat', year, 'flat', details, 0, 0, 0, padded, cut, bad, 'Ключ,День,Сумма', 'Нет', 'Статус', NULL FROM flat
UNION ALL SELECT 'doubled', year, 'flat', details, 0, 0, 0, padded, cut, 0, 'Ключ,День,Сумма', '', 'Статус',
    'ValueError: contract of doubled maps two columns to one name: [''order_key'', ''order_day'', ''order_day'']' FROM flat
UNION ALL SELECT 'unknown', year, 'flat', details, 0, 0, 0, padded, cut, 0, NULL, NULL, NULL, NULL FROM flat
""")
def ingest_outcome(spark, sf_dir):
    """What became of every file: rows by class, columns against the contract, unreadable cells, the whole error."""
    orders = table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/outcome-{run}"
    _report_files(_yearly(orders, extra=F.col("o_custkey") % 7 == 0), f"{root}/files/report=grouped")
    for name in ("flat", "doubled", "unknown"):
        _report_files(_flat_lines(orders), f"{root}/files/report={name}")
    database = f"outcome_{run}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/tables'")
    by_folder = lambda path: F.regexp_extract(path, "report=([^/]+)/", 1)
    contracts = [NOTED_CONTRACT, FLAT_CONTRACT, DOUBLED_CONTRACT]
    ingest = Ingest(spark, contracts, f"{database}.load_log", database, with_ids=False, report_of=by_folder, partition_unit="year")
    ingest.run_directory(f"{root}/files")
    found = spark.table(f"{database}.load_log_outcome")
    counts = [f"{c}_rows" for c in ("detail", "subtotal", "ragged", "other", "padded", "cut")]
    names = [F.when(F.col(c).isNotNull(), F.array_join(c, ",")).alias(c) for c in ("kept", "missing", "dropped")]
    return found.select("report", F.regexp_extract("path", "year=([0-9]+)/", 1).alias("year"), "kind", *counts, "unreadable_cells", *names, "error")


def _put_in_place(spark, new: str, old: str) -> None:
    """Each year's new file takes the path of the old one."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    store = path(old).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    parts = lambda root: {s.getPath().getParent().getName(): s.getPath() for s in store.globStatus(path(f"{root}/year=*/part-*"))}
    before = parts(old)
    for year, file in parts(new).items():
        store.delete(before[year], False)
        store.rename(file, before[year])


@query("""
SELECT o_orderstatus AS status, o_orderpriority AS order_priority, o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_day,
    (CAST(round(o_totalprice * 100) AS BIGINT) + CASE WHEN year(o_orderdate) % 2 = 0 THEN 100 ELSE 0 END) / 100.0::DOUBLE AS total
FROM orders WHERE year(o_orderdate) % 2 = 1 OR o_custkey % 3 <> 0
""")
def stream_changed_files(spark, sf_dir):
    """Yearly order reports loaded by a stream; those of even years change afterwards, and the stream loads them again."""
    orders = table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/changed-{run}"
    files = f"{root}/files/report=orders"
    database = f"changed_{run}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/tables'")
    by_folder = lambda path: F.regexp_extract(path, "report=([^/]+)/", 1)
    ingest = Ingest(spark, [ORDER_CONTRACT], f"{database}.load_log", database, with_ids=False, report_of=by_folder, partition_unit="year")
    _report_files(_yearly(orders), files)
    until_all_are_loaded(changed_files(spark, f"{root}/files", settle=0.0), ingest.run_files, f"{root}/progress")
    even = orders.filter((F.year("o_orderdate") % 2 == 0) & (F.col("o_custkey") % 3 != 0)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    _report_files(_yearly(even), f"{root}/new")
    _put_in_place(spark, f"{root}/new", files)
    until_all_are_loaded(changed_files(spark, f"{root}/files", settle=0.0), ingest.run_files, f"{root}/progress")
    return spark.table(f"{database}.loaded_orders").select(*[c.output for c in ORDER_CONTRACT.columns])


@query("""
SELECT 'prio_' || left(o_orderpriority, 1) AS table_name, o_orderstatus AS status, o_orderpriority AS order_priority, o_orderkey AS order_key,
    CAST(o_orderdate AS DATE) AS order_day, CAST(round(o_totalprice * 100) AS BIGINT) / 100.0::DOUBLE AS total
FROM orders
""")
def ingest_many_tables(spark, sf_dir):
    """A tick with five reports, each loaded into a table of its own, side by side."""
    orders = table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    run = uuid.uuid4().hex
    root = f"{shared_dir(spark)}/many-{run}"
    database = f"many_{run}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/tables'")
    numbers = "12345"
    for number in numbers:
        _report_files(_yearly(orders.filter(F.startswith("o_orderpriority", F.lit(number)))), f"{root}/files/report=prio_{number}")
    by_folder = lambda path: F.regexp_extract(path, "report=([^/]+)/", 1)
    contracts = [replace(ORDER_CONTRACT, report=f"prio_{n}", table_name=f"prio_{n}") for n in numbers]
    Ingest(spark, contracts, f"{database}.load_log", database, with_ids=False, report_of=by_folder, partition_unit="year").run_directory(f"{root}/files")
    columns = [c.output for c in ORDER_CONTRACT.columns]
    parts = [spark.table(f"{database}.prio_{n}").select(F.lit(f"prio_{n}").alias("table_name"), *columns) for n in numbers]
    return reduce(DataFrame.unionByName, parts)
