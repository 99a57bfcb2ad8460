"""Contracts and inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ladderline.operators.contracts import Contract, ContractColumn, apply_contract, drop_service_columns, match_contract
from ladderline.operators.inference import (
    DATE_SAMPLE,
    UUID_SAMPLE,
    generate_contracts,
    infer_cell_types,
    infer_types,
    pick_event_time,
    target_columns,
    uuid_columns,
    wide_to_cells,
)
from workload.base import money_text, query, table

CUSTOMER_CONTRACT = Contract(
    report="customer",
    use=True,
    table_name="customers",
    columns=(
        ContractColumn("c_acctbal", "balance", "Int64"),
        ContractColumn("c_custkey", "old name", "string"),
        ContractColumn("c_custkey", "customer key", "string", "the customer's number"),
        ContractColumn("c_phone", "phone", "string"),
        ContractColumn("c_name", None, "string"),
        ContractColumn("c_nationkey", "nation.key", "float"),
    ),
)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "customer key", c_name, CAST(c_nationkey AS DOUBLE) AS "nation.key",
    CAST(trunc(round(c_acctbal * 100) / 100.0::DOUBLE) AS BIGINT) AS balance
FROM customer
""")
def contract_apply(spark, sf_dir):
    """Rename, drop, cast: file order stays, a missing column is skipped, of repeated entries the last counts."""
    customers = table(spark, sf_dir, "customer").withColumn("c_acctbal", money_text(F.col("c_acctbal")))
    with_id = customers.withColumn("id", F.lit("service"))
    return apply_contract(drop_service_columns(with_id), CUSTOMER_CONTRACT)


@query("""
WITH f AS (SELECT DISTINCT p_brand AS report, 'size ' || CAST(p_size AS VARCHAR) AS name FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO', 'STANDARD')),
c AS (SELECT p_brand AS report, 'size ' || CAST(p_size AS VARCHAR) AS name, arg_max('c' || CAST(p_partkey AS VARCHAR), p_partkey) AS alias
    FROM part WHERE p_type IN ('MEDIUM', 'PROMO', 'ECONOMY') GROUP BY ALL)
SELECT coalesce(f.report, c.report) AS report, coalesce(f.name, c.name) AS name, alias,
    CASE WHEN f.name IS NULL THEN 'missing' WHEN c.name IS NULL THEN 'dropped' ELSE 'kept' END AS status
FROM f FULL JOIN c ON c.report = f.report AND c.name = f.name
""")
def contract_match(spark, sf_dir):
    """File columns against contract columns of many reports: kept, missing or dropped."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size", "p_type")
    name = F.concat(F.lit("size "), F.col("p_size").cast("string"))
    file_columns = parts.filter(F.col("p_type").isin("SMALL", "LARGE", "PROMO", "STANDARD")).select(F.col("p_brand").alias("report"), name.alias("name"))
    contract = parts.filter(F.col("p_type").isin("MEDIUM", "PROMO", "ECONOMY")).select(
        F.col("p_brand").alias("report"), name.alias("name"), F.col("p_partkey").alias("ord"),
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("alias"),
    )
    return match_contract(file_columns, contract)


INT_SQL = "^[+-]?(?:0|[1-9]\\d*|[1-9]\\d{0,2}(?:[\\s\\x{00A0}]\\d{3})+)$"
FLOAT_SQL = "^[+-]?(?:0|[1-9]\\d*|[1-9]\\d{0,2}(?:[\\s\\x{00A0}]\\d{3})+)[.,]\\d+$"
TYPE_SQL = f"""CASE WHEN count(*) FILTER (v <> '') = 0 THEN 'string'
    WHEN bool_and(regexp_matches(v, '{INT_SQL}')) FILTER (v <> '') THEN
        CASE WHEN bool_and(try_cast(regexp_replace(v, '[\\s\\x{{00A0}}]', '', 'g') AS BIGINT) IS NOT NULL) FILTER (v <> '') THEN 'Int64' ELSE 'float64' END
    WHEN bool_and(regexp_matches(v, '{INT_SQL}') OR regexp_matches(v, '{FLOAT_SQL}')) FILTER (v <> '') THEN 'float64'
    ELSE 'string' END"""


def _item_texts(spark, sf_dir) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey").cast("string")
    return items.select(
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
        F.concat(F.lit(" "), money_text(F.col("l_extendedprice"), "\xa0")).alias("price"),
        F.lpad(F.col("l_linenumber").cast("string"), 3, "0").alias("code"),
        F.concat(F.lit("9"), F.lpad(key, 20, "0")).alias("big number"),
        F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("-"), F.translate(F.format_number(F.col("l_orderkey") + 1000, 0), ",", " "))).alias("key.no"),
        F.when(F.col("l_tax") == 0, F.lit("free")).otherwise("1").alias("mixed"),
        F.date_format("l_shipdate", "dd.MM.yyyy").alias("shipped"),
        F.when(F.col("l_tax") > 5, F.lit("x")).alias("empty"),
        "l_partkey", "l_discount", "l_shipdate",
    )


ITEM_TEXT_SQL = """
    SELECT 0 AS ord, 'quantity' AS name, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS v FROM lineitem
    UNION ALL SELECT 1, 'price', replace(format('{:,}', CAST(round(l_extendedprice * 100) AS BIGINT) // 100), ',', ' ') || ','
        || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') FROM lineitem
    UNION ALL SELECT 2, 'code', lpad(CAST(l_linenumber AS VARCHAR), 3, '0') FROM lineitem
    UNION ALL SELECT 3, 'big number', '9' || lpad(CAST(l_orderkey AS VARCHAR), 20, '0') FROM lineitem
    UNION ALL SELECT 4, 'key.no', CASE WHEN l_linenumber = 1 THEN '' ELSE '-' || replace(format('{:,}', l_orderkey + 1000), ',', ' ') END FROM lineitem
    UNION ALL SELECT 5, 'mixed', CASE WHEN l_tax = 0 THEN 'free' ELSE '1' END FROM lineitem
    UNION ALL SELECT 6, 'shipped', strftime(l_shipdate, '%d.%m.%Y') FROM lineitem
    UNION ALL SELECT 7, 'empty', CASE WHEN l_tax > 5 THEN 'x' END FROM lineitem
"""


@query(f"""
SELECT ord, name, {TYPE_SQL} AS type FROM ({ITEM_TEXT_SQL}) GROUP BY ord, name
UNION ALL SELECT * FROM (SELECT 8, 'l_partkey', 'Int64' UNION ALL SELECT 9, 'l_discount', 'float64' UNION ALL SELECT 10, 'l_shipdate', 'datetime64[ns]')
""")
def infer_types_wide(spark, sf_dir):
    """Contract types of text and typed columns in one pass."""
    return infer_types(_item_texts(spark, sf_dir))


@query(f"SELECT doc AS report, name, {TYPE_SQL} AS type FROM " + """(
    SELECT source AS doc, 'n_chars' AS name, replace(format('{:,}', n_chars), ',', ' ') AS v FROM documents
    UNION ALL SELECT source, 'lang', lang FROM documents
    UNION ALL SELECT source, 'first', CASE WHEN n_chars < 1000 THEN CAST(n_chars AS VARCHAR) || '.5' WHEN n_chars > 18000 THEN lang END FROM documents
) GROUP BY doc, name""")
def infer_types_long(spark, sf_dir):
    """Types per report and column for many reports at once, from long cells."""
    documents = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    first = F.when(F.col("n_chars") < 1000, F.concat(F.col("n_chars").cast("string"), F.lit(".5"))).when(F.col("n_chars") > 18000, F.col("lang"))
    wide = documents.select(
        "doc_id", "source", F.translate(F.format_number("n_chars", 0), ",", " ").alias("n_chars"), "lang", first.alias("first")
    )
    cells = wide_to_cells(wide.select("source", "doc_id", "n_chars", "lang", "first"), "doc_id", F.col("source"))
    return infer_cell_types(cells.filter(F.col("name") != "source")).select("report", "name", "type")


def _event_texts(spark, sf_dir) -> DataFrame:
    """Events as text columns per event type: only some columns of some types look like dates or UUIDs."""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "ts", "user_id")
    h = F.md5(F.col("event_id").cast("string").cast("binary"))
    part = lambda at, size: F.substring(h, at, size)
    guid = F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), F.upper(part(21, 12)))
    kind = F.col("event_type")
    late = F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz")
    return events.select(
        "event_id",
        F.concat(F.lit("Отчёт "), kind).alias("report"),
        F.col("user_id").cast("string").alias("User Id"),
        F.when(kind == "error", F.lit("")).when(late, F.lit("later")).otherwise(F.date_format("ts", "dd.MM.yyyy")).alias("Day"),
        F.when(kind == "click", F.lit("none")).otherwise(F.date_format("ts", "dd.MM.yyyy H:mm:ss")).alias("Seen.At"),
        F.when(kind == "view", h).otherwise(guid).alias("Guid"),
    )


def _event_cells(spark, sf_dir) -> DataFrame:
    wide = _event_texts(spark, sf_dir)
    return wide_to_cells(wide, "event_id", F.col("report")).filter(F.col("name") != "report")


EVENT_CELL_SQL = """
WITH e AS (SELECT *, 'Отчёт ' || event_type AS report, md5(CAST(event_id AS VARCHAR)) AS h FROM events), c AS (
    SELECT report, 2 AS ord, 'User Id' AS name, event_id AS position, CAST(user_id AS VARCHAR) AS value FROM e
    UNION ALL SELECT report, 3, 'Day', event_id, CASE WHEN event_type = 'error' THEN '' WHEN ts >= TIMESTAMP '2024-01-05' THEN 'later'
        ELSE strftime(ts, '%d.%m.%Y') END FROM e
    UNION ALL SELECT report, 4, 'Seen.At', event_id, CASE WHEN event_type = 'click' THEN 'none' ELSE strftime(ts, '%d.%m.%Y %-H:%M:%S') END FROM e
    UNION ALL SELECT report, 5, 'Guid', event_id, CASE WHEN event_type = 'view' THEN h ELSE substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-'
        || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || upper(substr(h, 21)) END FROM e
), t AS (
    SELECT report, ord, name, """ + TYPE_SQL.replace("v ", "trim(value) ").replace("(v,", "(trim(value),") + """ AS type FROM c GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY report, ord ORDER BY position) AS rn FROM c WHERE value IS NOT NULL),
dated AS (
    SELECT report, ord, name FROM r WHERE rn <= 20 GROUP BY ALL
    HAVING bool_and(regexp_matches(trim(value), '^\\d{2}\\.\\d{2}\\.\\d{4}(?:\\s+\\d{1,2}:\\d{2}:\\d{2})?$'))
), event AS (
    SELECT d.report, min(d.ord) AS ord, arg_min(d.name, d.ord) AS name FROM dated d JOIN t ON t.report = d.report AND t.ord = d.ord
    WHERE t.type = 'string' GROUP BY d.report
)
"""


@query(EVENT_CELL_SQL + "SELECT report, ord, name FROM event")
def event_time_choice(spark, sf_dir):
    """The event time of every report: the first text column whose first values are dates."""
    cells = _event_cells(spark, sf_dir)
    return pick_event_time(infer_cell_types(cells), cells, DATE_SAMPLE)


@query(EVENT_CELL_SQL + """
SELECT report, ord, name FROM r WHERE rn <= 10 GROUP BY ALL
HAVING bool_and(regexp_matches(lower(value), '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$'))
""")
def uuid_detection(spark, sf_dir):
    """Columns whose first values are UUIDs."""
    return uuid_columns(_event_cells(spark, sf_dir), UUID_SAMPLE)


@query(EVENT_CELL_SQL + """
SELECT t.report, t.ord, t.name, translate(lower(t.name), ' .', '__') AS alias,
    CASE WHEN t.ord = event.ord THEN 'datetime64[ns]' ELSE t.type END AS type,
    'otchyot_' || substr(t.report, 7) || '_table' AS table_name, translate(lower(event.name), ' .', '__') AS event_time,
    false AS use, 'default_idx' AS index_name, 'user_id' AS index_column
FROM t LEFT JOIN event ON event.report = t.report
""")
def contract_generation(spark, sf_dir):
    """Contracts for reports seen for the first time."""
    return generate_contracts(_event_cells(spark, sf_dir), date_sample=DATE_SAMPLE)


ALL_ROWS_SQL = EVENT_CELL_SQL.replace("WHERE rn <= 20", "")


@query(ALL_ROWS_SQL + "SELECT report, ord, name FROM event")
def event_time_all_rows(spark, sf_dir):
    """The event time of every report: the first text column whose values all are dates."""
    cells = _event_cells(spark, sf_dir)
    return pick_event_time(infer_cell_types(cells), cells)


@query(ALL_ROWS_SQL + """
SELECT t.report, t.ord, t.name, CASE WHEN t.ord = event.ord THEN 'datetime64[ns]' ELSE t.type END AS type, event.name AS event_name,
    CASE WHEN u.ord IS NOT NULL THEN 'UUID' WHEN t.ord = event.ord THEN 'TIMESTAMP' WHEN t.type = 'Int64' THEN 'BIGINT'
        WHEN t.type = 'float64' THEN 'DOUBLE PRECISION' ELSE 'TEXT' END AS target
FROM t LEFT JOIN event ON event.report = t.report LEFT JOIN (
    SELECT report, ord FROM r GROUP BY ALL
    HAVING bool_and(regexp_matches(lower(value), '^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$'))
) u ON u.report = t.report AND u.ord = t.ord
""")
def target_types(spark, sf_dir):
    """The database type of every column of every report, UUID where all values are UUIDs."""
    cells = _event_cells(spark, sf_dir)
    types = target_columns(generate_contracts(cells), uuid_columns(cells))
    event = F.first(F.when(F.col("is_event"), F.col("name")), ignorenulls=True).over(Window.partitionBy("report"))
    return types.withColumn("event_name", event).select("report", "ord", "name", "type", "event_name", "target")
