"""Contract casts and names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.casts import (
    cast_to_target,
    clean_uuid,
    int_or_null,
    load_stamp,
    to_boolean,
    to_date,
    to_datetime,
    to_float,
    to_int,
)
from ladderline.functions.identifiers import column_alias, latin_identifier, truncate_bytes
from workload.base import money_text, query, table

ITEM_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
ITEM_KEY_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _price_texts(spark, sf_dir):
    """Prices as reports print them: grouped by spaces or no-break spaces, some unreadable, some missing."""
    items = table(spark, sf_dir, "lineitem", *ITEM_KEY, "l_extendedprice", "l_returnflag", "l_linestatus", "l_discount", "l_tax")
    price = F.col("l_extendedprice")
    text = (
        F.when(F.col("l_tax") == 0, None)
        .when(F.col("l_discount") == 0, F.concat(money_text(price), F.lit(",1")))
        .when((F.col("l_discount") > 0.09) & (F.col("l_returnflag") == "A"), F.concat(F.lit("n/a "), money_text(price)))
        .when(F.col("l_returnflag") == "N", money_text(price, "\xa0"))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit("-"), money_text(price, "\u202f")))
        .otherwise(F.concat(F.lit(" "), money_text(price)))
    )
    return items.select(*ITEM_KEY, "l_returnflag", "l_linestatus", text.alias("price_text"))


PRICE_SQL = """
WITH p AS (
    SELECT {key}, CAST(round(l_extendedprice * 100) AS BIGINT)
        * CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'O' THEN -1 ELSE 1 END AS c,
        l_tax = 0 OR l_discount = 0 OR (l_discount > 0.09 AND l_returnflag = 'A') AS bad
    FROM lineitem
)
SELECT {key}, {value} AS value FROM p
"""


@query(PRICE_SQL.format(key=ITEM_KEY_SQL, value="CASE WHEN bad OR bad IS NULL THEN 0 ELSE CAST(trunc(c / 100.0::DOUBLE) AS BIGINT) END"))
def cast_int(spark, sf_dir):
    """Report numbers as integers: fraction cut, unreadable and missing become 0."""
    return _price_texts(spark, sf_dir).select(*ITEM_KEY, to_int(F.col("price_text")).alias("value"))


@query(PRICE_SQL.format(key=ITEM_KEY_SQL, value="CASE WHEN bad OR bad IS NULL THEN 0.0::DOUBLE ELSE c / 100.0::DOUBLE END"))
def cast_float(spark, sf_dir):
    return _price_texts(spark, sf_dir).select(*ITEM_KEY, to_float(F.col("price_text")).alias("value"))


@query("""
WITH e AS (SELECT event_id, event_type, date_trunc('second', ts) AS t FROM events)
SELECT event_id,
    CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN date_trunc('day', t)::TIMESTAMP ELSE t END AS moment,
    CASE event_type WHEN 'error' THEN NULL ELSE CAST(t AS DATE) END AS day
FROM e
""")
def cast_dates(spark, sf_dir):
    """Event times with one-digit hours, double or no-break spaces, dates only, and impossible dates."""
    events = table(spark, sf_dir, "events", "event_id", "event_type", "ts")
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.concat(F.lit("31.02."), F.date_format("ts", "yyyy H:mm:ss")))
        .when(kind == "view", F.date_format("ts", "dd.MM.yyyy"))
        .when(kind == "click", F.date_format("ts", "dd.MM.yyyy  H:mm:ss"))
        .when(kind == "signup", F.date_format("ts", "dd.MM.yyyy HH:mm:ss"))
        .otherwise(F.date_format("ts", "dd.MM.yyyy H:mm:ss"))
    )
    texts = events.select("event_id", text.alias("t"))
    return texts.select("event_id", to_datetime(F.col("t")).alias("moment"), to_date(F.col("t")).alias("day"))


@query("""
WITH e AS (SELECT event_id, event_type, md5(CAST(event_id AS VARCHAR)) AS h FROM events)
SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS flag,
    substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
        || substr(h, 21) || CASE WHEN event_type = 'click' THEN '"' ELSE '' END AS guid
FROM e
""")
def cast_bool_uuid(spark, sf_dir):
    """Flags (only true and false count) and quoted identifiers (only the first quote goes)."""
    events = table(spark, sf_dir, "events", "event_id", "event_type")
    kind = F.col("event_type")
    word = F.when(kind == "click", "TRUE").when(kind == "view", "false").when(kind == "error", "yes").otherwise("1")
    h = F.md5(F.col("event_id").cast("string").cast("binary"))
    part = lambda at, size: F.substring(h, at, size)
    guid = F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))
    shown = F.when(kind == "click", F.concat(F.lit(' "'), guid, F.lit('"'))).otherwise(F.concat(F.lit("\xa0"), guid, F.lit("\t")))
    return events.select("event_id", to_boolean(word).alias("flag"), clean_uuid(shown).alias("guid"))


@query("""
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN event_id END AS whole,
    CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) / 100.0::DOUBLE END AS number,
    CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS day,
    CASE WHEN event_type = 'click' THEN true END AS flag
FROM events
""")
def final_cast(spark, sf_dir):
    """The last cast to the target types: what does not fit becomes NULL."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    hundredths = F.round(F.col("value") * 100).cast("bigint")
    point = F.concat(F.floor(hundredths / 100).cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0"))
    texts = events.select(
        "event_id",
        F.when(kind.isin("click", "view"), F.col("event_id").cast("string"))
        .otherwise(F.concat(F.col("event_id").cast("string"), F.lit("L"))).alias("whole"),
        F.when(kind == "error", F.lit("1d")).otherwise(point).alias("number"),
        F.when(kind == "error", F.lit("2024-02-31")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        F.when(kind == "click", F.lit("true")).otherwise(F.lit("yes")).alias("flag"),
    )
    targets = {"whole": T.LongType(), "number": T.DoubleType(), "day": T.DateType(), "flag": T.BooleanType()}
    return texts.select("event_id", *[cast_to_target(F.col(c), T.StringType(), t).alias(c) for c, t in targets.items()])


# Cyrillic letters used below, in both engines: Отчёт ПоЩукам -> otchyot_po_shchukam.
@query("""
WITH n AS (
    SELECT p_partkey, p_size || ' ОтчётПо' || upper(substr(p_name, 1, 1)) || substr(p_name, 2) || p_type || 'Щука_ъ№' || p_brand AS raw
    FROM part
), w AS (
    SELECT p_partkey, raw, lower(regexp_replace(raw, '([a-zа-яё0-9])([A-ZА-ЯЁ])', '\\1_\\2', 'g')) AS words FROM n
), l AS (
    SELECT p_partkey, raw, translate(replace(replace(replace(words, 'ё', 'yo'), 'щ', 'shch'), 'ч', 'ch'), 'откпоуаъ', 'otkpoua') AS latin
    FROM w
), c AS (
    SELECT p_partkey, raw, rtrim(left(trim(regexp_replace(latin, '[^a-z0-9]+', '_', 'g'), '_'), 63), '_') AS name FROM l
)
SELECT p_partkey, 't_' || name AS identifier, translate(lower(raw), ' .', '__') AS alias FROM c
""")
def identifier(spark, sf_dir):
    """Transliterated table names and default aliases of mixed Cyrillic and Latin names."""
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_size", "p_brand")
    title = F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring(F.col("p_name"), F.lit(2), F.length("p_name")))
    raw = F.concat(F.col("p_size").cast("string"), F.lit(" ОтчётПо"), title, F.col("p_type"), F.lit("Щука_ъ№"), F.col("p_brand"))
    named = parts.select("p_partkey", raw.alias("raw"))
    return named.select("p_partkey", latin_identifier(F.col("raw")).alias("identifier"), column_alias(F.col("raw")).alias("alias"))


@query("""
SELECT doc_id, left(text, CAST(list_max([i FOR i IN range(0, 64) IF octet_length(encode(left(text, i))) <= 63]) AS INTEGER)) AS name
FROM documents
""")
def byte_truncate(spark, sf_dir):
    """Whole texts as names: the longest prefix within 63 bytes."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return documents.select("doc_id", truncate_bytes(F.col("text")).alias("name"))


@query("""
SELECT o_orderkey, (CAST(o_orderdate AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Moscow' AS stamp, true AS present FROM orders
""")
def load_stamps(spark, sf_dir):
    """Load times as local time of the reports' zone, for instants over years of summer and winter time."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    instant = F.timestamp_seconds(F.unix_date(F.col("o_orderdate").cast("date")) * 86400)
    return orders.select("o_orderkey", load_stamp(instant).alias("stamp"), load_stamp().isNotNull().alias("present"))


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS rows_read,
    CAST(sum(CASE WHEN bad OR bad IS NULL THEN 0 ELSE CAST(trunc(c / 100.0::DOUBLE) AS BIGINT) END) AS BIGINT) AS total,
    count(*) FILTER (NOT bad) AS readable
FROM (
    SELECT l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT)
        * CASE WHEN l_returnflag <> 'N' AND l_linestatus = 'O' THEN -1 ELSE 1 END AS c,
        l_tax = 0 OR l_discount = 0 OR (l_discount > 0.09 AND l_returnflag = 'A') AS bad
    FROM lineitem
)
GROUP BY ALL
""")
def cast_totals(spark, sf_dir):
    """Totals over cast report numbers, with how many were readable."""
    text = F.col("price_text")
    return _price_texts(spark, sf_dir).groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(to_int(text)).alias("total"), F.count(int_or_null(text)).alias("readable")
    )
