"""Load errors, quarantine and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ladderline.operators.contracts import Contract, ContractColumn
from ladderline.operators.quality import classify_errors, quarantine, reconcile
from workload.base import cents, query, table
from workload.casts import _price_texts


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_returnflag <> 'R' THEN ['key', 'part', 'price'][l_linenumber % 4 + 1] END AS column_name,
    CASE WHEN l_returnflag = 'A' THEN CAST(l_partkey + 1 AS INTEGER) END AS row_number,
    CASE l_returnflag WHEN 'A' THEN '1.0' WHEN 'N' THEN '''x: (y)''' END AS received,
    CASE l_returnflag WHEN 'A' THEN 'str' WHEN 'N' THEN 'int' END AS expected,
    l_returnflag <> 'R' AS is_type_error,
    CASE l_returnflag
        WHEN 'A' THEN 'invalid input for query argument $' || (l_linenumber % 4 + 1) || ' in element #' || l_partkey
            || ' of executemany() sequence: 1.0 (expected str, got float)'
        WHEN 'N' THEN 'Invalid input for query argument $' || (l_linenumber % 4 + 1) || ': ''x: (y)''' || chr(10) || '(expected int, got str).'
        ELSE 'connection lost'
    END AS reason
FROM lineitem
""")
def error_classification(spark, sf_dir):
    """Load error messages: column, row, value and expected type where they name them."""
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    position = (F.col("l_linenumber") % 4 + 1).cast("string")
    message = (
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(
                F.lit("invalid input for query argument $"), position, F.lit(" in element #"), F.col("l_partkey").cast("string"),
                F.lit(" of executemany() sequence: 1.0 (expected str, got float)"),
            ),
        )
        .when(
            F.col("l_returnflag") == "N",
            F.concat(F.lit("Invalid input for query argument $"), position, F.lit(": 'x: (y)'\n(expected int, got str).")),
        )
        .otherwise("connection lost")
    )
    log = items.withColumns({"message": message, "columns": F.array(F.lit("key"), F.lit("part"), F.lit("price"))})
    return classify_errors(log).drop("message", "columns", "l_returnflag")


@query("""
WITH p AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, l_tax, l_discount,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem
), t AS (
    SELECT *, replace(format('{:,}', c // 100), ',', ' ') || ',' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS money FROM p
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'price' AS column_name, 'float' AS expected,
    CASE WHEN l_discount = 0 THEN money || ',1' ELSE 'n/a ' || money END AS received
FROM t WHERE l_tax <> 0 AND (l_discount = 0 OR (l_discount > 0.09 AND l_returnflag = 'A'))
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'flag', 'boolean', l_returnflag FROM t
""")
def cast_quarantine(spark, sf_dir):
    """Every cell that its contract type cannot read, with what it held."""
    contract = Contract(
        "items",
        columns=(ContractColumn("price_text", "price", "float"), ContractColumn("l_returnflag", "flag", "boolean"), ContractColumn("l_linestatus")),
    )
    return quarantine(_price_texts(spark, sf_dir), contract, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])


@query("""
WITH a AS (SELECT o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS price FROM orders),
b AS (SELECT o_custkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS price
    FROM orders WHERE o_orderpriority <> '5-LOW'),
u AS (SELECT *, 1 AS side FROM a UNION ALL SELECT *, -1 FROM b)
SELECT o_custkey, o_orderstatus, price, CAST(sum(side) AS BIGINT) AS surplus FROM u GROUP BY ALL HAVING sum(side) <> 0
""")
def reconciliation(spark, sf_dir):
    """Two exports of the orders: what only one side has, and how often."""
    orders = table(spark, sf_dir, "orders")
    price = cents(F.col("o_totalprice"))
    left = orders.select("o_custkey", "o_orderstatus", price.alias("price"))
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(price)
    right = orders.filter("o_orderpriority <> '5-LOW'").select("o_custkey", "o_orderstatus", changed.cast("bigint").alias("price"))
    return reconcile(left, right)
