"""Load errors and checks: messages (E1), cast quarantine (E2), reconciliation of two exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladderline.functions.casts import cast_failed
from ladderline.functions.text import named
from ladderline.operators.contracts import Contract

# The driver message about an unusable value (position, element, value, expected, received).
ARGUMENT_ERROR = (
    r"(?is)invalid input for query argument \$(\d+)(?: in element #(\d+))?(?: of executemany\(\) sequence)?"
    r":\s*(.+?)\s*\(expected (.+?), got (.+?)\)\.?\s*$"
)
UNKNOWN_ERROR = "неизвестная ошибка"


def classify_errors(log: DataFrame, message: str = "message", columns: str = "columns") -> DataFrame:
    """``(column_name, row_number, received, expected, is_type_error, reason)`` next to each message.

    ``columns`` is the array of loaded column names. Other messages keep their text as the reason."""
    text = F.col(message)
    part = lambda i: F.nullif(F.regexp_extract(text, ARGUMENT_ERROR, i), F.lit(""))
    position, element = part(1).try_cast("int"), part(2).try_cast("int")
    is_type_error = F.coalesce(position.isNotNull(), F.lit(False))
    return log.select(
        "*",
        F.get(F.col(columns), position - 1).alias("column_name"),
        (element + 1).alias("row_number"),
        part(3).alias("received"),
        part(4).alias("expected"),
        is_type_error.alias("is_type_error"),
        F.coalesce(F.nullif(text, F.lit("")), F.lit(UNKNOWN_ERROR)).alias("reason"),
    )


def lost_cells(columns: list[str], contract: Contract) -> Column:
    """The cells of a row that their cast cannot read, as ``array<(column_name, expected, received)>``."""
    entries = [
        F.when(
            cast_failed(named(c.name), c.type),
            F.struct(
                F.lit(c.output).alias("column_name"),
                F.lit(c.type).alias("expected"),
                named(c.name).cast("string").alias("received"),
            ),
        )
        for c in contract.columns
        if c.name in columns
    ]
    if not entries:
        raise ValueError(f"contract of {contract.report} describes no column of this report")
    return F.array_compact(F.array(*entries))


def quarantine(df: DataFrame, contract: Contract, keys: list[str]) -> DataFrame:
    """``(*keys, column_name, expected, received)`` for every non-blank cell that its cast cannot read.

    Casting continues with 0 or NULL as the contract says; this is the list of what was lost."""
    failed = F.explode(lost_cells(df.columns, contract))
    return df.select(*[named(k) for k in keys], failed.alias("cell")).select(*[named(k) for k in keys], "cell.*")


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that do not occur equally often on both sides: ``(columns..., surplus)``.

    ``surplus`` is positive for rows the left side has more of. One aggregation over the tagged union
    (combined map-side) instead of two set differences."""
    columns = [named(c) for c in left.columns]
    tagged = left.select(*columns, F.lit(1).alias("__side")).unionByName(
        right.select(*columns, F.lit(-1).alias("__side"))
    )
    surplus = F.sum("__side").cast("bigint").alias("surplus")
    return tagged.groupBy(*columns).agg(surplus).filter(F.col("surplus") != 0)


def reject(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and ``(..., reason)`` rejects; other files go on."""
    judged = df.withColumn("reason", reason)
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())
