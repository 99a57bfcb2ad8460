"""Type inference and contract generation.

All columns of all reports are inferred in one aggregation over long cells ``(report, ord, name, value)``.
Its buffers are flags and counters, so it combines map-side and a report with a third of the rows costs
no more shuffle than a small one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.casts import LOGICAL_TYPE, SPARK_TYPE
from ladderline.functions.identifiers import column_alias, latin_identifier
from ladderline.functions.text import named, strip, without_spaces
from ladderline.operators.contracts import Contract, ContractColumn, IndexSpec
from ladderline.operators.evolution import database_type

# What counts as a number, a date and a UUID in report text.
WHOLE_PART = r"(?:0|[1-9]\d*|[1-9]\d{0,2}(?:\s\d{3})+)"
NUMBER = rf"(?U)^[+-]?{WHOLE_PART}(?:[.,]\d+)?$"
DATE_TEXT = r"(?U)^\d{2}\.\d{2}\.\d{4}(?:\s+\d{1,2}:\d{2}:\d{2})?$"
UUID_TEXT = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
DATE_SAMPLE = 20
UUID_SAMPLE = 10
DATETIME_NAME = "datetime64[ns]"


def _filled(values: Column) -> Column:
    """Stripped text; blank values are NULL and do not count."""
    return F.nullif(strip(values), F.lit(""))


def _type_of(filled: Column, prefix: str = "") -> list[Column]:
    """The four facts a text column's type follows from. One pattern serves both kinds of number: a whole
    one is a number without a separator."""
    return [
        F.count(filled).alias(f"{prefix}filled"),
        F.bool_and(~F.contains(filled, F.lit(",")) & ~F.contains(filled, F.lit("."))).alias(f"{prefix}plain"),
        F.bool_and(F.rlike(filled, F.lit(NUMBER))).alias(f"{prefix}number"),
        F.bool_and(_fits_long(filled)).alias(f"{prefix}fits"),
    ]


def _fits_long(number: Column) -> Column:
    """Whether a whole number (without leading zeros) fits 64 bits, decided by its digits."""
    digits = F.translate(without_spaces(number), "+-", "")
    largest = F.when(F.startswith(number, F.lit("-")), "9223372036854775808").otherwise("9223372036854775807")
    checked = (F.length(digits) < 19) | ((F.length(digits) == 19) & (digits <= largest))
    return F.when(F.length(number) < 19, True).otherwise(checked)


def _decide(prefix: str = "") -> Column:
    fact = lambda name: F.col(f"{prefix}{name}")
    return (
        F.when(fact("filled") == 0, "string")
        .when(fact("number") & fact("plain") & fact("fits"), "Int64")
        .when(fact("number"), "float64")
        .otherwise("string")
    )


def infer_cell_types(cells: DataFrame, keys: tuple[str, ...] = ("report", "ord", "name")) -> DataFrame:
    """``(*keys, type)`` for long cells with a text ``value``."""
    filled = cells.select(*keys, _filled(F.col("value")).alias("value"))
    return filled.groupBy(*keys).agg(*_type_of(F.col("value"))).select(*keys, _decide().alias("type"))


def type_by_dtype(data_type: T.DataType) -> str:
    """Contract type of an already typed column (dates stay ``string``)."""
    if isinstance(data_type, T.IntegralType):
        return "Int64"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "float64"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return DATETIME_NAME
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    return "string"


def infer_types(df: DataFrame) -> DataFrame:
    """``(ord, name, type)`` for a wide DataFrame: one pass over all text columns at once."""
    fields = list(df.schema)
    texts = [i for i, f in enumerate(fields) if isinstance(f.dataType, T.StringType)]
    filled = df.select(F.lit(1).alias("row"), *[_filled(named(fields[i].name)).alias(f"c{i}") for i in texts])
    facts = [fact for i in texts for fact in _type_of(F.col(f"c{i}"), f"c{i}_")]
    # A frame without text columns still yields one row.
    one = filled.agg(F.count("row").alias("n"), *facts)
    entries = [
        F.struct(
            F.lit(i).alias("ord"),
            F.lit(f.name).alias("name"),
            (_decide(f"c{i}_") if isinstance(f.dataType, T.StringType) else F.lit(type_by_dtype(f.dataType))).alias(
                "type"
            ),
        )
        for i, f in enumerate(fields)
    ]
    return one.select(F.inline(F.array(*entries)))


def wide_to_cells(df: DataFrame, order: str, report: Column | None = None) -> DataFrame:
    """Text columns of a wide DataFrame as long cells ``(report, ord, name, position, value)``."""
    texts = [(i, f.name) for i, f in enumerate(df.schema) if isinstance(f.dataType, T.StringType) and f.name != order]
    entries = [
        F.struct(F.lit(i).alias("ord"), F.lit(n).alias("name"), named(n).alias("value")) for i, n in texts
    ]
    source = report if report is not None else F.lit("")
    return df.select(
        source.alias("report"), named(order).alias("position"), F.explode(F.array(*entries)).alias("cell")
    ).select("report", "cell.ord", "cell.name", "position", "cell.value")


def first_values(cells: DataFrame, count: int, keys: tuple[str, ...] = ("report", "ord", "name")) -> DataFrame:
    """The first ``count`` non-NULL values per column in row order.

    The limit is applied before the shuffle as well (``WindowGroupLimit``), so each task hands on at most
    ``count`` rows per column."""
    ordered = Window.partitionBy(*keys).orderBy("position")
    return cells.filter(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(ordered)).filter(
        F.col("rank") <= count
    )


def matching_columns(cells: DataFrame, pattern: str, count: int | None, keys: tuple[str, ...] = ("report", "ord", "name"), strip_values: bool = False) -> DataFrame:
    """Columns whose non-NULL values, all or the first ``count``, match ``pattern``; one without values doesn't."""
    value = strip(F.col("value")) if strip_values else F.col("value")
    sample = cells.filter("value IS NOT NULL") if count is None else first_values(cells, count, keys)
    return sample.groupBy(*keys).agg(F.bool_and(F.rlike(value, F.lit(pattern))).alias("all_match")).filter("all_match").drop("all_match")


def uuid_columns(cells: DataFrame, sample: int | None = None) -> DataFrame:
    """Columns that hold UUIDs, by every value or by the first ``sample``."""
    return matching_columns(cells, UUID_TEXT, sample)


def pick_event_time(types: DataFrame, cells: DataFrame, sample: int | None = None) -> DataFrame:
    """``(report, name, ord)`` of the event time: the first datetime column, else the first text
    column whose values, all of them or the first ``sample``, look like dates."""
    typed = types.filter(F.col("type") == DATETIME_NAME).select("report", "ord", "name", F.lit(0).alias("preference"))
    texts = types.filter(F.col("type") == "string").select("report", "ord", "name")
    dated = matching_columns(cells, DATE_TEXT, sample, strip_values=True)
    guessed = texts.join(dated, ["report", "ord", "name"], "left_semi").withColumn("preference", F.lit(1))
    best = F.min(F.struct("preference", "ord", "name")).alias("best")
    return typed.unionByName(guessed).groupBy("report").agg(best).select("report", "best.ord", "best.name")


def generate_contracts(cells: DataFrame, typed: DataFrame | None = None, date_sample: int | None = None) -> DataFrame:
    """I4 for any number of unknown reports: ``(report, ord, name, alias, type, table_name, event_time,
    use, index_name, index_column)``.

    ``cells`` are the reports' text cells with a ``position``; ``typed`` adds ``(report, ord, name, type)``
    rows for columns that are not text."""
    types = infer_cell_types(cells)
    if typed is not None:
        types = types.unionByName(typed)
    event = pick_event_time(types, cells, date_sample).select("report", F.col("ord").alias("event_ord"), F.col("name").alias("event_name"))
    first = types.groupBy("report").agg(F.min_by(column_alias(F.col("name")), "ord").alias("index_column"))
    is_event = F.coalesce(F.col("ord") == F.col("event_ord"), F.lit(False))
    return (
        types.join(event, "report", "left")
        .join(first, "report")
        .select(
            "report",
            "ord",
            "name",
            column_alias(F.col("name")).alias("alias"),
            F.when(is_event, DATETIME_NAME).otherwise(F.col("type")).alias("type"),
            F.concat(latin_identifier(F.col("report")), F.lit("_table")).alias("table_name"),
            column_alias(F.col("event_name")).alias("event_time"),
            F.lit(False).alias("use"),
            F.lit("default_idx").alias("index_name"),
            "index_column",
        )
    )


def collect_contracts(generated: DataFrame) -> list[Contract]:
    """Generated contracts as objects, for review: one small row per report column."""
    contracts: dict[str, list] = {}
    for row in generated.orderBy("report", "ord").toLocalIterator():
        contracts.setdefault(row["report"], []).append(row)
    return [
        Contract(
            report=report,
            use=False,
            table_name=rows[0]["table_name"],
            event_time=rows[0]["event_time"],
            columns=tuple(ContractColumn(r["name"], r["alias"], r["type"]) for r in rows),
            indexes=(IndexSpec("default_idx", (rows[0]["index_column"],)),),
        )
        for report, rows in contracts.items()
    ]


def target_columns(contracts: DataFrame, uuids: DataFrame) -> DataFrame:
    """The rows of ``generate_contracts`` with ``target``, the type a database column gets, and ``is_event``.

    Text columns among ``uuids (report, ord, name)`` become UUID."""
    names = {spelling: database_type(SPARK_TYPE[kind]) for spelling, kind in LOGICAL_TYPE.items()}
    by_name = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    marked = contracts.join(uuids.select("report", "ord", "name", F.lit(True).alias("__uuid")), ["report", "ord", "name"], "left")
    is_uuid = (F.col("type") == "string") & F.col("__uuid").isNotNull()
    target = F.when(is_uuid, "UUID").otherwise(F.coalesce(F.element_at(by_name, F.col("type")), F.lit("TEXT")))
    is_event = F.coalesce(F.col("alias") == F.col("event_time"), F.lit(False))
    return marked.withColumns({"target": target, "is_event": is_event}).drop("__uuid")
