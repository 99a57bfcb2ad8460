"""Table schemas: name resolution (J2), schema differences (J4), evolution (K4), comments (K5), ids (K3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.casts import cast_to_target
from ladderline.functions.identifiers import truncate_bytes
from ladderline.functions.text import named, quote_name
from ladderline.operators.contracts import SERVICE_COLUMNS
from ladderline.plans.ordered import block_offsets


# PostgreSQL's names, and common aliases, of types that are stored alike.
TYPE_FAMILIES = {
    "BIGINT": ("BIGINT", "BIGSERIAL", "INT", "INT2", "INT4", "INT8", "INTEGER", "SERIAL", "SMALLINT", "SMALLSERIAL"),
    "DOUBLE PRECISION": ("DECIMAL", "DOUBLE", "DOUBLE PRECISION", "FLOAT4", "FLOAT8", "NUMERIC", "REAL"),
    "TEXT": ("CHAR", "CHARACTER", "CHARACTER VARYING", "TEXT", "VARCHAR"),
    "TIMESTAMP": ("TIMESTAMP", "TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITHOUT TIME ZONE", "TIMESTAMPTZ"),
}


def type_family(type_name: Column) -> Column:
    """The family a database type belongs to, whatever its length or precision; a type of no family is its own."""
    plain = F.regexp_replace(F.upper(F.trim(type_name)), r"\s*\([^)]*\)", "")
    families = F.create_map(*[F.lit(x) for family, names in TYPE_FAMILIES.items() for name in names for x in (name, family)])
    return F.coalesce(F.element_at(families, plain), plain)


# Database type per Spark type.
DATABASE_TYPES = {
    T.LongType: "BIGINT", T.IntegerType: "BIGINT", T.ShortType: "BIGINT", T.ByteType: "BIGINT",
    T.DoubleType: "DOUBLE PRECISION", T.FloatType: "DOUBLE PRECISION",
    T.BooleanType: "BOOLEAN", T.TimestampType: "TIMESTAMP", T.TimestampNTZType: "TIMESTAMP",
    T.DateType: "DATE",
}


def database_type(data_type: T.DataType, is_uuid: bool = False) -> str:
    """The target type of a column; text columns whose sample is all UUIDs become UUID."""
    if isinstance(data_type, T.StringType) and is_uuid:
        return "UUID"
    return DATABASE_TYPES.get(type(data_type), "TEXT")


def schema_frame(spark: SparkSession, table: str, columns: dict[str, str]) -> DataFrame:
    """A table's columns as rows ``(table_name, ord, name, type)``."""
    rows = [(table, i, n, t) for i, (n, t) in enumerate(columns.items())]
    return spark.createDataFrame(rows, "table_name string, ord int, name string, type string")


def resolve_names(existing: DataFrame, expected: DataFrame) -> DataFrame:
    """``(table_name, name, actual)``; ``actual`` is the existing column of that exact name, else the
    one stored under the name cut to 63 bytes, else NULL.

    Both sides meet in one sort per table and cut name. A name travels as its cut and the bytes behind it, so no text is
    held twice, and the existing column with no such bytes is the cut one."""
    parts = lambda df: df.withColumn("__short", truncate_bytes(F.col("name"))).withColumn(
        "__rest", F.substring(F.col("name").cast("binary"), F.coalesce(F.octet_length("__short"), F.lit(0)) + 1, F.octet_length("name"))
    )
    have = parts(existing.select("table_name", "name").dropna()).select("table_name", "__short", "__rest", F.lit(True).alias("__stored"))
    want = parts(expected).drop("name").withColumn("__stored", F.lit(False))
    met = want.unionByName(have, allowMissingColumns=True)
    group = Window.partitionBy("table_name", "__short").orderBy("__rest")
    exact = F.max("__stored").over(group.rangeBetween(Window.currentRow, Window.currentRow))
    cut = F.max(F.col("__stored") & (F.octet_length("__rest") == 0)).over(group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    found = met.withColumn("__exact", exact).withColumn("__cut", cut).filter(~F.col("__stored"))
    name = F.concat(F.coalesce(F.col("__short").cast("binary"), F.lit(b"")), "__rest").cast("string")
    others = [F.col(f"`{c}`") for c in expected.columns if c not in ("table_name", "name")]
    actual = F.when(F.col("__exact"), F.col("name")).when(F.col("__cut"), F.col("__short"))
    return found.withColumn("name", name).select("table_name", "name", *others, actual.alias("actual"))


def schema_diff(existing: DataFrame, expected: DataFrame) -> DataFrame:
    """``(table_name, name, action, from_type, to_type)`` with action ``add``, ``retype``, ``drop`` or
    ``keep``; ``name`` is the stored name where the column exists. Both sides are
    ``(table_name, name, type)`` rows, for all tables at once."""
    have = existing.select("table_name", F.col("name").alias("actual"), F.col("type").alias("from_type"))
    want = resolve_names(existing, expected.select("table_name", "name", F.col("type").alias("to_type")))
    both = want.join(have, ["table_name", "actual"], "full_outer")
    same = type_family(F.col("from_type")) == type_family(F.col("to_type"))
    action = (
        F.when(F.col("from_type").isNull(), "add")
        .when(F.col("name").isNull(), F.when(F.col("actual").isin(*SERVICE_COLUMNS), "keep").otherwise("drop"))
        .when(same, "keep")
        .otherwise("retype")
    )
    return both.select("table_name", F.coalesce("actual", "name").alias("name"), action.alias("action"), "from_type", "to_type")


def evolve(old: DataFrame, target: T.StructType, strict: bool = True) -> DataFrame:
    """K4: the old table in the target schema, as one projection: new columns are NULL, changed types are
    cast (``strict`` fails on unreadable values, otherwise they become NULL), other columns go.

    A column stored under its 63-byte name takes its full name back."""
    stored = {f.name: f for f in old.schema}
    projection = []
    for field in target:
        source = stored.get(field.name) or stored.get(_cut(field.name))
        if source is None:
            value = F.lit(None).cast(field.dataType)
        elif source.dataType == field.dataType:
            value = named(source.name)
        elif strict:
            value = named(source.name).cast(field.dataType)
        else:
            value = cast_to_target(named(source.name), source.dataType, field.dataType)
        projection.append(value.alias(field.name, metadata=field.metadata) if field.metadata else value.alias(field.name))
    service = [named(c) for c in old.columns if c in SERVICE_COLUMNS and c not in target.names]
    return old.select(*service, *projection)


def _cut(name: str, limit: int = 63) -> str:
    return name.encode("utf-8")[:limit].decode("utf-8", errors="ignore")


def changed_comments(spark: SparkSession, table: str, wanted: dict[str, str]) -> dict[str, str]:
    """K5: the non-empty comments that differ from the stored ones."""
    current = {f.name: f.metadata.get("comment") for f in spark.table(table).schema}
    return {c: text for c, text in wanted.items() if text and c in current and current[c] != text}


def sync_comments(spark: SparkSession, table: str, table_comment: str | None, wanted: dict[str, str]) -> None:
    literal = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if table_comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {literal(table_comment)}")
    for column, text in changed_comments(spark, table, wanted).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {quote_name(column)} COMMENT {literal(text)}")


def with_surrogate_id(rows: DataFrame, order: str, block: str = "block", start: int | Column = 0, name: str = "id") -> DataFrame:
    """K3: a dense key that continues after ``start`` in ``(block, order)`` order.

    Counting inside blocks plus the counts of earlier blocks, which are prefix sums over a tree of ranges of blocks, so no
    task sees more than a block or a range. ``rows`` is read twice; stage it when what lies behind it is expensive."""
    before = block_offsets(rows.groupBy(block).agg(F.count(F.lit(1)).alias("n")), block)
    within = F.row_number().over(Window.partitionBy(block).orderBy(order))
    offset = F.lit(start) if isinstance(start, int) else start
    return rows.join(before, block).withColumn(name, (within + F.col("before") + offset).cast("bigint")).select(*rows.columns, name)
