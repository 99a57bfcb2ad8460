"""The query registry and the expressions reports are rendered with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderline.session import stage

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name, with the SQL over the same tables that it must equal."""

    def register(run: Run) -> Run:
        REGISTRY[run.__name__] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return source.select(*columns) if columns else source


def cents(value: Column) -> Column:
    """Money as whole cents, the only form in which both engines agree digit for digit."""
    return F.round(value * 100).cast("bigint")


def money_text(value: Column, separator: str = " ") -> Column:
    """``44473.56`` as reports print it: ``44 473,56``."""
    sign = F.when(cents(value) < 0, "-").otherwise("")
    whole = F.translate(F.format_number(F.floor(F.abs(cents(value)) / 100), 0), ",", separator)
    return F.concat(sign, whole, F.lit(","), F.lpad((F.abs(cents(value)) % 100).cast("string"), 2, "0"))


def day_text(moment: Column) -> Column:
    return F.date_format(moment, "dd.MM.yyyy")


def line_of(*cells: Column | str) -> Column:
    """A report line: cells joined by tabs."""
    return F.concat_ws("\t", *[F.lit(c) if isinstance(c, str) else F.coalesce(c.cast("string"), F.lit("")) for c in cells])


def written(lines: DataFrame) -> DataFrame:
    """Rendered report lines ``(path, block, line_no, line)`` as a table: it stands for the report files."""
    parallelism = lines.sparkSession.sparkContext.defaultParallelism
    return stage(lines.repartition(parallelism, "path", "block"), "lines")


def fixed_lines(files: DataFrame, lines: list[str], first: int = 0) -> DataFrame:
    """The same lines at the top of every file ``(path, line_no, line)``."""
    entries = [F.struct(F.lit(first + i).cast("bigint").alias("line_no"), F.lit(text).alias("line")) for i, text in enumerate(lines)]
    return files.select("path", F.inline(F.array(*entries)))
