"""Column contracts (P1-P5, P7, J1, J3): which columns a report has, their names and types."""

from __future__ import annotations

import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.casts import LOGICAL_TYPE, SPARK_TYPE, cast_column
from ladderline.functions.text import named
from ladderline.sources.text_reports import report_name

SERVICE_COLUMNS = ("id", "ID", "Id")


@dataclass(frozen=True)
class ContractColumn:
    name: str
    alias: str | None = None
    type: str = "string"
    comment: str | None = None

    @property
    def output(self) -> str:
        return self.alias or self.name


@dataclass(frozen=True)
class IndexSpec:
    name: str | None = None
    columns: tuple[str, ...] = ()
    use: bool = False
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    """The load settings of one report; ``report`` is the file's base name."""

    report: str
    use: bool = False
    table_name: str = "report01"
    schema_name: str = "marts"
    event_time: str | None = None
    comment: str | None = None
    columns: tuple[ContractColumn, ...] = ()
    indexes: tuple[IndexSpec, ...] = field(default=())

    @staticmethod
    def from_mapping(report: str, settings: dict) -> Contract:
        """From parsed settings; unknown keys are allowed and empty strings mean "not set"."""
        text = lambda key, default=None: settings.get(key) or default
        return Contract(
            report=report,
            use=bool(settings.get("use", False)),
            table_name=text("table_name", "report01"),
            schema_name=text("schema_name", "marts"),
            event_time=text("event_time"),
            comment=text("comment"),
            columns=tuple(
                ContractColumn(c["name"], c.get("alias") or None, c.get("type", "string"), c.get("comment") or None)
                for c in settings.get("columns", [])
                if c.get("name")
            ),
            indexes=tuple(
                IndexSpec(
                    (i.get("name") or "").strip() or None,
                    tuple(c for c in i.get("columns", []) if str(c).strip()),
                    bool(i.get("use", False)),
                    bool(i.get("unique", False)),
                )
                for i in settings.get("indexes", [])
            ),
        )

    @staticmethod
    def from_toml(report: str, text: str) -> Contract:
        return Contract.from_mapping(report, tomllib.loads(text))

    @property
    def aliases(self) -> dict[str, str]:
        """File column to output column; of repeated names the last entry counts."""
        return {c.name: c.output for c in self.columns}

    @property
    def comments(self) -> dict[str, str]:
        return {c.alias: c.comment for c in self.columns if c.alias and c.comment}

    def output_types(self) -> dict[str, T.DataType]:
        return {c.output: SPARK_TYPE[LOGICAL_TYPE[c.type]] for c in self.columns if c.type in LOGICAL_TYPE}


def apply_contract(df: DataFrame, contract: Contract, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename, drop what the contract does not describe, cast; the file's column order stays.

    Described columns the file lacks are skipped (``match_contract`` reports them), and ``keep`` names
    columns to pass on untouched. It is one projection, so the scan below reads only what is used."""
    aliases = contract.aliases
    kept = [c for c in df.columns if c in aliases and c not in keep]
    outputs = [aliases[c] for c in kept]
    if len(set(outputs)) != len(outputs):
        raise ValueError(f"contract of {contract.report} maps two columns to one name: {outputs}")
    projection = []
    for name in kept:
        value = named(name)
        for column in contract.columns:
            if column.output == aliases[name]:
                value = cast_column(value, column.type)
        comment = contract.comments.get(aliases[name])
        metadata = {"comment": comment} if comment else None
        projection.append(value.alias(aliases[name], metadata=metadata) if metadata else value.alias(aliases[name]))
    return df.select(*projection, *keep)


def drop_service_columns(df: DataFrame) -> DataFrame:
    """Leave out the table's own key column, in exactly its three spellings."""
    return df.select(*[named(c) for c in df.columns if c not in SERVICE_COLUMNS])


def contracts_frame(spark: SparkSession, contracts: list[Contract]) -> DataFrame:
    """Contracts as rows ``(report, ord, name, alias, type, comment)``."""
    rows = [
        (c.report, i, col.name, col.output, col.type, col.comment)
        for c in contracts
        for i, col in enumerate(c.columns)
    ]
    return spark.createDataFrame(
        rows, "report string, ord int, name string, alias string, type string, comment string"
    )


def match_contract(file_columns: DataFrame, contract_columns: DataFrame) -> DataFrame:
    """``(report, name, alias, status)`` with status ``kept``, ``missing`` or ``dropped``.

    Both sides carry ``(report, name)``; the contract side also ``(ord, alias)``, whose last entry per
    name counts."""
    wanted = contract_columns.groupBy("report", "name").agg(F.max_by("alias", "ord").alias("alias"))
    present = file_columns.select("report", "name").distinct().withColumn("present", F.lit(True))
    status = F.when(F.col("present").isNull(), "missing").when(F.col("alias").isNull(), "dropped").otherwise("kept")
    return present.join(wanted, ["report", "name"], "full_outer").select("report", "name", "alias", status.alias("status"))


def match_files(
    files: DataFrame, contracts: DataFrame, report_of: Callable[[Column], Column] = report_name
) -> DataFrame:
    """Files with their report name and load state: ``load``, ``disabled`` or ``unknown``.

    ``contracts`` is ``(report, use)``, one row per report; Spark broadcasts it while it is small."""
    with_report = files.withColumn("report", report_of(F.col("path")))
    known = contracts.select("report", F.col("use").alias("__use"))
    state = F.when(F.col("__use").isNull(), "unknown").when(F.col("__use"), "load").otherwise("disabled")
    return with_report.join(known, "report", "left").withColumn("state", state).drop("__use")
