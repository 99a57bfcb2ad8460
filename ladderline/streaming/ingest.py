"""From arrived files to loaded tables (D4): one batch of files per run, by tick or by stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ladderline.functions.casts import load_stamp
from ladderline.functions.text import named
from ladderline.operators.contracts import Contract, apply_contract, drop_service_columns, match_files
from ladderline.operators.evolution import with_surrogate_id
from ladderline.operators.flatten import flatten_tagged, tagged_counts, to_cells, to_columns
from ladderline.operators.inference import generate_contracts
from ladderline.operators.layout import detect_layout, layouts_by_file
from ladderline.operators.loading import SEQ, PeriodTable, audits
from ladderline.operators.periods import header_periods, report_periods
from ladderline.operators.quality import lost_cells
from ladderline.session import stage
from ladderline.sources.sheets import read_sheets, sheet_rows
from ladderline.sources.text_reports import as_rows, is_report, literal_path, read_text_lines, report_name
from ladderline.streaming.arrivals import new_versions, status_text

LOG_SCHEMA = "path string, mtime timestamp, report string, started timestamp, status string, rows bigint, error string"
OUTCOME_SCHEMA = (
    "path string, mtime timestamp, report string, started timestamp, kind string, detail_rows bigint, subtotal_rows bigint, "
    "ragged_rows bigint, other_rows bigint, padded_rows bigint, cut_rows bigint, kept array<string>, missing array<string>, "
    "dropped array<string>, unreadable_cells bigint, error string"
)
CELLS_SCHEMA = "path string, mtime timestamp, block bigint, line_no bigint, column_name string, expected string, received string"
FILES_PER_BATCH = 10_000
"""Files whose paths are handed to the readers at once; the others wait for the next batch of the same run."""
TABLES_AT_ONCE = 4


@dataclass
class IngestRun:
    """What a run did: the log rows it appended, proposed contracts, key violations per table, the outcome of every file and
    the cells that could not be read."""

    log: DataFrame | None
    proposals: DataFrame | None
    violations: dict[str, dict[str, DataFrame]]
    outcome: DataFrame | None = None
    cells: DataFrame | None = None


class Ingest:
    """Loads report files into tables by contract.

    ``log_table`` is both the ledger of processed file versions and the source of load status. Beside it stand
    ``<log_table>_outcome``, with one row per file that was read: which described columns it has, lacks and has beyond the
    contract, how many rows were details, subtotals, skipped, cut and padded, how many cells were unreadable, and the
    whole error; and ``<log_table>_cells`` with the unreadable cells. All of it is taken from the rows that one pass over
    the files leaves behind. A batch holds at most ``files_per_batch`` files, and up to ``tables_at_once`` tables are loaded
    side by side; the loads of one table follow each other, and logs are written in the order of the contracts.
    ``database`` overrides the contracts' schema names; ``report_of`` says which report a path belongs to
    (by default its base name)."""

    def __init__(
        self,
        spark: SparkSession,
        contracts: list[Contract],
        log_table: str,
        database: str | None = None,
        fallback_encoding: str | None = None,
        with_ids: bool = True,
        report_of: Callable[[Column], Column] = report_name,
        partition_unit: str = "day",
        files_per_batch: int = FILES_PER_BATCH,
        tables_at_once: int = TABLES_AT_ONCE,
    ):
        self.spark = spark
        self.contracts = {c.report: c for c in contracts}
        self.log_table = log_table
        self.database = database
        self.fallback_encoding = fallback_encoding
        self.with_ids = with_ids
        self.report_of = report_of
        self.partition_unit = partition_unit
        self.files_per_batch = files_per_batch
        self.tables_at_once = tables_at_once

    # ---- entry points

    def run_directory(self, directory: str) -> IngestRun:
        """One tick: list the directory (file contents are not read) and load what the ledger lacks."""
        listing = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(directory)
            .select("path", F.col("modificationTime").alias("mtime"))
        )
        return self.run_files(listing)

    def stream(self, events: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
        """Load files from a stream of arrivals ``(path, mtime)``, each version once."""
        return foreach_arrivals(events, lambda batch: self.run_files(batch), checkpoint, available_now)

    def run_files(self, files: DataFrame) -> IngestRun:
        """Load the versions among ``files (path, mtime)`` that the ledger does not know, oldest first."""
        self._create_logs()
        files = stage(files.select("path", "mtime"), "arrivals", reader=self.spark)
        ledger = self.spark.table(self.log_table).select("path", "mtime", "started")
        switched = self.spark.createDataFrame(
            [(c.report, c.use) for c in self.contracts.values()], "report string, use boolean"
        )
        fresh = new_versions(files.filter(is_report(F.col("path"))), ledger)
        todo = stage(match_files(fresh, switched, self.report_of).withColumn("started", F.current_timestamp()), "todo")
        skipped = todo.filter("state = 'disabled'")
        nothing = skipped.select("path", F.lit(None).cast("string").alias("reason"), F.lit(0).alias("rows"))
        logs = [stage(self._log_rows(skipped, nothing), "log")]
        self._append(logs[0], self.log_table)
        runs, after = [], None
        while True:
            waiting = todo.filter("state <> 'disabled'")
            if after:
                waiting = waiting.filter(F.struct("mtime", "path") > F.struct(F.lit(after["mtime"]), F.lit(after["path"])))
            batch = waiting.orderBy("mtime", "path").limit(self.files_per_batch)
            wanted = batch.select("mtime", "path").collect()
            if not wanted:
                break
            after = wanted[-1]
            until = F.struct("mtime", "path") <= F.struct(F.lit(after["mtime"]), F.lit(after["path"]))
            runs.append(self._run_batch(waiting.filter(until), [r["path"] for r in wanted]))
        return _together(logs, runs)

    def _run_batch(self, todo: DataFrame, wanted: list[str]) -> IngestRun:
        rows, merges, rejects = self._rows(wanted)
        layout = detect_layout(rows, merges)
        tagged = flatten_tagged(rows, layout).withColumn("report", self.report_of(F.col("path")))
        tagged = stage(tagged, "flat", partition_by=["report"])
        flat = tagged.filter("class = 'detail'")
        counts = stage(tagged_counts(tagged), "counts")
        per_file = counts.filter("detail_rows > 0").select("path", F.col("detail_rows").alias("rows"))
        problems = stage(self._problems(layout, per_file, rejects, rows, todo), "files")
        proposals = self._proposals(flat, todo)
        violations, logs, outcomes, cells = {}, [], [], []
        reports = {r["report"] for r in todo.select("report").distinct().collect()}  # reports of one batch
        due = [c for c in self.contracts.values() if c.use and c.report in reports]
        # A contract's files are logged as soon as they are loaded, and a contract that fails takes only its own files along.
        for contract, loaded in self._side_by_side(due, lambda c: self._load(c, flat, layout, problems, todo)):
            own = todo.filter(F.col("report") == contract.report)
            lost, error = None, None
            try:
                found, lost = loaded()
                if found:
                    violations[contract.table_name] = found
            except (PySparkException, ValueError) as failure:
                error = f"{type(failure).__name__}: {failure}"
            judged = problems.withColumn("reason", F.coalesce("reason", F.lit(error)))
            if lost is not None:
                cells.append(lost)
                self._append(lost, f"{self.log_table}_cells")
            outcomes.append(stage(self._outcome(own, layout, counts, judged, lost), "outcome"))
            self._append(outcomes[-1], f"{self.log_table}_outcome")
            logs.append(stage(self._log_rows(own, judged), "log"))
            self._append(logs[-1], self.log_table)
        named_reports = [c.report for c in self.contracts.values() if c.use]
        others = todo.filter(~F.col("report").isin(named_reports)) if named_reports else todo
        outcomes.append(stage(self._outcome(others, layout, counts, problems, None), "outcome"))
        self._append(outcomes[-1], f"{self.log_table}_outcome")
        logs.append(stage(self._log_rows(others, problems), "log"))
        self._append(logs[-1], self.log_table)
        every = reduce(DataFrame.unionByName, outcomes)
        return IngestRun(reduce(DataFrame.unionByName, logs), proposals, violations, every, reduce(DataFrame.unionByName, cells) if cells else None)

    def _side_by_side(self, contracts: list[Contract], load: Callable[[Contract], object]) -> Iterator[tuple[Contract, Callable]]:
        """Contracts, in their order, with what gives the result of their load or raises its error. Spark runs the jobs of
        several tables at once; contracts of one table are loaded one after another."""
        tables: dict[str, list[Contract]] = {}
        for contract in contracts:
            tables.setdefault(self._table_name(contract), []).append(contract)
        done = {c.report: Future() for c in contracts}

        def run(mine: list[Contract]) -> None:
            for contract in mine:
                try:
                    done[contract.report].set_result(load(contract))
                except BaseException as failure:  # noqa: BLE001, raised again by whoever takes the result
                    done[contract.report].set_exception(failure)

        with ThreadPoolExecutor(max(1, self.tables_at_once)) as pool:
            for mine in tables.values():
                pool.submit(run, mine)
            for contract in contracts:
                yield contract, done[contract.report].result

    # ---- steps

    def _rows(self, paths: list[str]) -> tuple[DataFrame, DataFrame | None, DataFrame]:
        """Report rows of text and sheet files in one form, staged once."""
        no_rejects = self.spark.createDataFrame([], "path string, reason string")
        books = [literal_path(p) for p in paths if p.lower().endswith(".mxl")]
        texts = [literal_path(p) for p in paths if not p.lower().endswith(".mxl")]
        parts, merges, rejects = [], None, no_rejects
        if texts:
            lines = stage(read_text_lines(self.spark, texts, self.fallback_encoding).drop("mtime"), "lines")
            parts.append(as_rows(lines))
        if books:
            sheets = read_sheets(self.spark, books)
            parts.append(stage(sheet_rows(sheets.cells), "sheet-rows"))
            merges, rejects = stage(sheets.merges, "merges"), stage(sheets.rejects, "rejects")
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows, merges, rejects

    def _problems(self, layout, per_file, rejects, rows, todo) -> DataFrame:
        """One row per file: ``(path, reason, start, end, rows)``; a reason means it is not loaded."""
        event_times = self.spark.createDataFrame(
            [(c.report, c.event_time) for c in self.contracts.values()], "report string, event_time string"
        )
        headers = header_periods(rows, layout).join(todo.select("path", "report"), "path").join(event_times, "report", "left")
        periods = report_periods(headers, F.col("event_time")).select("path", "start", "end", "missing")
        files = (
            todo.select("path", "report")
            .join(layouts_by_file(layout).select("path", "kind", F.col("reason").alias("layout_reason")), "path", "left")
            .join(rejects.withColumnRenamed("reason", "sheet_reason"), "path", "left")
            .join(per_file, "path", "left")
            .join(periods, "path", "left")
        )
        no_details = (F.col("kind") == "grouped") & F.col("rows").isNull()
        unbound = F.size("missing") > 0
        reason = F.coalesce(
            F.col("sheet_reason"),
            F.col("layout_reason"),
            F.when(F.col("kind").isNull(), "no table body"),
            F.when(no_details, "no detail rows"),
            F.when(unbound, F.concat(F.lit("missing period bounds: "), F.array_join("missing", ", "))),
        )
        return files.select("path", reason.alias("reason"), "start", "end", F.coalesce("rows", F.lit(0)).alias("rows"))

    def _proposals(self, flat: DataFrame, todo: DataFrame) -> DataFrame:
        """Contracts for reports without one, to be reviewed."""
        unknown = todo.filter("state = 'unknown'").select("path")
        cells = to_cells(flat.join(unknown, "path", "left_semi")).select(
            self.report_of(F.col("path")).alias("report"), "ord", "name",
            F.struct("path", "block", "line_no").alias("position"), "value",
        )
        return generate_contracts(cells)

    def _load(
        self, contract: Contract, flat: DataFrame, layout: DataFrame, problems: DataFrame, todo: DataFrame
    ) -> tuple[dict[str, DataFrame], DataFrame | None]:
        """All accepted files of one report, in one commit to its table; key violations and unreadable cells. Later files
        win: they are ordered by modification time, then path. A file version that the table took in before, in a run
        that ended before its log was written, is not loaded again."""
        files = (
            problems.filter("reason IS NULL")
            .join(todo.filter(F.col("report") == contract.report).select("path", "mtime"), "path")
            .join(layouts_by_file(layout).select("path", "names"), "path")
            .select("path", "mtime", "start", "end", "names", F.struct("mtime", "path").alias("seq"))
        )
        # As a table its size is known, so rows meet their file where they lie; by path, a file would be one task's.
        files = stage(files, "own-files")
        headers = files.select(F.explode("names").alias("name"))
        present = {r["name"] for r in headers.distinct().collect()}  # column headers of one report
        columns = [name for name in contract.aliases if name in present]
        if not columns:
            return {}, None
        keys = ("__at", "__names", "__lost")
        mine = flat.filter(F.col("report") == contract.report).join(files.select("path", F.col("seq").alias(SEQ)), "path")
        mine = mine.withColumns({"__at": F.struct("path", "block", "line_no"), "__names": F.col("names")})
        raw = to_columns(mine, columns, (*keys[:2], SEQ)).withColumn("__lost", lost_cells(columns, contract))
        typed = apply_contract(raw, contract, keep=(*keys, SEQ))
        # Casts turn unreadable numbers into 0; a column that the row's own file lacks stays NULL.
        origin = {contract.aliases[c]: c for c in columns}
        values = [
            F.when(F.array_contains("__names", origin[f.name]), named(f.name)).alias(f.name, metadata=f.metadata)
            if f.name in origin else named(f.name)
            for f in typed.schema
        ]
        typed = drop_service_columns(typed.select(*values)).withColumn("date_download", load_stamp())
        table = PeriodTable(self.spark, self._table_name(contract), contract.event_time, self.partition_unit)
        if self.with_ids:
            typed = self._with_ids(typed, table)
        typed = stage(typed, "typed")
        loadable = typed.drop(*keys)
        target = loadable.drop(SEQ).schema
        table.create_if_absent(target)
        # A described column that none of these files has stays in the table and is NULL in the new rows.
        described = set(contract.aliases.values())
        waiting = [f for f in table.read().schema if f.name in described and f.name not in target.names]
        table.sync_schema(T.StructType([*target, *waiting]))
        # A file without the event-time column only appends, whatever came with it.
        times = [name for name, alias in contract.aliases.items() if alias == contract.event_time]
        replacing = files.filter(F.arrays_overlap("names", F.array(*map(F.lit, times)))) if times else files.limit(0)
        version = F.concat_ws("@", "path", F.unix_micros("mtime").cast("string"))
        table.load_many(loadable, replacing.select("seq", "start", "end"), files.select("seq", version.alias("load_id")), self.with_ids)
        table.describe(contract.comment, contract.comments)
        table.vacuum()
        lost = typed.filter(F.size("__lost") > 0).select(f"{SEQ}.path", f"{SEQ}.mtime", "__at.block", "__at.line_no", F.inline("__lost"))
        return audits(table.read(), contract.indexes), stage(lost, "lost")

    def _with_ids(self, typed: DataFrame, table: PeriodTable) -> DataFrame:
        placed = typed.withColumns({"__unit": F.struct(F.col(SEQ), F.col("__at.block")), "__line": F.col("__at.line_no")})
        return with_surrogate_id(stage(placed, "placed"), "__line", "__unit", start=table.last_id()).drop("__unit", "__line")

    def _outcome(self, todo: DataFrame, layout: DataFrame, counts: DataFrame, judged: DataFrame, lost: DataFrame | None) -> DataFrame:
        """One row per file; columns are compared with the contract where the file's table was read."""
        described = self.spark.createDataFrame(
            [(c.report, list(c.aliases)) for c in self.contracts.values()], "report string, described array<string>"
        )
        names = F.when(F.col("kind") != "rejected", F.col("names"))
        layouts = layouts_by_file(layout).select("path", "kind", names.alias("names"))
        unread = (
            lost.groupBy("path").agg(F.count(F.lit(1)).alias("unreadable_cells")) if lost is not None
            else self.spark.createDataFrame([], "path string, unreadable_cells bigint")
        )
        files = (
            todo.select("path", "mtime", "report", "started").join(layouts, "path", "left").join(counts, "path", "left")
            .join(unread, "path", "left").join(judged.select("path", F.col("reason").alias("error")), "path", "left")
            .join(described, "report", "left")
        )
        zero = [f"{c}_rows" for c in ("detail", "subtotal", "ragged", "other", "padded", "cut")] + ["unreadable_cells"]
        compared = {
            "kept": F.array_intersect("names", "described"), "missing": F.array_except("described", "names"),
            "dropped": F.array_except("names", "described"),
        }
        filled = files.withColumns({**{c: F.coalesce(c, F.lit(0)).cast("bigint") for c in zero}, **compared})
        return filled.select(*[f.name for f in T.StructType.fromDDL(OUTCOME_SCHEMA)])

    def _table_name(self, contract: Contract) -> str:
        return f"{self.database or contract.schema_name}.{contract.table_name}"

    def _log_rows(self, todo: DataFrame, problems: DataFrame) -> DataFrame:
        judged = todo.join(problems.select("path", "reason", "rows"), "path", "left")
        loaded = F.col("state") == "load"
        status = F.when(loaded, status_text(F.col("reason"), F.current_timestamp()))
        count = F.when(loaded & F.col("reason").isNull(), F.coalesce("rows", F.lit(0))).otherwise(0).cast("bigint")
        error = F.when(loaded, F.col("reason"))
        return judged.select("path", "mtime", "report", "started", status.alias("status"), count.alias("rows"), error.alias("error"))

    def _create_logs(self) -> None:
        for end, columns in (("", LOG_SCHEMA), ("_outcome", OUTCOME_SCHEMA), ("_cells", CELLS_SCHEMA)):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.log_table}{end} ({columns}) USING parquet")
            self.spark.catalog.refreshTable(f"{self.log_table}{end}")
        if "error" not in self.spark.table(self.log_table).columns:  # a log that was begun without it
            self.spark.sql(f"ALTER TABLE {self.log_table} ADD COLUMNS (error string)")

    def _append(self, rows: DataFrame, table: str) -> None:
        rows.write.mode("append").insertInto(table)


def _together(logs: list[DataFrame], runs: list[IngestRun]) -> IngestRun:
    """The batches of a run as one."""
    union = lambda parts: reduce(DataFrame.unionByName, parts) if parts else None
    violations: dict[str, dict[str, DataFrame]] = {}
    for run in runs:
        violations |= run.violations
    return IngestRun(
        union([*logs, *[r.log for r in runs]]), union([r.proposals for r in runs]), violations,
        union([r.outcome for r in runs]), union([r.cells for r in runs if r.cells is not None]),
    )


def foreach_arrivals(
    events: DataFrame, load: Callable[[DataFrame], object], checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Hand each micro-batch of file versions to ``load``, which knows by its ledger what was loaded before. No version is
    too old to be handed on."""
    writer = events.writeStream.foreachBatch(lambda batch, _: load(batch)).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def until_all_are_loaded(events: DataFrame, load: Callable[[DataFrame], object], checkpoint: str) -> None:
    """Micro-batch after micro-batch until the source has nothing more; for ``changed_files``, whose batches are bounded."""
    query = foreach_arrivals(events, load, checkpoint, available_now=False)
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def watch_directory(spark: SparkSession, directory: str) -> DataFrame:
    """A stream of new files ``(path, mtime)``. It does not report changes of known files: ``changed_files`` does, as do
    ``Ingest.run_directory`` ticks."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .load(directory)
        .select("path", F.col("modificationTime").alias("mtime"))
        .filter(is_report(F.col("path")))
    )
