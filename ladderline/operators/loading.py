"""Period-replace loads (K1, K2, K6), load counts (I6), write layout (K7) and key audits (K8)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.periods import event_day, in_period, outside_period
from ladderline.functions.text import named, quote_name
from ladderline.operators.contracts import SERVICE_COLUMNS, IndexSpec
from ladderline.operators.evolution import changed_comments, evolve
from ladderline.session import stage, unstage


def replace_period(old: DataFrame, new: DataFrame, event_time: str | None, start: Column, end: Column) -> DataFrame:
    """K1: old rows outside the period, then the new rows. Without an event time (or when the loaded
    columns lack it) nothing is deleted."""
    if not event_time or event_time not in new.columns or event_time not in old.columns:
        return old.unionByName(new, allowMissingColumns=True)
    kept = old.filter(outside_period(named(event_time), old.schema[event_time].dataType, start, end))
    return kept.unionByName(new, allowMissingColumns=True)


def period_counts(old: DataFrame, event_time: str, start: Column, end: Column) -> DataFrame:
    """One row ``(total, in_period)``, the dry run of a period delete."""
    predicate = in_period(named(event_time), old.schema[event_time].dataType, start, end)
    return old.agg(F.count(F.lit(1)).alias("total"), F.count_if(predicate).alias("in_period"))


def surviving_rows(rows: DataFrame, loads: DataFrame, time: str, table: str | None = None, seq: str = "seq") -> DataFrame:
    """K6: rows of many period loads (and of the old tables) that no later load of their table deletes.

    ``rows`` carry ``seq``, or the column it names (struct or number; NULL for rows that were there before) and ``time``; ``loads``
    are ``(seq, start, end)`` and, when ``table`` names the table column, that column.

    The loads become clips per day they cover, with only the latest load per distinct clip: most loads
    cover whole days, so a day ends up with a handful of clips however many loads there are. Rows meet
    their day's clips in one equi-join that matches at most one row, so a busy day does not multiply rows
    (and adaptive execution may split it). Rows without a time match nothing and survive.
    """
    keys = ([table] if table else []) + ["__day"]
    clips = loads_by_day(loads, [table] if table else [])
    located = rows.withColumn("__day", F.col(time).cast("date"))
    # Rows without a time stay out of the join, where they would all have one key.
    timeless, timed = located.filter("__day IS NULL"), located.filter("__day IS NOT NULL")
    joined = timed.join(clips, keys, "left")
    covered = F.exists(
        "clips",
        lambda c: (c["from"] <= F.col(time)) & (F.col(time) <= c["to"]) & (F.col(seq).isNull() | (c["seq"] > F.col(seq))),
    )
    columns = [named(c) for c in rows.columns]
    return joined.filter(~F.coalesce(covered, F.lit(False))).select(*columns).unionByName(timeless.select(*columns))


def loads_by_day(loads: DataFrame, table_keys: list[str]) -> DataFrame:
    """``(*table_keys, __day, clips)``: what the loads cover of each day, latest load first kept."""
    valid = loads.filter(F.col("start").isNotNull()).withColumn("end", F.coalesce("end", "start")).filter(
        F.col("end") >= F.col("start")
    )
    days = F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date"), F.expr("INTERVAL 1 DAY")))
    daily = valid.select(*table_keys, "seq", "start", "end", days.alias("__day"))
    day_start = F.col("__day").cast("timestamp_ntz")
    day_end = (F.date_add("__day", 1).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND")).cast("timestamp_ntz")
    clipped = daily.select(
        *table_keys,
        "__day",
        "seq",
        F.greatest(F.col("start").cast("timestamp_ntz"), day_start).alias("from"),
        F.least(F.col("end").cast("timestamp_ntz"), day_end).alias("to"),
    )
    latest = clipped.groupBy(*table_keys, "__day", "from", "to").agg(F.max("seq").alias("seq"))
    return latest.groupBy(*table_keys, "__day").agg(F.collect_list(F.struct("from", "to", "seq")).alias("clips"))


def event_moment(value: Column, value_type: T.DataType) -> Column:
    """The time ``surviving_rows`` compares: text columns compare by day."""
    if isinstance(value_type, T.StringType):
        return event_day(value).cast("timestamp_ntz")
    return value.cast("timestamp_ntz")


def append_counts(planned: DataFrame, loaded: DataFrame, actual: DataFrame) -> DataFrame:
    """K2: one row ``(planned, loaded, actual)``."""
    names = ("planned", "loaded", "actual")
    ones = [
        df.select(*[F.lit(1 if n == mine else 0).alias(n) for n in names])
        for mine, df in zip(names, (planned, loaded, actual), strict=True)
    ]
    counted = ones[0].unionByName(ones[1]).unionByName(ones[2])
    return counted.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """K8: keys that occur more than once, with their count; a key with a NULL part never collides."""
    columns = [named(k) for k in keys]
    return df.na.drop(subset=keys).groupBy(*columns).agg(F.count(F.lit(1)).alias("occurrences")).filter(
        F.col("occurrences") > 1
    )


def audits(df: DataFrame, indexes: tuple[IndexSpec, ...]) -> dict[str, DataFrame]:
    """Violations per usable unique index; entries switched off or without name or columns are skipped."""
    usable = [i for i in indexes if i.use and i.unique and i.name and i.columns]
    return {i.name: unique_violations(df, list(i.columns)) for i in usable}


def key_layout(df: DataFrame, indexes: tuple[IndexSpec, ...], partitions: int | None = None) -> DataFrame:
    """K7: rows clustered by the first usable index, so file statistics prune reads by it."""
    usable = [i for i in indexes if i.use and i.name and i.columns]
    if not usable:
        return df
    keys = [named(c) for c in usable[0].columns]
    spread = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return spread.sortWithinPartitions(*keys)


def key_ranges(written: DataFrame, key: str) -> DataFrame:
    """``(file, least, greatest, rows)``: what each file of a written layout holds of a key. A read of one key opens the
    files whose range has it, by the statistics that Parquet keeps of every row group."""
    file = F.col("_metadata.file_path").alias("file")
    return written.select(file, named(key).alias("key")).groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("greatest"), F.count(F.lit(1)).alias("rows"))


# ---- a table that is replaced period by period -------------------------------------------------------

EVENT_DATE, SEQ, LOAD = "__event_date", "__seq", "__load"
"""Names of the table's own columns, which no contract may use."""
LISTED_DAYS = 1000
VERSION, PARTS, LAST_ID = "ladderline.version", "ladderline.parts", "ladderline.last_id"
"""Properties of the table: its current version, the table that holds its rows, the last surrogate key given out."""
STATE_SCHEMA = "kind string, event_date date, load string, version string"


class PeriodTable:
    """A Parquet table partitioned by event date whose loads are one commit each.

    ``unit`` is the width of a partition: ``day``, or ``month`` or ``year`` for small tables over long times.

    Under the table's name stands a view. Rows lie in ``<name>__parts``, in a folder per date and load; ``<name>__state``
    says for every version which loads' folders are current for which date; ``<name>__loads`` has the loads that each
    version took in. A load writes the new content of the dates it touches to folders of its own, then the state of the
    next version, and last replaces the view, which names its version. That step is the commit: whatever dies before it
    leaves the table as it was, and what was written is in no version. A load that comes with an id is taken in once, so
    repeating it after a crash on either side of the commit does no harm. ``vacuum`` removes folders of no version.
    A table has one writer at a time; readers are never disturbed by a load.
    """

    def __init__(self, spark: SparkSession, name: str, event_time: str | None, unit: str = "day"):
        self.spark = spark
        self.name = name
        self.event_time = event_time
        self.unit = unit

    def _partition(self, moment: Column) -> Column:
        return F.date_trunc(self.unit, moment).cast("date")

    def _moment(self, df: DataFrame) -> Column:
        """The event time as loads compare it; NULL when the rows have none."""
        if not self.event_time or self.event_time not in df.columns:
            return F.lit(None).cast("timestamp_ntz")
        return event_moment(named(self.event_time), df.schema[self.event_time].dataType)

    # ---- what the catalog knows

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def properties(self) -> dict[str, str]:
        found = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect()}
        if VERSION not in found:
            raise ValueError(f"{self.name} is not a table of period loads")
        return found

    def last_id(self) -> int:
        """The last surrogate key given out; no scan is needed for it."""
        return int(self.properties()[LAST_ID]) if self.exists() else 0

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(EVENT_DATE)

    def state(self, version: str | None = None) -> DataFrame:
        """``(kind, event_date, load)`` of a version: its ``part`` folders and the ``version``s it comes from."""
        version = version or self.properties()[VERSION]
        return self.spark.table(f"{self.name}__state").filter(F.col("version") == version).drop("version")

    def committed(self) -> DataFrame:
        """``(load_id)`` of all loads that were taken in."""
        versions = self.state().filter("kind = 'version'").select(F.col("load").alias("version"))
        return self.spark.table(f"{self.name}__loads").join(versions, "version", "left_semi").select("load_id")

    # ---- commits

    def create_if_absent(self, schema: T.StructType) -> None:
        """K3: an empty table of this schema; nothing happens when it exists."""
        if self.exists():
            self.properties()
            return
        for end in ("parts", "state", "loads"):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}__{end}")
        self._create_parts(schema, f"{self.name}__parts")
        self.spark.sql(f"CREATE TABLE {self.name}__state ({STATE_SCHEMA}) USING parquet PARTITIONED BY (version)")
        self.spark.sql(f"CREATE TABLE {self.name}__loads (load_id string, version string) USING parquet PARTITIONED BY (version)")
        self._commit("none", f"{self.name}__parts", 0)

    def _create_parts(self, schema: T.StructType, parts: str) -> None:
        columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in schema if f.name != EVENT_DATE)
        self.spark.sql(
            f"CREATE TABLE {parts} ({columns}, {EVENT_DATE} DATE, {LOAD} STRING) USING parquet PARTITIONED BY ({EVENT_DATE}, {LOAD})"
        )

    def _commit(self, version: str, parts: str, last_id: int, comment: str | None = None, comments: dict[str, str] | None = None) -> None:
        """Point the table at a version, in one statement; comments stay unless new ones are given."""
        known = {f.name: f.metadata.get("comment") for f in self.spark.table(self.name).schema} if self.exists() else {}
        known |= {c: text for c, text in (comments or {}).items() if text}
        if comment is None and known:
            comment = self.spark.catalog.getTable(self.name).description
        fields = [f.name for f in self.spark.table(parts).schema if f.name != LOAD]
        listed = ", ".join(quote_name(c) + (f" COMMENT {_literal(known[c])}" if known.get(c) else "") for c in fields)
        remark = f"COMMENT {_literal(comment)}" if comment else ""
        chosen = ", ".join(f"p.{quote_name(c)}" for c in fields)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} ({listed}) {remark} "
            f"TBLPROPERTIES ('{VERSION}' = '{version}', '{PARTS}' = '{parts}', '{LAST_ID}' = '{last_id}') AS "
            f"SELECT {chosen} FROM {parts} p LEFT SEMI JOIN (SELECT event_date, load FROM {self.name}__state "
            f"WHERE version = '{version}' AND kind = 'part') s ON p.{LOAD} = s.load AND p.{EVENT_DATE} <=> s.event_date"
        )

    def _write_state(self, version: str, kept: DataFrame, written: DataFrame) -> None:
        """The folders of a version: those it keeps, those of the dates just ``written``; and where it comes from."""
        here = written.select(F.lit("part").alias("kind"), F.col(EVENT_DATE).alias("event_date"), F.lit(version).alias("load"))
        own = self.spark.range(1).select(F.lit("version").alias("kind"), F.lit(None).cast("date").alias("event_date"), F.lit(version).alias("load"))
        state = kept.select("kind", "event_date", "load").unionByName(here.distinct()).unionByName(own)
        state.withColumn("version", F.lit(version)).coalesce(1).write.mode("append").insertInto(f"{self.name}__state")

    def sync_schema(self, target: T.StructType, strict: bool = True) -> None:
        """K4: bring the table to ``target``. Added columns only change the catalog; a changed type or a dropped column
        writes all rows anew, next to the old ones, and commits them."""
        current = self.read().schema
        stored = {f.name: f.dataType for f in current}
        wanted = {f.name: f.dataType for f in target}
        added = [f for f in target if f.name not in stored]
        facts = self.properties()
        if all(wanted.get(name) == kind for name, kind in stored.items() if name not in SERVICE_COLUMNS):
            if added:
                columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in added)
                self.spark.sql(f"ALTER TABLE {facts[PARTS]} ADD COLUMNS ({columns})")
                self._commit(facts[VERSION], facts[PARTS], int(facts[LAST_ID]))
            return
        content, version = evolve(self.read(), target, strict), uuid.uuid4().hex
        parts = f"{self.name}__parts_{version}"
        self._create_parts(content.schema, parts)
        dated = content.withColumn(EVENT_DATE, self._partition(self._moment(content))).withColumn(LOAD, F.lit(version))
        _spread(dated).write.mode("append").insertInto(parts)
        self._write_state(version, self.state().filter("kind = 'version'"), self._dates_of(parts, version))
        self._commit(version, parts, int(facts[LAST_ID]))
        self.spark.sql(f"DROP TABLE {facts[PARTS]}")

    def describe(self, comment: str | None, comments: dict[str, str]) -> None:
        """K5: comments of the table and its columns; nothing happens when they are there."""
        same = not comment or self.spark.catalog.getTable(self.name).description == comment
        if not same or changed_comments(self.spark, self.name, comments):
            facts = self.properties()
            self._commit(facts[VERSION], facts[PARTS], int(facts[LAST_ID]), comment, comments)

    def _dates_of(self, parts: str, version: str) -> DataFrame:
        """The dates that a version has folders for, from the catalog's list of partitions."""
        return self.spark.table(parts).filter(F.col(LOAD) == version).select(EVENT_DATE).distinct()

    def vacuum(self, at_once: int = 500) -> int:
        """Remove the folders that are in no version any more, ``at_once`` a statement; the number of them."""
        facts = self.properties()
        current = self.state(facts[VERSION]).filter("kind = 'part'").select(F.col("event_date").alias("d"), F.col("load").alias("l"))
        # the catalog's own list of folders; no file is opened for it
        part = lambda name: F.regexp_extract("partition", f"{name}=([^/]*)", 1)
        folders = self.spark.sql(f"SHOW PARTITIONS {facts[PARTS]}").select(part(EVENT_DATE).try_cast("date").alias(EVENT_DATE), part(LOAD).alias(LOAD))
        unused = folders.join(current, F.col(EVENT_DATE).eqNullSafe(F.col("d")) & (F.col(LOAD) == F.col("l")), "left_anti")
        removed, batch = 0, []
        for row in unused.toLocalIterator():
            day = f"DATE '{row[0]}'" if row[0] else "NULL"
            batch.append(f"PARTITION ({EVENT_DATE} = {day}, {LOAD} = '{row[1]}')")
            if len(batch) == at_once:
                removed += self._drop(facts[PARTS], batch)
        removed += self._drop(facts[PARTS], batch)
        old = self.spark.table(f"{self.name}__state").filter(F.col("version") != facts[VERSION]).select("version").distinct()
        for row in old.toLocalIterator():
            batch.append(f"PARTITION (version = '{row[0]}')")
        self._drop(f"{self.name}__state", batch)
        return removed

    def _drop(self, table: str, batch: list[str]) -> int:
        n = len(batch)
        if batch:
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(batch)}")
            batch.clear()
        return n

    # ---- loads

    def load(self, new: DataFrame, start=None, end=None, load_id: str | None = None) -> dict[str, int]:
        """Replace ``[start, end]`` by ``new``; the counts are ``planned``, ``loaded`` and ``deleted``. A load whose id was
        taken in before changes nothing."""
        bounds = (F.lit(b).cast("timestamp_ntz") for b in (start, end))
        one = self.spark.range(1).select(F.lit(1).alias("seq"), *[b.alias(n) for b, n in zip(bounds, ("start", "end"), strict=True)])
        ids = one.select("seq", F.lit(load_id).alias("load_id")) if load_id else None
        return self.load_many(new.withColumn(SEQ, F.lit(1)), one, ids)

    def load_many(self, new: DataFrame, loads: DataFrame, ids: DataFrame | None = None, with_ids: bool = False) -> dict[str, int]:
        """Many loads in one commit (K6): ``new`` carries each row's ``SEQ``, ``loads`` is ``(seq, start, end)`` and a later
        load deletes earlier rows in its period. ``ids`` names them, ``(seq, load_id)``: those taken in before are left
        out. ``with_ids``: the rows have surrogate keys that continue after ``last_id``, which goes up by their number."""
        columns = [c for c in new.columns if c != SEQ]
        self.create_if_absent(new.select(*[named(c) for c in columns]).schema)
        facts = self.properties()
        if ids is not None:
            ids = stage(ids.select("seq", "load_id").join(self.committed(), "load_id", "left_anti"), "load-ids")
            if ids.isEmpty():
                return {"planned": 0, "loaded": 0, "deleted": 0}
            new = new.join(ids.select(F.col("seq").alias(SEQ)).distinct(), SEQ, "left_semi")
            loads = loads.join(ids.select("seq").distinct(), "seq", "left_semi")
        count = F.count(F.lit(1)).alias("n")
        planned, found = Observation("planned"), Observation("found")
        fresh = new.observe(planned, count).withColumns({"__moment": self._moment(new), "__new": F.lit(True)})

        replaces = bool(self.event_time) and self.event_time in columns
        if replaces and isinstance(new.schema[self.event_time].dataType, T.StringType):
            loads = loads.withColumns({b: F.date_trunc("day", b).cast("timestamp_ntz") for b in ("start", "end")})
        days = loads_by_day(loads if replaces else loads.limit(0), [])
        days = stage(days.select(self._partition(F.col("__day")).alias(EVENT_DATE)).distinct(), "days")
        stored = self.spark.table(self.name).filter(self._among(days))
        touched = stored.join(days, EVENT_DATE, "left_semi").observe(found, count)
        old = touched.withColumns(
            {"__moment": self._moment(stored), "__new": F.lit(False), SEQ: F.lit(None).cast(new.schema[SEQ].dataType)}
        ).drop(EVENT_DATE)
        everything = old.unionByName(fresh, allowMissingColumns=True)
        content = surviving_rows(everything, loads, "__moment", seq=SEQ) if replaces else fresh
        dated = content.withColumn(EVENT_DATE, self._partition(F.col("__moment"))).drop(SEQ, "__moment")
        staged = stage(dated, "load")
        kept = staged.agg(F.count_if(~F.col("__new")).alias("old"), F.count_if("__new").alias("new")).first()

        version = uuid.uuid4().hex
        self._write_parts(staged, facts[PARTS], version)
        before = self.state(facts[VERSION]).join(days, F.col("event_date") == F.col(EVENT_DATE), "left_anti")
        self._write_state(version, before, staged.select(EVENT_DATE))
        if ids is not None:
            taken = ids.select("load_id", F.lit(version).alias("version")).distinct()
            taken.write.mode("append").insertInto(f"{self.name}__loads")
        last_id = int(facts[LAST_ID]) + (planned.get["n"] if with_ids else 0)
        self._commit(version, facts[PARTS], last_id)
        unstage(staged)
        deleted = (found.get["n"] if replaces else 0) - kept["old"]
        return {"planned": planned.get["n"], "loaded": kept["new"], "deleted": deleted}

    def _among(self, days: DataFrame) -> Column:
        """A condition on the partition column that the scan prunes by: the loads' dates, at most ``LISTED_DAYS`` by name,
        else their range."""
        first, last, n = days.agg(F.min(EVENT_DATE), F.max(EVENT_DATE), F.count(F.lit(1))).first()
        if n <= LISTED_DAYS:
            listed = [F.lit(r[0]) for r in days.select(EVENT_DATE).collect()]
            return F.col(EVENT_DATE).isin(*listed) if listed else F.lit(False)
        return F.col(EVENT_DATE).between(F.lit(first), F.lit(last))

    def _write_parts(self, staged: DataFrame, parts: str, version: str) -> None:
        """The rows in the parts table's order of columns; one it has and they lack is NULL."""
        have = set(staged.columns)
        fields = [f for f in self.spark.table(parts).schema if f.name != LOAD]
        ordered = staged.select(*[named(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
        _spread(ordered.withColumn(LOAD, F.lit(version))).write.mode("append").insertInto(parts)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spread(content: DataFrame) -> DataFrame:
    """Rows of a date written by few tasks; adaptive execution splits a date that is too large for one."""
    return content.hint("rebalance", EVENT_DATE)
