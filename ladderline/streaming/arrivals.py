"""Which file events lead to a load (P8, D1-D3) and what the load log says."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ladderline.plans.ordered import Running, running

MOVED_SECONDS = 0.1
RECENT_SECONDS = 10.0
STALE_SECONDS = 1800


def new_versions(events: DataFrame, ledger: DataFrame) -> DataFrame:
    """The file versions to load, ``(path, mtime)``.

    However many watchers report a file, only its current version counts, and it is skipped when the
    ledger's latest entry for the path has the same mtime. A failed load stays in the ledger, so it is
    retried only after the file changes. ``ledger`` is ``(path, mtime, started)``."""
    current = events.groupBy("path").agg(F.max("mtime").alias("mtime"))
    done = ledger.groupBy("path").agg(F.max(F.struct("started", "mtime"))["mtime"].alias("__done"))
    return (
        current.join(done, "path", "left")
        .filter(F.col("__done").isNull() | (F.col("__done") != F.col("mtime")))
        .select("path", "mtime")
    )


def distinct_versions(events: DataFrame) -> DataFrame:
    """Every version ``(path, mtime)`` once, whoever reported it."""
    return events.select("path", "mtime").distinct()


def recent_changes(
    sightings: DataFrame, order: str = "seen", moved: float = MOVED_SECONDS, recent: float = RECENT_SECONDS
) -> DataFrame:
    """Sightings ``(path, block, seen, mtime, ...)`` (times in seconds) that report a change.

    The file's mtime moved by at least ``moved`` since the sighting before, and is at most ``recent``
    seconds old when seen. ``(block, order)`` orders a path's sightings, so a file that is seen all the
    time is not one task."""
    previous = Running("last", F.col("mtime"), inclusive=False)
    seen = running(sightings, ["path"], order, {"previous": previous})
    changed = F.col("previous").isNull() | (F.abs(F.col("mtime") - F.col("previous")) >= moved)
    return seen.filter(changed & (F.col("seen") - F.col("mtime") <= recent)).drop("previous")


def accepted_starts(events: DataFrame, timeout: int = STALE_SECONDS, tie: str = "event_id") -> DataFrame:
    """D3 in batch: the events ``(path, ts, <tie>)`` that start processing when nothing reports an end.

    An event is dropped while an accepted one of its path is younger than ``timeout`` seconds. After a
    whole ``timeout`` bucket without events the next event is accepted whatever came before, so a path
    falls into independent islands of busy buckets. The islands are found on the distinct buckets, a table
    bounded by time and not by events, and each one is walked once in time order with constant memory.
    """
    located = events.withColumn("__micros", _epoch_micros(events, "ts"))
    bucketed = located.withColumn("__bucket", F.expr(f"__micros div {timeout * 1_000_000}"))
    busy = bucketed.select("path", "__bucket").distinct()
    in_order = Window.partitionBy("path").orderBy("__bucket")
    islands = busy.select("path", "__bucket", (F.col("__bucket") - F.row_number().over(in_order)).alias("__island"))
    located = bucketed.join(islands, ["path", "__bucket"]).select(
        "path", "__island", "ts", tie, "__micros"
    )
    ordered = located.repartition("path", "__island").sortWithinPartitions("path", "__island", "__micros", tie)
    walked = ordered.mapInPandas(_walker(timeout * 1_000_000), ordered.schema)
    return walked.select("path", "ts", tie)


def _epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since the epoch, whatever the session time zone when the column has none."""
    if isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(name)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(name))


def _walker(timeout: int):
    """Per partition, in order: keep an event when ``timeout`` has passed since the last kept one."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, last = None, 0
        for batch in batches:
            micros = batch["__micros"].to_numpy()
            heads = np.flatnonzero(
                (batch["path"] != batch["path"].shift()) | (batch["__island"] != batch["__island"].shift())
            )
            keep = []
            for first, stop in zip(heads, [*heads[1:], len(batch)], strict=True):
                name = (batch["path"].iat[first], batch["__island"].iat[first])
                at = first
                if name == group:
                    at = first + int(np.searchsorted(micros[first:stop], last + timeout))
                while at < stop:
                    keep.append(at)
                    last = int(micros[at])
                    at += int(np.searchsorted(micros[at:stop], last + timeout))
                group = name
            yield batch.iloc[keep]

    return walk


FREE = -(1 << 62)
"""The state of a path that is not being processed; else the state is the start of the processing, in microseconds."""
CHUNK_TIMEOUTS = 64


def guarded_starts(events: DataFrame, timeout: int = STALE_SECONDS, tie: str = "event_id") -> DataFrame:
    """D3 in batch with ends: the events ``(path, ts, <tie>, kind)`` of kind ``event`` that start processing.

    An event is dropped while an accepted one of its path is younger than ``timeout`` seconds and no ``finish`` came
    after it. Events are taken in the order of ``(ts, <tie>)``.

    A path's time is cut into chunks of ``CHUNK_TIMEOUTS`` timeouts. What a chunk does is a function from the state before
    it to the state behind it, which is constant if it has a finish, and else steps up at the events of its first timeout;
    chunks work it out side by side. The functions, short against the events, are then applied one after another along
    each path, which gives every chunk its state, and the chunks are walked side by side again. So a path with a large
    share of all events is dealt to many tasks; only its functions meet in one, which holds one at a time."""
    span = timeout * 1_000_000
    located = events.select("path", "ts", tie, (F.col("kind") == "finish").alias("__ends"), _epoch_micros(events, "ts").alias("__micros"))
    located = located.withColumn("__chunk", F.expr(f"__micros div {span * CHUNK_TIMEOUTS}L"))
    in_order = ("path", "__chunk", "__micros", tie)
    ordered = located.repartition("path", "__chunk").sortWithinPartitions(*in_order)
    steps = ordered.select("path", "__chunk", "__micros", "__ends").mapInPandas(_chunk_steps(span), "path string, __chunk bigint, above bigint, after bigint, passes boolean")
    along = steps.repartition("path").sortWithinPartitions("path", "__chunk", "above")
    before = along.mapInPandas(_apply_steps, "path string, __chunk bigint, __before bigint")
    begun = located.join(before, ["path", "__chunk"]).repartition("path", "__chunk").sortWithinPartitions(*in_order)
    return begun.mapInPandas(_guard_walk(span), begun.schema).select("path", "ts", tie)


def _whole_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows in frames that hold whole chunks, as many as a batch has; a chunk's rows are contiguous."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = int(_heads(batch)[-1])
        key = lambda rows, at: (rows["path"].iat[at], rows["__chunk"].iat[at])
        if not last and (not held or key(held[-1], -1) == key(batch, 0)):
            held.append(batch)
            continue
        ready = [*held, batch.iloc[:last]]
        held = [batch.iloc[last:]]
        yield pd.concat(ready, ignore_index=True)
    if held:
        yield pd.concat(held, ignore_index=True)


def _heads(batch: pd.DataFrame) -> np.ndarray:
    """Where the chunks of a frame begin."""
    paths, chunks = batch["path"].to_numpy(), batch["__chunk"].to_numpy()
    return np.flatnonzero(np.append(True, (chunks[1:] != chunks[:-1]) | (paths[1:] != paths[:-1])))


def _next_accepted(micros: np.ndarray, heads: np.ndarray, stops: np.ndarray, span: int) -> np.ndarray:
    """For each event the first of its chunk that is at least ``span`` later, or where the chunk stops.

    One search serves many chunks: their times are laid end to end, as far as 64 bits reach."""
    found = np.empty(len(micros), dtype=np.int64)
    length = int((micros[stops - 1] - micros[heads]).max()) + 1
    reach = min(span, length)
    at_once = max(1, (1 << 62) // (length + reach))
    for first in range(0, len(heads), at_once):
        h, s = heads[first : first + at_once], stops[first : first + at_once]
        sizes = s - h
        laid = micros[h[0] : s[-1]] - np.repeat(micros[h], sizes) + np.repeat(np.arange(len(h)) * length, sizes)
        found[h[0] : s[-1]] = np.minimum(h[0] + np.searchsorted(laid, laid + reach), np.repeat(s, sizes))
    return found


def _last_start(after: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """For each event, if it is accepted, the last one that will be: chains of next accepted events, doubled to their end."""
    to = np.where(after < stops, after, np.arange(len(after)))
    while True:
        further = to[to]
        if (further == to).all():
            return to
        to = further


def _chunk_steps(span: int):
    """Each chunk's function from state to state: states above ``above`` become ``after``, or stay if it ``passes`` them.
    All chunks of a frame are worked out together, on arrays."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole_chunks(batches):
            micros, ends, numbers = (rows[c].to_numpy() for c in ("__micros", "__ends", "__chunk"))
            heads = _heads(rows)
            stops = np.append(heads[1:], len(rows))
            own = np.repeat(np.arange(len(heads)), stops - heads)
            last = _last_start(_next_accepted(micros, heads, stops, span), stops[own])

            # behind its last finish a chunk goes on with the event after it, whatever the state was before
            finish = np.full(len(heads), -1)
            finish[own[ends]] = np.flatnonzero(ends)
            closed = finish >= 0
            rest = finish + 1
            constant = np.where(closed & (rest < stops), micros[last[np.minimum(rest, len(rows) - 1)]], FREE)

            # the state before is from an earlier chunk, so only events of the first timeout can be held off by it
            early = ~closed[own] & (micros < numbers * (span * CHUNK_TIMEOUTS) + span)
            entries = np.where(closed, 1, np.bincount(own[early], minlength=len(heads)) + 1)
            of = np.repeat(np.arange(len(heads)), entries)
            entry = np.arange(len(of)) - np.repeat(np.cumsum(entries) - entries, entries)
            at = heads[of] + entry
            passes = ~closed[of] & (at >= stops[of])
            after = np.where(closed[of], constant[of], micros[last[np.minimum(at, stops[of] - 1)]])
            above = np.where(entry > 0, micros[np.maximum(at - 1, 0)] - span, -(1 << 63))
            # of entries at one time the last one's step counts: states above it enter behind all of them
            of_time = np.append((of[1:] != of[:-1]) | (above[1:] != above[:-1]), True)
            of, above, after, passes = of[of_time], above[of_time], after[of_time], passes[of_time]
            step = np.append(True, (of[1:] != of[:-1]) | (after[1:] != after[:-1]) | (passes[1:] != passes[:-1]))
            first = heads[of[step]]
            yield pd.DataFrame(
                {"path": rows["path"].to_numpy()[first], "__chunk": numbers[first], "above": above[step], "after": after[step], "passes": passes[step]}
            )

    return run


def _apply_steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state before every chunk, from the functions of the chunks before it; rows come in the order of the chunks."""
    path = chunk = None
    state = taken = FREE
    for batch in batches:
        if not len(batch):
            continue
        cuts = [*_heads(batch).tolist(), len(batch)]
        paths, chunks, above, after, passes = (batch[c].tolist() for c in ("path", "__chunk", "above", "after", "passes"))
        found = []
        for first, stop in zip(cuts, cuts[1:], strict=False):
            name, number = paths[first], chunks[first]
            if name != path:
                path, state, chunk = name, FREE, None
            elif number != chunk:
                state = taken
            if number != chunk:
                chunk = number
                found.append((path, chunk, state))
            at = bisect_left(above, state, first, stop)
            if at > first:
                taken = state if passes[at - 1] else after[at - 1]
        yield pd.DataFrame(found, columns=["path", "__chunk", "__before"]).astype({"__chunk": "int64", "__before": "int64"})


def _guard_walk(span: int):
    """The accepted events of each chunk, from the state before it; a finish sets the state free."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, state = None, FREE
        for batch in batches:
            if not len(batch):
                continue
            cuts = [*_heads(batch).tolist(), len(batch)]
            paths, chunks, micros, before = (batch[c].tolist() for c in ("path", "__chunk", "__micros", "__before"))
            finishes = np.flatnonzero(batch["__ends"].to_numpy()).tolist()
            keep, seen = [], 0
            for first, stop in zip(cuts, cuts[1:], strict=False):
                name = (paths[first], chunks[first])
                if name != group:
                    group, state = name, before[first]
                at = first
                while at < stop:
                    open_end = seen < len(finishes) and finishes[seen] < stop
                    end = finishes[seen] if open_end else stop
                    at = bisect_left(micros, state + span, at, end)
                    while at < end:
                        keep.append(at)
                        state = micros[at]
                        at = bisect_left(micros, state + span, at, end)
                    if open_end:
                        state, at, seen = FREE, end + 1, seen + 1
            yield batch.iloc[keep]

    return walk


GUARD_OUTPUT = "path string, ts timestamp, accepted boolean"


class _Guard(StatefulProcessor):
    """The start of the processing of a path, until a finish comes or ``timeout`` is over by event time."""

    def __init__(self, timeout: int):
        self.timeout = timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.started = handle.getValueState("started", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows))
        found = found.sort_values("ts", kind="stable")
        micros = found["ts"].astype("datetime64[us]").astype("int64").to_numpy()
        ends = (found["kind"] == "finish").to_numpy()
        span = self.timeout * 1_000_000
        state = before = int(self.started.get()[0]) if self.started.exists() else FREE
        accepted, at = np.zeros(len(found), dtype=bool), 0
        for end in [*np.flatnonzero(ends).tolist(), len(found)]:
            at += int(np.searchsorted(micros[at:end], state + span))
            while at < end:
                accepted[at], state = True, int(micros[at])
                at += int(np.searchsorted(micros[at:end], state + span))
            if end < len(found):
                state, at = FREE, end + 1
        if state != before:
            if before != FREE:
                self.handle.deleteTimer(self._expiry(before))
            if state == FREE:
                self.started.clear()
            else:
                self.started.update((state,))
                self.handle.registerTimer(self._expiry(state))
        yield pd.DataFrame({"path": key[0], "ts": found["ts"], "accepted": accepted})[~ends]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.started.exists() and self._expiry(int(self.started.get()[0])) <= expiredTimerInfo.getExpiryTimeInMs():
            self.started.clear()
        return iter([])

    def _expiry(self, micros: int) -> int:
        return -(-micros // 1000) + self.timeout * 1000

    def close(self) -> None:
        pass


def guard_stream(events: DataFrame, timeout: int = STALE_SECONDS, delay: str = "1 minute") -> DataFrame:
    """D3 as a stream of ``(path, ts, kind)``: ``kind`` is ``event`` or ``finish``; ``(path, ts, accepted)`` of the events.

    The state is one start time per path that is being processed. A finish clears it; an event-time timer removes it when
    the watermark, ``delay`` behind the latest event, has passed its timeout. Rows of a path in a micro-batch are taken in
    the order of their times; those later than the watermark are dropped. The session needs a state store for
    transformWithState, which ``build_session`` sets."""
    marked = events.select("path", "ts", "kind").withWatermark("ts", delay)
    return marked.groupBy("path").transformWithStateInPandas(_Guard(timeout), GUARD_OUTPUT, "Append", "EventTime")


def dedup_stream(events: DataFrame) -> DataFrame:
    """D1 as a stream of ``(path, mtime, ...)``: each version once, however old it is when it arrives.

    The state keeps every version, as an age limit would lose copied or restored files. ``Ingest`` does without it: its
    ledger knows the versions that were loaded."""
    return events.dropDuplicates(["path", "mtime"])


def load_status(log: DataFrame) -> DataFrame:
    """Per file how often it was started and its latest status. ``log`` is append-only
    ``(file, ts, status)``."""
    latest = F.max(F.struct("ts", "status")).alias("latest")
    return log.groupBy("file").agg(F.count(F.lit(1)).alias("processed"), latest).select(
        "file", "processed", F.col("latest.status").alias("status"), F.col("latest.ts").alias("last_ts")
    )


def load_summary(log: DataFrame) -> DataFrame:
    """One row: loads started (failed ones included), files, failed files, last file."""
    per_file = load_status(log)
    failed = F.coalesce(F.startswith("status", F.lit("ERROR")), F.lit(False))
    return per_file.agg(
        F.sum("processed").alias("processed_files"),
        F.count(F.lit(1)).alias("files"),
        F.count_if(failed).alias("failed_files"),
        F.max(F.struct("last_ts", "file"))["file"].alias("last_processed"),
    )


def status_text(error: Column, finished: Column) -> Column:
    """The status line of one load: its finish time, or the start of the error, whose whole text the log keeps next to it."""
    return F.when(error.isNotNull(), F.concat(F.lit("ERROR: "), F.left(error, F.lit(200)))).otherwise(
        finished.cast("string")
    )
