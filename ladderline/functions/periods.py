"""Report periods: extraction from header text (H1), parsing (H2), completion (H3), checks (H4), P6."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.casts import matched, to_date, to_datetime
from ladderline.functions.text import one_space, strip

# How a header spells its period. The three patterns are tried in this order.
_MOMENT = r"(\d{2}\.\d{2}\.\d{4}(?:\s+\d{1,2}:\d{2}:\d{2})?)"
PARAMETERS = "Параметры:"
RANGE = rf":\s*{_MOMENT}\s*-\s*{_MOMENT}"
PERIOD_RANGE = rf"{PARAMETERS}[\s\S]*?{RANGE}"
PERIOD_TWO_LINES = rf":\s*{_MOMENT}\s*\n*.*:\s*{_MOMENT}"
PERIOD_START = rf"{PARAMETERS}.*?{_MOMENT}"
# Unicode classes, Unicode case folding, and `.` stopping at \n only.
_FLAGS = "(?diuU)"


def extract_period(header: Column) -> Column:
    """Struct ``(start_raw, end_raw, pattern)`` from a report header; all NULL when no pattern fits."""

    def found(pattern: str, groups: int) -> list[Column]:
        return [
            F.nullif(F.regexp_extract(header, _FLAGS + pattern, i), F.lit("")) for i in range(1, groups + 1)
        ]

    range_start, range_end = found(PERIOD_RANGE, 2)
    lines_start, lines_end = found(PERIOD_TWO_LINES, 2)
    (only_start,) = found(PERIOD_START, 1)
    pattern = (
        F.when(range_start.isNotNull(), 1).when(lines_start.isNotNull(), 2).when(only_start.isNotNull(), 3)
    )
    return F.struct(
        strip(F.coalesce(range_start, lines_start, only_start)).alias("start_raw"),
        strip(F.when(range_start.isNotNull(), range_end).otherwise(lines_end)).alias("end_raw"),
        pattern.alias("pattern"),
    )


def found_on_line(line: Column, behind: Column) -> Column:
    """Struct of what begins on ``line``, followed by the lines ``behind``: ``named``, whether it names the parameters, and
    as ``(start_raw, end_raw)`` or NULL the first range, the first range behind that name, the two dates and the start."""
    text = F.array_join(F.concat(F.array(line), behind), "\n")
    after = lambda c: F.regexp_extract(c, rf"{_FLAGS}{PARAMETERS}([\s\S]*)", 1)
    named = F.rlike(line, F.lit(_FLAGS + PARAMETERS))
    return F.struct(
        named.alias("named"),
        _begun(text, line, RANGE, 2).alias("range"),
        F.when(named, _begun(after(text), after(line), RANGE, 2)).alias("behind"),
        _begun(text, line, PERIOD_TWO_LINES, 2).alias("two"),
        F.when(named, _begun(text, line, PERIOD_START, 1)).alias("only"),
    )


def _begun(text: Column, line: Column, pattern: str, groups: int) -> Column:
    """The moments of the first match if it begins on the first line. Places in text count UTF-16 units, as Java does."""
    part = lambda i: strip(F.nullif(F.regexp_extract(text, _FLAGS + pattern, i), F.lit("")))
    moments = F.struct(part(1).alias("start_raw"), (part(2) if groups == 2 else F.lit(None).cast("string")).alias("end_raw"))
    units = F.octet_length(F.encode(line, "UTF-16BE")) / 2
    return F.when(F.regexp_instr(text, F.lit(_FLAGS + pattern)).between(1, units), moments)


_ISO_MOMENT = r"(?U)^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?:\s+[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?$"


def parse_moment(raw: Column) -> Column:
    """A header date in ISO or dotted form as a timestamp without time zone, else NULL."""
    iso = one_space(matched(raw, _ISO_MOMENT, 0)).try_cast("timestamp_ntz")
    return F.coalesce(iso, to_datetime(raw))


def has_time(raw: Column) -> Column:
    """Whether a readable header date also names a time of day."""
    return F.coalesce(parse_moment(raw).isNotNull() & F.contains(raw, F.lit(":")), F.lit(False))


def complete_end(event_time: Column, start: Column, start_has_time: Column, end: Column) -> Column:
    """A missing end becomes the end of the start's day (start with time) or the start itself."""
    wanted = (F.coalesce(event_time, F.lit("")) != "") & start.isNotNull() & end.isNull()
    last_second = (F.date_trunc("day", start) + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")).cast("timestamp_ntz")
    return F.when(wanted, F.when(start_has_time, last_second).otherwise(start)).otherwise(end)


def missing_bounds(event_time: Column, start: Column, end: Column) -> Column:
    """Names of the required bounds a report lacks; only the event time ``period`` requires them."""
    required = F.lower(strip(F.coalesce(event_time, F.lit("")))) == "period"
    names = F.array(
        F.when(start.isNull(), "start_period"), F.when(start.isNull() & end.isNull(), "end_period")
    )
    return F.when(required, F.array_compact(names)).otherwise(F.array().cast("array<string>"))


def event_day(text: Column) -> Column:
    """The day a text event time names: the part before the first space, read as ``dd.MM.yyyy``."""
    return to_date(F.split_part(text, F.lit(" "), F.lit(1)))


def in_period(value: Column, value_type: T.DataType, start: Column, end: Column) -> Column:
    """The period predicate. NULL (a NULL bound, a NULL or unreadable time) means "not in the period"."""
    last = F.coalesce(end, start)
    if isinstance(value_type, T.StringType):
        return event_day(value).between(start.cast("date"), last.cast("date"))
    return value.between(start, last)


def outside_period(value: Column, value_type: T.DataType, start: Column, end: Column) -> Column:
    """Rows a period delete leaves alone: also those whose predicate is NULL."""
    return ~F.coalesce(in_period(value, value_type, start, end), F.lit(False))
