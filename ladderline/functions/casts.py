"""Contract casts (C1-C8) and the load stamp (C11).

Numbers that cannot be read become 0 and dates or booleans that cannot be read become NULL; that is
the contract's rule, not Spark's, so every cast is guarded instead of relying on ANSI errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions.text import replace_first, strip, without_spaces

# Contract spellings of each logical type.
TYPE_SPELLINGS = {
    "int": ("Int64", "int", "integer"),
    "float": ("float64", "float"),
    "datetime": ("datetime64[ns]", "datetime"),
    "date": ("date",),
    "boolean": ("boolean",),
    "string": ("string",),
    "uuid": ("UUID", "uuid"),
}
LOGICAL_TYPE = {spelling: kind for kind, names in TYPE_SPELLINGS.items() for spelling in names}
SPARK_TYPE = {
    "int": T.LongType(),
    "float": T.DoubleType(),
    "datetime": T.TimestampNTZType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "uuid": T.StringType(),
}

# One pattern per type decides whether a text is readable and cuts out what is cast, so each value goes
# through a single chain of expressions. What does not match is NULL before the cast: a failing cast would
# build and catch an exception per value.
_WHOLE = r"^([+-]?[0-9]+)(?:[.,][0-9]+)?$"
_DIGITS = r"^([+-]?[0-9]+)$"
_NUMBER = r"^([+-]?(?:[0-9]+[.,]?[0-9]*|[.,][0-9]+)(?:[eE][+-]?[0-9]+)?)$"
_POINT_NUMBER = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)$"
REPORT_MOMENT = r"(?U)^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})(?:\s+([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}))?$"


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of a matching text, NULL when the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def int_or_null(value: Column) -> Column:
    """Spaces out, first comma to point, fraction cut. More than one separator is unreadable."""
    return matched(without_spaces(value.cast("string")), _WHOLE).try_cast("bigint")


def float_or_null(value: Column) -> Column:
    number = matched(without_spaces(value.cast("string")), _NUMBER)
    return F.translate(number, ",", ".").try_cast("double")


def to_int(value: Column) -> Column:
    """Anything unreadable is 0, and so is NULL."""
    return F.coalesce(int_or_null(value), F.lit(0).cast("bigint"))


def to_float(value: Column) -> Column:
    return F.coalesce(float_or_null(value), F.lit(0.0))


def to_datetime(value: Column) -> Column:
    """``dd.MM.yyyy H:mm:ss`` or ``dd.MM.yyyy`` as a timestamp without time zone.

    Rewritten to ISO and cast without a zone, so the session time zone does not matter."""
    readable = matched(value.cast("string"), REPORT_MOMENT, 0)
    return F.regexp_replace(readable, REPORT_MOMENT, "$3-$2-$1 $4").try_cast("timestamp_ntz")


def to_date(value: Column) -> Column:
    return to_datetime(value).cast("date")


def to_boolean(value: Column) -> Column:
    word = F.lower(value.cast("string"))
    return F.when(word == "true", True).when(word == "false", False)


def clean_uuid(value: Column) -> Column:
    """Strip and drop the first double quote; the value is not validated."""
    return replace_first(strip(value.cast("string")), '"', "")


def cast_column(value: Column, type_name: str) -> Column:
    """Cast by contract type; a spelling outside the contract vocabulary leaves the value as it is."""
    kind = LOGICAL_TYPE.get(type_name)
    casts = {
        "int": to_int,
        "float": to_float,
        "datetime": to_datetime,
        "date": to_date,
        "boolean": to_boolean,
        "string": lambda c: c.cast("string"),
        "uuid": clean_uuid,
    }
    return casts[kind](value) if kind else value


def cast_failed(value: Column, type_name: str) -> Column:
    """True where a non-blank value cannot be read as ``type_name`` (it would become 0 or NULL)."""
    kind = LOGICAL_TYPE.get(type_name)
    read = {
        "int": int_or_null,
        "float": float_or_null,
        "datetime": to_datetime,
        "date": to_date,
        "boolean": to_boolean,
    }.get(kind)
    if read is None:
        return F.lit(False)
    return F.coalesce(strip(value.cast("string")) != "", F.lit(False)) & read(value).isNull()


def cast_to_target(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """The last, non-strict cast before a write (C8): unreadable values become NULL."""
    if source == target:
        return value
    if isinstance(source, T.StringType):
        text = strip(value)
        if isinstance(target, T.LongType):
            return matched(text, _DIGITS).try_cast("bigint")
        if isinstance(target, T.DoubleType):
            return matched(text, _POINT_NUMBER).try_cast("double")
        if isinstance(target, T.BooleanType):
            return to_boolean(text)
    return value.try_cast(target)


def load_stamp(instant: Column | None = None, zone: str = "Europe/Moscow") -> Column:
    """One load time for the whole query, as local time of ``zone`` without a time zone."""
    moment = instant if instant is not None else F.current_timestamp()
    utc = F.to_utc_timestamp(moment.cast("timestamp"), F.current_timezone())
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))
