"""Column functions: casts, names, periods, cell arrays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.functions import casts, identifiers, periods
from ladderline.functions.text import last_filled, leading_filled, replace_first, strip, unquote


def values(spark, items, column, schema="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"n int, v {schema}")
    return [r[0] for r in df.orderBy("n").select(column(F.col("v"))).collect()]


NUMBERS = {
    "1": (1, 1.0), "1,9": (1, 1.9), "-1,9": (-1, -1.9), "1 234,56": (1234, 1234.56), "12\xa0345": (12345, 12345.0),
    "1,234,56": (0, 0.0), "1.2.3": (0, 0.0), ",5": (0, 0.5), "1,": (0, 1.0), "9" * 20: (0, 1e20), "1d": (0, 0.0),
    "nan": (0, 0.0), None: (0, 0.0), "": (0, 0.0), "+7": (7, 7.0),
}


def test_numbers(spark):
    assert values(spark, list(NUMBERS), casts.to_int) == [i for i, _ in NUMBERS.values()]
    assert values(spark, list(NUMBERS), casts.to_float) == [f for _, f in NUMBERS.values()]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Moscow", "America/New_York"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    texts = ["28.03.2010 2:30:00", "3.4.2026", "31.02.2026", "01.02.2026  0:00:00", "2026-02-01", "01.02.2026 24:00:00", None]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert values(spark, texts, casts.to_datetime) == [
            dt.datetime(2010, 3, 28, 2, 30), dt.datetime(2026, 4, 3), None, dt.datetime(2026, 2, 1), None, None, None,
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_booleans_and_uuids(spark):
    assert values(spark, ["TRUE", "false", "yes", "1", None], casts.to_boolean) == [True, False, None, None, None]
    assert values(spark, [' "a-b" ', "\xa0c"], casts.clean_uuid) == ['a-b"', "c"]


def test_unknown_type_is_left_alone(spark):
    assert values(spark, [" x "], lambda c: casts.cast_column(c, "money")) == [" x "]


def test_cast_failures(spark):
    failed = lambda kind: lambda c: casts.cast_failed(c, kind)
    assert values(spark, ["1", "x", " ", None], failed("int")) == [False, True, False, False]
    assert values(spark, ["01.01.2024", "32.01.2024"], failed("date")) == [False, True]
    assert values(spark, ["x"], failed("string")) == [False]


def test_final_cast(spark):
    to = lambda target: lambda c: casts.cast_to_target(c, T.StringType(), target)
    assert values(spark, [" 12 ", "1.5", "x"], to(T.LongType())) == [12, None, None]
    assert values(spark, ["1.5", "Infinity", "1d"], to(T.DoubleType())) == [1.5, None, None]


def test_identifiers(spark):
    names = ["ЭффективностьМультискладаНовый_PBI (TXT)", "Зарплата", "Щука Ёж", "Orders", "!!!", "2026 план", "Очень" * 30]
    got = values(spark, names, identifiers.latin_identifier)
    assert got[:6] == ["effektivnost_multisklada_novyy_pbi_txt", "zarplata", "shchuka_yozh", "orders", "report", "t_2026_plan"]
    assert len(got[6]) <= 63


def test_byte_truncation_keeps_whole_characters(spark):
    names = ["a" + "б" * 40, "б" * 40, "a" * 70, "short", "aa" + "😀" * 20]
    got = values(spark, names, identifiers.truncate_bytes)
    assert got == ["a" + "б" * 31, "б" * 31, "a" * 63, "short", "aa" + "😀" * 15]


HEADERS = {
    "Параметры:\tПериод: 16.03.2026 - 22.03.2026": ("16.03.2026", "22.03.2026", 1),
    "ПАРАМЕТРЫ:\tПериод: 01.01.2026 0:00:00 -\n 22.04.2026 23:59:59": ("01.01.2026 0:00:00", "22.04.2026 23:59:59", 1),
    "Начало: 01.03.2022 0:00:00\n   Конец: 20.03.2026 23:59:59": ("01.03.2022 0:00:00", "20.03.2026 23:59:59", 2),
    "Параметры:\tНа дату: 01.03.2026 0:00:00": ("01.03.2026 0:00:00", None, 3),
    "Параметры:\nНа дату: 01.03.2026": (None, None, None),
    "Отчёт": (None, None, None),
}


def test_header_periods(spark):
    got = [tuple(r) for r in values(spark, list(HEADERS), periods.extract_period)]
    assert got == list(HEADERS.values())


def test_period_completion(spark):
    starts = ["01.03.2026", "01.03.2026 10:15:30"]
    end = lambda c: periods.complete_end(F.lit("sale"), periods.parse_moment(c), periods.has_time(c), F.lit(None).cast("timestamp_ntz"))
    assert values(spark, starts, end) == [dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 1, 23, 59, 59)]
    none = F.lit(None).cast("timestamp_ntz")
    missing = lambda event: lambda c: periods.missing_bounds(F.lit(event), periods.parse_moment(c), none)
    assert values(spark, [None, "2026-01-01"], missing(" Period ")) == [["start_period", "end_period"], []]
    assert values(spark, [None], missing("sale_date")) == [[]]


def test_cells(spark):
    rows = [["a", " ", "c"], ["a", "b"], ["", ""], [" "]]
    assert values(spark, rows, lambda c: leading_filled(c, F.lit(3)), "array<string>") == [1, 2, 0, 0]
    assert values(spark, rows, last_filled, "array<string>") == [2, 1, -1, -1]


def test_text(spark):
    assert values(spark, ["\xa0\t x  \n"], strip) == ["x"]
    assert values(spark, ["1,2,3", "12"], lambda c: replace_first(c, ",", ".")) == ["1.2,3", "12"]
    assert values(spark, ['"a ""b"""', '"a" b', '""'], unquote) == ['a "b"', '"a" b', ""]
