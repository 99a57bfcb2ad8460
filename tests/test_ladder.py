"""Text reports: scan, layout detection and flattening."""

import pytest
from pyspark.sql import functions as F

from ladderline.operators.flatten import flatten, row_counts, to_columns
from ladderline.operators.layout import detect_layout, layouts_by_file, rejected_files, table_starts
from ladderline.sources.text_reports import as_rows, read_text_lines

TWO_LEVELS = (
    "﻿\r\nПараметры:\tСклад: 05.03.2024 - 06.03.2024\r\n\r\n"
    "Период, день\t\tНачальный остаток\tПриход\r\n"
    "Склад\tТовар\t\t\r\n"
    "05.03.2024 0:00:00\t\t5,00\t3,00\r\n"
    " 01 Север\tКепка\t2,00\t1,00\r\n"
    " 01 Север\tШарф\t3 000,00\t\r\n"
    "06.03.2024 0:00:00\t\t7,00\t3,00\r\n"
    " 02 Юг\tКепка\t\t4,00\r\n"
    " 02 Юг\tКепка\t\t4,00\tлишняя\r\n"
    "Итого\t\t12,00\t6,00\r\n"
)
FLAT = (
    "Параметры:\tПериод: 01.03.2024 - 31.03.2024\r\n\r\n"
    'Дата\t Товар \tСумма\r\n01.03.2024\t"A ""x"""\t1,00\r\n02.03.2024\tB\r\n03.03.2024\tC\t\t9\r\nИтоговая строка\t\t3,00\r\n'
)
THREE_LEVELS = (
    "Параметры:\tНа дату: 01.03.2024 0:00:00\n\n"
    "day\t\t\t\t\tqty\tcost\n"
    "store\tstore_id\t\t\t\t\t\n"
    "item\titem_id\tkind\tgroup\tprice\t\t\n"
    "01.03.2024\t\t\t\t\t10\t100\n"
    "A\ta1\t\t\t\t6\t60\n"
    "t1\ti1\tk\tg\t1,00\t2\t20\n"
    "t2\ti2\tk\tg\t1,00\t4\t40\n"
    "B\tb1\t\t\t\t4\t40\n"
    "t3\ti3\tk\tg\t1,00\t4\t40\n"
    "02.03.2024\t\t\t\t\t5\t50\n"
    "t4\ti4\tk\tg\t1,00\t5\t50\n"
    "A\ta1\t\t\t\t5\t50\n"
    "t1\ti1\tk\tg\t1,00\t5\t50\n"
)


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("reports")
    (root / "deep").mkdir()
    files = {
        "two.txt": TWO_LEVELS,
        "flat.TXT": FLAT,
        "deep/three.txt": THREE_LEVELS,
        "empty.txt": "nothing here\nno table\n",
        "short.txt": "a\tb\tc\n",
        "notes.md": "a\tb\tc\n1\t2\t3\n",
    }
    for name, text in files.items():
        (root / name).write_bytes(text.encode("utf-8"))
    lines = read_text_lines(spark, str(root))
    return as_rows(lines.withColumn("path", F.regexp_extract("path", r"([^/]+)$", 1)))


@pytest.fixture(scope="module")
def layout(rows):
    return detect_layout(rows)


def table(flat, path, names):
    return [tuple(r) for r in to_columns(flat.filter(F.col("path") == path), names, ("line_no",))
            .orderBy("line_no").drop("line_no").collect()]


def test_layouts(layout):
    found = {r["path"]: r for r in layouts_by_file(layout).collect()}
    assert set(found) == {"two.txt", "flat.TXT", "three.txt", "empty.txt", "short.txt"}
    assert (found["two.txt"]["kind"], found["two.txt"]["height"], found["two.txt"]["spans"]) == ("grouped", 2, [1])
    assert found["two.txt"]["names"] == ["Период, день", "Склад", "Товар", "Начальный остаток", "Приход"]
    assert (found["three.txt"]["height"], found["three.txt"]["spans"]) == (3, [1, 2])
    assert found["flat.TXT"]["kind"] == "flat"
    assert found["flat.TXT"]["names"] == ["Дата", "Товар", "Сумма"]


def test_rejected(layout):
    reasons = {r["path"]: r["reason"] for r in rejected_files(layout).collect()}
    assert reasons == {"empty.txt": "no table body", "short.txt": "fewer than two table lines"}


def test_two_levels(rows, layout):
    flat = flatten(rows, layout)
    got = table(flat, "two.txt", ["Период, день", "Склад", "Товар", "Начальный остаток", "Приход"])
    assert got == [
        ("05.03.2024 0:00:00", " 01 Север", "Кепка", "2,00", "1,00"),
        ("05.03.2024 0:00:00", " 01 Север", "Шарф", "3 000,00", None),
        ("06.03.2024 0:00:00", " 02 Юг", "Кепка", None, "4,00"),
    ]


def test_three_levels_and_reset(rows, layout):
    got = table(flatten(rows, layout), "three.txt", ["day", "store", "store_id", "item", "qty", "cost"])
    assert got == [
        ("01.03.2024", "A", "a1", "t1", "2", "20"),
        ("01.03.2024", "A", "a1", "t2", "4", "40"),
        ("01.03.2024", "B", "b1", "t3", "4", "40"),
        ("02.03.2024", None, None, "t4", "5", "50"),
        ("02.03.2024", "A", "a1", "t1", "5", "50"),
    ]


def test_flat(rows, layout):
    got = table(flatten(rows, layout), "flat.TXT", ["Дата", "Товар", "Сумма"])
    assert got == [("01.03.2024", 'A "x"', "1,00"), ("02.03.2024", "B", None), ("03.03.2024", "C", None)]


def test_counts(rows, layout):
    counts = {r["path"]: r.asDict() for r in row_counts(rows, layout).collect()}
    assert (counts["two.txt"]["detail_rows"], counts["two.txt"]["ragged_rows"]) == (3, 1)
    assert (counts["flat.TXT"]["padded_rows"], counts["flat.TXT"]["cut_rows"]) == (1, 1)


def test_blocks_do_not_change_the_result(rows, layout):
    """Cutting every file into two-line blocks gives the rows of the single-block form."""
    whole = flatten(rows, layout)
    expected = {(r["path"], tuple(r["values"])) for r in whole.collect()}
    for size in (1, 2, 3):
        cut = rows.withColumn("block", F.floor(F.col("line_no") / size))
        got = {(r["path"], tuple(r["values"])) for r in flatten(cut, detect_layout(cut)).collect()}
        assert got == expected


def test_table_starts_do_not_sort_the_rows(spark):
    """The first pass over all rows adds up in hash tables; one row per block, with its file's format."""
    lines = [("a.txt", b, n, "x\ty\tz" if n else "title") for b in (0, 1) for n in range(3)]
    found = table_starts(as_rows(spark.createDataFrame(lines, "path string, block bigint, line_no bigint, line string")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert sorted(map(tuple, found.collect())) == [("a.txt", b, 1, 2, 3, "txt") for b in (0, 1)]
