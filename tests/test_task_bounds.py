"""What a task of a load holds does not grow with the files (F1 of round 4)."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ladderline.operators import flatten as flattening
from ladderline.operators.contracts import Contract, ContractColumn
from ladderline.operators.flatten import flatten, flatten_tagged
from ladderline.operators.layout import detect_layout
from ladderline.sources.text_reports import as_rows, read_text_lines
from ladderline.streaming import ingest as loading

HEAD = "Отчёт\nПараметры:\tПериод: 01.03.2024 - 03.03.2024\nСклад\t\tСумма\nКод\tТовар\t\n"


def grouped(groups, size):
    """A grouped report and its detail rows; groups are longer than a block."""
    lines, rows = [HEAD], []
    for g in range(groups):
        lines.append(f"g{g}\t\t1\n")
        for i in range(size):
            lines.append(f"{g}-{i}\tx\t{i}\n")
            rows.append((f"g{g}", f"{g}-{i}", "x", str(i)))
    return "".join(lines), rows


@pytest.mark.parametrize("split", [None, 1_000_000])
def test_a_long_split_is_cut_into_blocks(spark, tmp_path, split):
    """Blocks of one split have 65,536 lines at most, stand in the order of the file, and hand on their groups."""
    text, expected = grouped(2, 90_000)
    (tmp_path / "long.txt").write_text(text, encoding="utf-8")
    (tmp_path / "short.txt").write_text(grouped(1, 3)[0], encoding="utf-8")
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = read_text_lines(spark, str(tmp_path))
        at = lines.filter(F.endswith("path", F.lit("long.txt")))
        sizes = [r["count"] for r in at.groupBy("block").count().collect()]
        assert len(sizes) > 2 and max(sizes) <= 1 << 16
        assert [r["line"] for r in at.orderBy("block", "line_no").collect()] == text.rstrip("\n").split("\n")
        rows = as_rows(lines)
        found = flatten(rows, detect_layout(rows)).orderBy("path", "block", "line_no").collect()
        assert [tuple(r["values"]) for r in found] == expected + grouped(1, 3)[1]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_are_dealt_by_their_number(spark, tmp_path, monkeypatch):
    """Many rows go to as many tasks as their number asks for, with a number for their file in place of its path."""
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text(grouped(3, 700)[0], encoding="utf-8")
    rows = as_rows(read_text_lines(spark, str(tmp_path)))
    rows = rows.withColumn("block", F.expr("line_no % 8589934592 div 50"))
    plain = flatten_tagged(rows, detect_layout(rows))
    monkeypatch.setattr(flattening, "ROWS_PER_TASK", 100)
    layout = detect_layout(rows)
    dealt = flatten_tagged(rows, layout)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    tasks = layout.agg(F.sum("kept")).first()[0] // 100
    assert tasks > 40 and f", {tasks}), REPARTITION_BY_NUM" in plan
    sorts = [line for line in plan.split("\n") if "Sort [" in line and "line_no" in line]
    assert sorts and not any("path" in line for line in sorts)


def test_rows_meet_their_file_where_they_lie(spark, tmp_path, monkeypatch):
    """A load doesn't shuffle its rows by path: a file would be one task's."""
    plans = []
    real = loading.stage

    def seen(df, label="stage", **how):
        if label == "typed":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label, **how)

    monkeypatch.setattr(loading, "stage", lambda df, label="stage", *a, **k: seen(df, label, **k) if not a else real(df, label, *a, **k))
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    for n in range(3):
        (inbox / f"{n}.txt").write_text(grouped(1, 5)[0], encoding="utf-8")
        os.utime(inbox / f"{n}.txt", (time.time() - 100 + n,) * 2)
    database = f"db_{os.urandom(4).hex()}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path / 'warehouse'}'")
    contract = Contract(report="r", use=True, table_name="t", columns=(ContractColumn("Склад", "store"), ContractColumn("Сумма", "total", "int")))
    loading.Ingest(spark, [contract], f"{database}.log", database, with_ids=False, report_of=lambda path: F.lit("r")).run_directory(str(inbox))
    assert spark.table(f"{database}.t").count() == 15
    assert len(plans) == 1 and "SortMergeJoin" not in plans[0] and "hashpartitioning" not in plans[0]
