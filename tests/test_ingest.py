"""From files to tables: contracts, periods, overlaps, rejects, versions, proposals, streams."""

import os
import time

import pytest
from pyspark.sql import functions as F

from ladderline.operators.contracts import Contract
from ladderline.streaming.ingest import Ingest, watch_directory

CONTRACT = """
use = true
table_name = "sales"
schema_name = "marts"
event_time = "day"
comment = "Sales by day"

[[columns]]
name = "Дата"
alias = "day"
type = "date"
comment = "day of sale"

[[columns]]
name = "Товар"
alias = "item"

[[columns]]
name = "Сумма"
alias = "total"
type = "float"

[[columns]]
name = "Нет такой"
alias = "missing"

[[indexes]]
use = true
name = "sales_key"
columns = ["day", "item"]
unique = true
"""
TEXT_TIME = CONTRACT.replace('type = "date"', 'type = "string"').replace('"sales"', '"text_sales"')


def report(period, rows):
    lines = "".join(f"{d}\t{i}\t{t}\r\n" for d, i, t in rows)
    return ("﻿Отчёт\r\nПараметры:\tПериод: " + period + "\r\n\r\nДата\tТовар\tСумма\r\n" + lines + "Итого\t\t9\r\n").encode("utf-8")


def put(path, data, age):
    path.write_bytes(data)
    stamp = time.time() - age
    os.utime(path, (stamp, stamp))


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{os.urandom(4).hex()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'warehouse'}'")
    return name


def rows_of(spark, table, columns):
    return sorted(tuple(r) for r in spark.table(table).select(*columns).collect())


def test_directory_ticks(spark, tmp_path, database):
    inbox = tmp_path / "inbox"
    (inbox / "a 100%").mkdir(parents=True)
    (inbox / "b[1]").mkdir()
    put(inbox / "a 100%" / "Продажи.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1,50"), ("03.03.2024", "B", "2")]), 300)
    put(inbox / "b[1]" / "Продажи.TXT", report("03.03.2024 - 04.03.2024", [("04.03.2024", "C", "3"), ("09.03.2024", "C", "4"), ("09.03.2024", "C", "5"), ("", "D", "6")]), 200)
    put(inbox / "Новый Отчёт.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1,50"), ("02.03.2024", "B", "2")]), 100)
    put(inbox / "Выкл.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 100)
    put(inbox / "readme.md", b"a\tb\tc\n1\t2\t3\n", 100)
    contracts = [Contract.from_toml("Продажи", CONTRACT), Contract("Выкл", use=False)]
    ingest = Ingest(spark, contracts, f"{database}.log", database)

    run = ingest.run_directory(str(inbox))
    sales = f"{database}.sales"
    columns = ["day", "item", "total"]
    got = [(str(d), i, t) for d, i, t in [tuple(r) for r in spark.table(sales).select(*columns).collect()]]
    assert sorted(got) == [
        ("2024-03-01", "A", 1.5), ("2024-03-04", "C", 3.0), ("2024-03-09", "C", 4.0), ("2024-03-09", "C", 5.0), ("None", "D", 6.0),
    ]
    assert sorted(r["id"] for r in spark.table(sales).select("id").collect()) == [1, 3, 4, 5, 6]
    assert spark.table(sales).filter("date_download IS NULL").count() == 0
    assert {f.name: f.metadata.get("comment") for f in spark.table(sales).schema}["day"] == "day of sale"
    assert [(str(r["day"]), r["item"], r["occurrences"]) for r in run.violations["sales"]["sales_key"].collect()] == [("2024-03-09", "C", 2)]
    proposals = {r["name"]: r for r in run.proposals.collect()}
    assert proposals["Дата"]["event_time"] == "дата" and proposals["Сумма"]["type"] == "float64"
    assert proposals["Дата"]["table_name"] == "novyy_otchyot_table"
    log = {(r["report"], r["rows"], r["status"] is None) for r in spark.table(f"{database}.log").collect()}
    assert log == {("Продажи", 2, False), ("Продажи", 4, False), ("Новый Отчёт", 0, True), ("Выкл", 0, True)}
    status = {r["status"] for r in spark.table(f"{database}.log").collect()}
    assert not any(s.startswith("ERROR") for s in status if s)

    again = ingest.run_directory(str(inbox))
    assert again.log.count() == 0

    # A changed file is loaded again and replaces its period only; an empty day disappears.
    put(inbox / "a 100%" / "Продажи.txt", report("01.03.2024 - 04.03.2024", [("02.03.2024", "E", "7")]), 10)
    put(inbox / "Выкл.txt", b"no table at all", 5)
    ingest.run_directory(str(inbox))
    got = [(str(d), i, t) for d, i, t in [tuple(r) for r in spark.table(sales).select(*columns).collect()]]
    assert sorted(got) == [("2024-03-02", "E", 7.0), ("2024-03-09", "C", 4.0), ("2024-03-09", "C", 5.0), ("None", "D", 6.0)]


def test_text_event_time_and_rejects(spark, tmp_path, database):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put(inbox / "Продажи.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1"), ("03.03.2024 5:00:00", "B", "2"), ("10.03.2024", "C", "3")]), 300)
    period = Contract.from_toml("Период", CONTRACT.replace('event_time = "day"', 'event_time = "period"').replace('"sales"', '"periods"'))
    put(inbox / "Период.txt", report("нет", [("01.03.2024", "A", "1")]), 200)
    put(inbox / "sub.mxl", b"not a sheet", 200)
    contracts = [Contract.from_toml("Продажи", TEXT_TIME), period, Contract("sub", use=True, table_name="sub")]
    ingest = Ingest(spark, contracts, f"{database}.log", database)
    ingest.run_directory(str(inbox))
    assert rows_of(spark, f"{database}.text_sales", ["item"]) == [("A",), ("B",), ("C",)]
    status = {r["report"]: r["status"] for r in spark.table(f"{database}.log").collect()}
    assert status["Период"] == "ERROR: missing period bounds: start_period, end_period"
    assert status["sub"] == "ERROR: not a sheet: signature missing"
    assert not spark.catalog.tableExists(f"{database}.periods")

    put(inbox / "Продажи.txt", report("03.03.2024 - 03.03.2024", [("03.03.2024", "X", "1")]), 30)
    ingest.run_directory(str(inbox))
    assert rows_of(spark, f"{database}.text_sales", ["item"]) == [("A",), ("C",), ("X",)]


def test_stream(spark, tmp_path, database):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put(inbox / "Продажи.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 300)
    ingest = Ingest(spark, [Contract.from_toml("Продажи", CONTRACT)], f"{database}.log", database, with_ids=False)
    for _ in range(2):
        query = ingest.stream(watch_directory(spark, str(inbox)), str(tmp_path / "checkpoint"))
        query.awaitTermination(300)
        assert query.exception() is None
        query.stop()
    assert rows_of(spark, f"{database}.sales", ["item", "total"]) == [("A", 1.0)]
    assert spark.table(f"{database}.log").select(F.count(F.lit(1))).first()[0] == 1


WIDE = CONTRACT.replace('alias = "missing"', 'alias = "missing"\ntype = "int"')
NO_TIME = "Товар\tСумма\tЕщё\r\nZ\t8\tx\r\nY\t9\ty\r\n"


def untimed(period):
    return ("﻿Отчёт\r\nПараметры:\tПериод: " + period + "\r\n\r\n" + NO_TIME).encode("utf-8")


def name_in_folder(path):
    return F.lit("Продажи")


@pytest.mark.parametrize("ticks", [1, 2])
def test_mixed_columns(spark, tmp_path, database, ticks):
    """Files with different columns give the same rows in one tick and in two: an absent column is NULL, not 0, and a
    file without the event time deletes nothing."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    ingest = Ingest(spark, [Contract.from_toml("Продажи", WIDE)], f"{database}.log", database, report_of=name_in_folder, with_ids=False)
    full = report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1"), ("03.03.2024", "B", "2")]).decode("utf-8")
    full = full.replace("Дата\tТовар\tСумма", "Дата\tТовар\tСумма\tНет такой").replace("A\t1", "A\t1\t7").replace("B\t2", "B\t2\tbad")
    put(inbox / "one.txt", full.encode("utf-8"), 300)
    if ticks == 2:
        ingest.run_directory(str(inbox))
    put(inbox / "two.txt", untimed("01.03.2024 - 03.03.2024"), 200)
    ingest.run_directory(str(inbox))
    got = [(r.item, r.total, r.missing, r.day is None) for r in spark.table(f"{database}.sales").collect()]
    assert sorted(got, key=lambda r: r[0]) == [("A", 1.0, 7, False), ("B", 2.0, 0, False), ("Y", 9.0, None, True), ("Z", 8.0, None, True)]


def test_failed_contract(spark, tmp_path, database):
    """A contract that can't be applied takes only its own files along, and nothing is loaded twice."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put(inbox / "Продажи.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 300)
    put(inbox / "Ошибка.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 300)
    doubled = Contract.from_toml("Ошибка", CONTRACT.replace('alias = "item"', 'alias = "day"').replace('"sales"', '"broken"'))
    ingest = Ingest(spark, [Contract.from_toml("Продажи", CONTRACT), doubled], f"{database}.log", database)
    ingest.run_directory(str(inbox))
    status = {r["report"]: r["status"] for r in spark.table(f"{database}.log").collect()}
    assert "two columns to one name" in status["Ошибка"] and not status["Продажи"].startswith("ERROR")
    assert ingest.run_directory(str(inbox)).log.count() == 0
    assert rows_of(spark, f"{database}.sales", ["item"]) == [("A",)]


def test_late_files(spark, tmp_path, database):
    """A stream loads files whose times are days behind those it has seen."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    ingest = Ingest(spark, [Contract.from_toml("Продажи", CONTRACT)], f"{database}.log", database, report_of=name_in_folder, with_ids=False)
    for n, age in enumerate((10, 3 * 86400, 43200)):
        put(inbox / f"{n}.txt", report(f"0{n + 1}.03.2024 - 0{n + 1}.03.2024", [(f"0{n + 1}.03.2024", f"F{n}", "1")]), age)
        query = ingest.stream(watch_directory(spark, str(inbox)), str(tmp_path / "checkpoint"))
        query.awaitTermination(300)
        assert query.exception() is None
    assert rows_of(spark, f"{database}.sales", ["item"]) == [("F0",), ("F1",), ("F2",)]


def test_reserved_names(spark, tmp_path, database):
    """Columns may be named like those that loading uses itself."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    text = CONTRACT.replace('alias = "item"', 'alias = "seq"').replace('alias = "total"', 'alias = "event_date"').replace('"day", "item"', '"day", "seq"')
    put(inbox / "Продажи.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 300)
    Ingest(spark, [Contract.from_toml("Продажи", text)], f"{database}.log", database).run_directory(str(inbox))
    assert rows_of(spark, f"{database}.sales", ["seq", "event_date"]) == [("A", 1.0)]


def test_period_load_is_pruned(spark, database):
    """A load of one day scans that day's partition only."""
    from ladderline.operators.loading import EVENT_DATE, PeriodTable

    table = PeriodTable(spark, f"{database}.days", "day")
    rows = spark.range(50).selectExpr("date_add(DATE '2024-01-01', cast(id as int)) as day", "id as n")
    table.load(rows)
    days = spark.sql(f"SELECT DATE '2024-01-07' AS {EVENT_DATE}")
    plan = spark.table(table.name).filter(table._among(days))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "2024-01-07" in plan
    new = spark.sql("SELECT DATE '2024-01-07' AS day, CAST(99 AS BIGINT) AS n")
    assert table.load(new, "2024-01-07 00:00:00", "2024-01-08 23:59:59") == {"planned": 1, "loaded": 1, "deleted": 2}
    assert spark.table(table.name).count() == 49


GROUPED = (
    "﻿Отчёт\r\nПараметры:\tПериод: 01.03.2024 - 03.03.2024\r\n\r\nСклад\t\tСумма\r\nКод\tТовар\t\r\n"
    "A\t\t5\r\nk1\tx\t1\r\nk2\ty\tbad\r\nk3\tz\t1\t2\t3\r\nB\t\t7\r\nk4\tw\t\r\n"
)
GROUPED_CONTRACT = CONTRACT.replace('"sales"', '"grouped"').replace('event_time = "day"\n', "").replace('name = "Дата"', 'name = "Склад"').replace('alias = "day"\ntype = "date"', 'alias = "store"')
GROUPED_CONTRACT = GROUPED_CONTRACT.replace('columns = ["day", "item"]', 'columns = ["store", "item"]')


def test_outcome_of_every_file(spark, tmp_path, database):
    """Ragged, padded, cut, unreadable and absent parts, files that fail, with the whole text of the error."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    flat = report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1"), ("03.03.2024", "B", "bad")]).decode("utf-8")
    flat = flat.replace("Итого", "02.03.2024\tC\r\n02.03.2024\tD\t4\textra\tmore\r\nno date\tE\t5\r\nИтого")
    put(inbox / "Продажи.txt", flat.encode("utf-8"), 300)
    put(inbox / "Группы.txt", GROUPED.encode("utf-8"), 300)
    put(inbox / "Ошибка.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 300)
    put(inbox / "Пусто.txt", b"no table at all", 300)
    put(inbox / "Новый.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", "A", "1")]), 300)
    doubled = CONTRACT.replace('alias = "item"', f'alias = "{"x" * 150}"').replace('alias = "total"', f'alias = "{"x" * 150}"').replace('"sales"', '"broken"')
    contracts = [
        Contract.from_toml("Продажи", CONTRACT), Contract.from_toml("Группы", GROUPED_CONTRACT), Contract.from_toml("Ошибка", doubled),
        Contract.from_toml("Пусто", CONTRACT.replace('"sales"', '"none"')),
    ]
    ingest = Ingest(spark, contracts, f"{database}.log", database, files_per_batch=2)
    run = ingest.run_directory(str(inbox))
    found = {r["report"]: r.asDict() for r in spark.table(f"{database}.log_outcome").collect()}
    assert run.outcome.count() == len(found) == 5
    counts = lambda name: [found[name][c] for c in ("detail_rows", "subtotal_rows", "ragged_rows", "other_rows", "padded_rows", "cut_rows", "unreadable_cells")]
    assert counts("Продажи") == [5, 0, 0, 0, 1, 1, 2] and found["Продажи"]["kind"] == "flat"
    assert counts("Группы") == [3, 2, 1, 0, 0, 0, 1] and found["Группы"]["kind"] == "grouped"
    assert (found["Продажи"]["kept"], found["Продажи"]["missing"], found["Продажи"]["dropped"]) == (["Дата", "Товар", "Сумма"], ["Нет такой"], [])
    assert (found["Группы"]["kept"], found["Группы"]["missing"], found["Группы"]["dropped"]) == (["Склад", "Товар", "Сумма"], ["Нет такой"], ["Код"])
    assert found["Новый"]["kept"] is None and found["Новый"]["error"] is None and found["Новый"]["detail_rows"] == 1
    assert found["Пусто"]["error"] == "no table body" and found["Пусто"]["kept"] is None
    assert found["Ошибка"]["error"].count("x" * 150) == 2 and found["Продажи"]["error"] is None
    log = {r["report"]: r for r in spark.table(f"{database}.log").collect()}
    assert len(log["Ошибка"]["status"]) < 220 < len(log["Ошибка"]["error"]) and log["Ошибка"]["error"] == found["Ошибка"]["error"]
    cells = {(r["path"].rsplit("/", 1)[1], r["column_name"], r["expected"], r["received"]) for r in spark.table(f"{database}.log_cells").collect()}
    assert cells == {("Продажи.txt", "total", "float", "bad"), ("Продажи.txt", "day", "date", "no date"), ("Группы.txt", "total", "float", "bad")}
    assert rows_of(spark, f"{database}.grouped", ["store", "item", "total"]) == [("A", "x", 1.0), ("A", "y", 0.0), ("B", "w", 0.0)]


def test_load_is_not_repeated_after_a_crash(spark, tmp_path, database, monkeypatch):
    """A run that ends between the load and its log leaves nothing to load twice, files without a period included."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    put(inbox / "one.txt", untimed("01.03.2024 - 03.03.2024"), 300)
    make = lambda: Ingest(spark, [Contract.from_toml("Продажи", CONTRACT)], f"{database}.log", database, report_of=name_in_folder)
    ingest = make()
    monkeypatch.setattr(ingest, "_outcome", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest.run_directory(str(inbox))
    assert spark.table(f"{database}.log").isEmpty()
    put(inbox / "two.txt", untimed("01.03.2024 - 03.03.2024"), 200)
    make().run_directory(str(inbox))
    assert rows_of(spark, f"{database}.sales", ["item"]) == [("Y",), ("Y",), ("Z",), ("Z",)]
    assert len({r["id"] for r in spark.table(f"{database}.sales").collect()}) == 4
    assert spark.table(f"{database}.log").count() == 2


@pytest.mark.parametrize("at_once", [1, 3])
def test_tables_side_by_side(spark, tmp_path, database, at_once):
    """Several tables of a run, one of them fed by two contracts and one that fails, give the same however many at once."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    own = {"a": "ta", "b": "tb", "c": "shared", "d": "shared", "e": "te"}
    for n, name in enumerate(own):
        put(inbox / f"{name}.txt", report("01.03.2024 - 03.03.2024", [("01.03.2024", f"{name}1", "1"), (f"0{n % 3 + 1}.03.2024", f"{name}2", "2")]), 300 - n)
    contracts = [Contract.from_toml(name, CONTRACT.replace('"sales"', f'"{table}"')) for name, table in own.items()]
    contracts[4] = Contract.from_toml("e", CONTRACT.replace('alias = "item"', 'alias = "day"'))
    ingest = Ingest(spark, contracts, f"{database}.log", database, tables_at_once=at_once)
    run = ingest.run_directory(str(inbox))
    assert [r["report"] for r in run.log.collect()] == list(own)
    assert rows_of(spark, f"{database}.ta", ["item"]) == [("a1",), ("a2",)] and rows_of(spark, f"{database}.tb", ["item"]) == [("b1",), ("b2",)]
    # both contracts of the shared table cover the same days, and the later one wins
    assert rows_of(spark, f"{database}.shared", ["item"]) == [("d1",), ("d2",)]
    errors = {r["report"]: r["error"] for r in spark.table(f"{database}.log").collect()}
    assert "two columns to one name" in errors["e"] and [errors[k] for k in "abcd"] == [None] * 4
