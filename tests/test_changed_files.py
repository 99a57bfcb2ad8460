"""New and changed files as a stream: offsets, bounded batches, restarts, late and moved files, and loads from it."""

import os
import time

import pytest
from test_ingest import CONTRACT, name_in_folder, put, report, rows_of

from ladderline.operators.contracts import Contract
from ladderline.sources.changed_files import _Reader, changed_files, versions
from ladderline.streaming.ingest import Ingest, until_all_are_loaded


def test_batches_are_bounded(tmp_path):
    for n in range(7):
        put(tmp_path / f"f{n % 3}{n}.txt", b"x" * n, 100)
    reader = _Reader(str(tmp_path), 3, 0.0)
    offset, seen = reader.initialOffset(), []
    while True:
        rows, end = reader.read(offset)
        rows = list(rows)
        if not rows:
            assert end == offset
            break
        assert len(rows) <= 3 and rows == list(reader.readBetweenOffsets(offset, end))
        seen += rows
        offset = end
    assert sorted(r[0] for r in seen) == sorted(f"file:{tmp_path}/f{n % 3}{n}.txt" for n in range(7))
    assert list(_Reader(str(tmp_path), 3, 3600.0).read(reader.initialOffset())[0]) == []  # none has settled
    assert list(versions(str(tmp_path / "none"))) == []


def test_restarts_changes_and_late_files(spark, tmp_path):
    inbox, seen = tmp_path / "inbox", []
    (inbox / "sub").mkdir(parents=True)
    run = lambda: until_all_are_loaded(
        changed_files(spark, str(inbox), 2, 0.0), lambda batch: seen.append(sorted(r["path"].rsplit("/", 1)[1] for r in batch.collect())), str(tmp_path / "c")
    )
    for n in range(3):
        put(inbox / f"{n}.txt", b"a", 300)
    put(inbox / "notes.md", b"a", 300)
    run()
    assert sorted(sum(seen, [])) == ["0.txt", "1.txt", "2.txt"] and max(map(len, seen)) <= 2
    seen.clear()
    run()
    assert sum(seen, []) == []
    put(inbox / "1.txt", b"changed", 5)
    put(tmp_path / "old.txt", b"old", 9 * 86400)
    os.rename(tmp_path / "old.txt", inbox / "sub" / "old.txt")
    run()
    assert sorted(sum(seen, [])) == ["1.txt", "old.txt"]


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{os.urandom(4).hex()}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'warehouse'}'")
    return name


def test_changed_files_are_loaded(spark, tmp_path, database):
    """A file that changes is loaded again by the same stream and replaces its period."""
    inbox = tmp_path / "in box"
    inbox.mkdir()
    ingest = Ingest(spark, [Contract.from_toml("Продажи", CONTRACT)], f"{database}.log", database, report_of=name_in_folder, with_ids=False)
    run = lambda: until_all_are_loaded(changed_files(spark, str(inbox), settle=0.0), ingest.run_files, str(tmp_path / "c"))
    put(inbox / "один.txt", report("01.03.2024 - 02.03.2024", [("01.03.2024", "A", "1"), ("02.03.2024", "B", "2")]), 300)
    run()
    time.sleep(0.01)
    put(inbox / "один.txt", report("02.03.2024 - 02.03.2024", [("02.03.2024", "C", "3")]), 10)
    run()
    assert rows_of(spark, f"{database}.sales", ["item", "total"]) == [("A", 1.0), ("C", 3.0)]
    run()
    assert spark.table(f"{database}.log").count() == 2
