"""Contracts, inference, evolution, loads, arrivals, checks, and the block-wise plans."""

import datetime as dt
import random
import re
import time
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladderline.operators.contracts import Contract, ContractColumn, IndexSpec, apply_contract, drop_service_columns
from ladderline.operators.evolution import changed_comments, database_type, evolve, resolve_names, sync_comments, with_surrogate_id
from ladderline.operators.flatten import flatten
from ladderline.operators.inference import collect_contracts, generate_contracts, infer_types, wide_to_cells
from ladderline.operators import layout, periods
from ladderline.operators.layout import detect_layout
from ladderline.operators.loading import PeriodTable, audits, key_layout, key_ranges, surviving_rows
from ladderline.operators.quality import classify_errors, reject
from ladderline.plans.ordered import Running, running, with_blocks
from ladderline.session import stage
from ladderline.sources.text_reports import as_rows, read_text_lines, split_lines
from ladderline.streaming import arrivals
from ladderline.streaming.arrivals import accepted_starts, guard_stream, guarded_starts, new_versions, recent_changes


def test_contract_application(spark):
    df = spark.createDataFrame([("1", "x", "drop"), ("2", "y", "drop")], "A string, `B.x` string, Extra string")
    contract = Contract("r", columns=(ContractColumn("A", "a_col", "Int64"), ContractColumn("B.x", "b col"), ContractColumn("Missing", "m", "int")))
    out = apply_contract(df, contract)
    assert out.dtypes == [("a_col", "bigint"), ("b col", "string")]
    assert [r[0] for r in out.collect()] == [1, 2]
    clash = Contract("r", columns=(ContractColumn("A", "x"), ContractColumn("Extra", "x")))
    with pytest.raises(ValueError):
        apply_contract(df, clash)


def test_service_columns(spark):
    df = spark.createDataFrame([(1, 2)], "id int, Identity int")
    assert drop_service_columns(df).columns == ["Identity"]


def test_contract_text():
    contract = Contract.from_toml("Отчёт", 'use = true\nextra = 1\nevent_time = ""\n[[columns]]\nname = "A"\nalias = ""\n[[indexes]]\nname = " i "\ncolumns = ["A", " "]\n')
    assert contract.use and contract.event_time is None and contract.schema_name == "marts"
    assert contract.columns[0].output == "A"
    assert contract.indexes == (IndexSpec("i", ("A",), False, False),)


INFERRED = {
    "a": (["1", "-15", "+7", "0", None], "Int64"),
    "b": (["1 234", "12\xa0345 678", "5", "", None], "Int64"),
    "c": (["1,5", "2", "-0,25", None, None], "float64"),
    "d": (["1.5", "1 234,56", None, None, None], "float64"),
    "e": (["007", "123", None, None, None], "string"),
    "f": (["12", "abc", None, None, None], "string"),
    "g": (["", None, " ", None, None], "string"),
    "h": (["99999999999999999999", "1", None, None, None], "float64"),
    "i": (["9223372036854775807", "-9223372036854775808", None, None, None], "Int64"),
    "j": (["9223372036854775808", "1", None, None, None], "float64"),
}


def test_inference(spark):
    rows = list(zip(*[v for v, _ in INFERRED.values()], strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in INFERRED)).withColumn("k", F.lit(dt.date(2024, 1, 1)))
    got = {r["name"]: r["type"] for r in infer_types(df).collect()}
    assert got == {**{n: t for n, (_, t) in INFERRED.items()}, "k": "string"}


def test_contract_generation(spark):
    df = spark.createDataFrame([(i, f"0{i}.02.2024", str(i), "x") for i in range(1, 6)], "n int, `Дата Док.` string, `Кол` string, `Имя` string")
    cells = wide_to_cells(df, "n", F.lit("Аренда помещений"))
    (contract,) = collect_contracts(generate_contracts(cells))
    assert contract.table_name == "arenda_pomeshcheniy_table" and contract.event_time == "дата_док_"
    assert [c.type for c in contract.columns] == ["datetime64[ns]", "Int64", "string"]
    assert not contract.use and contract.indexes[0].columns == ("дата_док_",)


def test_database_types():
    assert database_type(T.IntegerType()) == "BIGINT" and database_type(T.StringType()) == "TEXT"
    assert database_type(T.StringType(), True) == "UUID" and database_type(T.TimestampNTZType()) == "TIMESTAMP"


def test_evolution_strict_and_lenient(spark):
    df = spark.createDataFrame([("1",), ("x",)], "a string")
    target = T.StructType([T.StructField("a", T.LongType())])
    assert [r[0] for r in evolve(df, target, strict=False).collect()] == [1, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evolve(df, target).collect()
    long_name = "Остаток на начало периода, количество"
    cut = spark.createDataFrame([(1,)], f"`{long_name[:34]}` long")
    assert evolve(cut, T.StructType([T.StructField(long_name, T.LongType())])).columns == [long_name]


def test_schema_sync_and_comments(spark, tmp_path):
    spark.sql(f"CREATE DATABASE sync_db LOCATION '{tmp_path / 'w'}'")
    table = PeriodTable(spark, "sync_db.t", "day")
    day = dt.date(2024, 1, 1)
    table.load(spark.createDataFrame([(day, "1", "x")], "day date, a string, b string"), dt.datetime(2024, 1, 1), None)
    table.sync_schema(T.StructType.fromDDL("day date, a string, b string, c double"))
    table.sync_schema(T.StructType.fromDDL("day date, a long, c double"))
    assert [tuple(r) for r in spark.table("sync_db.t").select("day", "a", "c").collect()] == [(day, 1, None)]
    assert "b" not in spark.table("sync_db.t").columns
    counts = table.load(spark.createDataFrame([(day, 5, 1.0)], "day date, a long, c double"), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))
    assert counts == {"planned": 1, "loaded": 1, "deleted": 1}
    wanted = {"a": "number's", "c": "", "zz": "none"}
    spark.sql("CREATE TABLE sync_db.plain (a INT, c INT) USING parquet")
    sync_comments(spark, "sync_db.plain", "it's", wanted)
    table.describe("it's", wanted)
    for name in ("t", "plain"):
        assert changed_comments(spark, f"sync_db.{name}", {"a": "number's", "c": ""}) == {}
        assert spark.catalog.getTable(f"sync_db.{name}").description == "it's"
    table.load(spark.createDataFrame([(day, 6, 1.0)], "day date, a long, c double"))
    assert changed_comments(spark, "sync_db.t", {"a": "number's"}) == {}


class Stop(Exception):
    pass


@pytest.mark.parametrize("step", ["_write_parts", "_write_state", "_commit"])
@pytest.mark.parametrize("after", [False, True])
def test_load_is_one_commit(spark, tmp_path, monkeypatch, step, after):
    """A load that stops before or after any step leaves the old or the new content, and repeating it gives the new once."""
    name = f"commit_{step}_{after}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'w'}'")
    table = PeriodTable(spark, f"{name}.t", "day")
    schema = "day date, n int"
    day = lambda d: dt.date(2024, 1, d) if d else None
    rows = lambda: sorted((r.day.day if r.day else 0, r.n) for r in table.read().collect())
    table.load(spark.createDataFrame([(day(1), 1), (day(2), 2), (day(3), 3), (None, 4)], schema), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), "first")
    old, new = rows(), [(0, 4), (0, 8), (2, 7), (3, 3), (9, 9)]
    again = spark.createDataFrame([(day(2), 7), (None, 8), (day(9), 9)], schema)
    change = lambda: table.load(again, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 23), "second")
    whole = getattr(PeriodTable, step)

    def stopping(self, *args, **kwargs):
        if after:
            whole(self, *args, **kwargs)
        raise Stop

    monkeypatch.setattr(PeriodTable, step, stopping)
    with pytest.raises(Stop):
        change()
    monkeypatch.undo()
    committed = step == "_commit" and after
    assert rows() == (new if committed else old)
    assert change() == ({"planned": 0, "loaded": 0, "deleted": 0} if committed else {"planned": 3, "loaded": 3, "deleted": 2})
    assert rows() == new and change()["loaded"] == 0 and rows() == new
    left = lambda: spark.table(f"{name}.t__parts").select("__event_date", "__load").distinct().count()
    assert left() > 5 and table.vacuum() > 0 and left() == 5 and rows() == new and table.vacuum() == 0
    assert sorted(r[0] for r in table.committed().collect()) == ["first", "second"]


def plain_guard(events, timeout):
    started, out = {}, []
    for path, ts, n, kind in sorted(events, key=lambda e: (e[1], e[2])):
        if kind == "finish":
            started.pop(path, None)
        elif path not in started or (ts - started[path]).total_seconds() >= timeout:
            started[path] = ts
            out.append((path, n))
    return sorted(out)


@pytest.mark.parametrize("finishes", [0.0, 0.02, 0.3])
def test_guarded_starts(spark, monkeypatch, finishes):
    """Paths of all densities, over chunks of two timeouts and more, against a walk along all events."""
    monkeypatch.setattr(arrivals, "CHUNK_TIMEOUTS", 2)
    rnd = random.Random(int(finishes * 100))
    events = []
    for path, gap in enumerate((1, 60, 500, 1000, 1800, 2500, 9000)):
        at = dt.datetime(1969, 12, 31, 22)
        for _ in range(400):
            at += dt.timedelta(seconds=rnd.choice([0, gap, rnd.uniform(0, 2 * gap)]))
            events.append((f"p{path}", at, len(events), "finish" if rnd.random() < finishes else "event"))
    rnd.shuffle(events)
    found = guarded_starts(spark.createDataFrame(events, "path string, ts timestamp_ntz, event_id int, kind string"))
    assert sorted((r.path, r.event_id) for r in found.collect()) == plain_guard(events, 1800)
    if not finishes:
        plain = accepted_starts(spark.createDataFrame(events, "path string, ts timestamp_ntz, event_id int, kind string").drop("kind"))
        assert plain.exceptAll(found.select(*plain.columns)).isEmpty()


def test_chunk_steps_work_on_arrays():
    """A frame of many chunks gives one frame of steps, cut anywhere; chunk by chunk they are the same."""
    rnd, span = random.Random(11), 1800 * 1_000_000
    rows = []
    for path in range(60):
        for chunk in range(10):
            start = chunk * span * arrivals.CHUNK_TIMEOUTS
            times = sorted(start + rnd.choice([0, rnd.randrange(2 * span), rnd.randrange(span * arrivals.CHUNK_TIMEOUTS)]) for _ in range(rnd.randrange(1, 12)))
            rows += [(f"p{path}", chunk, micros, path % 2 == 0 and rnd.random() < 0.2) for micros in times]
    rows = pd.DataFrame(rows, columns=["path", "__chunk", "__micros", "__ends"])
    steps = lambda frames: list(arrivals._chunk_steps(span)(iter(frames)))
    cuts = [0, 1, 2, 1000, 1001, 1500, len(rows)]
    dealt = steps([rows.iloc[a:b] for a, b in zip(cuts, cuts[1:], strict=False)])
    assert len(dealt) < len(cuts) + 1
    alone = pd.concat([f for _, part in rows.groupby(["path", "__chunk"], sort=False) for f in steps([part])], ignore_index=True)
    assert pd.concat(dealt, ignore_index=True).equals(alone)


def test_guard_stream_ends(spark, tmp_path):
    """Over micro-batches: a finish frees a path, a timer forgets one whose time is over, and the stream comes to its end."""
    base = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    at = lambda s: base + dt.timedelta(seconds=s)
    batches = [
        [("a", at(10), "event"), ("a", at(5), "event"), ("b", at(0), "event")],
        [("a", at(100), "finish"), ("a", at(101), "event"), ("b", at(1000), "event"), ("a", at(102), "event")],
        [("b", at(1800), "event"), ("c", at(9000), "event")],
        [("a", at(9100), "event"), ("b", at(9200), "finish"), ("b", at(9201), "event"), ("c", at(9300), "event")],
    ]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, "path string, ts timestamp, kind string").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
        time.sleep(0.01)
    stream = spark.readStream.schema("path string, ts timestamp, kind string").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = (
        guard_stream(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(240) and query.exception() is None
    got = {(r.path, int((r.ts - base.replace(tzinfo=None)).total_seconds())): r.accepted for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    accepted = {("a", 5), ("b", 0), ("a", 101), ("b", 1800), ("c", 9000), ("a", 9100), ("b", 9201)}
    assert {k for k, v in got.items() if v} == accepted and len(got) == 11


def test_surviving_rows_against_brute_force(spark):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    moment = lambda: base + dt.timedelta(hours=rng.randrange(24 * 20), seconds=rng.choice([0, 0, 86399 % 3600]))
    loads = []
    for i in range(1, 13):
        a = moment()
        loads.append((i, rng.choice("xy"), a, rng.choice([None, a + dt.timedelta(hours=rng.randrange(0, 24 * 6))])))
    rows = [(n, rng.choice("xy"), rng.choice([None, moment()]) if n % 9 == 0 else moment(), rng.choice([None, *range(1, 13)])) for n in range(400)]
    expected = [
        r[0] for r in rows
        if r[2] is None or not any(l[1] == r[1] and (r[3] is None or l[0] > r[3]) and l[2] <= r[2] <= (l[3] or l[2]) for l in loads)
    ]
    kept = surviving_rows(
        spark.createDataFrame(rows, "n int, t string, ts timestamp_ntz, seq int"),
        spark.createDataFrame(loads, 'seq int, t string, start timestamp_ntz, `end` timestamp_ntz'),
        "ts",
        "t",
    )
    assert sorted(r["n"] for r in kept.collect()) == expected


def test_running_against_one_pass(spark):
    rng = random.Random(3)
    rows = [(s, i, rng.choice([None, i])) for s in "ab" for i in range(50)]
    df = with_blocks(spark.createDataFrame(rows, "s string, line_no long, v long"), 7)
    got = running(df, ["s"], "line_no", {
        "total": Running("sum", F.col("v")), "before": Running("sum", F.lit(1), inclusive=False),
        "last": Running("last", F.col("v")), "prev": Running("last", F.col("v"), inclusive=False),
        "next": Running("last", F.col("v"), inclusive=False, backward=True),
    }).collect()
    for r in got:
        mine = [v for s, i, v in rows if s == r["s"] and i <= r["line_no"] and v is not None]
        earlier = [v for s, i, v in rows if s == r["s"] and i < r["line_no"] and v is not None]
        later = [v for s, i, v in rows if s == r["s"] and i > r["line_no"] and v is not None]
        assert r["total"] == sum(mine) and r["before"] == r["line_no"]
        assert (r["last"], r["prev"], r["next"]) == (
            mine[-1] if mine else None, earlier[-1] if earlier else None, later[0] if later else None,
        )


def sequential_flatten(rows, spans, dims):
    """Straightforward reader of a body, the yardstick for random hierarchies."""
    stack = [[None] * s for s in spans]
    out = []
    for cells in rows:
        if any(c.strip() for c in cells[spans[-1]:dims]):
            out.append([v or None for v in [x for level in stack for x in level] + cells])
            continue
        filled = next((i for i in range(dims) if not cells[i].strip()), dims)
        if filled in spans:
            r = spans.index(filled)
            stack[r] = [c.strip() for c in cells[:filled]]
            for deeper in range(r + 1, len(spans)):
                stack[deeper] = [None] * spans[deeper]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_hierarchies(spark, seed):
    """Files with different depths and layouts in one job equal the sequential reader, for any block size."""
    rng = random.Random(seed)
    texts, expected = [], {}
    for n in range(6):
        depth = rng.randint(1, 3)
        spans = sorted(rng.sample(range(1, 5), depth))
        dims, measures = spans[-1] + rng.randint(1, 2) + 1, rng.randint(1, 3)
        pad = lambda names, width: names + [""] * (width - len(names))
        head = [pad([f"g{r}_{j}" for j in range(s)], dims) + [""] * measures for r, s in enumerate(spans)]
        head[0][dims:] = [f"m{j}" for j in range(measures)]
        head.append([f"d{j}" for j in range(dims)] + [""] * measures)
        # A first level wider than one column reads as measures: such a file is flat.
        grouped = spans[0] == 1
        body = [pad(["start"] * spans[0], dims) + ["1"] * measures]
        for i in range(60):
            kind = rng.random()
            if kind < 0.3:
                body.append(pad([f" v{i}_{j}" for j in range(rng.choice(spans))], dims) + ["1"] * measures)
            elif kind < 0.4:
                body.append(pad([f"x{i}"] * rng.randint(0, dims - 1), dims) + ["2"] * measures)
            else:
                cells = [rng.choice(["", " ", f"c{i}_{j}"]) for j in range(dims)]
                body.append(cells + [rng.choice(["", str(i)]) for _ in range(measures)])
        lines = ["\t".join(c) for c in [*head, *body]]
        texts.append((f"f{n}", "Заголовок\n" + "\n".join(lines)))
        if grouped:
            # Lines without any filled cell are blank and never reach the reader.
            rows = [c for c in body if any(x.strip() for x in c)]
            expected[f"f{n}"] = sequential_flatten(rows, spans, dims)
    frame = spark.createDataFrame(texts, "path string, text string")
    for size in (3, 1 << 16):
        rows = as_rows(split_lines(frame, rows_per_block=size))
        got = {}
        for r in flatten(rows, detect_layout(rows)).orderBy("path", "line_no").collect():
            got.setdefault(r["path"], []).append(r["values"])
        for path, want in expected.items():
            assert got.get(path, []) == want, path


def test_surrogate_ids_are_dense(spark):
    df = with_blocks(spark.range(0, 500).withColumnRenamed("id", "k"), 64, "k").filter("k % 3 = 0")
    got = [(r["k"], r["id"]) for r in with_surrogate_id(df, "k", start=10).orderBy("k").collect()]
    assert got == [(k, 11 + i) for i, k in enumerate(range(0, 500, 3))]


def test_audits_and_key_layout(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, "b")], "k int, v string")
    indexes = (
        IndexSpec("u", ("k", "v"), True, True), IndexSpec("off", ("k",), False, True), IndexSpec(None, ("k",), True, True),
        IndexSpec("plain", ("v",), True, False),
    )
    found = audits(df, indexes)
    assert list(found) == ["u"] and [tuple(r) for r in found["u"].collect()] == [(1, "a", 2)]
    plan = key_layout(df, indexes, 2)._jdf.queryExecution().toString()
    assert "rangepartitioning(k" in plan


def test_file_versions(spark):
    events = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 5), ("c", 7)], "path string, mtime int")
    ledger = spark.createDataFrame([("a", 2, 1), ("a", 1, 2), ("b", 5, 1)], "path string, mtime int, started int")
    assert sorted(tuple(r) for r in new_versions(events, ledger).collect()) == [("a", 2), ("c", 7)]


def test_recent_changes(spark):
    seen = [("a", 0, 1.0, 1.0), ("a", 0, 6.0, 1.0), ("a", 1, 11.0, 10.5), ("a", 1, 16.0, 10.55), ("b", 0, 50.0, 1.0)]
    df = spark.createDataFrame(seen, "path string, block long, seen double, mtime double")
    assert sorted(r["seen"] for r in recent_changes(df).collect()) == [1.0, 11.0]


def test_stale_guard_on_one_busy_path(spark):
    base = dt.datetime(2024, 1, 1)
    rng = random.Random(5)
    times = sorted(rng.uniform(0, 40000) for _ in range(300)) + [99999.0, 99999.5]
    events = [("p", base + dt.timedelta(seconds=round(t, 3)), i) for i, t in enumerate(times)]
    want, last = [], None
    for _, ts, i in events:
        if last is None or (ts - last).total_seconds() >= 1800:
            want.append(i)
            last = ts
    got = accepted_starts(spark.createDataFrame(events, "path string, ts timestamp_ntz, event_id int"))
    assert sorted(r["event_id"] for r in got.collect()) == want


def test_guard_stream(spark, tmp_path):
    base = pd.Timestamp("2024-01-01")
    steps = [(0, "event"), (10, "event"), (20, "finish"), (30, "event"), (1000, "event"), (1830, "event")]
    batch = pd.DataFrame({"path": "p", "ts": [base + pd.Timedelta(seconds=s) for s, _ in steps], "kind": [k for _, k in steps]})
    spark.createDataFrame(batch).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("path string, ts timestamp, kind string").parquet(str(tmp_path / "in"))
    query = guard_stream(stream).writeStream.format("memory").queryName("guarded").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r["ts"] - base.to_pydatetime()).total_seconds(): r["accepted"] for r in spark.table("guarded").collect()}
    assert got == {0.0: True, 10.0: False, 30.0: True, 1000.0: False, 1830.0: True}


def test_error_messages(spark):
    messages = [
        "invalid input for query argument $2 in element #4 of executemany() sequence: 1.0 (expected str, got float)",
        "invalid input for query argument $1: 'x' (expected int, got str)",
        "boom",
        "",
    ]
    log = spark.createDataFrame([(i, m, ["a", "b"]) for i, m in enumerate(messages)], "n int, message string, columns array<string>")
    got = [(r["column_name"], r["row_number"], r["expected"], r["is_type_error"], r["reason"]) for r in classify_errors(log).orderBy("n").collect()]
    assert got[0][:4] == ("b", 5, "str", True) and got[1][:4] == ("a", None, "int", True)
    assert got[2] == (None, None, None, False, "boom") and got[3][4] == "неизвестная ошибка"
    accepted, rejected = reject(log, F.when(F.col("message") == "boom", "bad"))
    assert accepted.count() == 3 and [r["reason"] for r in rejected.collect()] == ["bad"]


def test_text_scan_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("﻿Привет\r\nа\rб".encode("utf-8") + b"\xd0\n\xffq\n")
    (tmp_path / "b.TXT").write_bytes("Привет №\r\n".encode("cp1251"))
    (tmp_path / "c.csv").write_bytes(b"no\n")
    read = lambda **k: {p: [r["line"] for r in g] for p, g in _by_file(read_text_lines(spark, str(tmp_path), **k)).items()}
    assert read() == {"a.txt": ["Привет", "а", "б", "q"], "b.TXT": [" "]}
    assert read(fallback_encoding="cp1251")["b.TXT"] == ["Привет №"]
    with pytest.raises(ValueError):
        read_text_lines(spark, str(tmp_path), fallback_encoding="koi8-r")


def _by_file(lines):
    files = {}
    for r in lines.orderBy("path", "block", "line_no").collect():
        files.setdefault(r["path"].rsplit("/", 1)[-1], []).append(r)
    return files


def test_large_file_is_split(spark, tmp_path):
    """A file larger than a scan split is read by several tasks and still flattens in order."""
    body = ["day\t\tqty", "item\tcode\t"]
    for d in range(40):
        body.append(f"{d:02d}.01.2024\t\t9")
        body += [f"item {d} {i}\tc{i}\t{i}" for i in range(50)]
    (tmp_path / "big.txt").write_text("\n".join(body) + "\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = as_rows(read_text_lines(spark, str(tmp_path)))
        assert rows.select("block").distinct().count() > 3
        got = [tuple(r["values"]) for r in flatten(rows, detect_layout(rows)).orderBy("block", "line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [(f"{d:02d}.01.2024", f"item {d} {i}", f"c{i}", str(i)) for d in range(40) for i in range(50)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_without_one_task(spark):
    """Dense ids over many blocks of all sizes, and no window that gathers all blocks in one task."""
    rnd = random.Random(3)
    rows = [(b, n) for b in rnd.sample(range(10_000), 700) for n in rnd.sample(range(50), rnd.choice([1, 1, 7, 30]))]
    df = spark.createDataFrame(rows, "block int, n int").repartition(5)
    placed = with_surrogate_id(df, "n", "block", start=100)
    assert "SinglePartition" not in plan_of(placed)
    assert [r.id for r in sorted(placed.collect(), key=lambda r: (r.block, r.n))] == list(range(101, 101 + len(rows)))
    assert with_surrogate_id(df.where("false"), "n").isEmpty()


def test_heads_are_gathered_per_file(spark):
    """A very wide file next to narrow ones: each gathers the lines its own width allows, under its own bound in the plan."""
    narrow = "\n".join(["a\tb\tc", *[f"{i}\tx\ty" for i in range(300)]])
    wide = "\n".join(["\t".join(f"c{i}" for i in range(1000)), *["\t".join(str(i) for i in range(1000))] * 5])
    files = [("n1", narrow), ("n2", narrow), ("w", wide)]
    rows = as_rows(split_lines(spark.createDataFrame(files, "path string, text string")))
    blocks = layout.table_starts(rows)
    limits = layout._limits(blocks)
    assert {(r["path"], r["limit"], r["bound"]) for r in limits.collect()} == {("n1", 5, 16), ("n2", 5, 16), ("w", 1002, 4096)}
    heads = layout._head_rows(rows, blocks, limits)
    assert {(r["path"], r["count"]) for r in heads.groupBy("path").count().collect()} == {("n1", 5), ("n2", 5), ("w", 6)}
    assert "WindowGroupLimit" in plan_of(heads)
    found = {(r["path"], r["kind"], len(r["names"])) for r in layout.layouts_by_file(detect_layout(rows)).collect()}
    assert found == {("n1", "flat", 3), ("n2", "flat", 3), ("w", "flat", 1000)}


@pytest.mark.parametrize("lines", [7, 8, 64])
def test_periods_of_long_titles(spark, monkeypatch, lines):
    """Chunks of any size find what one search over the whole title finds, wherever names, dates and line ends fall."""
    monkeypatch.setattr(periods, "CHUNK_LINES", lines)
    rnd = random.Random(lines)
    day = lambda: f"{rnd.randint(10, 28)}.0{rnd.randint(1, 9)}.2024" + rnd.choice(["", " 0:00:00", "\n10:00:00", " "])
    pieces = [
        lambda: "Параметры:", lambda: "Заметка", lambda: "ПАРАМЕТРЫ:\tНа дату: " + day(), lambda: f"Период: {day()} - {day()}", lambda: f"Период:\n{day()}\n-\n\n{day()}",
        lambda: f"Начало: {day()}\nКонец: {day()}", lambda: "Дата " + day(), lambda: "Отбор:", lambda: day(), lambda: "",
    ]
    texts = []
    for n in range(160):
        chosen = rnd.choices(pieces, weights=[rnd.choice([0, 1, 3]) for _ in pieces[:-1]] + [1], k=rnd.choice([0, 1, 3, 12, 60, 150]))
        texts.append((f"f{n}", "\n".join([*["Заметка"] * rnd.choice([0, 5, 40]), *[p() for p in chosen], "a\tb\tc", "1\t2\t3"])))
    rows = as_rows(split_lines(spark.createDataFrame(texts, "path string, text string").repartition(4), rows_per_block=rnd.choice([5, 50])))
    rows = stage(rows, "title-rows")
    columns = ("path", "start_raw", "end_raw", "pattern")
    whole = {tuple(r) for r in periods.report_periods(periods.header_texts(rows), F.lit("day")).select(*columns).collect()}
    found = {tuple(r) for r in periods.report_periods(periods.header_periods(rows), F.lit("day")).select(*columns).collect()}
    assert found == whole and len({r[3] for r in whole}) == 4


def test_key_layout_skips_row_groups(spark, tmp_path):
    """A read of one key opens few row groups of a clustered table, and all of an unordered one."""
    rnd = random.Random(8)
    rows = spark.createDataFrame([(rnd.randrange(5000), n) for n in range(40_000)], "k int, n int")
    indexes = (IndexSpec("by_k", ("k",), True),)

    def scanned(df, path):
        df.write.option("parquet.block.size", 4096).option("parquet.page.size", 1024).parquet(path)
        found = spark.read.parquet(path).filter("k = 77")
        assert found.count() == len([1 for r in rows.filter("k = 77").collect()])
        plan = found.select("n")._jdf.queryExecution().executedPlan()
        plan.executeCollect()
        leaves = plan.collectLeaves()
        return leaves.apply(0).metrics().apply("numOutputRows").value()

    loose = scanned(rows.repartition(4), str(tmp_path / "loose"))
    tight = scanned(key_layout(rows, indexes, 4), str(tmp_path / "tight"))
    assert loose > 20 * tight > 0
    ranges = sorted((r.least, r.greatest, r.rows) for r in key_ranges(spark.read.parquet(str(tmp_path / "tight")), "k").collect())
    assert sum(r[2] for r in ranges) == 40_000 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_periods_read_rows_twice(spark):
    """A title is read to find where the table starts and once more for its lines, whatever stands behind the rows."""
    seen = spark.sparkContext.accumulator(0)

    def counted(n):
        seen.add(1)
        return "f", 0, n, "a\tb\tc" if n == 999 else f"Заметка: {n}"

    lines = spark.createDataFrame(spark.sparkContext.parallelize(range(1000), 4).map(counted), "path string, block long, line_no long, line string")
    assert [tuple(r) for r in periods.header_periods(as_rows(lines)).collect()] == [("f", None, None, None)]
    assert seen.value == 2000


@pytest.mark.parametrize("before", ["", "😀" * 40])
def test_periods_behind_wide_characters(spark, before):
    """Characters of two UTF-16 units before a period move it in the text, but not out of its line."""
    titles = {
        "one": f"{before}\nПараметры: {before} Период: 01.02.2024 - 03.02.2024",
        "two": f"{before}\n{before} Начало: 01.02.2024\nКонец: 03.02.2024",
        "start": f"{before} Параметры: {before}\n{before} Параметры: На дату 01.02.2024",
        "near": f"{before} Параметры:\n:\n01.02.2024\n0:00:00\n-\n03.02.2024\n23:59:59",
        "own": "Период: 01.01.2024 - 02.01.2024 Параметры:",
    }
    rows = as_rows(split_lines(spark.createDataFrame([(k, v + "\na\tb\tc") for k, v in titles.items()], "path string, text string")))
    got = {r[0]: tuple(r)[1:] for r in periods.header_periods(rows).collect()}
    assert got == {
        "one": ("01.02.2024", "03.02.2024", 1), "two": ("01.02.2024", "03.02.2024", 2), "start": ("01.02.2024", None, 3),
        "near": ("01.02.2024\n0:00:00", "03.02.2024\n23:59:59", 1), "own": (None, None, None),
    }


def test_names_are_resolved_in_one_sort(spark):
    """Names of all kinds against what two joins would find, with one sort of both sides in the plan and no join."""
    rnd = random.Random(16)
    long = ["я" * 31 + "z", "я" * 40, "x" * 61 + "😀", "x" * 62 + "😀" * 3, "y" * 63, "y" * 64, "y" * 200]
    shortened = lambda n: n.encode()[:63].decode(errors="ignore")
    names = [*long, *map(shortened, long), *[n + "q" for n in long], "", " ", "col", None]
    rows = lambda n: [(rnd.choice(["a", "b", "c", None]), rnd.choice(names), rnd.randrange(3)) for _ in range(n)]
    existing, expected = rows(60), rows(200)
    schema = "table_name string, name string, to_type int"
    have = spark.createDataFrame(existing, schema).drop("to_type").repartition(3)
    found = resolve_names(have, spark.createDataFrame(expected, schema).repartition(3))
    plan = plan_of(found)
    assert "Join" not in plan and len(re.findall(r"\bSort \[", plan)) == 1
    stored = {r[:2] for r in existing if None not in r[:2]}

    def actual(table, name):
        wanted = [] if name is None else [name, shortened(name)]
        return next((n for n in wanted if (table, n) in stored), None)

    assert found.columns == ["table_name", "name", "to_type", "actual"]
    assert Counter(map(tuple, found.collect())) == Counter((t, n, k, actual(t, n)) for t, n, k in expected)
    broken = spark.sql("SELECT 'a' AS table_name, CAST(X'61FF' AS STRING) AS name")
    assert [bytes(r[0]) for r in resolve_names(broken, broken).select(F.col("actual").cast("binary")).collect()] == [b"a\xff"]
