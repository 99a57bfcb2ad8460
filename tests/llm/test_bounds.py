"""What has no bound by length, distance, size or place: long words and texts, far hosts, wide numbers, cut regions."""

import resource
import subprocess
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from test_llm_operators import plain_rules, words

from ladderline.llm import kernel, langid, neardup, ppm, rules, substrings, topk, urltrust


def test_long_words_are_summed_whole():
    """Words beyond 20 bytes against a plain forward pass over the whole word, pieces of any length included."""
    count, table = langid.pieces_of(langid.default_vocabulary())
    model = np.random.default_rng(1).random((count, 2)) ** 3 + 1e-12
    model /= model.sum(axis=0)
    long = [b"internationalisation" * 3, "ñandúçedilla".encode() * 5, b"-" * 90, b"x" * 20, b"y" * 19]
    for word in long:
        text = b" " + word
        places = {}
        for a in range(len(text)):
            for b in range(a + 1, len(text) + 1):
                place = table.places(np.array([langid._hash_of(text[a:b])], dtype=np.uint64))[0]
                if place >= 0:
                    places[a, b] = int(table.values[place])
        ahead = np.full((len(text) + 1, 2), -np.inf)
        behind = np.full((len(text) + 1, 2), -np.inf)
        ahead[0] = behind[-1] = 0
        for a, b in sorted(places, key=lambda s: s[1]):
            ahead[b] = np.logaddexp(ahead[b], ahead[a] + np.log(model[places[a, b]]))
        for a, b in sorted(places, key=lambda s: -s[0]):
            behind[a] = np.logaddexp(behind[a], behind[b] + np.log(model[places[a, b]]))
        assert np.allclose(langid.log_probabilities([word], model, table)[0], ahead[-1])
        expected = np.zeros_like(model)
        for (a, b), piece in places.items():
            expected[piece, 1] += 2 * np.exp(ahead[a, 1] + np.log(model[piece, 1]) + behind[b, 1] - ahead[-1, 1])
        assert np.allclose(langid.expected_pieces([word], np.array([2.0]), np.array([1]), model, table), expected, atol=1e-9)
    assert any(b - a > 24 for a, b in places) or max(map(len, long)) > 24


def test_far_hosts_are_reached(spark, monkeypatch):
    """A chain of more than 40 hosts: mass reaches its end as soon as it is above the least."""
    monkeypatch.setattr(urltrust, "TOLERANCE", 1e-4)
    monkeypatch.setattr(urltrust, "LEAST", 1e-4)
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1.0) for i in range(60)], "src string, dst string, share double").coalesce(1)
    found = {r.host: r.mass for r in urltrust.propagated(edges, spark.createDataFrame([("h0", 1)], "host string, seed long")).collect()}
    assert "h42" in found and found["h42"] == pytest.approx(0.15 * 0.85**42, rel=1e-2) and "h50" not in found


def test_distinct_words_do_not_fall_with_length(spark):
    rng = np.random.default_rng(2)
    pool = np.array(["".join(rng.choice(list("abcdeghilmnorstu"), 6)) for _ in range(4000)])
    long = " ".join(rng.choice(pool, 150_000))
    junk = " ".join(rng.choice(pool[:31], 20_000))
    docs = spark.createDataFrame([(1, long), (2, junk), (3, "")], "doc_id long, text string")
    kept = {r["doc_id"]: r.kept for r in rules.judged(docs).select("row.doc_id", "kept").collect()}
    assert 100 * len(set(words(long))) < 3 * len(words(long)) and kept == {1: True, 2: False, 3: False}


def test_wide_components_are_not_cut(spark):
    """Components beyond 65,536, with sums beyond 62 bits, against Python's integers."""
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in np.round(rng.normal(size=4) * 700_000, 2)]) for i in range(60)]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    quant = {i: [int(np.floor(1024 * x)) for x in v] for i, v in data}
    expected = []
    for q in (0, 20, 40):
        best = sorted((-sum(a * b for a, b in zip(quant[q], v, strict=True)), i) for i, v in quant.items() if i != q)[:10]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert max(abs(e[3]) for e in expected) > 1 << 60
    assert sorted(tuple(r) for r in topk.top_k(table, every=20).collect()) == sorted(expected)


def region(n, lo=7):
    return pa.record_batch({
        "tree": pa.array(np.zeros(n, np.int32)), "hi": pa.array(np.full(n, 5)), "lo": pa.array(np.full(n, lo)),
        "node": pa.array([bytes([lo % 251, i]) for i in range(n)], pa.binary()),
    })


@pytest.mark.parametrize("cuts", [(10,), (5, 5), (1, 9), (2, 2, 6), (3, 1)])
def test_regions_do_not_hang_on_cuts(cuts):
    """Rows of one region, wherever the order is cut into parts, are all pairs or all marked for the step that holds them
    against each other."""
    whole = region(sum(cuts))
    pairs, marks, at = set(), set(), 0
    for n in cuts:
        for out in neardup._neighbour_pairs(6, 5)(iter([whole.slice(at, n)])):
            for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True):
                (marks if a == b else pairs).add((a, b))
        at += n
    every = {(a, b) for a in whole.column("node").to_pylist() for b in whole.column("node").to_pylist() if a < b}
    nodes = {a for a, _ in marks}
    assert all(p in pairs or set(p) <= nodes for p in every)


def test_blocks_say_where_they_were_cut():
    rows = pa.concat_batches([region(3, 1 << 50), region(4, 2 << 50), region(2, 3 << 50)])
    blocks = [(b.num_rows, before, after) for b, before, after in neardup._blocks(iter([rows]), 5)]
    assert sum(n for n, _, _ in blocks) == 9 and blocks[0][1] and blocks[-1][2] and not any(b for _, b, _ in blocks[1:])


def test_segments_of_a_long_text(monkeypatch):
    """Segments of any size give the grams and words of the whole text, in order."""
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("ab ñ\n\t日😀Z"), 3000)) + " " * 50 + "w" * 400
    whole = ppm.Coded(ppm.written(pa.array([text]), 5), 5)
    for size in (1, 7, 100, 10_000):
        monkeypatch.setattr(ppm, "SEGMENT", size)
        parts = [ppm.Coded(pa.array([s], pa.binary()), 5) for s in ppm._segments(pa.array([text]), 5)]
        assert np.array_equal(np.concatenate([p.grams for p in parts]), whole.grams)
        assert np.array_equal(np.concatenate([p.words for p in parts]), whole.words)
        assert sum(p.ended.sum() for p in parts) == 1 and parts[-1].ended[-1]
        assert "".join(t[0].as_py() for t in kernel.slices(pa.array([text]), size)) == text


MEMORY = """
import resource, sys
import numpy as np, pyarrow as pa
sys.path.insert(0, {root!r})
from ladderline.llm import ppm
class Context:
    partitionId = staticmethod(lambda: 0)
ppm.TaskContext.get = staticmethod(lambda: Context)
rng = np.random.default_rng(0)
pool = ["".join(rng.choice(list("abcdeghilmnorstu"), rng.integers(2, 9))) for _ in range(20000)]
text = " ".join(rng.choice(pool, 9_000_000))
assert len(text) > 50_000_000
batch = pa.record_batch({{"id": pa.array([1]), "text": pa.array([text], pa.large_string()), "train": pa.array([True])}})
del text
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows = size = 0
for out in ppm._streams(5, ppm.BLOCK)(iter([batch])):
    for found in ppm._different(5)(iter([out])):
        rows += found.num_rows
    size += out.column("data").nbytes
print(rows, size, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_memory_of_a_long_text():
    """A text of 50 MB takes no more memory than its blocks, beside the text itself."""
    code = MEMORY.format(root=str(Path(__file__).resolve().parents[2]))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, check=True)
    rows, size, grown = map(int, out.stdout.split())
    assert size > 50_000_000 and rows > 100_000 and grown < 400
    assert resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss > 0


def test_plain_rules_agree_on_long_texts(spark):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(rng.choice([f"w{k}" for k in range(n)], size))) for i, (n, size) in enumerate([(40, 4999), (149, 5000), (151, 5000), (200, 12_000)])]
    found = {r["doc_id"]: r.kept for r in rules.judged(spark.createDataFrame(rows, "doc_id long, text string")).select("row.doc_id", "kept").collect()}
    assert found == {i: verdict[-1] for (i, _), verdict in zip(rows, plain_rules(rows), strict=True)}


def test_substrings_hold_little_of_a_batch():
    """A batch of 18 MB of text is counted with less than 60 MB of arrays, and the counts are those of the whole batch."""
    rng = np.random.default_rng(3)
    pool = np.array([f"w{i}" for i in range(20_000)])
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(rng.choice(pool, 300)) for _ in range(10_000)])], names=["text"])
    tracemalloc.start()
    counted = 0
    for part in substrings._count_parts(35, 18, [])(iter([batch])):
        counted += sum(part.column("n").to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    piece = substrings._Piece(batch.column("text"), 35)
    _, places = piece.parts(18)
    assert counted == len(np.unique(places)) and peak < 60 << 20
