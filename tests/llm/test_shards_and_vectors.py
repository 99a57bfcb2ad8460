"""Sharding, vector codes and clusters against plain versions."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladderline.llm import bisectors, codebooks, shards, vectors
from ladderline.session import stage

SCHEMA = "doc_id long, text string, source string, lang string, n long, key string, row string, bucket int, shard int, slot string"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    out = [(i, f"text {rnd.random()}" * rnd.randint(0, 9), "hot" if i % 3 else rnd.choice(["a", "b", None, "", "é"])) for i in range(400)]
    out += [(1000 + i, "lone", f"single{i}") for i in range(40)]
    out += [(7, "same", "hot")] * 90 + [(None, "same", "a")] * 50 + [(None, None, None)] * 5 + [(2000, "日本 😀", "b"), (2001, "x" * 300_000, "b")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, "k", "r", 2, 3, "s") for r in rows], SCHEMA).repartition(5)


def hashed(*parts):
    return hashlib.sha256(":".join(parts).encode()).hexdigest()[:32]


def plain_shards(rows, count, seed):
    facts = []
    for i, text, source in rows:
        data = (text or "").encode()
        facts.append((source is not None, source or "", hashed(str(seed), "" if i is None else str(i), str(zlib.crc32(data)), str(len(data) + 1)), i, len(data) + 1, zlib.crc32(data)))
    groups = collections.defaultdict(list)
    for f in sorted(facts, key=lambda f: f[:3]):
        groups[f[:2]].append(f)
    order = []
    for (known, source), held in groups.items():
        phase = int(hashed(str(seed), str(known).lower(), source)[:15], 16) / float(1 << 60)
        order += [((rank + phase) / len(held), known, source.encode(), rank, f) for rank, f in enumerate(held)]
    order.sort(key=lambda o: o[:4])
    out, slots = [], collections.Counter()
    for place, (*_, f) in enumerate(order):
        shard = place * count // len(order)
        out.append((f[3], f[1] if f[0] else None, f[4], f[5], shard, slots[shard]))
        slots[shard] += 1
    return out


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("count", [8, 3, 1, 5000])
def test_shards(docs, rows, count):
    found = [(r.id, r.source, r.size, r.crc, r.shard, r.slot) for r in shards.placed(docs, count).collect()]
    assert sorted(found, key=key) == sorted(plain_shards(rows, count, shards.SEED), key=key)


def test_shards_match_the_mixture(docs, rows):
    found = shards.placed(docs).groupBy("shard", "source").count().collect()
    sizes = collections.Counter(s for _, _, s in rows)
    got = {(r.shard, r.source): r["count"] for r in found}
    per_shard = collections.Counter()
    for (shard, _), n in got.items():
        per_shard[shard] += n
    assert len(per_shard) == 8 and max(per_shard.values()) - min(per_shard.values()) <= 1
    for source, n in sizes.items():
        if n > 40:
            for shard in range(8):
                assert abs(got.get((shard, source), 0) - n / 8) < 4
    lone = collections.Counter(shard for (shard, source), n in got.items() if (source or "").startswith("single"))
    assert len(lone) >= 5  # sources of one row don't share a shard


def test_sharded_rows(spark, docs, rows, tmp_path):
    placed = stage(shards.sharded(docs, 4), "test-sharded")
    assert sorted((tuple(r.row) for r in placed.collect()), key=key) == sorted(map(tuple, docs.collect()), key=key)
    small = shards.placed(docs, 4).groupBy("id", "size", "shard").count()
    big = placed.groupBy(F.col("row.doc_id").alias("id"), (F.octet_length(F.coalesce("row.text", F.lit(""))) + 1).cast("bigint").alias("size"), "shard").count()
    assert small.exceptAll(big).isEmpty() and big.exceptAll(small).isEmpty()
    path = str(tmp_path / "out")
    shards.written(placed, path, 6)
    back = spark.read.parquet(path)
    assert back.groupBy("shard").agg(F.min("slot"), F.max("slot") + 1, F.count("*")).where("`min(slot)` != 0 or `(max(slot) + 1)` != `count(1)`").isEmpty()
    assert back.count() == len(rows)


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert shards.placed(none).isEmpty() and shards.sharded(none).isEmpty()
    vecs = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    found, books = codebooks.compressed(vecs, label_col="label")
    assert found.isEmpty() and codebooks.codebooks_sha256(books) == hashlib.sha256(b"").hexdigest()
    placed, centroids = bisectors.clustered(vecs)
    assert not centroids and bisectors.with_inertia(placed, centroids).isEmpty()


@pytest.fixture(scope="module")
def points():
    """Few different values, so that distances tie and entries stop moving; nulls, non-finite values, repeats, no ids."""
    rnd = random.Random(4)
    centres = [[rnd.choice([-0.5, 0.0, 0.5]) for _ in range(8)] for _ in range(6)]
    out = [(i, [c + rnd.choice([-0.25, 0.0, 0.25]) for c in rnd.choice(centres)], rnd.choice([1, 2, None])) for i in range(300)]
    out += [(5, [0.1] * 8, 1), (None, [0.3] * 8, 2), (None, [0.2] * 8, None)] + [(400, [0.5] * 8, 2)] * 100
    out += [(500, None, 1), (501, [1.0, None] * 4, 1), (502, [math.nan] + [0.0] * 7, 1), (503, [math.inf] + [0.0] * 7, 2)]
    return out


def table(spark, points):
    data = [(i, v, k, "c", 1, 2, [3]) for i, v, k in points]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, label int, code string, id int, n long, v array<int>").repartition(4)


def usable(points, scale):
    good = [(i, v, k) for i, v, k in points if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v, _ in good), default=0)
    return [(i, [math.floor(scale * c) for c in v] + [0] * (width - len(v)), k) for i, v, k in good]


def seeds(kept, place, n):
    least = {}
    for i, v, _ in kept:
        least[i] = min(v, least.get(i, v))
    return [least[i] for i in sorted(least, key=place)[:n]]


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def plain_lloyd(xs, entries, rounds):
    book = [list(e) for e in entries]
    near = lambda x: min(range(len(book)), key=lambda e: (gap(x, book[e]), e))
    for _ in range(rounds):
        held = collections.defaultdict(list)
        for x in xs:
            held[near(x)].append(x)
        for e, mine in held.items():
            book[e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    return book, [near(x) for x in xs]


@pytest.mark.parametrize(("parts", "entries", "rounds", "scale"), [(4, 256, 4, 1024), (2, 9, 4, 4), (2, 9, 0, 4), (3, 5, 6, 7)])
def test_codes(spark, points, parts, entries, rounds, scale):
    kept = usable(points, scale)
    each = -(-len(kept[0][1]) // parts)
    padded = [(i, v + [0] * (parts * each - len(v)), k) for i, v, k in kept]
    start = seeds(padded, lambda i: (i is None, i or 0), entries)
    cut = lambda v, p: v[p * each : (p + 1) * each]
    fits = [plain_lloyd([cut(v, p) for _, v, _ in padded], [cut(v, p) for v in start], rounds) for p in range(parts)]
    expected, totals = [], collections.Counter()
    for at, (i, v, k) in enumerate(padded):
        code = "".join(f"{codes[at]:02x}" for _, codes in fits)
        error = sum(gap(cut(v, p), fits[p][0][fits[p][1][at]]) for p in range(parts))
        totals[k] += error
        expected.append((i, k, code, error))
    found, books = codebooks.compressed(table(spark, points), label_col="label", parts=parts, entries=entries, rounds=rounds, scale=scale)
    assert books == [book for book, _ in fits]
    got = [(r.id, None if r.label is None else int(r.label), r.code, r.error, r.label_error) for r in found.collect()]
    assert sorted(got, key=key) == sorted(((*e, totals[e[1]]) for e in expected), key=key)


def test_codes_restore_vectors(spark, points):
    """The codes say how far the vectors they stand for are from the originals."""
    held, books = codebooks.trained(table(spark, points), parts=4, entries=16, rounds=3, scale=8)
    for r in codebooks.restored(held, books, 8).join(held.select("id", "v", "distances").distinct(), ["id", "v"]).collect():
        assert gap(r.v, [8 * c for c in r.approx]) == sum(r.distances)


def test_active_entries_equal_a_full_scan():
    rng = np.random.default_rng(1)
    for top in (3, 40, 1 << 24, 1 << 25):
        x = rng.integers(-top, top, (500, 6))
        old = rng.integers(-top, top, (20, 6))
        code, distance = codebooks.nearest(x, old)
        for moves in (0, 1, 7, 20):
            new, moved = old.copy(), np.zeros(20, dtype=bool)
            moved[rng.permutation(20)[:moves]] = True
            new[moved] = rng.integers(-top, top, (moves, 6))
            got = codebooks.active_nearest(x, new, code, distance, moved)
            want = codebooks.nearest(x, new)
            assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_active_entries_spare_comparisons(monkeypatch):
    looked = []
    scan = vectors.squared_distances
    monkeypatch.setattr(codebooks, "squared_distances", lambda x, e: looked.append(len(x) * len(e)) or scan(x, e))
    x, entries = np.arange(100)[:, None], np.array([[10], [50], [90]])
    code, distance = codebooks.nearest(x, entries)
    codebooks.active_nearest(x, entries, code, distance, np.array([False, False, True]))
    at_third = int((code == 2).sum())
    assert looked == [300, 3 * at_third, 100 - at_third]


def test_wide_components_stay_exact():
    top = (1 << 31) - 1
    x, entries = np.array([[top, -top], [0, 1]]), np.array([[-top, top], [top, -top + 1]])
    gaps = [[gap(p, e) for e in entries.tolist()] for p in x.tolist()]
    code, distance = codebooks.nearest(x, entries)
    assert code.tolist() == [1, 0] and distance.tolist() == [min(g) for g in gaps]
    contest = bisectors.Tournament(entries)
    assert contest.winners(x).tolist() == [1, 0] and contest.distances(x, code).tolist() == distance.tolist()


def test_number_beyond_64_bits_is_an_error(spark):
    huge = spark.createDataFrame([(1, [1e300] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        codebooks.trained(huge)


@pytest.mark.parametrize(("k", "rounds", "scale"), [(16, 3, 64), (5, 4, 2), (1, 2, 64), (1000, 1, 64)])
def test_clusters(spark, points, k, rounds, scale):
    others = [(900, [0.5] * 7, 1), (901, [0.5] * 9, 1), (902, [], 1)]
    kept = usable(points, scale)
    name = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    book, codes = plain_lloyd([v for _, v, _ in kept], seeds(kept, name, k), rounds)
    distances = [gap(v, book[c]) for (_, v, _), c in zip(kept, codes, strict=True)]
    by = collections.Counter()
    for c, d in zip(codes, distances, strict=True):
        by[c] += d
    sha = [hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() for e in book]
    expected = [(i, c, d, by[c], sum(distances), sha[c]) for (i, _, _), c, d in zip(kept, codes, distances, strict=True)]
    placed, centroids = bisectors.clustered(table(spark, points + others), k=k, rounds=rounds, scale=scale, width=8)
    got = [(r.id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in bisectors.with_inertia(placed, centroids).collect()]
    assert centroids == book and sorted(got, key=key) == sorted(expected, key=key)


def test_tournament_ties():
    """Equal centroids and points on bisectors go to the smaller number."""
    rng = np.random.default_rng(3)
    centroids = rng.integers(-2, 3, (12, 3))
    centroids[7] = centroids[2]
    x = np.array(np.meshgrid(*[range(-4, 5)] * 3)).reshape(3, -1).T
    gaps = vectors.squared_distances(x, centroids)
    assert (np.sort(gaps, axis=1)[:, 0] == np.sort(gaps, axis=1)[:, 1]).sum() > 50
    contest = bisectors.Tournament(centroids)
    assert (contest.winners(x) == gaps.argmin(axis=1)).all()
    assert (contest.distances(x, contest.winners(x)) == gaps.min(axis=1)).all()
