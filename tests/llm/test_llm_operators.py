"""Each operator against a plain version, on small tables with nulls, blanks, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ladderline.llm import bpe, langid, mixing, nbsvm, neardup, ppm, queries, rules, substrings, topk, urltrust

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, node int, label string, size string, words int, kept string"


def words(text):
    return WORD.findall(text or "")


def texts(seed=3):
    """Invented documents: near copies, shared passages, junk, blanks, repeated rows, a long text."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices("abcdeghilmnorstu", k=rnd.randint(2, 7))) for _ in range(400)]
    some = lambda n: rnd.choices(pool, k=n)
    out = [None, "", " \n\t ", "one", "One two", "a b c", "a b c", "x" * 3000, "é ñ\x85ü z 日本 😀"]
    passage = some(60)
    for _ in range(12):
        base = some(rnd.randint(60, 120))
        out.append(" ".join(base).capitalize())
        for _ in range(rnd.randint(0, 4)):
            copy = list(base)
            for _ in range(rnd.randint(1, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(pool)
            out.append(" ".join(copy))
    out += [" ".join(some(30) + passage + some(20)) for _ in range(4)]
    out += ["\n".join([" ".join(some(6))] * 9), " ".join(w + "###" for w in some(40)), " ".join(some(9000))]
    return out


@pytest.fixture(scope="module")
def rows():
    found = [(i, t) for i, t in enumerate(texts())]
    return [*found, found[20], (None, found[25][1]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    langs, sources = ["en", "de", None], ["b", "a", None, "é"]
    data = [(i, t, langs[k % 3], sources[k % 4], len(t or ""), 1, "r", 2, "l", "s", 3, "k") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    groups = collections.defaultdict(list)
    for x in range(len(rows)):
        groups[root(x)].append(rows[x][0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return [(rows[x][0], len(sets[x]), least(groups[root(x)])) for x in range(len(rows))], len(groups)


@pytest.mark.parametrize("crowd", [5, 1])
def test_near_duplicates(docs, empty, rows, crowd, monkeypatch):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    expected, groups = plain_components(rows)
    found = neardup.near_duplicates(docs).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in found), key=key) == sorted(expected, key=key)
    assert sum(r.kept for r in found) == groups
    stays = neardup.deduplicated(docs)
    assert stays.columns == docs.columns and stays.count() == groups
    assert neardup.near_duplicates(empty).count() == 0


def test_crowded_regions(spark):
    """Hundreds of near copies with few links between them: every component is found."""
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(rnd.randint(0, 9)):
            copy[rnd.randrange(120)] = f"x{rnd.random()}"
        rows.append((i, " ".join(copy)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in found) == sorted(plain_components(rows)[0])


def test_sole_links_in_crowded_regions(spark):
    """A template family whose members have 0.72 in common, and copies of some that only their original links, at 0.85:
    those that share all minima with it in none of 20 trees of depth 8."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(300)]

    def changed(source, n):
        out = list(source)
        for at in rnd.sample(range(4, 296), n):
            out[at] = f"x{rnd.random()}"
        return out

    def prefixes(variants):
        sets = neardup.shingle_sets(pa.array([" ".join(v) for v in variants]), 3)
        return np.stack([neardup._signature(s)[:160].reshape(20, 8) for s in sets])

    family = [changed(base, 8) for _ in range(250)]
    rows = [(i, " ".join(v)) for i, v in enumerate(family)]
    for i in range(10):
        own, copy = prefixes([family[i]])[0], None
        while copy is None:
            tried = [changed(family[i], 8) for _ in range(200)]
            apart = np.flatnonzero(~(prefixes(tried) == own).all(axis=2).any(axis=1))
            copy = next((tried[k] for k in apart if 0.85 <= _similarity(tried[k], family[i]) <= 0.87), None)
        rows.append((1000 + i, " ".join(copy)))
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.component_id for r in found} == {i: i % 1000 for i, _ in rows}
    assert sorted((r.id, r.n_shingles, r.component_id) for r in found) == sorted(plain_components(rows)[0])


def _similarity(one, two):
    one, two = shingles(" ".join(one)), shingles(" ".join(two))
    return len(one & two) / len(one | two)


def test_forest_misses():
    for percent in (80, 85, 90):
        trees, depth = neardup.forest_of(percent)
        assert (1 - (percent / 100) ** depth) ** trees <= 8e-6 and trees * depth <= neardup.VALUES


def plain_ppm(rows, order):
    stream = lambda t: b"\xff" * order + " ".join(words((t or "").translate(LOWER))).encode() + b"\xff"
    trained = [(i, t) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 10]
    context, tokens = collections.defaultdict(collections.Counter), collections.Counter()
    for _, t in trained:
        s = stream(t)
        tokens.update([*words((t or "").translate(LOWER)), None])
        for p in range(order, len(s)):
            for k in range(order + 1):
                context[s[p - k : p]][s[p]] += 1
    total, unit = sum(tokens.values()), sum(tokens.values()) + 0.1 * (len(tokens) + 1)

    def score(s):
        out = 0.0
        for p in range(order, len(s)):
            seen = set()
            for k in range(order, -1, -1):
                left = {b: n for b, n in context.get(s[p - k : p], {}).items() if b not in seen}
                if left:
                    whole = sum(left.values()) + len(left)
                    out += math.log10(left.get(s[p], len(left)) / whole)
                    if s[p] in left:
                        break
                    seen |= set(left)
            else:
                out -= math.log10(256 - len(seen))
        return out

    for i, t in rows:
        mine = [*words((t or "").translate(LOWER)), None]
        held = zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
        yield i, held, len(mine), sum(tokens[w] > 0 for w in mine), total, sum(math.log10((tokens[w] + 0.1) / unit) for w in mine), score(stream(t))


@pytest.mark.parametrize("shard, head", [(1 << 22, 1 << 20), (500, 100)])
def test_ppm(docs, empty, rows, shard, head):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    found = sorted((tuple(r) for r in ppm.scored(docs, shard=shard, head=head, order=3).collect()), key=key)
    expected = sorted(plain_ppm(rows, 3), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in found], [r[5:] for r in expected], rtol=1e-9)
    assert ppm.scored(empty).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 37)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(2)
    vectors = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)], 1) for i in range(240)]
    vectors += [(300, None, 1), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1), (None, [1.0] * 6, 1), (304, vectors[7][1], 1), (305, vectors[7][1], 1), (20, vectors[20][1], 1)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, score int").repartition(4)
    quant = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, v, _ in vectors if i is not None and i not in (300, 301, 302, 303)}
    expected = []
    for q in (i for i in quant if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(quant[q], v, strict=True)), i) for i, v in quant.items() if i != q)
        # the row of id 20 is there twice, and so is as a candidate
        best = sorted([*best, *[x for x in best if x[1] == 20]])[:10]
        expected += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in topk.top_k(table, every=20).collect()) == sorted(expected)
    assert topk.top_k(table.where("false")).count() == 0
    assert topk.top_k(table.where("vec_id = 0"), every=20).count() == 0


def test_urls(spark):
    link = lambda u: f'<p><a class="x" href="{u}">t</a>'
    pages = [
        (1, "http://good.com/x", link("http://near.org/") + link("/own"), "h"), (2, "http://BAD.net/es/1", None, "h"), (3, "http://near.org/a?b#c", "", "h"),
        (4, "https://linker.org/z", link("//bad.net/fr/") + link("http://bad.net/es/9"), "h"), (5, None, "x", "h"), (6, "no scheme", None, "h"),
        (7, "http://www.example.com/en/1", None, "h"), (8, "http://m.example.com/en/1", None, "h"), (9, "http://com", None, "h"), (9, "http://com", None, "h"),
        (10, "http://far.org", None, "h"), (11, "http://netnet/es/", None, "h"),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string, host string")
    found = sorted((tuple(r) for r in urltrust.judged_urls(table).collect()), key=lambda r: r[0])
    assert found == [
        (1, "good.com", "/x", "com/", "allow"), (2, "bad.net", "/es/1", "net/es/", "block"), (3, "near.org", "/a", None, "allow"), (4, "linker.org", "/z", None, "block"),
        (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "www.example.com", "/en/1", "www.example.com/en/", "allow"), (8, "m.example.com", "/en/1", "example.com/en/", "block"),
        (9, "com", "", None, "allow"), (9, "com", "", None, "allow"), (10, "far.org", "", None, "allow"), (11, "netnet", "/es/", None, "allow"),
    ]
    assert urltrust.judged_urls(table.where("false")).count() == 0


def test_propagation(spark):
    """Against the same walk by dense matrices."""
    rng = np.random.default_rng(4)
    share = rng.random((6, 6)) * (rng.random((6, 6)) < 0.5)
    share[3] = 0
    share = np.divide(share, share.sum(axis=1, keepdims=True), out=np.zeros_like(share), where=share.sum(axis=1, keepdims=True) > 0)
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", float(share[i, j])) for i in range(6) for j in range(6) if share[i, j]], "src string, dst string, share double")
    seeds = np.array([3.0, 0, 1, 0, 0, 0])
    mass = seeds.copy()
    for _ in range(200):
        moved = 0.85 * mass @ share
        mass = moved + seeds * (seeds.sum() - moved.sum()) / seeds.sum()
    found = urltrust.propagated(edges, spark.createDataFrame([(f"h{i}", int(s)) for i, s in enumerate(seeds)], "host string, seed long"))
    got = {r.host: r.mass for r in found.collect()}
    assert np.allclose([got.get(f"h{i}", 0) for i in range(6)], mass, atol=1e-4)


def test_mixing(docs, empty, rows):
    found = mixing.mixed(docs).collect()
    assert len(found) == len(rows) and sorted(r.size for r in found) == sorted(len(words(t)) for _, t in rows)
    size, taken, target = collections.Counter(), collections.Counter(), {}
    for r in found:
        size[r.source] += r.size
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
        assert 0 <= r.copies <= 2
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    aim, free = {}, set(names)
    while free:
        left, whole = 1.5 * sum(size.values()) - sum(aim.values()), sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / whole > 2 * size[s]]
        aim |= {s: 2 * size[s] for s in full} if full else {s: left * weight[s] / whole for s in free}
        free -= set(full or free)
    largest = max(r.size for r in found)
    for s in names:
        assert target[s] == pytest.approx(aim[s]) and abs(taken[s] - aim[s]) <= largest / 2
    again = mixing.mixed(docs).collect()
    pick = lambda out: sorted((r.id is None, r.id or 0, r.size, r.copies) for r in out)
    assert pick(found) == pick(again)
    assert mixing.mixed(empty).count() == 0


def plain_cut(rows, size):
    split = [words(t) for _, t in rows]
    seen = collections.Counter(tuple(w[j : j + size]) for w in split for j in range(len(w) - size + 1))
    for (i, _), w in zip(rows, split, strict=True):
        gone = set()
        for j in range(len(w) - size + 1):
            if seen[tuple(w[j : j + size])] > 1:
                gone |= set(range(j, j + size))
        yield i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)


@pytest.mark.parametrize("size", [35, 10])
def test_substrings(docs, empty, rows, size):
    found = substrings.without_repeats(docs, size=size).select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    assert sorted(map(tuple, found), key=key) == sorted(plain_cut(rows, size), key=key)
    assert substrings.without_repeats(empty, size=size).count() == 0


def test_bpe(docs, empty, rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.default_vocabulary())
    found = bpe.encoded(docs).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.ids == tokenizer.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    digest = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert digest == {(r.doc_id, len(r.ids), sha(",".join(map(str, r.ids))), sha(r.decoded)) for r in found}
    assert bpe.round_trip(empty).count() == 0


def test_bpe_strings(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "LONG", 50)
    path = bpe.default_vocabulary()
    tokenizer, coder = Tokenizer.from_file(path), bpe.Bpe(path)
    rnd = random.Random(1)
    odd = ["<|endoftext|>a<|endoftext|><|endoftext|> b<|endoftext|", "ab" * 900, "don't we'll it's '", "  \n\n x\t\t y", "\x1c\x1d\x85\xa0 　", "😀" * 70]
    odd += ["".join(rnd.choices(" ab'\n1é日 <|>.", k=120)) for _ in range(40)]
    for text in odd:
        assert bpe._plain(coder, coder.encode(coder.cuts(text))) == (tokenizer.encode(text, add_special_tokens=False).ids, text)
        assert bpe._code(coder, coder.encode(coder.cuts(text)))[2] == hashlib.sha256(text.encode()).hexdigest()


def test_langid_forward():
    """Forward sums and expected counts against all segmentations."""
    count, table = langid.pieces_of(langid.default_vocabulary())
    model = np.random.default_rng(0).random((count, 2))
    model /= model.sum(axis=0)

    def split(text):
        if not text:
            yield []
        for end in range(1, len(text) + 1):
            place = table.places(np.array([langid._hash_of(text[:end])], dtype=np.uint64))[0]
            if place >= 0:
                for more in split(text[end:]):
                    yield [int(table.values[place]), *more]

    for word in (b"then", "ñu".encode(), b"a"):
        ways = [(w, np.prod(model[w], axis=0)) for w in split(b" " + word)]
        whole = sum(p for _, p in ways)
        assert np.allclose(langid.log_probabilities([word], model, table)[0], np.log(whole))
        expected = np.zeros_like(model)
        for w, p in ways:
            np.add.at(expected, (w, 1), 3 * p[1] / whole[1])
        assert np.allclose(langid.expected_pieces([word], np.array([3.0]), np.array([1]), model, table), expected)


def test_langid(spark, empty):
    data = [(i, ("the and ing that with tion " if i % 2 else "der und ung ich schein auch ") * 3, "en" if i % 2 else "de") for i in range(40)]
    data += [(100, None, "en"), (101, "", "de"), (102, "12 !! 34", "en"), (103, "q" * 4000, None), (None, "und der auch", None)]
    table = spark.createDataFrame(data, "doc_id long, text string, lang string")
    found = {r.id: r for r in langid.identified(table).collect()}
    assert all(found[i].lang_pred == ("en" if i % 2 else "de") for i in range(40)) and found[None].lang_pred == "de"
    assert [found[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in found.values())
    assert found[7].held_out == (zlib.crc32(b"7") % 3 == 1)
    assert langid.identified(empty).count() == 0
    untaught = langid.identified(table.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in untaught] == ["und"]


def test_langid_rounds(spark):
    """The model is the one of three rounds of fitting."""
    table = spark.createDataFrame([("the and ing that", "en"), ("der und ung ich", "de")], "text string, lang string")
    path = langid.default_vocabulary()
    assert np.array_equal(langid.fitted(table, path)[2], langid.fitted(table, path, rounds=3)[2])
    assert not np.allclose(langid.fitted(table, path)[2], langid.fitted(table, path, rounds=2)[2], atol=1e-9)


def test_quality_classifier(spark, empty):
    rnd = random.Random(0)
    word = lambda: "".join(rnd.choices("abcdefg", k=4))
    data = [(i, " ".join(word() + ("###" if i % 3 == 0 else "") for _ in range(30))) for i in range(150)] + [(200, None), (201, ""), (None, "a b"), (3, "again")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(150)] + [(1, 0, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    found = nbsvm.classified(docs, labels).collect()
    assert len(found) == len(data) and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == int(r.id % 3 != 0) for r in found if r.id is not None and r.id < 150 and r.id != 3)
    assert {r.held_out for r in found if r.id == 7} == {zlib.crc32(b"7") % 5 == 0}
    assert nbsvm.classified(empty.select("doc_id", "text"), labels).count() == 0
    assert {r.score for r in nbsvm.classified(docs, labels.where("false")).collect()} == {0.5}


def test_descent():
    """The dual's optimum, against small steps on the primal."""
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 4)), np.where(rng.random(60) < 0.5, 1.0, -1.0)
    x += 0.8 * y[:, None]
    w = nbsvm.descend([np.arange(4)] * 60, list(x), y, np.ones(60), epochs=400)
    found = np.append(w[:4], w[-1])
    loss = lambda v: v @ v / 2 + np.maximum(0, 1 - y * (x @ v[:4] + v[4])).sum()
    assert all(loss(found) <= loss(found + rng.normal(size=5) * s) + 1e-3 for s in (0.3, 0.1, 0.03, 0.01) for _ in range(200))


def plain_rules(rows):
    for i, t in rows:
        w, t = words(t), t or ""
        lines = [line for line in t.split("\n") if words(line)]
        seen = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        again = {k for j in range(len(w) - 7) if seen[tuple(w[j : j + 8])] > 1 for k in range(j, j + 8)}
        chars, symbols, repeats = sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines))
        base = len(w) < 20 or 100 * len(again) > 30 * len(w)
        letters = sum(any(c.isalpha() for c in x) for x in w)
        distinct = sum(len(set(w[k : k + 5000])) for k in range(0, len(w), 5000))
        bad = 10 * symbols > chars or not 2 * len(w) <= chars <= 20 * len(w) or 2 * repeats > len(lines) or 10 * letters < 6 * len(w) or 100 * distinct < 3 * len(w)
        yield i, len(w), chars, symbols, repeats, len(again), base, not (base or bad)


def test_rules(docs, empty, rows):
    found = rules.judged(docs).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by").collect()
    expected = list(plain_rules(rows))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:8] for r in found), key=key) == sorted(expected, key=key)
    assert all((r.rejected_by is None) == r.kept for r in found)
    stays = rules.kept_rows(docs)
    assert stays.columns == docs.columns and stays.count() == sum(e[-1] for e in expected)
    assert rules.judged(empty).count() == 0
    backwards = rules.cascade(rules.measures(docs), list(reversed(rules.RULES)))
    assert backwards.where("kept").count() == stays.count()


def test_every_number_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
