"""Each stage of the pipeline on empty tables, nulls, repeated rows and columns with the names that stages use."""

import pytest
from test_llm_operators import SCHEMA, plain_cut, plain_rules, texts, words
from test_pipeline import plain_near_dedup

import corpus_pipeline
from ladderline.session import stage

STAGES = dict(corpus_pipeline.STAGES)
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def rows():
    found = [(i, t, "en", ["b", None, "é"][i % 3], len(t or ""), 1, "r", 2, "l", "s", 3, "k") for i, t in enumerate(texts())]
    return [*found, found[20], found[20], (None, *found[25][1:]), (None, None, *found[0][2:]), (None, *found[30][1:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(3), "cases")


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", list(STAGES))
def test_empty_table(spark, docs, name):
    out = STAGES[name](spark, docs.where("false"), "")
    assert out.count() == 0 and out.columns == NAMES + (["n_tokens", "ids"] if name == "bpe_codes" else [])


def test_quality_rules(spark, docs, rows):
    out = STAGES["quality_rules"](spark, docs, "")
    kept = [r for r, verdict in zip(rows, plain_rules([r[:2] for r in rows]), strict=True) if verdict[-1]]
    assert out.columns == NAMES and order(map(tuple, out.collect())) == order(kept)


def test_near_dedup(spark, docs, rows):
    out = STAGES["near_dedup"](spark, docs, "")
    # a null id counts as larger than any
    numbered = [(r[0] if r[0] is not None else 10**9, *r[1:]) for r in rows]
    want = [(r[0] if r[0] != 10**9 else None, *r[1:]) for r in plain_near_dedup([tuple(x if x is not None else "" for x in r) for r in numbered])]
    blank = lambda r: tuple(x if x is not None else "" for x in r)
    assert out.columns == NAMES and order(map(blank, map(tuple, out.collect()))) == order(map(blank, want))


def test_substring_dedup(spark, docs, rows):
    out = STAGES["substring_dedup"](spark, docs, "")
    want = []
    for r, (_, _, gone, kept) in zip(rows, plain_cut([r[:2] for r in rows], 35), strict=True):
        want.append((r[0], kept, *r[2:4], len(kept), *r[5:]) if gone else r)
    assert out.columns == NAMES and order(map(tuple, out.collect())) == order(want)


def test_mix_sources(spark, docs, rows):
    out = STAGES["mix_sources"](spark, docs, "")
    found = [tuple(r) for r in out.collect()]
    size = sum(len(words(r[1])) for r in rows)
    assert out.columns == NAMES and set(found) <= set(rows)
    assert all(found.count(r) <= 2 * rows.count(r) for r in set(found))
    assert 0 < sum(len(words(r[1])) for r in found) <= 2 * size


def test_bpe_codes(spark, docs, rows):
    from tokenizers import Tokenizer

    from ladderline.llm.bpe import default_vocabulary

    tokenizer = Tokenizer.from_file(default_vocabulary())
    out = STAGES["bpe_codes"](spark, docs, "")
    assert out.columns == [*NAMES, "n_tokens", "ids"]
    found = [tuple(r) for r in out.collect()]
    assert order(r[:-2] for r in found) == order((r[0], r[1] or "", *r[2:]) for r in rows)
    assert all(r[-1] == tokenizer.encode(r[1], add_special_tokens=False).ids and r[-2] == len(r[-1]) for r in found)
