"""A training corpus from ``documents``: rules, near-dedup, substring dedup, mixing, and BPE, stage after stage.

Each stage works on all that the one before it returned, read back from Parquet. The columns stay those of
``documents`` until the last stage, which adds the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladderline.llm import bpe, mixing, neardup, rules, substrings
from ladderline.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go. Those with a null or blank text are among them."""
    return rules.kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id; of repeated rows, one.

    Near copies have a similarity of 0.8 or more over the sets of their shingles of five words. A null id counts as larger
    than any; documents without a word are linked with nothing and stay."""
    return neardup.deduplicated(docs, size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that occur elsewhere go. A text that loses some is its kept words joined by spaces, its
    ``n_chars`` counted anew; others stay as they are. A document that loses all words stays, with an empty text."""
    cut = substrings.without_repeats(docs, unchanged=True)
    length = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("bigint"))
    new = {"text": F.col("kept_text"), "n_chars": F.coalesce(length, F.col("row")["n_chars"])}
    return cut.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, from none to twice; one without words adds nothing to the mix."""
    taken = mixing.mixed(docs).select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return taken.select("row.*")


def bpe_codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the text decoded from their token ids, ``n_tokens`` and ``ids``; a null text becomes empty.

    Columns of these two names give way."""
    coded = bpe.recoded(docs)
    columns = [F.col("decoded").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns if c not in ("n_tokens", "ids")]
    return coded.select(*columns, F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe_codes", bpe_codes),
]

ORACLE_SQL = None
"""SQL can express neither the tilted rates nor the token ids; tests hold each stage against a plain version."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
