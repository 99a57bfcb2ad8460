"""Joins of rows with facts by a key that a large share of the rows may have."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 1000


def joined(rows: DataFrame, facts: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` with the columns of ``facts`` but ``weight``, null where the key has none; ``facts`` has a row per key, and
    in ``weight`` the number of rows with it.

    Keys of more than one in ``SHARE`` rows are at most so many; their facts are sent to all tasks, so those rows stay where
    they are. The other rows are dealt by key. Rows and facts are read twice, so both are cheap to read or tables."""
    total = facts.agg(F.sum(weight)).first()[0] or 0
    often = F.col(weight) * SHARE > F.lit(total)
    hot = facts.where(often).drop(weight).withColumn("hot_", F.lit(True))
    marked = rows.join(F.broadcast(hot), key, "left")
    rare = marked.where("hot_ IS NULL").select(*rows.columns).join(facts.where(~often).drop(weight), key, "left")
    return marked.where("hot_").drop("hot_").unionByName(rare)
