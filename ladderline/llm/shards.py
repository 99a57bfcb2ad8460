"""Sharding by proportional stratified interleaving, in DataFrame functions only.

Rows are shuffled within each source by a seeded hash and ranked. Row ``r`` of a source with ``n`` rows gets the fraction
``(r + phase) / n``; the phase, in [0, 1), is a hash of the source, so that sources of few rows don't all fall into the
same place. Sorted by fraction, every stretch holds each source in proportion, and shards are equal stretches: their
counts differ by at most one and their shares of a source by about two rows. The law that holds is ``rows``.

Both rankings are prefix sums over buckets, about as many as the square root of the number of rows: rows are counted by
bucket, the counts are summed up in order, and rows are numbered within buckets. No window sees more than the rows of a
bucket or the counts of all buckets. Equal shuffle keys (rows that repeat an id and a text) are counted by chunks of
the scan first, so a key that a third of all rows share is not gathered either.

Only ids, sources, sizes and checksums are shuffled for the placement. ``sharded`` brings the rows themselves to it, by
one join on a row number, and ``written`` stores them by shard, in order.

Defined cases: a null text has no bytes, so size 1 and the checksum of nothing, 0; a null source is a source of its own,
different from an empty one; null ids are shuffled by their texts. Rows equal in id, source, text are interchangeable, so
reruns agree. Equal texts are no groups here: copies lie in any shard, as a third of all rows may share a text. An empty
table gives no rows. Further columns are carried in the struct ``row`` and can't clash.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderline.session import stage

SEED = 11
CHUNK_BITS = 12
"""Rows of a scan task that are counted together, as a power of two, where their keys are equal."""


def _hashed(*parts: Column) -> Column:
    """128 bits, in hexadecimal, of the sha256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 32)


def _uniform(hashed: Column) -> Column:
    """A number in [0, 1) from the first 60 bits."""
    return F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint") / F.lit(float(1 << 60))


def digests(rows: DataFrame, seed: int, doc_id: Column, source: Column, text: Column, n: Column) -> DataFrame:
    """``(n, id, source, known, size, crc, key)``: ``n`` tells rows apart, ``known`` is false for a null source."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    named = rows.select(
        n.alias("n"), doc_id.cast("bigint").alias("id"), F.coalesce(source.cast("string"), F.lit("")).alias("source"), source.isNotNull().alias("known"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("crc"),
    )
    return named.withColumn("key", _hashed(F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("crc").cast("string"), F.col("size").cast("string")))


def _bucket(share: Column, total: int) -> Column:
    buckets = isqrt(max(total - 1, 0)) + 1
    return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("bigint")


def _before(counts: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``counts`` with the sum of ``held`` over the rows before, within ``group``."""
    past = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("held").over(past), F.lit(0)).cast("bigint"))


def ranked_in_source(rows: DataFrame, total: int) -> DataFrame:
    """``rows`` with ``rank``, from 0 by shuffle key within the source, and ``source_rows``."""
    of = ["known", "source", "bucket"]
    cell = [*of, "key", "chunk"]
    chunked = rows.withColumn("bucket", _bucket(_uniform(F.col("key")), total)).withColumn("chunk", F.shiftright("n", CHUNK_BITS))
    cells = _before(chunked.groupBy(*cell).agg(F.count("*").alias("held")), of, ["key", "chunk"], "in_bucket")
    counts = _before(chunked.groupBy(*of).agg(F.count("*").alias("held")), of[:2], ["bucket"], "in_source")
    counts = counts.withColumn("source_rows", F.sum("held").over(Window.partitionBy(*of[:2])))
    starts = cells.drop("held").join(counts.drop("held"), of)
    rank = F.col("in_source") + F.col("in_bucket") + F.row_number().over(Window.partitionBy(*cell).orderBy("n")) - 1
    return chunked.join(starts, cell).withColumn("rank", rank.cast("bigint")).select(*rows.columns, "rank", "source_rows")


def _placed(rows: DataFrame, shards: int, seed: int) -> DataFrame:
    rows = stage(rows, "shard-digests")
    total = rows.count()
    phase = _uniform(_hashed(F.lit(str(seed)), F.col("known").cast("string"), F.col("source")))
    ranked = ranked_in_source(rows, total).withColumn("fraction", (F.col("rank") + phase) / F.col("source_rows"))
    spread = stage(ranked.withColumn("bucket", _bucket(F.col("fraction"), total)).drop("key"), "shard-fractions")
    starts = _before(spread.groupBy("bucket").agg(F.count("*").alias("held")), [], ["bucket"], "start").drop("held")
    within = Window.partitionBy("bucket").orderBy("fraction", "known", "source", "rank")
    at = spread.join(starts, "bucket").withColumn("place", (F.col("start") + F.row_number().over(within) - 1).cast("bigint"))
    at = at.withColumn("shard", F.expr(f"cast(place * {shards}L div {max(total, 1)}L as int)"))
    slot = F.expr(f"place - (shard * {total}L + {shards - 1}) div {shards}L")
    return at.select("n", "id", F.when(F.col("known"), F.col("source")).alias("source"), "size", "crc", "shard", slot.alias("slot"))


def placed(docs: DataFrame, shards: int = 8, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(n, id, source, size, crc, shard, slot)`` of every row; the source is null where it was."""
    return _placed(digests(docs, seed, F.col(id_col), F.col(source_col), F.col(text_col), F.monotonically_increasing_id()), shards, seed)


def sharded(docs: DataFrame, shards: int = 8, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, with ``shard`` and ``slot``."""
    kept = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n")), "shard-rows")
    row = F.col("row")
    places = _placed(digests(kept, seed, row[id_col], row[source_col], row[text_col], F.col("n")), shards, seed)
    return kept.join(places.select("n", "shard", "slot"), "n").select("row", "shard", "slot")


def written(rows: DataFrame, path: str, files: int) -> None:
    """The rows of ``sharded`` under ``path``, a folder per shard, about ``files`` files in all, in slot order by file and in files."""
    dealt = rows.repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
