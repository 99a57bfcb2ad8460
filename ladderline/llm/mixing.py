"""Mixing sources to target weights by entropy balancing.

Targets: the sources, by code point and null last, weigh ``weights`` in turn and share ``share`` of all words; a target
stops at ``most`` times its source's size and the excess is shared again by weight (water filling, solved exactly).

Rates: among all document rates between 0 and ``most`` that take a source's target in words, those of the largest
entropy relative to taking every document once are exponentially tilted, r = min(most, exp(lambda * size / mean size)).
The convex dual has one lambda for each source's token constraint; each Newton round is one aggregation over all sources
at once, on counts by (source, size), with a bracket that a step outside is replaced by the middle of.

Copies: a document has floor(r) copies; one more goes to those with the smallest hash value minus fraction, as many as
bring the source nearest to its target. The cut is found on sums by (source, bucket), so a source of any size is split.

Defined cases: a null text has size 0, and documents of size 0 take 0 words at rate 1. Null is a source like any other.
Repeated rows are documents of their own. Further columns are carried in the struct ``row``. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladderline.session import stage

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
ROUNDS, TOLERANCE = 60, 1e-7
BUCKETS = 4096


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """All rows of ``docs`` as ``row`` with ``id``, ``source`` and ``size``, the number of words."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))
    return docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), words.cast("bigint").alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source, source_size, n_docs, target)`` from ``(source, size, n)``; one row per source, ranked in one order."""
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")))
    ranked = weighed.withColumn("cap", most * F.col("source_size")).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = ranked.select(
        "*",
        (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(up_to), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(up_to), F.lit(0))).alias("left_weight"),
    )
    level = F.max(F.when(F.col("left") / F.col("left_weight") <= F.col("full_at"), F.col("left") / F.col("left_weight"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return filled.select("source", "source_size", "n_docs", target.alias("target"))


def _same_source() -> Column:
    return F.col("s.source").eqNullSafe(F.col("h.source"))


def _first_tilts(sizes: DataFrame, aims: DataFrame, most: int) -> DataFrame:
    """``aims`` with ``first``, where Newton starts: the tilt that fits sizes put together in eight steps per power of two,
    a few hundred sums for each source, by halving."""
    of = aims.select(F.col("source").alias("of"), "mean")
    placed = sizes.where("size > 0").join(of, F.col("source").eqNullSafe(F.col("of"))).withColumn("x", F.col("size") / F.col("mean"))
    mass = F.col("n") * F.col("size")
    steps = placed.groupBy("of", F.floor(8 * F.log2("x")).alias("step")).agg(F.sum(mass).cast("double").alias("mass"), (F.sum(mass * F.col("x")) / F.sum(mass)).alias("x"))
    held = steps.groupBy("of").agg(F.collect_list(F.struct("x", "mass")).alias("steps"))
    middle = "(s.lo + s.hi) / 2"
    taken = f"aggregate(steps, 0D, (a, b) -> a + b.mass * least({most}D, exp(least({middle} * b.x, 700D))))"
    halved = f"if({taken} < target, struct({middle} as lo, s.hi as hi), struct(s.lo as lo, {middle} as hi))"
    first = f"aggregate(sequence(1, 50), struct(-1000D as lo, 1000D as hi), (s, i) -> {halved}, s -> {middle})"
    return aims.join(held, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("first", F.expr(f"if(steps is null, 0D, {first})")).drop("of", "steps")


def tilts(sizes: DataFrame, aims: DataFrame, most: int = MOST) -> DataFrame:
    """``aims`` with ``mean`` and ``tilt`` by safeguarded Newton steps on the dual; ``tilt`` is null where all rates are ``most``."""
    began = stage(_first_tilts(sizes, aims.withColumn("mean", F.col("source_size") / F.col("n_docs")), most), "tilts")
    state = began.select(
        *aims.columns,
        "mean",
        F.when((F.col("target") < most * F.col("source_size")) & (F.col("source_size") > 0), F.coalesce("first", F.lit(0.0))).alias("tilt"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(False).alias("done"),
    )
    x = F.col("h.size") / F.col("s.mean")
    rate = F.exp(F.least(F.col("s.tilt") * x, F.lit(700.0)))
    mass = F.col("h.n") * F.col("h.size")
    for _ in range(ROUNDS):
        part = state.where("tilt is not null and not done").alias("s").join(sizes.alias("h"), _same_source())
        sums = part.groupBy(F.col("s.source").alias("of")).agg(
            F.sum(mass * F.least(rate, F.lit(float(most)))).alias("taken"), F.sum(F.when(rate < most, mass * x * rate).otherwise(0.0)).alias("slope")
        )
        seen = state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        gap = F.col("taken") - F.col("target")
        seen = seen.withColumn("low", F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")))
        step = F.when(F.col("slope") > 0, F.col("tilt") - gap / F.col("slope"))
        wide = 2 * F.abs("tilt") + 1
        middle = F.when(F.col("high").isNull(), wide).when(F.col("low").isNull(), -wide).otherwise((F.col("low") + F.col("high")) / 2)
        within = (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high"))) & (F.abs(step - F.col("tilt")) <= wide)
        moved = F.when(within, step).otherwise(middle)
        near = F.coalesce((F.abs(gap) <= TOLERANCE * F.col("target")) | F.coalesce(F.col("high") - F.col("low") < 1e-12, F.lit(False)), F.col("done") | F.col("tilt").isNull())
        state = stage(seen.select(*[c for c in aims.columns], "mean", F.when(near | F.col("taken").isNull(), F.col("tilt")).otherwise(moved).alias("tilt"), "low", "high", near.alias("done")), "tilts")
        if state.where("not done").isEmpty():
            break
    # sums of doubles differ in their last bits from run to run, so those are rounded off
    return state.drop("low", "high", "done").withColumn("tilt", F.round("tilt", 8))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", most: int = MOST) -> DataFrame:
    """Every row of ``docs`` as ``row`` with ``id``, ``source``, ``size``, ``source_size``, ``target`` and ``copies``."""
    rows = sized(docs, id_col, text_col, source_col)
    counts = stage(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    fitted = tilts(counts, targets(counts, most=most), most)
    rated = _rated(rows, fitted, most)
    # the cut needs ids and sizes only; the rows, with their texts, are read once more for the result
    cuts = stage(_cuts(_rated(rows.drop("row"), fitted, most)), "cuts")
    return _copied(rated, cuts)


def _rated(rows: DataFrame, fitted: DataFrame, most: int) -> DataFrame:
    tilted = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0))))
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("tilt").isNull(), float(most)).otherwise(tilted)
    facts = fitted.withColumnRenamed("source", "of")
    joined = rows.join(facts, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate).drop("of", "mean", "n_docs")
    uniform = (F.shiftrightunsigned(F.xxhash64("id", "size"), 11) / F.lit(float(1 << 53))).cast("double")
    keyed = joined.withColumn("whole", F.floor("rate")).withColumn("key", uniform - (F.col("rate") - F.col("whole")))
    return keyed.withColumn("bucket", F.floor((F.col("key") + 1) * (BUCKETS / 2)))


def _cuts(rated: DataFrame) -> DataFrame:
    """``(of, at, reach)`` for each source: documents before bucket ``at`` get one copy more, and within it those whose
    running size stays within ``reach`` words; found on at most ``BUCKETS`` sums per source."""
    more = rated.where("whole < rate")
    sums = more.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    whole = rated.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("size")).alias("sure"))
    need = whole.select(F.col("source").alias("of"), (F.col("target") - F.col("sure")).alias("need"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    placed = sums.withColumn("before", running - F.col("words")).join(need, F.col("source").eqNullSafe(F.col("of"))).where("before < need")
    last = placed.groupBy("of").agg(F.max(F.struct("bucket", "before", "need")).alias("c"))
    return last.select("of", F.col("c.bucket").alias("at"), (F.col("c.need") - F.col("c.before")).alias("reach"))


def _copied(rated: DataFrame, cuts: DataFrame) -> DataFrame:
    columns = [c for c in rated.columns if c not in ("tilt", "rate", "whole", "key", "bucket")]
    placed = rated.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    at_cut = (F.col("whole") < F.col("rate")) & F.coalesce(F.col("bucket") == F.col("at"), F.lit(False))
    order = Window.partitionBy("source").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    extra = (F.sum("size").over(order) - F.col("size") / 2 <= F.col("reach")).cast("bigint")
    near = placed.where(at_cut).select(*columns, (F.col("whole") + extra).alias("copies"))
    before = F.coalesce((F.col("whole") < F.col("rate")) & (F.col("bucket") < F.col("at")), F.lit(False)).cast("bigint")
    return placed.where(~at_cut).select(*columns, (F.col("whole") + before).alias("copies")).unionByName(near)
