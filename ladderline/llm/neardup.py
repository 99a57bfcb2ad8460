"""Near-duplicate documents by an LSH forest over MinHash signatures.

A text's set holds its distinct word shingles. Every distinct set gets one signature of ``VALUES`` minima. Each tree
orders all signatures by its own ``depth`` minima, and candidates have a common prefix of at least ``SHALLOW`` values;
``forest_of`` gives the number of trees and their depth for a threshold. The depth adapts to the region: a region, the sets with one prefix, of at most ``CROWD`` sets gives all its
pairs; a larger one is split by the next value of the prefix, and gives only the pairs next to each other, which are
those with the longest common prefixes. Regions that are still larger at full depth are not cut short: after the first
round of links, every set of such a region outside the region's largest component is held against all sets of it with
another label, and linked if their full sets say so.
Candidates with too few equal minima are left out and the others confirmed on the full sets, so no false link is
returned. The same holds for regions that the cut of the order into parts may have divided: the first and last
region of every part is marked for this step, so the result does not hang on where the cuts are.

Two sets that share all minima of a tree are candidates or held against each other, however crowded their regions are.
So a pair at the threshold that no other set links is missed by all trees with probability at most ``MISS``: at 0.85
(1 - 0.85**6)**25 = 7.2e-6, at 0.8 (1 - 0.8**5)**30 = 6.7e-6.

Rows: a null or blank text has an empty set, is linked with nothing and is its own component. Equal texts, repeated rows
included, are always linked. The component id is the smallest id of its rows; null ids are passed over, and a component
without any other id has the id null. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladderline.llm import kernel
from ladderline.llm.bitmaps import flagged_in, maybe_in
from ladderline.llm.components import components
from ladderline.llm.hot import joined
from ladderline.session import stage

WIDTH, SHALLOW, CROWD = 8, 5, 5
"""Values in a key, of which a tree uses the first ``depth``; the least depth of a region; sets that give all pairs."""
MISS, MOST = 8e-6, 160
"""The trees miss a pair at the threshold with at most this probability; minima of all trees together, at most."""
BLOCK = 50_000
VALUES = 256
"""Minima in a signature: those of the trees and more, so that the share of equal ones tells the similarity."""
SLACK = 5.5
"""Candidates whose share of equal minima is this many standard deviations below the threshold are dropped: of pairs at
0.8 or 0.85 fewer than one in a million."""
CELL, CELL_BYTES = 512, 1 << 24
"""Sets of a crowded region that are held against each other in one task, or fewer where their texts have more bytes."""

_rng = np.random.Generator(np.random.PCG64(1))
_A = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per text its distinct shingles as sorted hashes: a text of fewer words is one shingle, one without any none."""
    words = kernel.words_of(texts, lower=True)
    hashes = words.hashes()
    starts, offsets = kernel.window_starts(words.offsets, size)
    windows = kernel.window_hashes(hashes, starts, size)
    for d, n in enumerate(words.counts.tolist()):
        if n >= size:
            yield np.unique(windows[offsets[d] : offsets[d + 1]])
        elif n:
            yield kernel.window_hashes(hashes, words.offsets[d : d + 1], n)
        else:
            yield np.empty(0, dtype=np.uint64)


def _signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(VALUES, 0xFFFFFFFF, dtype=np.uint32)
    keys = (shingles >> np.uint64(32)).astype(np.uint32)
    for first in range(0, len(keys), 256):
        np.minimum(low, (keys[first : first + 256, None] * _A + _B).min(axis=0), out=low)
    return ((low * np.uint32(0x85EBCA6B)) >> np.uint32(16)).astype(">u2")


def _sketch(size: int, text: str):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for piece in kernel.pieces(batches, text):
            rid = pa.array(np.arange(row, row + piece.num_rows))
            row += piece.num_rows
            count, node, sig = [], [], []
            for shingles in shingle_sets(piece.column(text), size):
                count.append(len(shingles))
                node.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                sig.append(_signature(shingles).tobytes() if len(shingles) else None)
            columns = [*piece.columns, rid, pa.array(count, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[*piece.schema.names, "rid", "n_shingles", "node", "sig"])

    return run


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u2").reshape(-1, VALUES)


def forest_of(percent: int) -> tuple[int, int]:
    """Trees and depth: the deepest trees that miss a pair at the threshold with at most ``MISS``, of ``MOST`` minima."""
    for depth in range(WIDTH, 0, -1):
        share = (percent / 100) ** depth
        trees = math.ceil(math.log(MISS) / math.log1p(-share)) if share < 1 else 1
        if trees * depth <= MOST:
            return trees, depth
    raise ValueError(f"no forest of {MOST} minima for {percent} percent")


def _tree_keys(sig: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Per signature and tree two numbers, which order as the tree's minima do."""
    keys = np.zeros((len(sig), trees, WIDTH), dtype=">u2")
    keys[:, :, :depth] = sig[:, : trees * depth].reshape(-1, trees, depth)
    return keys.view(">u8").astype(np.int64)


def _forest_rows(trees: int, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = _tree_keys(_signatures(batch.column("sig")), trees, depth)
            tree = pa.array(np.tile(np.arange(trees, dtype=np.int32), len(keys)))
            node = batch.column("node").take(pa.array(np.repeat(np.arange(len(keys)), trees)))
            yield pa.RecordBatch.from_arrays([tree, pa.array(keys[:, :, 0].ravel()), pa.array(keys[:, :, 1].ravel()), node], names=["tree", "hi", "lo", "node"])

    return run


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The run that each row is in, and for each row its run's length; a run is of equal keys."""
    new = np.zeros(len(keys[0]), dtype=np.int64)
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    run = np.cumsum(new)
    return run, np.bincount(run)[run]


def _blocks(batches: Iterator[pa.RecordBatch], shallow: int) -> Iterator[tuple[pa.RecordBatch, bool, bool]]:
    """Sorted rows in blocks of whole shallow regions; of one beyond ``BLOCK`` rows in blocks that share a row. With each
    block, whether a region may go on before it and after it: at the ends of the part, and where a region was cut."""
    held, cut = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
        run = _runs(*_keys(rows, shallow))[0]
        first = int(np.searchsorted(run, run[-1]))
        if first:
            yield rows.slice(0, first), cut, False
            cut = False
        held = rows.slice(first)
        if held.num_rows > BLOCK:
            yield held, cut, True
            held, cut = held.slice(held.num_rows - 1), True
    if held is not None:
        yield held, cut, True


def _keys(rows: pa.RecordBatch, depth: int) -> tuple[np.ndarray, ...]:
    hi, lo = rows.column("hi").to_numpy(), rows.column("lo").to_numpy().view(np.uint64)
    half = WIDTH // 2
    return rows.column("tree").to_numpy(), hi >> np.int64(16 * max(half - depth, 0)), lo >> np.uint64(16 * (WIDTH - depth)) if depth > half else np.zeros_like(lo)


def _neighbour_pairs(depth: int, crowd: int):
    """Candidates of each region: all pairs at the least depth where it has at most ``crowd`` rows, and before that the
    rows next to each other. A row in a larger region of full depth, or in one that may go on in another part or block, also
    gives a pair with itself, as a mark."""
    shallow = min(SHALLOW, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, before, after in _blocks(batches, shallow):
            n = rows.num_rows
            crowded = np.ones(n, dtype=bool)
            left, right = [], []
            for level in range(shallow, depth + 1):
                of, length = _runs(*_keys(rows, level))
                thin = crowded & (length <= crowd)
                crowded &= length > crowd
                for k in range(1, min(crowd, n)):
                    at = np.flatnonzero(thin[k:] & (of[k:] == of[:-k])) + k
                    left.append(at - k)
                    right.append(at)
                if level == shallow:
                    at = np.flatnonzero(crowded[1:] & (of[1:] == of[:-1])) + 1
                    left.append(at - 1)
                    right.append(at)
            marked = crowded | (before & (of == of[0])) | (after & (of == of[-1]))
            at = np.flatnonzero(marked)
            left.append(at)
            right.append(at)
            one, two = pa.array(np.concatenate(left)), pa.array(np.concatenate(right))
            node = rows.column("node")
            yield pa.RecordBatch.from_arrays([node.take(one), node.take(two), *(rows.column(c).take(two) for c in ("tree", "hi", "lo"))], names=["a", "b", "tree", "hi", "lo"])

    return run


def _least_share(percent: int) -> float:
    share = percent / 100
    return share - SLACK * math.sqrt(share * (1 - share) / VALUES)


def _alike(percent: int):
    least = _least_share(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = _signatures(batch.column("sig_a")), _signatures(batch.column("sig_b"))
                batch = batch.filter(pa.array((one == two).mean(axis=1) >= least))
            yield batch.select(["a", "b"])

    return run


def _confirmed(size: int, percent: int):
    @kernel.freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in kernel.pieces(batches, "text_a", kernel.SLICE):
            sets = zip(shingle_sets(piece.column("text_a"), size), shingle_sets(piece.column("text_b"), size), strict=True)
            linked = [_linked(one, two, percent) for one, two in sets]
            yield piece.filter(pa.array(linked, pa.bool_())).select(["a", "b"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 85) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` of every row; ``kept`` marks one row of each component, of its id.

    Two sets are linked if 100 * intersection >= ``percent`` * union.
    """
    return _grouped(_sketched(docs.select(id_col, text_col), id_col, text_col, size), size, percent).drop("rid")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 85) -> DataFrame:
    """One row of ``docs`` for each component, with all columns. Only rows that may go are shuffled with their texts."""
    sketches = _sketched(docs, id_col, text_col, size)
    gone = stage(_grouped(sketches, size, percent).where("not kept").select("rid"), "gone")
    marked = flagged_in(sketches.select("row", "text", "rid"), gone, "rid", "rid")
    stays = marked.where("flagged").join(gone, "rid", "left_anti").select("row", "text")
    whole = kernel.with_text(docs, text_col, "row", "text").alias("row")
    return marked.where("not flagged").select("row", "text").unionByName(stays).select(whole).select("row.*")


def _sketched(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """The rows, ``row`` without the ``text`` beside it, with ``rid``, a number of their own, ``n_shingles``, ``node`` (the set's name) and ``sig``, as a table."""
    rows = docs.select(kernel.others(docs, text_col).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    row_type, id_type = (rows.schema[c].dataType.simpleString() for c in ("row", "id"))
    sketches = rows.mapInArrow(_sketch(size, "text"), f"row {row_type}, id {id_type}, text string, rid bigint, n_shingles bigint, node binary, sig binary")
    return stage(sketches, "sketches")


def _grouped(sketches: DataFrame, size: int, percent: int) -> DataFrame:
    labels = _labels(sketches, size, percent)
    copies = sketches.where("node is not null").groupBy("node").agg(F.count("*").alias("rows"))
    named = stage(maybe_in(copies, labels, "node").join(labels, "node"), "labelled")
    labelled = joined(sketches.select("rid", "id", "n_shingles", "node"), named, "node", "rows").withColumn("label", F.coalesce("label", "node"))
    least = labelled.where("label is not null").groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "rid")).alias("least"), F.count("*").alias("rows"))
    out = joined(labelled, stage(least, "least"), "label", "rows")
    alone = F.col("label").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("least.id"))
    return out.select("rid", "id", "n_shingles", component.alias("component_id"), (alone | (F.col("rid") == F.col("least.rid"))).alias("kept"))


def _labels(sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """``(node, label)`` of every set that is linked with another."""
    sets = stage(sketches.where("node is not null").groupBy("node").agg(F.min("sig").alias("sig")), "sets")
    trees, depth = forest_of(percent)
    forest = sets.mapInArrow(_forest_rows(trees, depth), "tree int, hi bigint, lo bigint, node binary")
    ordered = forest.repartitionByRange("tree", "hi", "lo", "node").sortWithinPartitions("tree", "hi", "lo", "node")
    near = stage(ordered.mapInArrow(_neighbour_pairs(depth, CROWD), "a binary, b binary, tree int, hi bigint, lo bigint"), "near")
    pairs = near.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = stage(_confirm(pairs, sets, sketches, size, percent), "confirmed")
    labels = stage(components(links), "labels")
    crowded = near.where("a = b").select("tree", "hi", "lo").distinct()
    rest = stage(_rest(forest, stage(crowded, "crowded"), labels, sets, sketches, size, percent), "rest")
    return labels if rest.isEmpty() else stage(components(links.unionByName(rest)), "labels")


def _rest(forest: DataFrame, crowded: DataFrame, labels: DataFrame, sets: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` within crowded regions of full depth between labels, one end outside the region's largest component.

    The sets outside are a query set against the region: both are laid out in cells of about ``CELL`` sets a side at
    most, and only links leave a cell, one for each query and label.
    """
    key = ["tree", "hi", "lo"]
    named = lambda df: df.withColumn("region", F.xxhash64(*key))
    regions = maybe_in(named(forest), named(crowded), "region").drop("region").join(crowded, key)
    rows = regions.join(maybe_in(labels, regions.select("node"), "node"), "node", "left").select(*key, "node", F.coalesce("label", "node").alias("label"))
    rows = stage(rows, "regions")
    sizes = rows.groupBy(*key, "label").agg(F.count("*").alias("n"))
    most = sizes.groupBy(*key).agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels"))
    main = most.where("labels > 1").select(*key, F.col("most.label").alias("main"))
    open_rows = stage(rows.join(main, key), "open")
    nodes = open_rows.select("node").distinct()
    known = stage(maybe_in(sets, nodes, "node").join(_texts(sketches, nodes), "node").withColumn("bytes", F.octet_length("text")), "open-sets")
    weight = F.greatest(F.lit(1.0 / CELL), F.col("bytes") / CELL_BYTES)
    cells = open_rows.join(known.select("node", "bytes"), "node").groupBy(*key).agg(
        F.ceil(F.sum(weight)).alias("across"), F.ceil(F.sum(F.when(F.col("label") != F.col("main"), weight))).alias("down")
    )
    open_rows = open_rows.join(cells, key).join(known.drop("bytes"), "node")
    salt = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    columns = ["node", "label", "sig", "text"]
    held = open_rows.select(*key, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("down") - 1)).alias("d"), salt("across").alias("c"), *columns, F.lit(False).alias("asks"))
    asking = open_rows.where("label != main").select(*key, salt("down").alias("d"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("across") - 1)).alias("c"), *columns, F.lit(True).alias("asks"))
    found = held.unionByName(asking).groupBy(*key, "c", "d").applyInArrow(_links_in_cell(size, percent), "a binary, b binary")
    return found.distinct()


def _links_in_cell(size: int, percent: int):
    trees, depth = forest_of(percent)
    least = _least_share(percent)

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        tree = cell.column("tree")[0].as_py()
        asks = cell.column("asks").to_numpy()
        node, sig = cell.column("node").to_pylist(), _signatures(cell.column("sig"))
        code = np.unique(np.array(cell.column("label").to_pylist(), dtype=object), return_inverse=True)[1]
        prefixes = _tree_keys(sig, trees, depth)
        text, held, sets = cell.column("text"), np.flatnonzero(~asks), {}

        def shingles(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = next(shingle_sets(text.slice(i, 1).combine_chunks(), size))
            return sets[i]

        out = []
        for at in np.flatnonzero(asks):
            alike = (sig[held] == sig[at]).mean(axis=1)
            # a pair is looked at in the first of its common regions only
            first = (prefixes[held] == prefixes[at]).all(axis=2).argmax(axis=1) == tree
            near = np.flatnonzero((alike >= least) & (code[held] != code[at]) & first)
            linked = set()
            for x in held[near[np.argsort(-alike[near], kind="stable")]]:
                if code[x] not in linked and _linked(shingles(at), shingles(x), percent):
                    linked.add(code[x])
                    out.append((min(node[at], node[x]), max(node[at], node[x])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    return run


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _texts(sketches: DataFrame, nodes: DataFrame) -> DataFrame:
    """A text for each of some distinct nodes."""
    return maybe_in(sketches, nodes, "node").groupBy("node").agg(F.min("text").alias("text")).join(nodes, "node")


def _confirm(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, size: int, percent: int) -> DataFrame:
    side = lambda c, what, source: source.select(F.col("node").alias(c), F.col(what).alias(f"{what}_{c}"))
    ends = lambda df: df.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    pairs = stage(pairs, "pairs")
    near = stage(maybe_in(sets, ends(pairs), "node"), "near-sets")
    rated = pairs.join(side("a", "sig", near), "a").join(side("b", "sig", near), "b")
    likely = stage(rated.mapInArrow(_alike(percent), "a binary, b binary"), "likely")
    texts = stage(_texts(sketches, ends(likely)), "texts")
    filled = likely.join(side("a", "text", texts), "a").join(side("b", "text", texts), "b")
    return filled.mapInArrow(_confirmed(size, percent), "a binary, b binary")
