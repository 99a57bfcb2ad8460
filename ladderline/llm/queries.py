"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.neardup import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query(
    """
    WITH vectors AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
        FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """
)
def op3_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


@query()
def op4_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.urltrust import judged_urls

    return judged_urls(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query()
def op5_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.mixing import mixed

    rows = mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query()
def op8_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    """
    WITH words AS (
        SELECT rowid_, doc_id, text, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
        FROM (SELECT row_number() OVER () AS rowid_, doc_id, coalesce(text, '') AS text FROM documents)
    ), windows AS (
        SELECT rowid_, i, array_to_string(words[i:i + 7], ' ') AS win
        FROM (SELECT rowid_, words, unnest(range(1, len(words) - 6)) AS i FROM words WHERE len(words) >= 8)
    ), repeated AS (
        SELECT rowid_, i, count(*) OVER (PARTITION BY rowid_, win) AS n FROM windows
    ), starts AS (
        SELECT rowid_, i, lead(i) OVER (PARTITION BY rowid_ ORDER BY i) AS behind FROM repeated WHERE n > 1
    ), covered AS (
        SELECT rowid_, sum(least(8, coalesce(behind - i, 8)))::BIGINT AS n FROM starts GROUP BY rowid_
    ), lines AS (
        SELECT rowid_, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM words
    ), counts AS (
        SELECT doc_id, words, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
        FROM words JOIN lines USING (rowid_) LEFT JOIN covered USING (rowid_)
    ), judged AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT (base_failed OR 10 * n_symbols > word_chars OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > n_lines OR 10 * len(list_filter(words, lambda w: regexp_matches(w, '\\p{L}'))) < 6 * n_words
            OR 100 * list_sum(list_transform(range(0, len(words), 5000), lambda i: len(list_distinct(words[i + 1:i + 5000])))) < 3 * n_words) AS kept
    FROM judged
    """
)
def op10_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.rules import judged

    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged(table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", *columns)


@query()
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.substrings import without_repeats

    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


@query()
def op2_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.ppm import scored

    return scored(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op7_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.nbsvm import classified

    found = classified(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


@query()
def op9_marginal_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.langid import identified

    return identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).withColumnRenamed("id", "doc_id")


@query(
    """
    WITH crc_table AS (
        SELECT list(v ORDER BY b) AS t FROM (
            SELECT b, list_reduce([b, 0, 1, 2, 3, 4, 5, 6, 7], lambda a, i: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v
            FROM (SELECT unnest(range(256))::BIGINT AS b))
    ), rows_ AS (
        SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS source, source IS NOT NULL AS known
        FROM documents
    ), digests AS (
        SELECT n, doc_id, source, known, strlen(text) + 1 AS size, xor(list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::BIGINT)),
            lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) AS crc
        FROM rows_, crc_table
    ), ranked AS (
        SELECT *, count(*) OVER (PARTITION BY known, source) AS source_rows, row_number() OVER (
            PARTITION BY known, source ORDER BY substr(sha256('11:' || coalesce(doc_id::VARCHAR, '') || ':' || crc || ':' || size), 1, 32), n) - 1 AS rank,
            ('0x' || substr(sha256('11:' || CASE WHEN known THEN 'true' ELSE 'false' END || ':' || source), 1, 15))::BIGINT / 1152921504606846976::DOUBLE AS phase
        FROM digests
    ), placed AS (
        SELECT *, row_number() OVER (ORDER BY (rank + phase) / source_rows, known, source, rank) - 1 AS place, count(*) OVER () AS total FROM ranked
    )
    SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (place * 8 // total)::INTEGER AS shard,
        (place - ((place * 8 // total) * total + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM placed
    """
)
def op11_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.shards import placed

    at = placed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), shards=8, seed=11)
    return at.select(F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _usable(scale: int, more: str = "TRUE") -> str:
    """SQL of the embeddings that take part, as whole numbers."""
    return f"""
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND {more}"""


def _floor_mean(total: str, n: str) -> str:
    return f"(({total} - (({total} % {n}) + {n}) % {n}) // {n})"


def _codebook_sql(rounds: int) -> str:
    gap = "list_sum(list_transform(list_zip(p.part, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"usable AS MATERIALIZED ({_usable(1024)})",
        "parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // 4) + 1:(p + 1) * (len(v) // 4)] AS part FROM usable, range(4) r(p))",
        "book0 AS MATERIALIZED (SELECT p, e, part AS entry FROM parts JOIN"
        " (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM usable ORDER BY vec_id LIMIT 256) USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"near{r} AS MATERIALIZED (SELECT vec_id, p, arg_min(label, vec_id) AS label, min(struct_pack(gap := gap, e := e)) AS best, any_value(part) AS part"
            f" FROM (SELECT p.*, b.e, {gap} AS gap FROM parts p JOIN book{r} b USING (p)) GROUP BY vec_id, p)"
        )
        if r < rounds:
            mean = _floor_mean("s", "n")
            steps.append(
                f"book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.entry, b.entry) AS entry FROM book{r} b LEFT JOIN ("
                f"SELECT p, e, list({mean} ORDER BY i) AS entry FROM (SELECT p, e, i, sum(c)::BIGINT AS s, count(*) AS n FROM ("
                f"SELECT p, best.e AS e, unnest(part) AS c, generate_subscripts(part, 1) AS i FROM near{r}) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e))"
            )
    return (
        f"WITH {', '.join(steps)}, coded AS (SELECT vec_id, any_value(label) AS label, string_agg(lpad(lower(hex(best.e)), 2, '0'), '' ORDER BY p) AS code,"
        f" sum(best.gap)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)"
        " SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,"
        f" (SELECT sha256(string_agg(array_to_string(entry, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256 FROM coded"
    )


@query(_codebook_sql(4))
def op12_active_lloyd_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.codebooks import codebooks_sha256, compressed

    found, books = compressed(table(spark, sf_dir, "embeddings"), label_col="label", parts=4, entries=256, rounds=4, scale=1024)
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def _cluster_sql(rounds: int) -> str:
    gap = "list_sum(list_transform(list_zip(p.v, b.entry), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    steps = [
        f"usable AS MATERIALIZED ({_usable(64, 'len(embedding) = 64')})",
        "book0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS e, v AS entry FROM usable ORDER BY sha256('1:' || vec_id) LIMIT 16)",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"near{r} AS MATERIALIZED (SELECT vec_id, min(struct_pack(gap := gap, e := e)) AS best, any_value(v) AS v"
            f" FROM (SELECT p.vec_id, p.v, b.e, {gap} AS gap FROM usable p, book{r} b) GROUP BY vec_id)"
        )
        if r < rounds:
            steps.append(
                f"book{r + 1} AS MATERIALIZED (SELECT b.e, coalesce(m.entry, b.entry) AS entry FROM book{r} b LEFT JOIN ("
                f"SELECT e, list({_floor_mean('s', 'n')} ORDER BY i) AS entry FROM (SELECT e, i, sum(c)::BIGINT AS s, count(*) AS n FROM ("
                f"SELECT best.e AS e, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM near{r}) GROUP BY e, i) GROUP BY e) m USING (e))"
            )
    return (
        f"WITH {', '.join(steps)} SELECT vec_id, best.e::INTEGER AS cluster, best.gap AS distance, sum(best.gap) OVER (PARTITION BY best.e)::BIGINT AS cluster_inertia,"
        f" sum(best.gap) OVER ()::BIGINT AS inertia, sha256(array_to_string(b.entry, ',')) AS centroid_sha256 FROM near{rounds} n JOIN book{rounds} b ON b.e = n.best.e"
    )


@query(_cluster_sql(3))
def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ladderline.llm.bisectors import clustered, with_inertia

    found = with_inertia(*clustered(table(spark, sf_dir, "embeddings"), k=16, rounds=3, scale=64, width=64, seed=1))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
