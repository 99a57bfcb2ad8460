"""Text sources: encodings, line filter, flat tables, file gate."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ladderline.functions.casts import to_int
from ladderline.operators.contracts import match_files
from ladderline.operators.flatten import flatten_columns, row_counts
from ladderline.operators.layout import detect_layout, rejected_files
from ladderline.plans.ordered import with_blocks
from ladderline.session import shared_dir
from ladderline.sources.text_reports import as_rows, is_report, read_text_lines, split_lines
from workload.base import cents, fixed_lines, line_of, query, table, written


@query("""
SELECT c_mktsegment AS segment, c_custkey AS custkey, 'Клиент №' || CAST(c_custkey AS VARCHAR) AS name,
    CAST(round(c_acctbal * 100) AS BIGINT) AS balance
FROM customer
""")
def read_files(spark, sf_dir):
    """Customers written as report files, some in UTF-8 and some in Windows-1251, CRLF line ends, read back."""
    customers = table(spark, sf_dir, "customer")
    line = F.concat(
        line_of(F.col("c_custkey"), F.concat(F.lit("Клиент №"), F.col("c_custkey").cast("string")), cents(F.col("c_acctbal"))),
        F.lit("\r"),
    )
    upper = bytes(range(128, 256))
    known = [(c, b) for c, b in zip(upper.decode("cp1251", errors="replace"), upper.decode("latin-1"), strict=True) if c != "�"]
    single_bytes = F.translate(line, "".join(c for c, _ in known), "".join(b for _, b in known))
    in_cp1251 = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    raw = F.when(in_cp1251, F.encode(single_bytes, "ISO-8859-1")).otherwise(F.encode(line, "UTF-8"))
    target = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    customers.select(F.col("c_mktsegment").alias("segment"), raw.cast("string").alias("value")).write.partitionBy("segment").text(target)
    cells = F.split("line", "\t")
    return read_text_lines(spark, target, fallback_encoding="windows-1251").select(
        F.regexp_extract("path", "segment=([^/]+)/", 1).alias("segment"),
        cells[0].cast("bigint").alias("custkey"),
        cells[1].alias("name"),
        cells[2].cast("bigint").alias("balance"),
    )


@query("""
WITH l AS (
    SELECT doc_id, unnest(string_split(replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), ', ', chr(9)), chr(10))) AS line
    FROM documents
)
SELECT doc_id, count(*) AS lines, count(*) FILTER (contains(line, chr(9)) AND trim(line, ' ' || chr(9)) <> ''
        AND NOT starts_with(lower(trim(string_split(line, chr(9))[1])), 'итого')) AS kept,
    count(*) FILTER (len(string_split(line, chr(9))) >= 3) AS opens
FROM l GROUP BY doc_id
""")
def line_filter(spark, sf_dir):
    """Lines of whole texts: which belong to a table body, which could start one."""
    texts = table(spark, sf_dir, "documents", "doc_id", "text")
    tabbed = texts.select(F.col("doc_id").cast("string").alias("path"), F.replace("text", F.lit(", "), F.lit("\t")).alias("text"))
    rows = as_rows(split_lines(tabbed))
    per_text = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("kept").alias("kept"), F.count_if("opens").alias("opens")
    )
    return per_text.select(F.col("path").cast("bigint").alias("doc_id"), "lines", "kept", "opens")


DOCUMENT_HEAD = ["Отчёт по текстам", "Параметры:\tПериод: 01.01.2024 - 31.01.2024", "", "doc_id\t lang \tn_chars\tbody"]


def _document_lines(spark, sf_dir):
    """Documents as flat tables per source: short ones lack their last cell, German ones have one too many,
    and totals lines are mixed in."""
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    docs = documents.withColumn("path", F.concat("source", F.lit(".txt")))
    body = F.concat(F.lit("#"), F.col("doc_id").cast("string"), F.lit(" "), F.regexp_replace("text", "[\t\r\n]+", " "))
    count = F.translate(F.format_number("n_chars", 0), ",", " ")
    short = line_of(F.col("doc_id"), F.col("lang"), count)
    full = line_of(F.col("doc_id"), F.col("lang"), count, body)
    line = F.when(F.col("n_chars") < 300, short).when(F.col("lang") == "de", F.concat(full, F.lit("\tlost"))).otherwise(full)
    details = docs.select("path", (F.col("doc_id") + 100).alias("line_no"), line.alias("line"))
    totals = docs.select("path", "lang").distinct().select(
        "path", F.lit(50).cast("bigint").alias("line_no"), line_of(F.concat(F.lit(" Итого "), F.col("lang")), "", "1", "x").alias("line")
    )
    head = fixed_lines(docs.select("path").distinct(), DOCUMENT_HEAD)
    return with_blocks(head.unionByName(details).unionByName(totals), 64)


@query("""
SELECT source || '.txt' AS path, doc_id, lang, n_chars, CASE WHEN n_chars >= 300 THEN
    md5('#' || CAST(doc_id AS VARCHAR) || ' ' || regexp_replace(text, '[\\t\\r\\n]+', ' ', 'g')) END AS body_md5
FROM documents
""")
def flat_report(spark, sf_dir):
    """Flat tables with title lines and totals: every document row, padded or cut to the header."""
    rows = as_rows(written(_document_lines(spark, sf_dir)))
    wide = flatten_columns(rows, detect_layout(rows), ["doc_id", "lang", "n_chars", "body"], ("path",))
    return wide.select(
        "path", to_int(F.col("doc_id")).alias("doc_id"), "lang", to_int(F.col("n_chars")).alias("n_chars"),
        F.md5(F.col("body").cast("binary")).alias("body_md5"),
    )


@query("""
SELECT source || '.txt' AS path, count(*) AS detail_rows, count(*) FILTER (n_chars < 300) AS padded_rows,
    count(*) FILTER (n_chars >= 300 AND lang = 'de') AS cut_rows
FROM documents GROUP BY ALL
""")
def flat_counts(spark, sf_dir):
    """How many rows of each flat table were padded or cut."""
    rows = as_rows(written(_document_lines(spark, sf_dir)))
    return row_counts(rows, detect_layout(rows)).select("path", "detail_rows", "padded_rows", "cut_rows")


@query("""
WITH t AS (
    SELECT doc_id, replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), ', ', chr(9)) AS text FROM documents
), l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM t
), s AS (
    SELECT doc_id, min(pos) FILTER (len(string_split(line, chr(9))) >= 3) AS start FROM l GROUP BY doc_id
), k AS (
    SELECT s.doc_id, start, count(*) FILTER (pos >= start AND contains(line, chr(9)) AND trim(line, ' ' || chr(9)) <> ''
        AND NOT starts_with(lower(trim(string_split(line, chr(9))[1])), 'итого')) AS kept
    FROM s JOIN l ON l.doc_id = s.doc_id GROUP BY ALL
)
SELECT doc_id, CASE WHEN start IS NULL THEN 'no table body' ELSE 'fewer than two table lines' END AS reason
FROM k WHERE start IS NULL OR kept < 2
""")
def rejected_reports(spark, sf_dir):
    """Whole texts as report files: those without a usable table, with the reason."""
    texts = table(spark, sf_dir, "documents", "doc_id", "text")
    tabbed = texts.select(F.col("doc_id").cast("string").alias("path"), F.replace("text", F.lit(", "), F.lit("\t")).alias("text"))
    rows = as_rows(written(split_lines(tabbed)))
    return rejected_files(detect_layout(rows)).select(F.col("path").cast("bigint").alias("doc_id"), "reason")


@query("""
WITH p AS (
    SELECT page_id, url, split_part(url, '/', 3) AS host,
        CASE WHEN starts_with(url, 'https') THEN '.TXT' WHEN contains(url, '/en/') THEN '.mxl' ELSE '.csv' END AS ext
    FROM pages
), c AS (SELECT host, bool_or(contains(url, 'utm')) AS use FROM p WHERE contains(url, '?') GROUP BY host)
SELECT '/in/' || CAST(page_id AS VARCHAR) || '/' || p.host || ext AS path, p.host AS report,
    CASE WHEN c.use IS NULL THEN 'unknown' WHEN c.use THEN 'load' ELSE 'disabled' END AS state
FROM p LEFT JOIN c ON c.host = p.host WHERE ext <> '.csv'
""")
def file_gate(spark, sf_dir):
    """Arrived files by type and contract: to load, switched off, or not known yet."""
    pages = table(spark, sf_dir, "pages", "page_id", "url").withColumn("host", F.split_part("url", F.lit("/"), F.lit(3)))
    extension = F.when(F.startswith("url", F.lit("https")), ".TXT").when(F.contains("url", F.lit("/en/")), ".mxl").otherwise(".csv")
    path = F.concat(F.lit("/in/"), F.col("page_id").cast("string"), F.lit("/"), F.col("host"), extension)
    asked = pages.filter(F.contains("url", F.lit("?")))
    contracts = asked.groupBy(F.col("host").alias("report")).agg(F.bool_or(F.contains("url", F.lit("utm"))).alias("use"))
    files = pages.select(path.alias("path")).filter(is_report(F.col("path")))
    return match_files(files, contracts)
