"""Documents as files: discovery, extraction, bronze rows, ledger, streams and whole runs."""

from __future__ import annotations

import uuid
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions import parse_documents
from tallyspark.operators import Store, key_counts
from tallyspark.operators.extract import HtmlColumns, accepted, extract_documents, first_page, page_payload, quarantined
from tallyspark.schemas import GOLD_DB, TABLES
from tallyspark.session import durable_path, staged
from tallyspark.sources import ddl, ledger
from tallyspark.sources.bronze import bronze_envelope
from tallyspark.sources.export import sample_by_path
from tallyspark.sources.files import with_file_name
from tallyspark.sources.registry import DS2, route
from tallyspark.streaming.ingest import Layout, find_new_files, ingest_stream, load_bronze_batch, quarantined_rows, silver_table, upsert_stream
from tallyspark.streaming.runs import Run, run_all
from workload import fixtures as fx
from workload.expected import DS2_DOCS, GOLD, LINES, SILVER2_COLUMNS, silver2, with_tables
from workload.load_queries import CUTS, MERGED, SNAPSHOTS
from workload.registry import query

# What is printed where on a test page: label -> pattern, by section.
LANG, TITLE, AD = r'<html lang="([a-z]+)"', r"<title>([^<]*)</title>", r"<!-- ad (\d+) -->"
HOST, CHARSET = r"<footer>&copy; (\S+) ", r"charset=utf-(\d+)"
DS1_LABELS = {
    "header": {"Invoice Number": AD, "Vendor": LANG, "Seller tax id": LANG, "Client": HOST, "Client tax id": HOST},
    "items": {"Description": TITLE, "Quantity": CHARSET, "Price": AD},
    "summary": {},
}
DS2_LABELS = {
    "header": {"Bill To": LANG, "Address": HOST},
    "items": {"Item": TITLE, "Quantity": CHARSET, "Rate": AD},
    "summary": {"Order ID": AD},
}
DS1_EXTRACTOR = HtmlColumns(DS1_LABELS)
DS2_EXTRACTOR = HtmlColumns(DS2_LABELS)

MODIFIED = "2024-01-01T00:00:00Z"

PAGES = f"""
page_fields AS (
  SELECT page_id, url, right(html, 7) = '</html>' AS complete, regexp_extract(html, '{LANG}', 1) AS lang,
    regexp_extract(html, '{TITLE}', 1) AS title, regexp_extract(html, '{AD}', 1) AS ad,
    regexp_extract(html, '{HOST}', 1) AS host, regexp_extract(html, '{CHARSET}', 1) AS charset, TRY_CAST(regexp_extract(html, '{CHARSET}', 1) AS BIGINT) AS qty,
    octet_length(encode(html)) AS size
  FROM pages
)"""


def page_files(spark: SparkSession, sf_dir: str, path: Column | None = None) -> DataFrame:
    """Pages with the columns of a binary file read, named by their URL or by ``path``."""
    return fx.table(spark, sf_dir, "pages").select(
        (F.col("url") if path is None else path).alias("path"), F.lit(MODIFIED).cast("timestamp").alias("modificationTime"),
        F.length(F.encode("html", "UTF-8")).cast("bigint").alias("length"), F.encode("html", "UTF-8").alias("content"),
    )


def page_folder(spark: SparkSession, sf_dir: str) -> str:
    """Every page as a file of its own, most with a document suffix, in the shared folder."""
    folder = durable_path(spark, "unprocessed")
    suffix = F.get(F.array(*[F.lit(s) for s in SUFFIXES]), (F.col("page_id") % len(SUFFIXES)).cast("int"))
    named = fx.table(spark, sf_dir, "pages").select(F.concat("page_id", suffix).alias("name"), "html")

    def write(rows) -> None:
        target, base = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        target.create_dir(base, recursive=True)
        for row in rows:
            with target.open_output_stream(f"{base}/{row.name}") as out:
                out.write(row.html.encode("utf-8"))

    named.foreachPartition(write)
    return folder


SUFFIXES = [".jpg", ".jpeg", ".png", ".pdf", ".PDF", ".pdf", ".txt", ".pdf"]
SUFFIX_SQL = "(['" + "', '".join(SUFFIXES) + f"'])[page_id % {len(SUFFIXES)} + 1]"
TAKEN = f"{SUFFIX_SQL} IN ('.jpg', '.jpeg', '.png', '.pdf')"


def folder(spark: SparkSession, sf_dir: str) -> str:
    return fx.once(spark, sf_dir, "folder", lambda: page_folder(spark, sf_dir))


@query("src_new_files", with_tables(PAGES, f"""
SELECT page_id || {SUFFIX_SQL} AS file, CAST(size AS BIGINT) AS length FROM page_fields WHERE {TAKEN}
"""))
def src_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_new_files(spark, Layout(durable_path(spark, "found"), DS2), folder(spark, sf_dir))
    return with_file_name(found).select("file", "length")


@query("extract_pages", with_tables(PAGES, """
SELECT url AS path, CASE WHEN complete THEN lang END AS client, CASE WHEN complete THEN host END AS client_address,
  CASE WHEN complete THEN title END AS item_desc, CASE WHEN complete THEN ad END AS order_id,
  CASE WHEN NOT complete THEN 'ValueError: truncated document' END AS error
FROM page_fields
"""))
def extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract_documents(page_files(spark, sf_dir), DS2, DS2_EXTRACTOR)
    parsed = parse_documents(extracted, "json", DS2, "d")
    return parsed.select("path", "d.header.client", "d.header.client_address",
                         F.get("d.items", F.lit(0))["item_desc"].alias("item_desc"), "d.summary.order_id", "error")


@query("extract_quarantine", with_tables(PAGES, """
SELECT complete AS kept, lang, count(*) AS n FROM page_fields GROUP BY 1, 2
"""))
def extract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are told apart by their id: some share a URL."""
    path = F.concat_ws("/", "page_id", "url")
    extracted = staged(extract_documents(page_files(spark, sf_dir, path), DS2, DS2_EXTRACTOR), "extracted")
    pages = fx.table(spark, sf_dir, "pages").select(path.alias("path"), F.regexp_extract("html", LANG, 1).alias("lang"))
    outcome = accepted(extracted).select("path", F.lit(True).alias("kept")).unionByName(
        quarantined(extracted).select("path", F.lit(False).alias("kept")))
    return outcome.join(pages, "path").groupBy("kept", "lang").agg(F.count(F.lit(1)).alias("n"))


@query("extract_fallback", """
WITH parts AS (SELECT doc_id, string_split(text, chr(10))[1] AS page FROM documents)
SELECT doc_id, CASE WHEN right(page, 1) = '.' THEN '{"text": true}' ELSE page END AS payload FROM parts
""")
def extract_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are a document's lines; those that end in a full stop count as extracted."""
    pages = F.transform(F.split("text", "\n"), lambda line: F.struct(
        F.when(F.endswith(line, F.lit(".")), F.lit('{"text": true}')).alias("extracted_data"), line.alias("raw_text")))
    return fx.table(spark, sf_dir, "documents").select("doc_id", page_payload(pages).alias("payload"))


@query("first_page", """
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS rn FROM conversations) WHERE rn = 1
""")
def first_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_page(fx.table(spark, sf_dir, "conversations"), "conv_id", ["turn", "role", "text"])


@query("sample_dump", with_tables(PAGES, """
SELECT url AS path, CASE WHEN complete THEN ad END AS order_id FROM (SELECT * FROM page_fields ORDER BY url LIMIT 70)
"""))
def sample_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = durable_path(spark, "sample")
    extract_documents(sample_by_path(page_files(spark, sf_dir)), DS2, DS2_EXTRACTOR).write.json(path)
    dumped = spark.read.schema("path string, json string").json(path)
    return parse_documents(dumped, "json", DS2, "d").select("path", "d.summary.order_id")


@query("bronze_envelope", with_tables(PAGES, """
SELECT sha256('2|' || url || '|' || CAST(epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS VARCHAR)) AS id, false AS exclude_from_silver,
  '{"header":{"invoice_date":null,"client":' || to_json(lang) || ',"client_address":' || to_json(host) || '},"items":[{"item_desc":'
  || to_json(title) || ',"item_qty":' || coalesce(to_json(nullif(charset, '')), 'null') || ',"item_rate":' || to_json(ad) || '}],"summary":{"order_id":' || to_json(ad)
  || ',"discount":null,"shipping":null}}' AS raw_json,
  regexp_extract(url, '([^/]*)$', 1) AS "file_name_in_R2"
FROM page_fields WHERE complete
"""))
def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = extract_documents(page_files(spark, sf_dir), DS2, DS2_EXTRACTOR)
    return bronze_envelope(accepted(extracted), DS2).select("id", "raw_json", "exclude_from_silver", "file_name_in_R2")


@query("source_routing", """
SELECT event_id, 'ds' || (event_id % 2 + 1) AS bucket, 'ds_' || (event_id % 2 + 1) || '_raw_json' AS bronze_table,
  'ds' || (event_id % 2 + 1) || '_invoice_lines' AS silver_table, 'InvoiceDocument_DS' || (event_id % 2 + 1) AS model_name
FROM events
""")
def source_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fx.table(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 2 + 1).cast("int").alias("source_id"))
    return route(files).drop("source_id")


def first_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fx.table(spark, sf_dir, "orders").select(F.concat("o_orderkey", F.lit(".pdf")).alias("file"), "o_orderdate")
    return ledger.ledger_rows(files, 1, F.lit(ledger.UNPROCESSED), F.col("o_orderdate").cast("timestamp"))


@query("file_ledger", """
SELECT o_orderkey || '.pdf' AS file,
  CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'O' THEN 'startedprocessing' ELSE 'unprocessed' END AS state,
  CASE o_orderstatus WHEN 'F' THEN 'done' END AS outcome,
  CAST(CASE WHEN o_orderstatus IN ('F', 'O') THEN DATE '2024-01-01' ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS day
FROM orders
""")
def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").withColumn("file", F.concat("o_orderkey", F.lit(".pdf")))
    now = F.lit(MODIFIED).cast("timestamp")
    started = ledger.ledger_rows(orders.filter(F.col("o_orderstatus").isin("F", "O")), 1, F.lit(ledger.STARTED), now)
    done = ledger.ledger_rows(orders.filter("o_orderstatus = 'F'"), 1, F.lit(ledger.PROCESSED), now, F.lit("done"))
    moved = ledger.move(ledger.move(first_ledger(spark, sf_dir), started), done)
    return moved.select("file", "state", "outcome", F.col("last_modified").cast("date").cast("string").alias("day"))


LEDGER_STATES = "(['unprocessed', 'startedprocessing', 'startedprocessing', 'processed'])[event_id % 4 + 1]"


@query("requeue_stale", f"""
SELECT event_id || CASE WHEN event_id % 3 = 0 THEN '.PDF' ELSE '.pdf' END AS file,
  CASE WHEN {LEDGER_STATES} = 'startedprocessing' AND event_id % 3 <> 0
    AND coalesce(bound, ts) < TIMESTAMP '2024-01-01 11:00:00' THEN 'unprocessed' ELSE {LEDGER_STATES} END AS state
FROM (SELECT *, CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '2024-01-01 11:00:00' END AS bound FROM events)
""")
def requeue_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    states = F.array(F.lit(ledger.UNPROCESSED), F.lit(ledger.STARTED), F.lit(ledger.STARTED), F.lit(ledger.PROCESSED))
    exactly_an_hour = F.lit("2024-01-01 11:00:00").cast("timestamp")
    rows = fx.table(spark, sf_dir, "events").select(
        F.lit(1).alias("source_id"),
        F.concat(event, F.when(event % 3 == 0, ".PDF").otherwise(".pdf")).alias("file"),
        F.get(states, (event % 4).cast("int")).alias("state"),
        F.when(event % 5 == 0, exactly_an_hour).otherwise(F.col("ts").cast("timestamp")).alias("last_modified"),
        F.lit(None).cast("string").alias("outcome"),
    )
    return ledger.requeue_stale(rows, F.lit("2024-01-01 12:00:00").cast("timestamp")).select("file", "state")


@query("ddl_roundtrip", with_tables(GOLD, """
SELECT 'dim_buyer' AS name, count(*) AS n FROM dim_buyer UNION ALL SELECT 'dim_vendor', count(*) FROM dim_vendor
UNION ALL SELECT 'fact_invoice_line', count(*) FROM fact
"""))
def ddl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = "_" + uuid.uuid4().hex[:8]
    root = durable_path(spark, "warehouse")
    for _ in range(2):  # the second time finds everything in place
        ddl.create_all(spark, root, suffix)
    counts = None
    for name, df in fx.gold(spark, sf_dir).items():
        full = f"{GOLD_DB}{suffix}.{name}"
        df.select(*TABLES[f"{GOLD_DB}.{name}"].names).write.insertInto(full)
        n = spark.table(full).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        counts = n if counts is None else counts.unionByName(n)
    return counts


PAGE_SILVER = PAGES + f""",
page_lines AS (
  SELECT md5(ad || '-' || title) AS unique_invoice_line_no, md5(ad || '-' || lang) AS unique_invoice_no, lang AS client,
    host AS client_address, CAST(NULL AS DATE) AS invoice_date, CAST(NULL AS DOUBLE) AS discount, ad AS order_id,
    CAST(NULL AS DOUBLE) AS shipping, title AS item_desc, CAST(ad AS DOUBLE) AS item_rate, qty AS item_qty
  FROM page_fields WHERE complete AND {TAKEN}
)"""


@query("stream_ingest", with_tables(PAGE_SILVER, "SELECT * FROM page_lines"))
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = durable_path(spark, "ingested")
    ingest_stream(
        spark, DS2, folder(spark, sf_dir), out, DS2_EXTRACTOR, buckets=8
    ).awaitTermination()
    return silver_table(spark, out, DS2)


@query("stream_upsert", with_tables(SNAPSHOTS, MERGED))
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze arrives in three portions; each start of the stream takes up the new one."""
    arriving, out, checkpoint = (durable_path(spark, n) for n in ("arriving", "merged", "checkpoint"))
    rows = fx.bronze(spark, sf_dir, 2)
    since = "1900-01-01"
    for cut in CUTS:
        between = (F.col("inserted_at") >= F.lit(since).cast("timestamp")) & (
            F.col("inserted_at") < F.lit(cut).cast("timestamp"))
        rows.filter(between).write.mode("append").option("compression", "zstd").parquet(arriving)
        stream = spark.readStream.schema(rows.schema).parquet(arriving)
        upsert_stream(stream, DS2, out, checkpoint, buckets=8).awaitTermination()
        since = cut
    return silver_table(spark, out, DS2).select(*[c.strip() for c in SILVER2_COLUMNS.split(",")])


KEPT = LINES + "," + DS2_DOCS + f""",
early AS (SELECT * FROM ds2_docs WHERE inserted_at < TIMESTAMP '{CUTS[0]}'),
kept AS (SELECT * FROM ds2_docs WHERE inserted_at < TIMESTAMP '{CUTS[0]}' OR inserted_at >= TIMESTAMP '{CUTS[1]}')""" + "," + silver2(
    "first", docs="early") + "," + silver2("last", docs="kept")


@query("quarantined_batch", with_tables(KEPT, f"""
SELECT 'silver' AS place, unique_invoice_line_no AS key, client, item_desc, item_rate, item_qty FROM last
UNION ALL SELECT 'silver', unique_invoice_line_no, client, item_desc, item_rate, item_qty FROM first
  WHERE unique_invoice_line_no NOT IN (SELECT unique_invoice_line_no FROM last)
UNION ALL SELECT 'quarantine', id, NULL, NULL, NULL, NULL FROM ds2_docs
  WHERE inserted_at >= TIMESTAMP '{CUTS[0]}' AND inserted_at < TIMESTAMP '{CUTS[1]}'
"""))
def quarantined_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, of which the second has quantities below zero: it is kept apart and the third is loaded."""
    rows, layout = fx.bronze(spark, sf_dir, 2), Layout(durable_path(spark, "quarantined"), DS2, 8)
    bounds = ["1900-01-01", *CUTS]
    for number, (since, until) in enumerate(zip(bounds, bounds[1:], strict=False)):
        batch = rows.filter((F.col("inserted_at") >= F.lit(since).cast("timestamp")) & (F.col("inserted_at") < F.lit(until).cast("timestamp")))
        if number == 1:
            batch = batch.withColumn("raw_json", F.replace("raw_json", F.lit('"item_qty":"'), F.lit('"item_qty":"-')))
        load_bronze_batch(batch, layout, [number], on_fail="continue")
    lines = silver_table(spark, layout.root, DS2).select(
        F.lit("silver").alias("place"), F.col("unique_invoice_line_no").alias("key"), "client", "item_desc", "item_rate", "item_qty")
    held = quarantined_rows(spark, layout.root, DS2).select(F.lit("quarantine").alias("place"), F.col("id").alias("key"))
    return lines.unionByName(held, allowMissingColumns=True)


@query("dq_incremental", """
WITH lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS line, l_partkey FROM lineitem WHERE NOT (l_linenumber = 7 AND l_orderkey % 4 < 3)
)
SELECT 'unique lineitem.line' AS test, line AS value, count(*) AS n_records FROM lines GROUP BY line HAVING count(*) > 1
UNION ALL
SELECT 'relationships lineitem.l_partkey part.p_partkey', CAST(l_partkey AS VARCHAR), count(*) FROM lines
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0) GROUP BY l_partkey
""")
def dq_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches of lines and of parts with even keys; each batch takes back the seventh lines of the one before."""
    store = Store(spark, durable_path(spark, "counts"), {key_counts.TABLE: key_counts.SPEC}, 8)
    lines = fx.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), "l_partkey", "l_linenumber", (F.col("l_orderkey") % 4).alias("portion"))
    parts = fx.table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select("p_partkey", (F.col("p_partkey") % 4).alias("portion"))
    once = key_counts.unique_name("lineitem", "line")
    known = key_counts.relationship_name("lineitem", "l_partkey", "part", "p_partkey")
    for number in range(4):
        come, gone = lines.filter(F.col("portion") == number), lines.filter((F.col("portion") == number - 1) & (F.col("l_linenumber") == 7))
        batch = store.transaction()
        key_counts.apply_changes(
            batch, *(key_counts.changes(test, rows, column, sign) for test, column in ((once, "line"), (known, "l_partkey")) for rows, sign in ((come, 1), (gone, -1))),
            key_counts.changes(known, parts.filter(F.col("portion") == number), "p_partkey", parent=True))
        batch.commit()
    return key_counts.failing(store)


def whole_run(spark: SparkSession, sf_dir: str) -> tuple[Run, DataFrame]:
    """Both sources fed with the same pages, read as two kinds of document."""
    def build() -> tuple[Run, DataFrame]:
        run = Run(
            spark, durable_path(spark, "run"), {i: folder(spark, sf_dir) for i in (1, 2)},
            {1: DS1_EXTRACTOR, 2: DS2_EXTRACTOR}, database=f"{GOLD_DB}_{uuid.uuid4().hex[:8]}", buckets=8,
        )
        return run, run_all(run, "1")

    return fx.once(spark, sf_dir, "run", build)


@query("end_to_end_load", with_tables(PAGES, f"""
SELECT md5('1-' || ad || '-' || host || '-' || lang || '-1') AS row_id, '1' AS data_source_id, ad AS invoice_no,
  host || '-1' AS vendor_no_id, lang || '-1' AS buyer_no_id, round(CAST(ad AS DOUBLE) * qty, 3) AS spend
FROM page_fields WHERE complete AND {TAKEN}
UNION ALL
SELECT md5('2-' || md5(ad || '-' || title)), '2', ad, md5('ds2-superstore-vendor-2'), md5('2-' || lang || '-' || host),
  round(CAST(ad AS DOUBLE) * qty, 3)
FROM page_fields WHERE complete AND {TAKEN}
"""))
def end_to_end_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, outcomes = whole_run(spark, sf_dir)
    fact = spark.table(f"{run.database}.fact_invoice_line")
    return fact.select("row_id", "data_source_id", "invoice_no", "vendor_no_id", "buyer_no_id", "spend")


@query("run_outcomes", with_tables(PAGES, f"""
SELECT source_id, 'done' AS status, count(*) FILTER (complete) AS processed, count(*) FILTER (NOT complete) AS rejected,
  CAST(NULL AS VARCHAR) AS problem
FROM page_fields, (VALUES (1), (2)) AS sources(source_id) WHERE {TAKEN} GROUP BY 1
"""))
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whole_run(spark, sf_dir)[1]
