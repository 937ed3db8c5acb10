"""Scalar helpers, each over a column derived from a whole test table.

The derived columns mix ordinary values with the awkward spellings each helper must handle, so
that every spelling meets many different rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import functions as fn
from tallyspark.sources.registry import DS1
from workload import fixtures as fx
from workload.registry import query


def variants(number: Column, options: list[Column | str | None]) -> Column:
    """The option numbered ``number % len(options)``, the last one by default."""
    columns = [o if isinstance(o, Column) else F.lit(o) for o in options]
    chain = F.when(number % len(columns) == 0, columns[0])
    for i, column in enumerate(columns[1:-1], start=1):
        chain = chain.when(number % len(columns) == i, column)
    return chain.otherwise(columns[-1])


def variants_sql(number: str, options: list[str]) -> str:
    """The same in SQL; every option is an expression."""
    cases = " ".join(f"WHEN {i} THEN {o}" for i, o in enumerate(options[:-1]))
    return f"CASE {number} % {len(options)} {cases} ELSE {options[-1]} END"


JSON_VARIANTS = variants_sql("event_id", [
    """'{"a":"' || event_type || '"}'""", """'{"a":' || user_id || '}'""", """'{"a":true}'""", """'{"a":null}'""",
    """'{"b":"' || event_type || '"}'""", """'{"a":{"b":' || user_id || '}}'""", """'{"a":["' || event_type || '"]}'""",
    """'{"a":"{' || event_type || '}"}'""", """'{"a":"[1]"}'""", """'{"a":"' || event_type""",
])


@query("json_scalar", f"""
SELECT event_id, json_extract_string(props, '$.k') AS k,
  CASE WHEN json_valid(raw) THEN
    CASE WHEN json_type(raw, '$.a') NOT IN ('OBJECT', 'ARRAY') THEN json_extract_string(raw, '$.a') END END AS a
FROM (SELECT *, {JSON_VARIANTS} AS raw FROM events)
""")
def json_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    kind, user = F.col("event_type"), F.col("user_id")
    raw = variants(F.col("event_id"), [
        F.concat(F.lit('{"a":"'), kind, F.lit('"}')), F.concat(F.lit('{"a":'), user, F.lit("}")),
        '{"a":true}', '{"a":null}', F.concat(F.lit('{"b":"'), kind, F.lit('"}')),
        F.concat(F.lit('{"a":{"b":'), user, F.lit("}}")), F.concat(F.lit('{"a":["'), kind, F.lit('"]}')),
        F.concat(F.lit('{"a":"{'), kind, F.lit('}"}')), '{"a":"[1]"}', F.concat(F.lit('{"a":"'), kind),
    ])
    rows = events.select("event_id", "props", raw.alias("raw"))
    return rows.select(
        "event_id", fn.json_scalar(F.col("props"), "$.k").alias("k"), fn.json_scalar(F.col("raw"), "$.a").alias("a")
    )


DATE_TEXTS = variants_sql("o_orderkey", [
    "strftime(o_orderdate, '%Y-%m-%d')", "strftime(o_orderdate, '%Y-%-m-%-d')", "strftime(o_orderdate, '%m/%d/%Y')",
    "strftime(o_orderdate, '%b %d %Y')", "strftime(o_orderdate, '%Y')", "strftime(o_orderdate, '%Y-%m')",
    "strftime(o_orderdate, '%Y-%m-%d') || ' junk'", "strftime(o_orderdate, '%Y') || '-02-30'", "''", "NULL",
])


@query("safe_cast_date", f"""
SELECT o_orderkey, CASE WHEN regexp_full_match(txt, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN TRY_CAST(txt AS DATE) END AS day
FROM (SELECT o_orderkey, {DATE_TEXTS} AS txt FROM orders)
""")
def safe_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    text = variants(F.col("o_orderkey"), [
        *[F.date_format(day, p) for p in ("yyyy-MM-dd", "yyyy-M-d", "MM/dd/yyyy", "MMM dd yyyy", "yyyy", "yyyy-MM")],
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" junk")),
        F.concat(F.date_format(day, "yyyy"), F.lit("-02-30")), "", None,
    ])
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", fn.safe_date(text).alias("day"))


WHOLE = "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)"
FLOAT_TEXTS = variants_sql("l_orderkey", [
    f"{WHOLE} || '.5'", f"' ' || {WHOLE} || '.5 '", f"{WHOLE} || 'e3'", f"{WHOLE} || '.5d'", "'0x1p3'",
    f"{WHOLE} || ',5'", f"'-.' || {WHOLE}", f"{WHOLE} || '.'", "''", "NULL",
])


@query("safe_cast_float", f"""
SELECT l_orderkey, sum(d) AS total, count(d) AS n
FROM (SELECT l_orderkey, CASE WHEN regexp_full_match(txt, ' *[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[0-9]+)? *')
        THEN TRY_CAST(trim(txt) AS DOUBLE) END AS d
      FROM (SELECT l_orderkey, {FLOAT_TEXTS} AS txt FROM lineitem)) GROUP BY 1
""")
def safe_cast_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.col("l_quantity").cast("bigint").cast("string")
    text = variants(F.col("l_orderkey"), [
        F.concat(whole, F.lit(".5")), F.concat(F.lit(" "), whole, F.lit(".5 ")), F.concat(whole, F.lit("e3")),
        F.concat(whole, F.lit(".5d")), "0x1p3", F.concat(whole, F.lit(",5")), F.concat(F.lit("-."), whole),
        F.concat(whole, F.lit(".")), "", None,
    ])
    rows = fx.table(spark, sf_dir, "lineitem").select("l_orderkey", fn.safe_double(text).alias("d"))
    return rows.groupBy("l_orderkey").agg(F.sum("d").alias("total"), F.count("d").alias("n"))


KEY = "CAST(o_orderkey AS VARCHAR)"
INT_TEXTS = variants_sql("o_orderkey", [
    KEY, f"{KEY} || '.0'", f"'+' || {KEY}", "'9223372036854775808'", f"{KEY} || '.5'", f"'-' || {KEY} || '.5'",
    "'1e30'", "'nan'", "''", "NULL",
])


@query("safe_cast_int", f"""
SELECT o_orderkey, CASE WHEN regexp_full_match(txt, '[-+]?[0-9]+') THEN TRY_CAST(txt AS BIGINT) END AS direct,
  CASE WHEN txt IN ('nan', '') THEN NULL ELSE TRY_CAST(round(TRY_CAST(txt AS DOUBLE)) AS BIGINT) END AS via_double
FROM (SELECT o_orderkey, {INT_TEXTS} AS txt FROM orders)
""")
def safe_cast_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    text = variants(F.col("o_orderkey"), [
        key, F.concat(key, F.lit(".0")), F.concat(F.lit("+"), key), "9223372036854775808", F.concat(key, F.lit(".5")),
        F.concat(F.lit("-"), key, F.lit(".5")), "1e30", "nan", "", None,
    ])
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.safe_int(text).alias("direct"), fn.safe_int_via_double(text).alias("via_double")
    )


MONEY_TEXTS = variants_sql("o_orderkey", [
    "'$' || format('{:,.2f}', o_totalprice)", "'$'", "'1,2,3'", "format('{:.2f}', o_totalprice)", "NULL",
])


@query("clean_money", f"""
SELECT o_orderkey, regexp_replace(txt, '[$,]', '', 'g') AS amount FROM (SELECT o_orderkey, {MONEY_TEXTS} AS txt FROM orders)
""")
def clean_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.format_number("o_totalprice", 2)
    text = variants(F.col("o_orderkey"), [
        F.concat(F.lit("$"), price), "$", "1,2,3", F.replace(price, F.lit(","), F.lit("")), None,
    ])
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", fn.clean_money(text).alias("amount"))


@query("normalise_text", """
SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(replace(padded, ',', ''),
    '^[\\s\\x{A0}]+', ''), '[\\s\\x{A0}]+$', ''), '[ \\t\\n\\f\\r]+', ' ', 'g')) AS digest
FROM (SELECT doc_id, chr(160) || ' ' || chr(9) || text || chr(10) || ' ' || chr(160) AS padded FROM documents)
""")
def normalise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  \t"), "text", F.lit("\n  "))
    return fx.table(spark, sf_dir, "documents").select("doc_id", F.md5(fn.normalise_text(padded)).alias("digest"))


@query("surrogate_key", """
SELECT c_custkey, md5(coalesce(part, '_dbt_utils_surrogate_key_null_') || '-' || c_name || '-' || c_nationkey) AS key
FROM (SELECT *, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_mktsegment ELSE c_mktsegment || '-x' END AS part FROM customer)
""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = variants(F.col("c_custkey"), [None, F.col("c_mktsegment"), F.concat("c_mktsegment", F.lit("-x"))])
    return fx.table(spark, sf_dir, "customer").select(
        "c_custkey", fn.surrogate_key(part, F.col("c_name"), F.col("c_nationkey")).alias("key")
    )


@query("invoice_key", """
SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey AS VARCHAR) END, 'missingin') || '-' ||
  coalesce(CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey AS VARCHAR) END, 'missingcti') || '-' ||
  coalesce(CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END, 'missingsti') AS key
FROM orders
""")
def invoice_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", fn.invoice_key(
        (F.when(key % 3 > 0, key.cast("string")), "missingin"),
        (F.when(key % 4 > 0, F.col("o_custkey").cast("string")), "missingcti"),
        (F.when(key % 5 > 0, F.col("o_orderstatus")), "missingsti"),
    ).alias("key"))


@query("line_spend", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * CAST(l_quantity AS BIGINT), 3) AS spend FROM lineitem
""")
def line_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    spend = fn.line_spend(F.col("l_extendedprice"), F.col("l_quantity").cast("bigint"))
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", spend.alias("spend"))


@query("other_bucket", """
SELECT l_orderkey, l_linenumber, CASE WHEN spend < 10000 THEN 'Other' ELSE l_returnflag END AS name
FROM (SELECT *, CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 10000.0 WHEN l_linenumber = 5 THEN 9999.99
        ELSE l_extendedprice END AS spend FROM lineitem)
""")
def other_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    spend = (
        F.when(line == 3, F.lit(None)).when(line == 4, F.lit(10000.0)).when(line == 5, F.lit(9999.99))
        .otherwise(F.col("l_extendedprice"))
    )
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", fn.other_bucket(spend, F.col("l_returnflag")).alias("name")
    )


@query("date_parts", """
SELECT event_id, strftime(ts, '%b') AS month, strftime(ts, '%A') AS weekday, CAST(isodow(ts) AS INTEGER) AS weekday_num
FROM events
""")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return fx.table(spark, sf_dir, "events").select(
        "event_id", fn.month_abbr(day).alias("month"), fn.weekday_name(day).alias("weekday"),
        fn.iso_weekday(day).alias("weekday_num"),
    )


@query("alias_resolve", """
SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment WHEN 2 THEN NULL WHEN 3 THEN c_mktsegment
  ELSE NULL END AS client
FROM customer
""")
def alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    nothing = F.lit(None).cast("string")
    labels = variants(F.col("c_custkey"), [
        F.create_map(F.lit("Client"), segment, F.lit("Buyer"), name),  # the better label wins
        F.create_map(F.lit("Client"), segment),
        F.create_map(F.lit("Buyer"), nothing, F.lit("Client"), segment),  # present but null wins too
        F.create_map(F.lit("Customer"), segment, F.lit("Seller"), name),
        F.create_map(F.lit("Seller"), name),
        F.create_map(F.lit("client"), name),  # the field's own name is not a label
    ])
    return fx.table(spark, sf_dir, "customer").select(
        "c_custkey", fn.resolve_aliases(labels, DS1.header["client"]).alias("client")
    )


# The document texts of ``doc_validate``; ``{k}`` is the order key and ``{s}`` its status.
VALID_SHAPES = [
    '{"gt_parse":{"header":{"invoice_no":"{k}"},"items":[{"item_desc":"{s}"}],"summary":{"total_vat":null}}}',
    '{"gt_parse":{"header":{},"items":[],"summary":{}}}',
]
INVALID_SHAPES = [
    '{"gt_parse":{"header":{"invoice_no":"{k}"},"items":[{"item_desc":"{s}"}]}}',
    '{"gt_parse":{"header":"{k}","items":[],"summary":{}}}',
    '{"gt_parse":{"header":{},"items":{"item_desc":"{s}"},"summary":{}}}',
    '{"gt_parse":{"header":{},"items":["{s}"],"summary":{}}}',
    '{"gt_parse":{"header":{"invoice_no":{k}},"items":[],"summary":{}}}',
    '{"gt_parse":{"header":{"iban":{"x":"{k}"}},"items":[],"summary":{}}}',
    '{"header":{},"items":[],"summary":{}}',
    '"{k} {s}"',
    '{"gt_parse":{"header":{"invoice_no":"{k}"',
]


@query("doc_validate", f"""
SELECT o_orderkey, o_orderkey % {len(VALID_SHAPES) + len(INVALID_SHAPES)} < {len(VALID_SHAPES)} AS valid FROM orders
""")
def doc_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(shape: str) -> Column:
        filled = F.replace(F.lit(shape), F.lit("{k}"), F.col("o_orderkey").cast("string"))
        return F.replace(filled, F.lit("{s}"), F.col("o_orderstatus"))

    raw = variants(F.col("o_orderkey"), [text(s) for s in VALID_SHAPES + INVALID_SHAPES])
    rows = fx.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    return fn.with_validity(rows, "raw", DS1).select("o_orderkey", "valid")
