"""Bronze documents to one typed table of invoice lines per source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyspark.functions import (
    clean_money,
    document_type,
    invoice_key,
    parse_documents,
    safe_date,
    safe_double,
    safe_int,
    safe_int_via_double,
    surrogate_key,
)
from tallyspark.operators.dedup import latest_per_key
from tallyspark.schemas import SILVER_DS1, SILVER_DS2, columns
from tallyspark.session import staged
from tallyspark.sources.registry import DS1, DS2, SourceSpec

INVOICE_COLUMNS = ["invoice_no", "client_tax_id", "seller_tax_id"]


def included(bronze: DataFrame) -> DataFrame:
    """Rows not marked for exclusion; an unknown mark excludes too."""
    return bronze.filter(~F.col("exclude_from_silver"))


def documents(bronze: DataFrame, spec: SourceSpec) -> DataFrame:
    """Parsed documents, still one row each: ``id, inserted_at``, header, summary, ``items``.

    A pure per-row step, so a load can append it batch by batch and never parse a text twice.
    """
    parsed = parse_documents(included(bronze), "raw_json", spec, "d")
    return parsed.select("id", "inserted_at", "d.header.*", "d.summary.*", F.col("d.items").alias("items"))


def documents_type(spec: SourceSpec) -> StructType:
    """The schema of ``documents``."""
    fields = {f.name: f for f in document_type(spec).fields}
    flat = [f for name in ("header", "summary") for f in fields[name].dataType.fields]
    return StructType([*columns("id string, inserted_at timestamp").fields, *flat, fields["items"]])


def ds1_invoice_no() -> Column:
    return invoice_key(
        (F.col("invoice_no"), "missingin"), (F.col("client_tax_id"), "missingcti"), (F.col("seller_tax_id"), "missingsti")
    )


def silver_ds1(bronze: DataFrame, keep: str = "one_line") -> DataFrame:
    """Parse and write the documents once, for the plan scans them for rows and for descriptions."""
    return silver_ds1_lines(staged(documents(bronze, DS1), DS1.bronze_table), keep)


def silver_ds2(bronze: DataFrame) -> DataFrame:
    """The plan scans the documents once, so they are parsed on the way."""
    return silver_ds2_lines(documents(bronze, DS2))


def silver_ds1_lines(docs: DataFrame, keep: str = "one_line", within: Sequence[str] = ()) -> DataFrame:
    """Lines of the latest version of each invoice, numbered among the lines of all versions.

    ``keep="one_line"`` keeps a single line per invoice, the first of its latest document;
    ``keep="all_lines"`` keeps the whole latest document.

    The numbering order is (item_desc, newest version first, id, position). Since the surviving
    document is the first version in that order, a line's number is: lines of all versions with a
    smaller description, plus equal descriptions before it in its own document, plus one. The
    first term is a count, so no invoice is ever sorted in one task, however many lines share
    its key, and only descriptions travel for it.

    With the columns ``within`` documents that differ in them have nothing to do with each other, as if the plan were
    called for each of their values; the lines have these columns too.
    """
    if keep not in ("one_line", "all_lines"):
        raise ValueError(f"keep must be 'one_line' or 'all_lines', not {keep!r}")
    # A document without items contributes no line and cannot be the latest one.
    docs = docs.filter(F.size("items") > 0).withColumn("unique_invoice_no", ds1_invoice_no())
    counted = _lines_per_gap(docs, keep, within)
    # The first line is all that one line per invoice needs of a document: cut before it is shuffled.
    rows = docs.withColumn("item", F.get("items", F.lit(0))).drop("items") if keep == "one_line" else docs
    latest = latest_per_key(rows, [*within, "unique_invoice_no"], ["-inserted_at", "id"])
    numbered = _one_line(latest, counted, within) if keep == "one_line" else _all_lines(latest, counted, within)
    return numbered.select(
        F.concat("unique_invoice_no", F.lit("-"), F.col("number").cast("string")).alias("unique_invoice_line_no"),
        "unique_invoice_no", "client", "client_tax_id", "iban",
        safe_date(F.col("invoice_date")).alias("invoice_date"),
        "invoice_no", "seller", "seller_tax_id",
        safe_double(F.col("total_net_worth")).alias("total_net_worth"),
        safe_double(F.col("total_vat")).alias("total_vat"),
        F.col("item.item_desc").alias("item_desc"),
        safe_double(F.col("item.item_net_price")).alias("item_net_price"),
        safe_int_via_double(F.col("item.item_qty")).alias("item_qty"),
        safe_double(F.col("item.item_vat")).alias("item_vat"), *within,
    ).select(*SILVER_DS1.names, *within)


def _one_line(latest: DataFrame, counted: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The first line with its number. There is one mark, so all counted lines lie before it."""
    before = counted.select(*within, "unique_invoice_no", F.col("n").alias("before"))
    return latest.join(before, [*within, "unique_invoice_no"], "left").withColumn("number", F.coalesce("before", F.lit(0)) + 1)


def _all_lines(latest: DataFrame, counted: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """All lines with their numbers, worked out in the arrays of each document before a line has a row.

    Sorted lines are cut where the description changes, one row each; the counts of the gaps up to there are added up,
    and the lines of a row are numbered on from that sum.
    """
    invoice = [*within, "unique_invoice_no"]
    gaps = counted.groupBy(*invoice).agg(F.map_from_entries(F.collect_list(F.struct("gap", "n"))).alias("gaps"))
    item = F.transform("items", lambda i, at: F.struct(_sort_text(i["item_desc"]).alias("text"), at.alias("at"), i.alias("item")))
    ordered = latest.join(gaps, invoice, "left").withColumn("items", F.array_sort(item))
    begins = F.filter(F.sequence(F.lit(0), F.size("items") - 1),
                      lambda at: (at == 0) | (F.get(F.col("items"), at - 1)["text"] != F.get(F.col("items"), at)["text"]))
    ordered = ordered.withColumn("begins", begins)
    parts = F.transform("begins", lambda begin, mark: F.slice(
        "items", begin + 1, F.coalesce(F.get(F.col("begins"), mark + 1), F.size("items")) - begin))
    marked = ordered.select("*", F.posexplode(parts).alias("mark", "part")).drop("items", "begins")
    before = Window.partitionBy(*invoice).orderBy("mark").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    smaller = F.sum(F.coalesce(F.try_element_at("gaps", F.col("mark")), F.lit(0))).over(before)
    numbered = marked.withColumn("smaller", smaller).drop("gaps")
    lines = numbered.select("*", F.posexplode("part").alias("equal", "line")).drop("part")
    return lines.withColumn("item", F.col("line.item")).withColumn("number", F.col("smaller") + F.col("equal") + 1)


def _sort_text(description: Column) -> Column:
    """Text that sorts like the description with NULL lowest."""
    return F.when(description.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), description))


def _marks(descriptions: Column) -> Column:
    """The distinct descriptions of an invoice's surviving lines, sorted."""
    return F.array_sort(F.array_distinct(F.transform(descriptions, _sort_text)))


def _lines_per_gap(docs: DataFrame, keep: str, within: Sequence[str] = ()) -> DataFrame:
    """``unique_invoice_no, gap, n``: how many lines of an invoice sort into each gap of its marks.

    A line is in gap ``g`` if ``g`` marks are not above it, so it sorts before mark ``g`` (from
    0) and all later ones. Marks come from one document, which bounds the gaps of an invoice.

    Lines meet their invoice in a join on the raw identifiers (a NULL differs here from the text
    that stands for it in the key). If a third of all lines share them, AQE splits that join: the
    counts are grouped by the invoice key and not by the join columns, so each task counts what
    it joined and only those counts are shuffled.

    Many marks are cut into parts, about as many as a part has marks: a line is compared with the first mark of each
    part, which finds its part, and with the marks of that part alone. That is done where a document meets the marks,
    so no line is shuffled by itself, and only counts are moved on.
    """
    alike, invoice = [*within, *INVOICE_COLUMNS], [*within, "unique_invoice_no"]
    slim = docs.select(
        "unique_invoice_no", *alike, "inserted_at", "id", F.col("items.item_desc").alias("descriptions")
    )
    kept = F.slice("descriptions", 1, 1) if keep == "one_line" else F.col("descriptions")
    ranked = slim.withColumn("descriptions", kept)  # cut before it is shuffled
    marks = latest_per_key(ranked, invoice, ["-inserted_at", "id"]).select(
        "unique_invoice_no", *[F.col(c).alias(f"_{c}") for c in alike], _marks(F.col("descriptions")).alias("marks"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in alike]
    # Whole documents meet the marks: an identifier travels once for all lines of one.
    texts = slim.select(*alike, F.transform("descriptions", _sort_text).alias("texts")).join(marks, same)
    if keep == "one_line":
        below = texts.select(*invoice, F.size(F.filter("texts", lambda t: t < F.col("marks")[0])).alias("below"))
        return below.filter("below > 0").groupBy(*invoice, F.lit(0).alias("gap")).agg(F.sum("below").alias("n"))
    step = F.ceil(F.sqrt(F.size("marks"))).cast("int")
    lines = texts.select(*invoice, "marks", step.alias("step"), F.explode("texts").alias("text"))
    lines = lines.filter(F.col("text") < F.element_at("marks", -1))
    heads = F.sequence(F.lit(0), F.floor((F.size("marks") - 1) / F.col("step")).cast("int"))
    placed = lines.withColumn("part", F.size(F.filter(heads, lambda k: F.get("marks", k * F.col("step")) <= F.col("text"))) - 1)
    begin = F.col("part") * F.col("step")
    inside = F.sequence(begin, F.least(begin + F.col("step"), F.size("marks")) - 1)
    gap = F.when(F.col("part") < 0, 0).otherwise(begin + F.size(F.filter(inside, lambda k: F.get("marks", k) <= F.col("text"))))
    return placed.groupBy(*invoice, gap.alias("gap")).agg(F.count(F.lit(1)).alias("n"))


def silver_ds2_lines(docs: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The first usable line of the latest document of each (order, client).

    A line with neither rate nor quantity is a category heading read as an item; dropping it
    comes before choosing the latest line. All lines of a document tie on its insertion time, so
    the choice among its lines is made inside the document and documents, not lines, are ranked.

    Documents without a usable line are ranked last and dropped then. Dropped earlier, they would
    have Spark evaluate the parsing a second time in the pushed-down filter.

    ``within`` is that of ``silver_ds1_lines``.
    """
    usable = F.filter("items", lambda i: i["item_rate"].isNotNull() | i["item_qty"].isNotNull())
    lines = docs.withColumn("item", F.get(usable, F.lit(0))).drop("items").withColumn("_none", F.col("item").isNull())
    latest = latest_per_key(lines, [*within, "order_id", "client"], ["_none", "-inserted_at", "id"]).filter(~F.col("_none"))
    return latest.select(
        surrogate_key(F.col("order_id"), F.col("item.item_desc")).alias("unique_invoice_line_no"),
        surrogate_key(F.col("order_id"), F.col("client")).alias("unique_invoice_no"),
        "client", "client_address",
        safe_date(F.col("invoice_date")).alias("invoice_date"),
        safe_double(clean_money(F.col("discount"))).alias("discount"),
        "order_id",
        safe_double(clean_money(F.col("shipping"))).alias("shipping"),
        F.col("item.item_desc").alias("item_desc"),
        safe_double(clean_money(F.col("item.item_rate"))).alias("item_rate"),
        safe_int(clean_money(F.col("item.item_qty"))).alias("item_qty"), *within,
    ).select(*SILVER_DS2.names, *within)
