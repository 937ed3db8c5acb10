"""The registered data sources. Adding one means adding a ``SourceSpec`` and its plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Aliases = dict[str, tuple[str, ...]]


@dataclass(frozen=True)
class SourceSpec:
    """What the generic stages need to know about one source.

    ``root`` is the JSON path that holds header, items and summary. Each section maps a field
    to the labels under which a document may print it, best label first.
    """

    source_id: int
    model_name: str
    root: str
    header: Aliases
    items: Aliases
    summary: Aliases

    @property
    def bucket(self) -> str:
        return f"ds{self.source_id}"

    @property
    def bronze_table(self) -> str:
        return f"ds_{self.source_id}_raw_json"

    @property
    def silver_table(self) -> str:
        return f"ds{self.source_id}_invoice_lines"

    @property
    def sections(self) -> dict[str, Aliases]:
        return {"header": self.header, "items": self.items, "summary": self.summary}


# Document field names and the printed labels each one is read from, in order.
DS1 = SourceSpec(
    source_id=1,
    model_name="InvoiceDocument_DS1",
    root="$.gt_parse",
    header={
        "invoice_no": ("Invoice no", "Invoice Number", "Invoice number"),
        "invoice_date": ("Invoice date", "Date"),
        "seller": ("Seller", "Vendor", "Supplier"),
        "client": ("Buyer", "Client", "Customer"),
        "seller_tax_id": ("Seller tax id", "seller_tax_id"),
        "client_tax_id": ("Client tax id", "client_tax_id"),
        "iban": ("IBAN", "iban", "Account number"),
    },
    items={
        "item_desc": ("Description", "description", "Item description"),
        "item_qty": ("Quantity", "Item quantity"),
        "item_net_price": ("Price", "Item net price", "Net price"),
        "item_vat": ("vat", "Item vat", "VAT", "Tax"),
    },
    summary={
        "total_net_worth": ("total_net_worth", "total worth", "Total worth"),
        "total_vat": ("total_vat", "total vat", "Total VAT", "Total tax"),
    },
)

DS2 = SourceSpec(
    source_id=2,
    model_name="InvoiceDocument_DS2",
    root="$",
    header={
        "invoice_date": ("Date", "Order date"),
        "client": ("Bill To:", "Bill To", "Customer Name", "Buyer"),
        "client_address": ("Ship To:", "Address", "Ship To"),
    },
    items={
        "item_desc": ("Item", "Item description", "Item name", "Product name"),
        "item_qty": ("Quantity", "Item quantity"),
        "item_rate": ("Rate", "Price", "Item net price", "Unit cost"),
    },
    summary={
        "order_id": ("Order ID", "order"),
        "discount": ("Discount",),
        "shipping": ("Shipping", "Shipping fee"),
    },
)

SOURCES: dict[int, SourceSpec] = {spec.source_id: spec for spec in (DS1, DS2)}


def source_spec(source_id: int) -> SourceSpec:
    if source_id not in SOURCES:
        raise ValueError(f"no document model registered for data source {source_id}")
    return SOURCES[source_id]


def sources_frame(spark: SparkSession) -> DataFrame:
    """The registry as a config table: one row per source."""
    return spark.createDataFrame(
        [(s.source_id, s.bucket, s.bronze_table, s.silver_table, s.model_name) for s in SOURCES.values()],
        "source_id int, bucket string, bronze_table string, silver_table string, model_name string",
    )


def route(files: DataFrame, source_id: str = "source_id") -> DataFrame:
    """Attach bucket, tables and document model to each file; an unregistered source fails the job.

    The registry has one row per source known to this code, so it is broadcast.
    """
    registry = sources_frame(files.sparkSession).withColumnRenamed("source_id", "_registered")
    joined = files.join(F.broadcast(registry), F.col(source_id) == F.col("_registered"), "left")

    def known(name: str) -> Column:
        message = F.concat(F.lit("no document model registered for data source "), F.col(source_id).cast("string"))
        return F.when(F.col("_registered").isNull(), F.raise_error(message)).otherwise(F.col(name)).alias(name)

    added = [c for c in registry.columns if c != "_registered"]
    return joined.select(*files.columns, *[known(c) for c in added])
