"""Fixed table layouts of the four schemas, and the shape of a file listing."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BRONZE_DB, SILVER_DB, GOLD_DB, CONF_DB = "bronze", "invoices_silver", "invoices_gold", "conf"

TYPES = {
    "string": StringType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "date": DateType(),
    "timestamp": TimestampType(), "boolean": BooleanType(), "binary": BinaryType(),
}


def columns(text: str) -> StructType:
    """A schema from ``name type, ...``, without needing a session as Spark's own reader does."""
    pairs = [pair.split() for pair in text.split(",")]
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


BRONZE = columns(
    "id string, raw_json string, inserted_at timestamp, exclude_from_silver boolean, file_name_in_R2 string"
)

SILVER_DS1 = columns(
    "unique_invoice_line_no string, unique_invoice_no string, client string, client_tax_id string, "
    "iban string, invoice_date date, invoice_no string, seller string, seller_tax_id string, "
    "total_net_worth double, total_vat double, item_desc string, item_net_price double, "
    "item_qty bigint, item_vat double"
)

SILVER_DS2 = columns(
    "unique_invoice_line_no string, unique_invoice_no string, client string, client_address string, "
    "invoice_date date, discount double, order_id string, shipping double, item_desc string, "
    "item_rate double, item_qty bigint"
)

DIM_VENDOR = columns(
    "data_source_id string, vendor_no_id string, vendor_no string, vendor_desc string, vendor_address string"
)

DIM_BUYER = columns(
    "data_source_id string, buyer_no_id string, buyer_no string, buyer_desc string, buyer_address string"
)

FACT_INVOICE_LINE = columns(
    "row_id string, data_source_id string, unique_invoice_line_no string, unique_invoice_no string, "
    "vendor_no_id string, buyer_no_id string, spend double, iban string, invoice_date date, "
    "invoice_no string, item_desc string, item_net_price double, item_qty bigint"
)

CONF_DATA_SOURCE = columns("id bigint, name string, source_link string")

# Layout of Spark's binaryFile source; a streaming read must be given it.
BINARY_FILE = columns("path string, modificationTime timestamp, length bigint, content binary")

LEDGER = columns("source_id int, file string, state string, last_modified timestamp, outcome string")

# Files as listings name them, and which of these were taken up.
LISTED = columns("path string, modificationTime timestamp, length bigint")
SEEN = columns("version string, path string, modificationTime timestamp, length bigint")

# One page of a document as a model returns it: what it read, or else the plain text; and what becomes of all pages.
PAGE = columns("extracted_data string, raw_text string")
EXTRACTED = columns("path string, modificationTime timestamp, json string, error string").add("pages", ArrayType(PAGE))

TABLES: dict[str, StructType] = {
    f"{BRONZE_DB}.ds_1_raw_json": BRONZE,
    f"{BRONZE_DB}.ds_2_raw_json": BRONZE,
    f"{SILVER_DB}.ds1_invoice_lines": SILVER_DS1,
    f"{SILVER_DB}.ds2_invoice_lines": SILVER_DS2,
    f"{GOLD_DB}.dim_vendor": DIM_VENDOR,
    f"{GOLD_DB}.dim_buyer": DIM_BUYER,
    f"{GOLD_DB}.fact_invoice_line": FACT_INVOICE_LINE,
    f"{CONF_DB}.conf_data_source": CONF_DATA_SOURCE,
}
