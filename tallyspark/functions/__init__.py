"""Column helpers: casts, JSON access, keys, text and dates, document parsing."""

from tallyspark.functions.dates import iso_weekday, month_abbr, weekday_name
from tallyspark.functions.documents import document_type, parse_documents, resolve_aliases, with_validity
from tallyspark.functions.scalars import (
    clean_money,
    file_name,
    has_document_suffix,
    invoice_key,
    json_array,
    json_scalar,
    line_spend,
    money_text,
    normalise_text,
    other_bucket,
    safe_date,
    safe_double,
    safe_int,
    safe_int_via_double,
    surrogate_key,
)

__all__ = [
    "clean_money", "document_type", "file_name", "has_document_suffix", "invoice_key",
    "iso_weekday", "json_array", "json_scalar", "line_spend", "money_text", "month_abbr",
    "normalise_text", "other_bucket", "parse_documents", "resolve_aliases", "safe_date",
    "safe_double", "safe_int", "safe_int_via_double", "surrogate_key", "weekday_name", "with_validity",
]
