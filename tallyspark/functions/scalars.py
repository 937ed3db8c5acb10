"""Scalar column helpers. Everything here stays inside the JVM.

Spark's ANSI mode raises on a dirty cast, so each cast is a ``try_cast``; and since Spark's
parsers accept a few spellings the warehouse rejects, each is guarded by the accepted pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
DATE_PATTERN = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
FLOAT_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
INT_PATTERN = r"^\s*[+-]?\d+\s*$"
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
DOCUMENT_SUFFIXES = (".jpg", ".jpeg", ".png", ".pdf")
OTHER_THRESHOLD = 10000.0


def _container(variant: Column) -> Column:
    """True for a variant holding an object or an array."""
    return F.schema_of_variant(variant).rlike("^(OBJECT|ARRAY)")


def json_scalar(json: Column, path: str) -> Column:
    """The scalar at ``path`` as text; NULL for missing, null, object and array.

    ``get_json_object`` prints objects and arrays too. A text may also begin with a bracket, so
    only such results pay for the typed look-up that tells the two apart.
    """
    text = F.get_json_object(json, path)
    typed = F.try_variant_get(F.try_parse_json(json), path, "variant")
    return F.when(text.rlike(r"^\s*[\[{]") & _container(typed), F.lit(None)).otherwise(text)


def json_array(json: Column, path: str) -> Column:
    """The elements at ``path`` as JSON texts (strings unquoted); NULL if it is not an array."""
    return F.from_json(F.get_json_object(json, path), "array<string>")


def safe_date(text: Column) -> Column:
    return F.when(text.rlike(DATE_PATTERN), F.trim(text).try_cast("date"))


def safe_double(text: Column) -> Column:
    return F.when(text.rlike(FLOAT_PATTERN), text.try_cast("double"))


def safe_int(text: Column) -> Column:
    """Whole numbers only: ``1.0`` gives NULL."""
    return F.when(text.rlike(INT_PATTERN), text.try_cast("bigint"))


def safe_int_via_double(text: Column) -> Column:
    """Through a float, rounding half away from zero; NULL for nan, inf and overflow.

    2**63 itself is tested for, since as a float it passes Spark's own overflow check.
    """
    rounded = F.round(safe_double(text))
    return F.when((rounded >= -(2.0**63)) & (rounded < 2.0**63), rounded.try_cast("bigint"))


def clean_money(text: Column) -> Column:
    """Drop every ``$`` and ``,``."""
    return F.translate(text, "$,", "")


def normalise_text(text: Column) -> Column:
    """Drop commas, strip Unicode white space from both ends, collapse inner runs to one space."""
    stripped = F.regexp_replace(
        F.replace(text, F.lit(","), F.lit("")), r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$", ""
    )
    return F.regexp_replace(stripped, r"[ \t\n\f\r]+", " ")


def line_spend(price: Column, qty: Column) -> Column:
    return F.round(price * qty, 3)


def surrogate_key(*parts: Column) -> Column:
    """Lower-case MD5 of the parts joined by ``-``, NULL spelled out.

    As in the original keys, a ``-`` inside a part is not escaped.
    """
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def invoice_key(*parts: tuple[Column, str]) -> Column:
    """Parts joined by ``-``, each with its own stand-in for NULL."""
    pieces: list[Column] = []
    for column, null_token in parts:
        pieces += [F.lit("-"), F.coalesce(column, F.lit(null_token))]
    return F.concat(*pieces[1:])


def other_bucket(spend: Column, name: Column, threshold: float = OTHER_THRESHOLD) -> Column:
    """``Other`` for a line below the threshold; a line without spend keeps its name."""
    return F.when(spend < threshold, F.lit("Other")).otherwise(name)


def money_text(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def has_document_suffix(path: Column, suffixes: tuple[str, ...] = DOCUMENT_SUFFIXES) -> Column:
    """Exact, case-sensitive suffix test."""
    test = F.lit(False)
    for suffix in suffixes:
        test = test | F.endswith(path, F.lit(suffix))
    return test
