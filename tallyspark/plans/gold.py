"""The star schema: each source mapped to shared columns, then united."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions import line_spend, surrogate_key
from tallyspark.operators.dedup import latest_per_key
from tallyspark.schemas import DIM_BUYER, DIM_VENDOR, FACT_INVOICE_LINE


@dataclass(frozen=True)
class Party:
    """Columns of a silver table that name and identify a buyer or vendor by tax id."""

    name: str
    tax_id: str


# Which role each party of a source-1 document plays: the document's client is the vendor.
DS1_VENDOR = Party("client", "client_tax_id")
DS1_BUYER = Party("seller", "seller_tax_id")

# All documents of source 2 come from one vendor.
DS2_VENDOR_NO, DS2_VENDOR_NAME = "ds2-superstore-vendor", "SuperStore"
DS2_VENDOR_ADDRESS = "Ozark Highlands Road, St. Louis"


def _tax_key(party: Party) -> Column:
    """NULL where the tax id is."""
    return F.concat(F.col(party.tax_id), F.lit("-"), F.lit("1"))


def _ds2_vendor_key() -> Column:
    return surrogate_key(F.lit(DS2_VENDOR_NO), F.lit("2"))


def _ds2_buyer_key() -> Column:
    return surrogate_key(F.lit("2"), F.col("client"), F.col("client_address"))


def _ds1_parties(s1: DataFrame, party: Party, role: str) -> DataFrame:
    """One row per tax id with its first name in sort order, where NULL comes first.

    Names are reduced before the shuffle, so a tax id on most lines is no burden.
    """
    name = F.col(party.name)
    first = F.when(F.count(name) < F.count(F.lit(1)), F.lit(None)).otherwise(F.min(name))
    return s1.groupBy(party.tax_id).agg(first.alias(f"{role}_desc")).select(
        F.lit("1").alias("data_source_id"),
        _tax_key(party).alias(f"{role}_no_id"),
        F.col(party.tax_id).alias(f"{role}_no"),
        f"{role}_desc",
        F.lit("").alias(f"{role}_address"),
    )


def _ds2_buyers(s2: DataFrame) -> DataFrame:
    return s2.select("client", "client_address").distinct().select(
        F.lit("2").alias("data_source_id"),
        _ds2_buyer_key().alias("buyer_no_id"),
        surrogate_key(F.col("client"), F.col("client_address")).alias("buyer_no"),
        F.col("client").alias("buyer_desc"),
        F.col("client_address").alias("buyer_address"),
    )


def _ds2_vendor(s2: DataFrame) -> DataFrame:
    """The one constant member, present if the source has any line."""
    return s2.select(F.lit(1)).limit(1).select(
        F.lit("2").alias("data_source_id"),
        _ds2_vendor_key().alias("vendor_no_id"),
        F.lit(DS2_VENDOR_NO).alias("vendor_no"),
        F.lit(DS2_VENDOR_NAME).alias("vendor_desc"),
        F.lit(DS2_VENDOR_ADDRESS).alias("vendor_address"),
    )


def _one_per_line(lines: DataFrame, first: str) -> DataFrame:
    """One row of each line key, the first by the named column.

    Silver keys are unique as a rule. Whether they are is seen from eight bytes a row, and only if any repeats are
    whole rows shuffled to compare them. Two keys with one hash would cost that shuffle, nothing else.
    """
    key = "unique_invoice_line_no"
    if lines.groupBy(F.xxhash64(key).alias("key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        return lines
    return latest_per_key(lines, [key], [first, *_others(lines, key, first)])


def _ds1_facts(s1: DataFrame) -> DataFrame:
    rows = _one_per_line(s1, "client")
    return rows.select(
        surrogate_key(F.lit(1), F.col("unique_invoice_line_no")).alias("row_id"),
        F.lit("1").alias("data_source_id"),
        "unique_invoice_line_no", "unique_invoice_no",
        _tax_key(DS1_VENDOR).alias("vendor_no_id"),
        _tax_key(DS1_BUYER).alias("buyer_no_id"),
        line_spend(F.col("item_net_price"), F.col("item_qty")).alias("spend"),
        "iban", "invoice_date", "invoice_no", "item_desc", "item_net_price", "item_qty",
    )


def _ds2_facts(s2: DataFrame) -> DataFrame:
    """Spend leaves out discount and shipping, to mean the same for all sources."""
    rows = _one_per_line(s2, "item_rate")
    return rows.select(
        surrogate_key(F.lit(2), F.col("unique_invoice_line_no")).alias("row_id"),
        F.lit("2").alias("data_source_id"),
        "unique_invoice_line_no", "unique_invoice_no",
        _ds2_vendor_key().alias("vendor_no_id"),
        _ds2_buyer_key().alias("buyer_no_id"),
        line_spend(F.col("item_rate"), F.col("item_qty")).alias("spend"),
        F.lit("").alias("iban"), "invoice_date",
        F.col("order_id").alias("invoice_no"), "item_desc",
        F.col("item_rate").alias("item_net_price"), "item_qty",
    )


def _others(df: DataFrame, *names: str) -> list[str]:
    """Remaining columns, to break ties in a fixed way."""
    return [c for c in df.columns if c not in names]


# source id -> mapping of its silver table. A new source adds one entry to each.
VENDORS = {1: lambda s: _ds1_parties(s, DS1_VENDOR, "vendor"), 2: _ds2_vendor}
BUYERS = {1: lambda s: _ds1_parties(s, DS1_BUYER, "buyer"), 2: _ds2_buyers}
FACTS = {1: _ds1_facts, 2: _ds2_facts}


def _united(mappings: Mapping, silver: Mapping[int, DataFrame], columns: list[str]) -> DataFrame:
    parts = [mappings[source_id](df).select(*columns) for source_id, df in sorted(silver.items())]
    return reduce(DataFrame.unionByName, parts)


def dim_vendor(silver: Mapping[int, DataFrame]) -> DataFrame:
    return _united(VENDORS, silver, DIM_VENDOR.names)


def dim_buyer(silver: Mapping[int, DataFrame]) -> DataFrame:
    return _united(BUYERS, silver, DIM_BUYER.names)


def fact_invoice_line(silver: Mapping[int, DataFrame]) -> DataFrame:
    return _united(FACTS, silver, FACT_INVOICE_LINE.names)


def star(silver: Mapping[int, DataFrame]) -> dict[str, DataFrame]:
    """The three gold tables from silver tables given by source id."""
    return {
        "dim_vendor": dim_vendor(silver),
        "dim_buyer": dim_buyer(silver),
        "fact_invoice_line": fact_invoice_line(silver),
    }
