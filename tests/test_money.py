"""Sums of money."""

from __future__ import annotations

from tallyspark.plans import analytics


def test_spend_is_summed_exactly(spark):
    lines = spark.range(200_000, numPartitions=4).selectExpr("date'2024-01-01' AS invoice_date", "90000000000.001D AS spend", "1L AS item_qty")
    # 200,000 times 90,000,000,000.001: a sum of floats is off by more than a cent
    assert analytics.kpi_formatted(lines).first().total_spend == "$18,000,000,000,000,200.00"
    assert analytics.kpi_totals(lines).first().total_spend == 18_000_000_000_000_200.0
    assert analytics.spend_by_date(lines).first().spend == 18_000_000_000_000_200.0


def test_amounts_beyond_decimals_still_count(spark):
    lines = spark.createDataFrame([(1e30, 1), (2.0, 1), (None, None)], "spend double, item_qty bigint")
    assert analytics.kpi_totals(lines).first().total_spend == 1e30
    assert analytics.kpi_formatted(lines).first().total_spend.startswith("$1,000,000,000,000,000,0")
