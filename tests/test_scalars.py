import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tallyspark import functions as fn


def apply(spark, values, column, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[1] for r in rows.select("i", column(F.col("x"))).orderBy("i").collect()]


def test_safe_date(spark):
    texts = ["2021-3-4", "2021-02-30", "2021", "2021-3", "2021-03-04 junk", "03/04/2021", "Mar 06 2012", "", None]
    assert apply(spark, texts, fn.safe_date) == [dt.date(2021, 3, 4)] + [None] * 8


def test_safe_double(spark):
    texts = ["1.5", " 1.5 ", "1e3", "-.5", "1.5d", "0x1p3", "1,5", "", None, "inf", "-Infinity", "NaN"]
    got = apply(spark, texts, fn.safe_double)
    assert got[:9] == [1.5, 1.5, 1000.0, -0.5, None, None, None, None, None]
    assert got[9] == math.inf and got[10] == -math.inf and math.isnan(got[11])


def test_safe_int_takes_whole_numbers_only(spark):
    texts = ["1", "1.0", "+3", "9223372036854775807", "9223372036854775808", "", None]
    assert apply(spark, texts, fn.safe_int) == [1, None, 3, 2**63 - 1, None, None, None]


def test_safe_int_via_double_rounds_half_away_from_zero(spark):
    texts = ["1.0", "2.5", "-2.5", "0.5", "1e30", "9223372036854775808", "-9223372036854775808", "nan", "inf", "x", None]
    assert apply(spark, texts, fn.safe_int_via_double) == [1, 3, -3, 1, None, None, -(2**63), None, None, None, None]


def test_clean_money(spark):
    assert apply(spark, ["$1,234.50", "$", "1,2,3", None], fn.clean_money) == ["1234.50", "", "123", None]


def test_normalise_text(spark):
    texts = ["  a,  b ", "\ta\t\tb\n", " a b ", ", a ,", "", None]
    assert apply(spark, texts, fn.normalise_text) == ["a b", "a b", "a b", "a", "", None]


@pytest.mark.parametrize("document,expected", [
    ('{"a": "x"}', "x"), ('{"a": 7}', "7"), ('{"a": true}', "true"), ('{"a": null}', None), ('{"b": 1}', None),
    ('{"a": {"b": 1}}', None), ('{"a": [1]}', None), ('{"a": "{text"}', "{text"), ('{"a": "[1]"}', "[1]"),
    ('"only text"', None), ("{broken", None), (None, None),
])
def test_json_scalar(spark, document, expected):
    assert apply(spark, [document], lambda c: fn.json_scalar(c, "$.a")) == [expected]


def test_json_array(spark):
    texts = ['{"a":[{"x":1},3,null,"t",[1]]}', '{"a":[]}', '{"a":{"x":1}}', '{"a":"t"}', '{"a":null}', "{}", None]
    assert apply(spark, texts, lambda c: fn.json_array(c, "$.a")) == [
        ['{"x":1}', "3", None, "t", "[1]"], [], None, None, None, None, None]


def test_surrogate_key(spark):
    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    rows = spark.createDataFrame([("a", "b"), (None, "b"), ("a-b", "c"), ("a", "b-c")], "x string, y string")
    got = [r[0] for r in rows.select(fn.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert got == [md5("a-b"), md5("_dbt_utils_surrogate_key_null_-b"), md5("a-b-c"), md5("a-b-c")]
    constant = spark.range(1).select(fn.surrogate_key(F.lit("ds2-superstore-vendor"), F.lit("2"))).first()[0]
    assert constant == "5a0938ef696e84647d74dc642e231311"


def test_invoice_key_spells_out_nulls(spark):
    rows = spark.createDataFrame([("1", None), (None, "2")], "x string, y string")
    key = fn.invoice_key((F.col("x"), "nox"), (F.col("y"), "noy"))
    assert [r[0] for r in rows.select(key).collect()] == ["1-noy", "nox-2"]


def test_line_spend_and_other_bucket(spark):
    rows = spark.createDataFrame([(1.0005, 1), (2.5, None)], "p double, q bigint")
    assert [r[0] for r in rows.select(fn.line_spend(F.col("p"), F.col("q"))).collect()] == [1.001, None]
    assert apply(spark, [9999.99, 10000.0, None], lambda c: fn.other_bucket(c, F.lit("name")), "double") == [
        "Other", "name", "name"]


def test_date_parts(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(400)]
    got = apply(spark, days, lambda c: F.struct(fn.month_abbr(c), fn.weekday_name(c), fn.iso_weekday(c)), "date")
    assert [tuple(g) for g in got] == [(d.strftime("%b"), d.strftime("%A"), d.isoweekday()) for d in days]


def test_file_names(spark):
    paths = ["a/b/c.pdf", "c.PDF", "x/y.jpeg", "z.txt", "q.pdf.bak"]
    assert apply(spark, paths, fn.file_name) == ["c.pdf", "c.PDF", "y.jpeg", "z.txt", "q.pdf.bak"]
    assert apply(spark, paths, fn.has_document_suffix) == [True, False, True, False, False]


def test_money_text(spark):
    assert apply(spark, [1234.5, 0.0, None], fn.money_text, "double") == ["$1,234.50", "$0.00", None]
