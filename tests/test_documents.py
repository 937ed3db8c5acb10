import json

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import json_array, json_scalar, parse_documents, resolve_aliases, with_validity
from tallyspark.operators import unnest_items
from tallyspark.sources.registry import DS1, DS2, route, source_spec

GOOD = {"header": {"client": "C", "invoice_date": "2020-01-02"}, "items": [{"item_desc": "a", "item_qty": "1"}],
        "summary": {"order_id": "O1"}}
ODD = [
    GOOD,
    {**GOOD, "header": {"client": {"name": "C"}}},
    {**GOOD, "header": {"client": ["C"]}},
    {**GOOD, "header": {"client": "{C}", "client_address": "[1]"}},
    {**GOOD, "header": "text"},
    {**GOOD, "header": None},
    {**GOOD, "items": []},
    {**GOOD, "items": None},
    {**GOOD, "items": {"item_desc": "a"}},
    {**GOOD, "items": "text"},
    {**GOOD, "items": [{"item_desc": "a"}, 3, None, "text", [1], {"item_desc": {"x": 1}, "item_rate": "$1"}]},
    {**GOOD, "items": [{"item_desc": 12, "item_qty": True}]},
    {"items": [{"item_desc": "a"}]},
    {**GOOD, "items": ['{"item_desc": "text that holds JSON"}']},
    "just text",
    [GOOD],
    7,
]


def expected(document):
    """Field by field, as path look-ups that yield scalars only."""
    def scalar(holder, name):
        value = holder.get(name) if isinstance(holder, dict) else None
        if value is None or isinstance(value, (dict, list)):
            return None
        return {True: "true", False: "false"}[value] if isinstance(value, bool) else str(value)

    sections = document if isinstance(document, dict) else {}
    items = sections.get("items")
    return (
        tuple(scalar(sections.get("header"), f) for f in DS2.header),
        [tuple(scalar(i, f) for f in DS2.items) for i in items] if isinstance(items, list) else None,
        tuple(scalar(sections.get("summary"), f) for f in DS2.summary),
    )


def flat(row):
    """Structs as tuples; a missing section or item is one of NULL leaves."""
    header, items, summary = row
    return (
        tuple(header or [None] * len(DS2.header)),
        None if items is None else [tuple(i or [None] * len(DS2.items)) for i in items],
        tuple(summary or [None] * len(DS2.summary)),
    )


def test_parse_documents_equals_path_lookups(spark):
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(ODD)], "i int, raw string")
    got = parse_documents(rows, "raw", DS2).orderBy("i").select("document.*").collect()
    assert [flat(r) for r in got] == [expected(d) for d in ODD]


def test_parse_documents_of_nested_root(spark):
    rows = spark.createDataFrame([(json.dumps({"gt_parse": {"header": {"iban": "I"}, "items": [{"item_vat": "v"}]}}),),
                                  ("{broken",), (None,)], "raw string")
    got = parse_documents(rows, "raw", DS1).select("document.header.iban", "document.items.item_vat").collect()
    assert [tuple(r) for r in got] == [("I", ["v"]), (None, None), (None, None)]


def test_documents_are_parsed_once_per_row(spark):
    rows = spark.createDataFrame([(json.dumps(GOOD),)], "raw string")
    fields = parse_documents(rows, "raw", DS2, "d").select("d.header.*", "d.summary.*", "d.items")
    plan = fields._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(header") == 1


@pytest.mark.parametrize("labels,value", [
    ({"Client": "x", "Buyer": "y"}, "y"), ({"Client": "x"}, "x"), ({"Buyer": None, "Client": "x"}, None),
    ({"Seller": "x"}, None), ({"client": "x"}, None), ({"Customer": "z"}, "z"),
])
def test_first_present_alias_wins(spark, labels, value):
    rows = spark.createDataFrame([(labels,)], "m map<string,string>")
    assert rows.select(resolve_aliases(F.col("m"), DS1.header["client"])).first()[0] == value


def test_is_valid(spark):
    verdicts = [
        (GOOD, True), ({"header": {}, "items": [], "summary": {}}, True),
        ({**GOOD, "summary": {"discount": None}}, True), ({**GOOD, "summary": {"discount": 3}}, False),
        ({**GOOD, "items": [{"item_desc": 3}]}, False), ({**GOOD, "items": ["x"]}, False),
        ({**GOOD, "items": {}}, False), ({**GOOD, "header": None}, False), ({"header": {}, "items": []}, False),
        ("text", False), ([GOOD], False),
    ]
    rows = spark.createDataFrame([(json.dumps(d), v) for d, v in verdicts] + [("{broken", False), (None, False)],
                                 "raw string, verdict boolean")
    checked = with_validity(rows, "raw", DS2)
    assert checked.filter(F.col("valid") != F.col("verdict")).count() == 0
    assert checked._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1


def test_unnest_drops_documents_without_items(spark):
    rows = spark.createDataFrame(
        [(1, '{"i":[{"a":1},null,"t"]}'), (2, '{"i":[]}'), (3, "{}"), (4, '{"i":{}}'), (5, None)], "k int, raw string")
    got = unnest_items(rows, "raw", "$.i").select("k", "pos", "item").collect()
    assert [tuple(r) for r in got] == [(1, 0, '{"a":1}'), (1, 1, None), (1, 2, "t")]


def test_unregistered_source_fails(spark):
    with pytest.raises(ValueError):
        source_spec(3)
    files = spark.createDataFrame([(1,), (2,)], "source_id int")
    assert {tuple(r) for r in route(files).select("bucket", "model_name").collect()} == {
        ("ds1", "InvoiceDocument_DS1"), ("ds2", "InvoiceDocument_DS2")}
    with pytest.raises(Exception, match="no document model registered for data source 3"):
        route(spark.createDataFrame([(3,)], "source_id int")).collect()


def test_helpers_agree_on_text_documents(spark):
    rows = spark.createDataFrame([('"text"',)], "raw string")
    assert rows.select(json_scalar(F.col("raw"), "$.a"), json_array(F.col("raw"), "$.a")).first() == (None, None)
