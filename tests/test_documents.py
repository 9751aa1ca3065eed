from __future__ import annotations

import datetime as dt
import json
from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

import docstrata as ds
from docstrata.sources.documents import parsed_texts
from docstrata.spec import NOT_YET

SPEC = ds.delivery_spec()
ENGINES = ["typed", "variant"]


def document(dockets, **order) -> str:
    order = {"orderId": "o", "lineId": "1", **order}
    if dockets is not ...:
        order["dockets"] = dockets
    return json.dumps({"orders": [order]})


def ids(rows) -> list[str]:
    return sorted(str(r["DOCKET_ID"]) for r in rows.select("DOCKET_ID").collect())


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize(
    "text",
    [
        document([]),
        document(None),
        document(...),
        document(5),
        document({}),
        "{}",
        '{"orders": null}',
        '{"orders": 5}',
        "null",
        "[]",
        "[null]",
        "",
        "   ",
    ],
)
def test_nothing_to_flatten_gives_no_rows(raw, engine, text):
    assert ids(ds.flatten_documents(raw(text), SPEC, engine=engine)) == []


@pytest.mark.parametrize("engine", ENGINES)
def test_outer_array_gives_every_document(raw, engine):
    one, two = document([{"docketId": "a"}]), document([{"docketId": "b"}, {"docketId": "c"}])
    rows = ds.flatten_documents(raw(f" [{one}, {two}]", one), SPEC, engine=engine)
    assert ids(rows) == ["a", "a", "b", "c"]
    assert {r[0] for r in rows.select("document_pos").collect()} == {0, 1}


@pytest.mark.parametrize("engine", ENGINES)
def test_odd_spots_do_not_cost_their_neighbours(raw, engine):
    text = json.dumps(
        {
            "orders": [
                {"orderId": "w", "dockets": 7},
                9,
                {"orderId": "x", "siteAddress": "here", "dockets": [{"docketId": "k"}, None]},
            ]
        }
    )
    rows = ds.flatten_documents(raw(text), SPEC, engine=engine)
    assert ids(rows) == ["None", "k"]
    assert [r[0] for r in rows.select("SITE_LAT").collect()] == [None, None]


@pytest.mark.parametrize("engine", ENGINES)
def test_values(raw, engine):
    full = {
        "docketId": 5,
        "compliance": True,
        "deliveryQuantity": "12.3456785",
        "ratioOPC": 0.65,
        "ratioPFA": 0.4,
        "customerOrderId": "other case",
        "grade": None,
        "orderDate": "2026-03-19T09:41:43.287",
        "loadedTime": "2026-03-19T09:41:43+08:00",
        "siteArrivalTime": NOT_YET,
        "startDischargeTime": NOT_YET + ".000",
        "finishDischargeTime": "junk",
    }
    text = document([full], siteAddress={"lat": 22.123456789, "siteId": 3})
    row = ds.flatten_documents(raw(text), SPEC, engine=engine).first().asDict()
    assert row["DOCKET_ID"] == "5" and row["COMPLIANCE"] == "true"
    assert row["DELIVERY_QUANTITY"] == Decimal("12.345679")
    assert (row["RATIO_OPC"], row["RATIO_PFA"]) == (1, 0)
    assert row["SITE_LAT"] == Decimal("22.123456789") and row["SITE_ID"] == "3"
    assert row["CUSTOMER_ORDER_ID"] is None and row["GRADE"] is None
    assert row["ORDER_DATE"] == dt.datetime(2026, 3, 19, 9, 41, 43, 287000)
    assert row["LOADED_TIME"] == dt.datetime(2026, 3, 19, 9, 41, 43)
    assert row["SITE_ARRIVAL_TIME"] is None
    assert row["START_DISCHARGE_TIME"] == dt.datetime(1900, 1, 1)
    assert row["FINISH_DISCHARGE_TIME"] is None


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_and_lenient_numbers(spark, raw, engine, ansi):
    text = raw(document([{"docketId": "a", "deliveryQuantity": "abc", "ratioOPC": 2}]))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
            ds.flatten_documents(text, SPEC, engine=engine).collect()
        lenient = replace(SPEC, fields=tuple(replace(f, strict=False) for f in SPEC.fields))
        row = ds.flatten_documents(text, lenient, engine=engine).first()
        assert row["DELIVERY_QUANTITY"] is None and row["RATIO_OPC"] == 2
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


BAD = [
    '{"orders":[{"a":1}',
    '{"orders":[{"dockets":[{"docketId":"k"}',
    document([{"docketId": "k"}]) + " junk",
    document([{"docketId": "k"}]) + document([{"docketId": "l"}]),
    "[{}] x",
    "[" + document([{"docketId": "k"}]) + "]} {}",
    document([{"docketId": "k"}]) + '],"_end":"x"} {',
    "5",
    "[[{}]]",
    "[{}, 5]",
    '{"orders":[{"quantity":NaN}]}',
    "{'orders':[]}",
]


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("text", BAD)
def test_malformed_text_aborts_or_is_rejected(raw, engine, text):
    texts = raw(text, document([{"docketId": "good"}]))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ds.flatten_documents(texts, SPEC, engine=engine).collect()
    assert ids(ds.flatten_documents(texts, SPEC, "quarantine", engine)) == ["good"]
    assert [r["text"] for r in ds.rejected_documents(texts).collect()] == [text]


def test_engines_agree_on_the_whole(spark, raw):
    from docstrata.catalogue import delivery_documents
    from conftest import SF_DIR

    docs = delivery_documents(spark, SF_DIR)
    typed = ds.flatten_documents(docs, SPEC)
    assert same_rows(typed, ds.flatten_documents(docs, SPEC, engine="variant"))


def test_documents_are_parsed_once(raw):
    rows = ds.flatten_documents(raw(document([])), SPEC)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("engine", ENGINES)
def test_new_field_is_a_new_column(raw, engine):
    spec = SPEC.with_field(ds.FieldSpec("NEW_COLUMN", "newFieldPath", level=1))
    text = raw(document([{"docketId": "a", "newFieldPath": "n"}, {"docketId": "b"}]))
    rows = ds.flatten_documents(text, spec, engine=engine)
    assert sorted(map(tuple, rows.select("DOCKET_ID", "NEW_COLUMN").collect())) == [
        ("a", "n"),
        ("b", None),
    ]
    assert spec.master_schema().names[-2:] == ["NEW_COLUMN", "INGESTION_TS"]


def test_three_levels(raw):
    spec = ds.PipelineSpec(
        root="a",
        levels=("x.b", "c"),
        fields=(
            ds.FieldSpec("i", "i", "int"),
            ds.FieldSpec("j", "j", "int", level=1),
            ds.FieldSpec("k", "deep.k", "int", level=2),
        ),
        natural_key=("k",),
        view_key=("k",),
        version_key=("k",),
    )
    c = [{"deep": {"k": 3}}, {"deep": {"k": 4}}]
    text = json.dumps({"a": [{"i": 1, "x": {"b": [{"j": 2, "c": c}, {"j": 9, "c": []}]}}]})
    for engine in ENGINES:
        rows = ds.flatten_documents(raw(text), spec, engine=engine).select("i", "j", "k")
        assert sorted(map(tuple, rows.collect())) == [(1, 2, 3), (1, 2, 4)]


def test_spec_checks_itself():
    with pytest.raises(ValueError, match="unique"):
        SPEC.with_field(ds.FieldSpec("GRADE", "grade2", level=1))
    with pytest.raises(ValueError, match="level"):
        SPEC.with_field(ds.FieldSpec("X", "x", level=2))
    with pytest.raises(ValueError, match="without a field"):
        replace(SPEC, natural_key=("NOPE",))


def test_master_schema(spark):
    schema = SPEC.master_schema()
    assert len(schema) == 32 and schema.names[0] == "PROJECT_ID"
    assert not schema["INGESTION_TS"].nullable
    assert schema["RATIO_OPC"].dataType.simpleString() == "decimal(38,0)"


def test_flatten_variants(spark):
    rows = spark.sql(
        """SELECT id, parse_json(j) AS v FROM VALUES
        (1, '[1,null]'), (2, '[]'), (3, 'null'), (4, '7'), (5, NULL) AS t(id, j)"""
    )
    flat = ds.flatten(rows, "v", "e").select("id", "e_pos", F.col("e").cast("int").alias("e"))
    assert sorted(map(tuple, flat.collect())) == [(1, 0, 1), (1, 1, None)]
    objects = spark.sql("""SELECT 1 AS id, parse_json('{"a": 1, "b": null}') AS v""")
    pairs = ds.flatten_object(objects, "v").select("key", F.col("value").cast("string"))
    assert sorted(map(tuple, pairs.collect())) == [("a", "1"), ("b", None)]


def test_to_key_value_keeps_nulls_and_mixed_types(spark):
    rows = spark.sql("SELECT 1 AS id, 2.50BD AS n, CAST(NULL AS STRING) AS s, DATE'2026-01-02' AS d")
    assert sorted(map(tuple, ds.to_key_value(rows, ["id"]).collect())) == [
        (1, "d", "2026-01-02"),
        (1, "n", "2.50"),
        (1, "s", None),
    ]


@pytest.mark.parametrize("engine", ENGINES)
@pytest.mark.parametrize("before", ["", "\n", "\t", "\r\n", " ", "\ufeff", "\ufeff\n"])
def test_nothing_before_a_document_hides_it(raw, engine, before):
    one = document([{"docketId": "a"}])
    for on_error in ("abort", "quarantine"):
        texts = raw(before + one, before + "[" + one + ", null]")
        assert ids(ds.flatten_documents(texts, SPEC, on_error, engine)) == ["a", "a"]
        assert ds.rejected_documents(texts).isEmpty()


VALUES = [
    '"12,5"', '"1,234.5"', "{}", '{"z":1,"a":2}', "[]", "[1]", "1.50", "1e2", '" 7 "', '""', "1" * 30, "true", "null",
    '"09:41:43"', '"2026-03-19"', '"2026-03-19T09:41:43"', '"abc"', "0.1", "-0", "1e400", "12345678901234567.891",
]


@pytest.mark.parametrize("strict", [True, False])
def test_engines_agree_on_every_value(raw, strict):
    spec = replace(SPEC, fields=tuple(replace(f, strict=strict) for f in SPEC.fields))
    names = {"string": "docketId", "decimal(18,6)": "deliveryQuantity", "decimal(38,0)": "ratioOPC", "time": "orderDate"}

    def outcome(text, engine):
        try:
            return ds.flatten_documents(raw(text), spec, engine=engine).collect()
        except Exception as error:  # noqa: BLE001
            return str(getattr(error, "getCondition", lambda: None)() or "error").split(".")[0]

    for name in names.values():
        for odd in (False, True) if name == "docketId" else (False,):
            for value in VALUES:
                site = '"siteAddress":"odd",' if odd else ""
                text = '{"orders":[{"orderId":"o",%s"dockets":[{"%s":%s}]}]}' % (site, name, value)
                assert outcome(text, "typed") == outcome(text, "variant"), (name, value)


def test_an_object_in_a_text_field_is_one_key(raw):
    plain = '{"orders":[{"orderId":{"z":1,"a":2},%s"dockets":[{"docketId":"d"}]}]}'
    rows = ds.flatten_documents(raw(plain % "", plain % '"siteAddress":"odd",'), SPEC)
    assert {r[0] for r in rows.select("ORDER_ID").collect()} == {'{"a":2,"z":1}'}


def test_a_comma_is_no_number(raw):
    text = document([{"docketId": "a"}], quantity="12,5")
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        ds.flatten_documents(raw(text), SPEC).collect()


def test_rejects_are_found_by_one_parse_of_a_text_made_once(spark):
    from conftest import SF_DIR

    from docstrata.catalogue import delivery_documents

    docs = delivery_documents(spark, SF_DIR)
    docs = docs.withColumn("text", F.when(F.col("text").contains("x"), "y").otherwise(F.col("text")))
    plan = ds.rejected_documents(docs).agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 1
    assert plan.lower().count("parsejson") == 1


ODD_LEAVES = [
    "1.50",
    "1e400",
    "1e2",
    "12.3456784999999999999",
    "12345678901234567890.5e0",
    "-0",
    "0.10",
    "123456789012345678901234567890",
    "1.0000000000000000000000000000000000000000001",
    "true",
    "false",
    "null",
    '{"b": 1, "a": [1, 2.50]}',
    "[1.0]",
    '"1.50"',
    '"-0"',
    '"{x"',
    '"a\\nb"',
    '"12\\n13"',
    '"12\\n"',
    '""',
    '" 7 "',
    '"2026-03-19T09:41:43.5"',
    "2026",
]


def test_a_leaf_read_as_text_is_what_its_variant_is(raw):
    names = ("docketId", "mixId", "orderDate", "loadedTime", "deliveryQuantity", "ratioOPC")
    fields = (
        *(f for f in SPEC.fields if f.level == 1 and f.path in names),
        *(f for f in SPEC.fields if f.name in SPEC.natural_key or f.name in SPEC.view_key and f.level == 0),
        ds.FieldSpec("SAME_TEXT", "mixId", level=1),
        ds.FieldSpec("TWO_WAYS", "ratioOPC", level=1),
        ds.FieldSpec("EPOCH", "epoch", "timestamp_ntz", level=1, format="epoch_seconds"),
        ds.FieldSpec("UNLESS", "mixId", sentinels=("1.5",), level=1),
    )
    fields = {f.name: replace(f, strict=False) for f in fields}
    spec = replace(SPEC, fields=tuple(fields.values()))
    form = '{"orders":[{"orderId":"o"},{"orderId":"o","dockets":[null,{"docketId":"k","%s":%s}]}]}'
    for name in ("mixId", "orderDate", "deliveryQuantity", "ratioOPC", "epoch"):
        texts = raw(*(form % (name, leaf) for leaf in ODD_LEAVES))
        typed, variant = (ds.flatten_documents(texts, spec, engine=e) for e in ENGINES)
        assert sorted(map(str, typed.collect())) == sorted(map(str, variant.collect())), name


def test_texts_need_no_variants(raw):
    """A leaf that is read as text is kept as text, also where a number is delivered."""
    parsed = parsed_texts(raw(document([{"docketId": 5, "deliveryQuantity": 1.5}])), SPEC)
    docket = parsed.select(F.col("_docs")[0]["orders"][0]["dockets"][0].alias("k")).schema["k"].dataType
    kinds = {f.name: f.dataType.simpleString() for f in docket}
    assert (kinds["docketId"], kinds["orderDate"], kinds["deliveryQuantity"]) == ("string", "string", "variant")


def test_the_text_is_cleaned_and_marked_once(raw):
    parsed = parsed_texts(raw('{"orders": []}'), SPEC).drop("text")
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    reader = plan.split("from_json(")[1].split(" AS _parsed")[0]
    assert "md5" not in reader and plan.count("md5(cast(_text") == 1
