"""Cases with known answers for the resolver, DDL columns, types and titles."""

import json

import pytest
from pyspark.sql import functions as F

from schemaward import constants as K
from schemaward.functions.ddl import ddl_columns
from schemaward.functions.text import clean_text, label_value, title_variants
from schemaward.functions.types import resolve_types
from schemaward.operators import resolver as R


def _raw(spark, doc: dict, extra=()):
    rows = [(i, k, v if isinstance(v, str) else json.dumps(v)) for i, (k, v) in enumerate([*doc.items(), *extra])]
    return spark.createDataFrame(rows, "entry_ord long, entry_key string, entry_json string")


def _rules(spark, doc, extra=()):
    return sorted(r.rule for r in R.validate_resolver(_raw(spark, doc, extra)).collect())


GOOD = {"aliases": ["first", "Second"], "defaults": {"environments": ["dev", "QA"], "fqdn": "lake.core.orders"},
        "specific_environments": {"prod": {"fqdn": "live.core.orders_v", "object_type": "view"}}}


def test_valid_map(spark):
    raw = _raw(spark, {"Orders": GOOD})
    got = {tuple(r) for r in R.load_resolver(raw).collect()}
    assert got == {(n, *t) for n in ("ORDERS", "FIRST", "SECOND") for t in (
        ("DEV", "LAKE.CORE.ORDERS", "TABLE"), ("QA", "LAKE.CORE.ORDERS", "TABLE"), ("PROD", "LIVE.CORE.ORDERS_V", "VIEW"))}
    assert R.validate_resolver(raw).count() == 0


def test_specific_overrides_default(spark):
    doc = {"x": {"defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}, "specific_environments": {"dev": {"fqdn": "p.q.r"}}}}
    assert [tuple(r) for r in R.load_resolver(_raw(spark, doc)).collect()] == [("X", "DEV", "P.Q.R", "TABLE")]


@pytest.mark.parametrize("doc, extra, rules", [
    ({"ITEM": GOOD}, [("item", GOOD)], ["V6"]),
    ({"A": {"aliases": ["same"], "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}},
      "B": {"aliases": ["SAME"], "defaults": {"environments": ["DEV"], "fqdn": "a.b.d"}}}, [], ["V7"]),
    ({"A": {"aliases": ["same"], "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}},
      "B": {"aliases": ["SAME"], "defaults": {"environments": ["dev"], "fqdn": "A.B.C"}}}, [], []),
    ({"A": {"defaults": {"environments": ["DEV"]}}}, [], ["V2"]),
    ({"A": {"defaults": {"environments": ["DEV"], "fqdn": "db.only"}}}, [], ["V3"]),
    ({"A": {"defaults": {"fqdn": "a.b.c"}}}, [], ["V2"]),
    ({"A": {"aliases": ["b"]}}, [], ["V5"]),
    ({"A": "not an object"}, [], ["V1"]),
    ({"A": {"aliases": "b", "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}}}, [], ["V8"]),
    ({"A": {"aliases": ["b", 3], "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}}}, [], ["V8"]),
    ({"A": {"specific_environments": {"DEV": {}}}}, [], ["V4"]),
    ({"A": {"aliases": ["b"], "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}},
      "B": {"defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}}}, [], ["V6"]),
    ({"A": {"aliases": ["a"], "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}}}, [], []),
])
def test_resolver_rules(spark, doc, extra, rules):
    assert _rules(spark, doc, extra) == rules


LONG = "create table lake.notes (body text default '" + "it''s, (long) " * 9000 + "', size int)"
WIDE = "create table wide (" + ", ".join(f"f{i} decimal({i % 30 + 1}, 2) default round(power({i}, 2), 1)" for i in range(5000)) + ")"
CASES = [
    ('create or alter table "Plant 7"."Read, (ings)" ("Probe No" char(4), "a,b (c" real not null, "in""ch" float)', ["PROBE NO CHAR(4)", "A,B (C REAL", 'IN"CH FLOAT']),
    ("create temp table t (a int, -- left, over int\n b date /* c, d int\n */, e bigint)", ["A INT", "B DATE", "E BIGINT"]),
    ("create local temporary table if not exists t (a double precision, b timestamp ( 6 ) with time zone, c character  varying(7), d time without time zone)",
     ["A DOUBLE PRECISION", "B TIMESTAMP(6) WITH TIME ZONE", "C CHARACTER VARYING(7)", "D TIME WITHOUT TIME ZONE"]),
    ("create table t (a int default greatest(1, least(2, abs(-3))), b numeric( 5 ,1 ), check (a > (b + (1))), unique (a, b)) cluster by (a, b) comment = 'x)'",
     ["A INT", "B NUMERIC(5,1)"]),
    ("create transient table s.t(only_one boolean)", ["ONLY_ONE BOOLEAN"]),
    (LONG, ["BODY TEXT", "SIZE INT"]),
    (WIDE, [f"F{i} DECIMAL({i % 30 + 1},2)" for i in range(5000)]),
    ("create table deep (a int default " + "(" * 500 + "1, 2" + ")" * 500 + ", b date, check (" + "f(x, (" * 40 + "1" + "))" * 40 + "))", ["A INT", "B DATE"]),
    ('create table q ("' + 'x""' * 500 + '" int, """first" real, "two  blanks" date, "a/*b*/--c\'d" time)', ["X\"" * 500 + " INT", '"FIRST REAL', "TWO  BLANKS DATE", "A/*B*/--C'D TIME"]),
    ("create materialized view v (a) as select (1)", []), ("create table t as select f(a int) from u", []), ("create table t (a int", []),
    ("alter table t add (a int)", []), ("", []), (None, []),
]


@pytest.mark.parametrize("ddl, columns", CASES)
def test_ddl_columns(spark, ddl, columns):
    df = ddl_columns(spark.createDataFrame([(1, ddl)], "id int, ddl string"))
    got = df.orderBy("ordinal").collect()
    assert [f"{r.name} {r.type}" for r in got] == columns
    assert [r.ordinal for r in got] == list(range(1, len(columns) + 1))


@pytest.mark.parametrize("declared, resolved, category", [
    ("VARCHAR(128)", "VARCHAR(128)", "MAPPED"), ("varchar ( 12 )", "VARCHAR(12)", "MAPPED"), ("Float or Number", "NUMBER(38,0)", "MAPPED"),
    ("BIGINT", "NUMBER(38,0)", "MAPPED"), ("integer", "NUMBER(38,0)", "MAPPED"), ("NUMBER(38, 2)", "NUMBER(38,2)", "MAPPED"),
    ("bool", "BOOLEAN", "MAPPED"), ("timestamp", "TIMESTAMP_LTZ", "MAPPED"), ("decimal", "NUMBER(38,0)", "MAPPED"),
    ("VARCHAR(12", K.DEFAULT_TYPE, "MALFORMED"), ("money", K.DEFAULT_TYPE, "MALFORMED"), ("FLOAT", K.DEFAULT_TYPE, "UNMAPPED"),
    ("DATETIME", K.DEFAULT_TYPE, "UNMAPPED"), ("double precision", K.DEFAULT_TYPE, "UNMAPPED"),
    ("", K.DEFAULT_TYPE, "MISSING"), (None, K.DEFAULT_TYPE, "MISSING"),
])
def test_declared_types(spark, declared, resolved, category):
    types = spark.createDataFrame(list(K.DEFAULT_TYPE_MAP.items()), "declared_type string, warehouse_type string")
    row = resolve_types(spark.createDataFrame([(declared,)], "data_type string"), types).first()
    assert (row.resolved_type, row.type_category) == (resolved, category)


@pytest.mark.parametrize("title, variants", [
    ("Table: X", ["Table: X", "Table:X", "Table : X"]),
    ("Table : X", ["Table : X", "Table: X", "Table:X"]),
    ("Table:X", ["Table:X", "Table : X"]),
    ("  Table:  X ", ["  Table:  X ", "Table: X", "Table:X", "Table : X"]),
    ("Plain", ["Plain"]),
    ("Two words", ["Two words", "Twowords"]),
])
def test_title_variants(spark, title, variants):
    got = spark.createDataFrame([(title,)], "t string").select(title_variants(F.col("t")).alias("v")).first().v
    assert got == variants


def test_cleaning_and_labels(spark):
    df = spark.createDataFrame([("  naïve café \n x_y-z.1 ", "a Database name: LAKE Historization: SCD-2", None)], "a string, b string, c string")
    row = df.select(clean_text(F.col("a")).alias("a"), label_value(F.col("b"), "Database name:").alias("b"),
                    label_value(F.col("c"), "Table name:").alias("c"), label_value(F.col("b"), "Schema name:").alias("d")).first()
    assert tuple(row) == ("na ve caf x_y-z.1", "LAKE", None, None)


def test_string_entries_stay_strings(spark, tmp_path):
    from schemaward.sources.inputs import document_faults, read_resolver_raw, read_type_map
    (tmp_path / "a.json").write_text(json.dumps({"A": json.dumps({"defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}}), "B": {"aliases": ["x"]}}))
    raw = read_resolver_raw(spark, str(tmp_path / "a.json"))
    assert sorted(r.rule for r in R.validate_resolver(raw).where("key = 'A'").collect()) == ["V1"]
    (tmp_path / "b.json").write_text('{"A": 1')
    (tmp_path / "c.json").write_text('["A"]')
    got = {r.path[-6:]: r.reason for r in document_faults(spark, str(tmp_path)).collect()}
    assert got == {"b.json": "not JSON", "c.json": "not a JSON object"}
    (tmp_path / "t.json").write_text('{"num": "VARCHAR", "NUM": "NUMBER", "x": " "}')
    assert [tuple(r) for r in read_type_map(spark, str(tmp_path / "t.json")).collect()] == [("NUM", "NUMBER")]


def test_earlier_entries_are_judged_over_documents(spark):
    entry = json.dumps({"aliases": ["B"], "defaults": {"environments": ["DEV"], "fqdn": "a.b.c"}})
    rows = [("doc1", 5, "A", entry), ("doc2", 0, "B", entry)]
    raw = spark.createDataFrame(rows, "path string, entry_ord long, entry_key string, entry_json string")
    assert "V6" in {r.rule for r in R.validate_resolver(raw).collect()}
