"""Column mapping over runs, keyed state, sources and sinks."""

import pytest
from pyspark.sql import functions as F

from schemaward import constants as K
from schemaward import schemas as S
from schemaward.functions.hashing import ddl_hash
from schemaward.operators import matching, merge, parity
from schemaward.plans import jobs
from schemaward.workload.inputs import ENVIRONMENTS
from schemaward.sources import inputs, outputs

SPECS = ("page_id long, row_ord long, source_table string, source_field_name string, target_field_name string, data_type string, "
         "add_source_to_target string, is_primary_key string, definition string, comments string")


def _specs(spark, *rows):
    return spark.createDataFrame([(1, i, "src", s, t, "varchar(8)", " YES ", "yes", "", "") for i, (s, t) in enumerate(rows)], SPECS)


def _inputs(spark, ddls):
    resolver = spark.createDataFrame([("SRC", env, f"D.S.{env}", "TABLE") for env in ddls], "source_name string, env string, fqdn string, object_type string")
    state = spark.createDataFrame([(f"D.S.{env}", env, "TABLE", ddl) for env, ddl in ddls.items()],
                                  "fqdn string, env string, object_type string, current_ddl string").withColumn("current_ddl_hash", ddl_hash(F.col("current_ddl")))
    types = spark.createDataFrame(list(K.DEFAULT_TYPE_MAP.items()), "declared_type string, warehouse_type string")
    names = spark.createDataFrame([(1, "Page")], "page_id long, page_title string")
    return names, resolver, ENVIRONMENTS, state, types


def _run(spark, specs, ddls, prev, as_of, **settings):
    names, resolver, envs, state, types = _inputs(spark, ddls)
    out = jobs.map_specs(specs, names, resolver, envs, state, prev, types, as_of, matching.MatchSettings(**settings))
    return spark.createDataFrame(out.collect(), S.COLUMN_MAP)


def _by_key(df):
    return {(r.target_field_name, r.env): r for r in df.collect()}


def test_mapping_over_runs(spark):
    empty = spark.createDataFrame([], S.COLUMN_MAP)
    dev, pru = "create table t (CUST_ID NUMBER, NAME VARCHAR(8))", "create table t (CUSTOMER_ID NUMBER)"
    first = _run(spark, _specs(spark, ("cust_id", "id"), ("zzz", "other")), {"DEV": dev, "PRU": pru}, empty, "2024-01-01 00:00:00")
    got = _by_key(first)
    assert got["id", "DEV"].mapping_status == "MAPPED_EXACT" and got["id", "DEV"].matched_column == "CUST_ID"
    assert got["id", "PRU"].mapping_status == "UNMAPPED_LOW_SCORE" and got["id", "PRU"].matched_column is None
    assert got["id", "DEV"].resolved_type == "VARCHAR(8)" and got["id", "DEV"].is_primary_key
    # the reviewer overrides one mapping; then 'other' leaves the page and the DDL of PRU changes
    over = first.withColumn("user_override", (F.col("target_field_name") == "other") & (F.col("env") == "DEV"))
    over = over.withColumn("matched_column", F.when(F.col("user_override"), "MANUAL").otherwise(F.col("matched_column")))
    second = _by_key(_run(spark, _specs(spark, ("cust_id", "id")), {"DEV": dev, "PRU": "create table t (CUST_IDS NUMBER)"}, over, "2024-02-01 00:00:00"))
    assert second["id", "PRU"].mapping_status == "MAPPED_FUZZY" and round(second["id", "PRU"].match_score, 2) == 93.33
    kept, gone = second["other", "DEV"], second["other", "PRU"]
    assert kept.is_active and kept.user_override and kept.matched_column == "MANUAL" and kept.last_mapped_on.month == 2
    assert not gone.is_active and gone.mapping_status == "INACTIVE_ORPHANED"


def test_override_survives_rerun_and_unchanged_ddl_keeps_match(spark):
    empty = spark.createDataFrame([], S.COLUMN_MAP)
    specs, ddls = _specs(spark, ("cust_id", "id")), {"DEV": "create table t (CUST_ID NUMBER)"}
    first = _run(spark, specs, ddls, empty, "2024-01-01 00:00:00")
    edited = first.withColumn("matched_column", F.lit("KEEP"))
    assert _by_key(_run(spark, specs, ddls, edited, "2024-02-01 00:00:00"))["id", "DEV"].matched_column == "KEEP"
    mine = edited.withColumn("user_override", F.lit(True)).withColumn("mapping_status", F.lit("UNMAPPED_LOW_SCORE"))
    again = _by_key(_run(spark, specs, {"DEV": "create table t (CUST_ID VARCHAR)"}, mine, "2024-02-01 00:00:00"))["id", "DEV"]
    assert again.user_override and again.matched_column == "KEEP" and again.mapping_status == "UNMAPPED_LOW_SCORE"


def test_exact_only_and_duplicate_targets(spark):
    empty = spark.createDataFrame([], S.COLUMN_MAP)
    specs = _specs(spark, ("first", "id"), ("cust_ids", "id"))
    got = _by_key(_run(spark, specs, {"DEV": "create table t (CUST_ID NUMBER)"}, empty, "2024-01-01 00:00:00", exact_only=True))
    assert len(got) == 1 and got["id", "DEV"].mapping_status == "UNMAPPED_NOT_EXACT"
    assert matching.MatchSettings(threshold=140).threshold == 100


def test_upsert_null_overwrites_and_supplied(spark):
    state = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, u string, v string")
    changes = spark.createDataFrame([(2, None, ["u"]), (3, "c", ["v"])], "k int, u string, s array<string>")
    got = sorted(map(tuple, merge.upsert(state, changes.drop("s"), ["k"]).collect()))
    assert got == [(1, "a", "x"), (2, None, "y"), (3, "c", None)]
    got = sorted(map(tuple, merge.upsert(state, changes, ["k"], supplied="s").collect()), key=lambda r: r[0])
    assert got == [(1, "a", "x"), (2, None, "y"), (3, None, None)]


def test_line_diff_counts_copies(spark):
    pairs = spark.createDataFrame([(1, "a\nb\nb", "a\nc"), (2, None, "x"), (3, "s", "s")], "id int, old_ddl string, new_ddl string")
    got = sorted(tuple(r) for r in parity.line_diff(pairs, ["id"]).collect())
    assert got == [(1, "+", "c", 1), (1, "-", "b", 2), (2, "+", "x", 1), (2, "-", "", 1)]


def test_line_edits_turn_the_old_text_into_the_new(spark):
    import random
    rng = random.Random(3)
    pairs = [("a\nb\nc", "c\na\nb"), (None, "x"), ("s", "s"), ("a\n\nb\n", "b\n\na"), ("r\n" * 300, "r\n" * 200 + "z\n" + "r\n" * 150)]
    for _ in range(150):
        left = [rng.choice("abcdefgh") + str(rng.randrange(3)) for _ in range(rng.randint(0, 25))]
        right = [x for x in left if rng.random() < 0.8]
        for _ in range(rng.randint(0, 4)):
            right.insert(rng.randint(0, len(right)), rng.choice(left or ["new"]) if rng.random() < 0.5 else f"new{rng.random()}")
        pairs.append(("\n".join(left), "\n".join(right)))
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "id int, old_ddl string, new_ddl string")
    rows = {}
    for r in parity.line_edits(df, ["id"]).collect():
        rows.setdefault(r.id, []).append(r)
    assert sorted((r.sign, r.line, r.old_position, r.new_position) for r in rows[0]) == [("+", "c", 0, 1), ("-", "c", 3, 3)] and 2 not in rows
    for k, (old, new) in enumerate(pairs):
        old, new, edits = (old or "").split("\n"), (new or "").split("\n"), rows.get(k, [])
        gone = {r.old_position for r in edits if r.sign == "-"}
        assert all(old[r.old_position - 1] == r.line for r in edits if r.sign == "-")
        made = [x for n, x in enumerate(old, 1) if n not in gone]
        for r in sorted((r for r in edits if r.sign == "+"), key=lambda r: r.new_position):
            made.insert(r.new_position - 1, r.line)
        assert made == new
        table = [[0] * (len(new) + 1) for _ in range(len(old) + 1)]
        for i, x in enumerate(old):
            for j, y in enumerate(new):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        if len(set(old)) < 3 or len(set(old)) == len(old):  # without anchors, and where all lines are told apart, nothing more can stay
            assert len(gone) == len(old) - table[-1][-1] or len(set(new)) < len(new)


def test_unused_entries_name_canonical_keys_only(spark):
    from schemaward.operators import resolver as R
    flat = spark.createDataFrame([(n, "DEV", o, "TABLE") for n, o in (("CANON", "a.b.c"), ("ALIAS1", "a.b.c"), ("USED", "x.y.z"), ("NICK", "x.y.z"))], "source_name string, env string, fqdn string, object_type string")
    names = spark.createDataFrame([("NICK",)], "source_name string")
    canonical = spark.createDataFrame([("CANON",), ("USED",)], "source_name string")
    assert [r.source_name for r in R.unused_entries(flat, names, canonical).collect()] == ["CANON"]
    assert sorted(r.source_name for r in R.unused_entries(flat, names).collect()) == ["ALIAS1", "CANON"]


def test_titles_after_leading_white_space(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n\t ["x", "y"]')
    assert [r.given_title for r in inputs.read_titles(spark, str(tmp_path)).orderBy("ord").collect()] == ["x", "y"]
    assert inputs.document_faults(spark, str(tmp_path), "list").count() == 0


def test_mapping_skips_name_every_reason(spark):
    from schemaward.operators import matching
    specs = spark.createDataFrame([(1, 1, "No", "S1"), (2, 1, "Yes", ""), (3, 1, "Yes", "nowhere"), (4, 1, "Yes", " s1 ")], "page_id long, row_ord int, add_source_to_target string, source_table string")
    resolver = spark.createDataFrame([("S1", "DEV", "a.b.t", "TABLE"), ("S1", "QA", "a.b.v", "VIEW"), ("S1", "UAT", "a.b.n", "TABLE")], "source_name string, env string, fqdn string, object_type string")
    state = spark.createDataFrame([("a.b.t", "DEV", "TABLE", "create table t (a int)", "h1"), ("a.b.v", "QA", "VIEW", "create view v as select 1", "h2"), ("a.b.n", "UAT", "TABLE", None, None)],
                                  "fqdn string, env string, object_type string, current_ddl string, current_ddl_hash string")
    got = {(r.page_id, r.env, r.reason) for r in matching.mapping_skips(specs, ["dev", "qa", "uat", "prod"], resolver, state).collect()}
    per_env = {("QA", "NO_DDL_COLUMNS"), ("UAT", "NO_DDL"), ("PROD", "NO_OBJECT")}
    assert got == {(1, None, "NO_FLAGGED_COLUMNS"), (2, None, "NO_SOURCE_TABLE"), (3, None, "SOURCE_UNKNOWN")} | {(p, *x) for p in (1, 4) for x in per_env}


def test_sources_tolerate_broken_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('["One", "Two"]')
    (tmp_path / "b.json").write_text('{"not": "a list"}')
    assert [r.given_title for r in inputs.read_titles(spark, str(tmp_path)).orderBy("ord").collect()] == ["One", "Two"]
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "report.json").write_text('[{"given_title": "One",\n "status": "HIT", "user_verified": true}]')
    assert inputs.read_report(spark, str(tmp_path / "r"), document=True).first().user_verified is True
    (tmp_path / "r" / "report.json").write_text("[{broken")
    assert inputs.read_report(spark, str(tmp_path / "r"), document=True).count() == 0
    (tmp_path / "t.json").write_text('{"varchar": "VARCHAR", "VarChar": "VARCHAR", "x": " "}')
    assert [tuple(r) for r in inputs.read_type_map(spark, str(tmp_path / "t.json")).collect()] == [("VARCHAR", "VARCHAR")]


@pytest.mark.parametrize("name", list(S.STATE_TABLES))
def test_state_schemas(name):
    names = S.state_schema(name).names
    assert len(names) == {"page_metadata": 25, "parsed_content": 3, "ddl_state": 15, "column_map": 21}[name]
    assert set(S.PRIMARY_KEYS[name]) <= set(names)


def test_state_write_needs_a_new_path(spark, tmp_path):
    df = spark.createDataFrame([], S.PARSED_CONTENT)
    outputs.write_state(df, "parsed_content", str(tmp_path / "s"))
    with pytest.raises(Exception):
        outputs.write_state(df, "parsed_content", str(tmp_path / "s"))
