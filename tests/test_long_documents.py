"""Documents read in blocks of a few bytes give the same rows as documents read whole."""

import json

import pytest

from schemaward.sources import inputs as small
from schemaward.sources import long_documents as long

LISTS = {
    "plain": '["a", "b","c"]', "escapes": r'  ["say \"x, [y]\"", "back\\", "\\\"", "é\n", "{,}"]', "mixed": '["a", 5, null, true, {"k": [1, 2]}, ["x", "y"], ""]\n',
    "empty": "[]", "blank": " [ \n ] ", "one": '["only"]', "numbers": "[1,2,3]", "many": json.dumps([f'title "{i}", \\ {{' * (i % 4) for i in range(300)]),
}
BROKEN = {
    "cut": '["a", "b"', "string": '["a", "b', "tail": '["a"] x', "comma": '["a",]', "double": '["a",,"b"]', "kind": '{"a": ["b"]}', "mismatch": '["a"}', "twice": '["a"]["b"]',
    "word": 'titles: ["a"]', "garbage": '["a" "b"]', "closed": '"a"]',
}
OBJECTS = {
    "resolver": json.dumps({f'K"{i}': {"defaults": {"environments": ["DEV"], "fqdn": f"A.B.T{i}"}, "aliases": [f"x,{i}", "y"]} for i in range(40)}, indent=1),
    "odd": r'{"a": "{\"b\": 1}", "a": {"c": "}"}, "n": 5, "x\"y": null, "": []}',
}


@pytest.fixture(params=[24, 1 << 20])
def blocks(spark, request):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def _write(folder, documents):
    for name, text in documents.items():
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


def _rows(df, *columns):
    rows = [(r["path"].rsplit("/", 1)[-1].removesuffix(".json"), *[r[c] for c in columns]) for r in df.collect()]
    return sorted(rows, key=repr)


def test_lists_in_blocks(spark, tmp_path, blocks):
    path = _write(tmp_path, LISTS if blocks > 24 else {k: v for k, v in LISTS.items() if k != "many"})
    rows = _rows(long.read_titles(spark, path), "ord", "given_title")
    assert rows == _rows(small.read_titles(spark, path), "ord", "given_title")
    assert ("escapes", 0, 'say "x, [y]"') in rows
    assert _rows(long.document_faults(spark, path, "list"), "reason") == []


def test_broken_documents_are_faults_and_give_no_rows(spark, tmp_path, blocks):
    path = _write(tmp_path, BROKEN)
    faults = dict(_rows(long.document_faults(spark, path, "list"), "reason"))
    assert faults == {**dict.fromkeys(BROKEN, "not JSON"), "kind": "not a JSON list", "closed": "not a JSON list"}
    assert long.read_titles(spark, path).count() == 0


def test_objects_in_blocks(spark, tmp_path, blocks):
    path = _write(tmp_path, OBJECTS if blocks > 24 else {"odd": OBJECTS["odd"]})
    rows = _rows(long.read_resolver_raw(spark, path), "entry_ord", "entry_key", "entry_json")
    assert rows == _rows(small.read_resolver_raw(spark, path), "entry_ord", "entry_key", "entry_json")


def test_type_map_in_blocks(spark, tmp_path, blocks):
    path = _write(tmp_path, {"map": '{"text": "VARCHAR", "n,1": "NUMBER(1,2)", "blank": " "}'})
    assert _rows(long.read_type_map_raw(spark, path), "entry_ord", "map_key", "map_value") == _rows(small.read_type_map_raw(spark, path), "entry_ord", "map_key", "map_value")


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        path = _write(tmp_path, {"long": json.dumps([f"Table: {i}" for i in range(5000)])})
        read = spark.read.text(path, lineSep='"')
        assert read.rdd.getNumPartitions() > 10
        titles = long.read_titles(spark, path)
        assert titles.count() == 5000 and titles.where("given_title <> concat('Table: ', ord)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_blocks_are_bounded_within_a_split(spark, tmp_path, monkeypatch):
    """A split of many blocks, in more tasks than a shuffle has, gives what one block gives."""
    items = [f'x{i} "q\\" [{{,' if i % 3 else "é" * i for i in range(40)]
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "good.json").write_text(json.dumps(items, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "d" / "bad.json").write_text(json.dumps(items)[:-1], encoding="utf-8")
    monkeypatch.setattr(long, "RUN", 7)
    monkeypatch.setattr(long, "TASK_BYTES", 256)
    tasks = long._tasks(spark, str(tmp_path / "d"))
    assert tasks > 4 and long._parts(spark, str(tmp_path / "d"), tasks).rdd.getNumPartitions() == tasks
    rows = sorted(long.read_titles(spark, str(tmp_path / "d")).select("ord", "given_title").collect())
    assert [r.given_title for r in rows] == items
    assert [(r.path.rsplit("/")[-1], r.reason) for r in long.document_faults(spark, str(tmp_path / "d"), "list").collect()] == [("bad.json", "not JSON")]
