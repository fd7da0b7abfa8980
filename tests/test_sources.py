"""Files of every kind read through a dotted mapping."""

import json

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import extract
from shelfmark.sources import readers

VESSEL = {"hull": {"owner's no": "K-17", "decks [m]": {"upper": 2.5, "lower": None}},
          "flags": ["PA", "LR"], "draught": "-"}
FIELDS = {"ship.id": "hull.owner's no", "ship.height.upper": "hull.decks [m].upper",
          "ship.height.lower": "hull.decks [m].lower", "registry": "flags", "depth": "draught"}
SHIP = {"ship": {"id": "K-17", "height": {"upper": "2.5", "lower": None}},
        "registry": '["PA","LR"]', "depth": None}


def values(df):
    return [{k: v for k, v in r.asDict(recursive=True).items() if k != "file"}
            for r in df.collect()]


def test_json_text_and_types(spark):
    df = spark.createDataFrame([(json.dumps(VESSEL),), ("{broken",), ('{"other": 1}',)],
                               "doc string")
    got = extract.json_records(df, F.col("doc"), FIELDS, {"ship.height.upper": "double"}, "-")
    assert values(got) == [{**SHIP, "ship": {"id": "K-17", "height": {"upper": 2.5, "lower": None}}}]


def test_json_files(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"site": {"code": "x y"}, "n": 1.5}, indent=1))
    (tmp_path / "two.json").write_text(json.dumps([{"n": 7}, {"site": {"name": "z"}}]))
    got = readers.read_json(spark, str(tmp_path), {"at": "site.code", "count": "n"})
    assert sorted((r["file"][-8:], r["at"], r["count"]) for r in got.collect()) == [
        ("one.json", "x y", "1.5"), ("two.json", None, "7")]


def test_delimited_files(spark, tmp_path):
    table = [["when", "what", "how much"], ["1 May", 'the "big" one', "12"], ["", "a;b", "-"],
             [" ", "", "x"], ["", "", ""]]
    (tmp_path / "t.txt").write_text("\n".join(";".join(
        '"' + c.replace('"', '""') + '"' if set(c) & set(';"') else c for c in row)
        for row in table) + "\n")
    mapping = {"day": "when", "goods.label": "what", "goods.count": "how much", "goods.by": "who"}
    read = lambda **more: sorted(
        (str(r["day"]), str((r["goods"] or {}).get("label")), str((r["goods"] or {}).get("count")))
        for r in values(readers.read_csv(spark, str(tmp_path), mapping, ";", **more)))
    assert read() == [("1 May", 'the "big" one', "12"), ("None", "None", "x"), ("None", "a;b", "-")]
    assert read(types={"goods.count": "int"}) == [
        ("1 May", 'the "big" one', "12"), ("None", "a;b", "None")]
    assert ("None", "a;b", "None") in read(na_values=["-", ""])
    # Text lines are read by the same rules as files.
    lines = spark.createDataFrame([('5;"a ""quoted"" cell"',), ('"x;y";z',)], "line string")
    got = extract.csv_records(lines, F.col("line"), ["a", "b"], {"one": "a", "two": "b"}, ";")
    assert values(got) == [{"one": "5", "two": 'a "quoted" cell'}, {"one": "x;y", "two": "z"}]


def test_xml_file(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<log><day no='3'><sky><cover>8/8</cover></sky></day><day no='4'><rain>02</rain></day></log>")
    got = values(readers.read_xml(spark, str(tmp_path), {
        "cloud": "sky.cover", "water.mm": "rain", "day": "_no"}, row_tag="day",
        types={"water.mm": "int"}))
    assert got == [{"cloud": "8/8", "water": None, "day": "3"},
                   {"cloud": None, "water": {"mm": 2}, "day": "4"}]


def test_yaml_file(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("tide: {high: '06:12'}\nport: 5\n---\nport: 9\n---\nx: y\n")
    got = values(readers.read_yaml(spark, str(tmp_path), {
        "water.high": "tide.high", "at": "port"}, types={"at": "int"}))
    assert got == [{"water": {"high": "06:12"}, "at": 5}, {"water": None, "at": 9}]


def test_file_names(spark, tmp_path):
    for name in ("buoy7-2021.log", "buoy12-1999.log", "notes"):
        (tmp_path / name).write_text("x")
    got = values(readers.read_file_names(spark, str(tmp_path), {
        "buoy.number": r"^buoy(\d+)", "year": r"\d{4}"}))
    assert sorted(got, key=str) == [{"buoy": {"number": "12"}, "year": "1999"},
                                    {"buoy": {"number": "7"}, "year": "2021"}]


NAMES = ["a b", "it's", 'q"u', "b\"o'th", "[x", "x]", "?", "*", "$", "", "[it's", '[q"', "\\", "é"]


@pytest.mark.parametrize("name", NAMES)
def test_names_with_odd_characters(spark, name):
    df = spark.createDataFrame([(json.dumps({name: {name: 1}}),)], "doc string")
    got = extract.json_records(df, F.col("doc"), {"x": f"{name}.{name}"})
    assert values(got) == [{"x": "1"}]


@pytest.mark.parametrize("na, want", [(None, "v"), ("v", None), (["a", "v"], None), ([], "v")])
def test_na_values(rows, na, want):
    assert rows([("v",)], "c string", c=extract.without_na(F.col("c"), na)) == [(want,)]


def test_directories(spark):
    df = spark.sql("""select * from values ('d1/b', null, 'x'), ('d1/a', null, 'y'),
        ('d1/c', 5, null), ('d2/a', 1, 'z') as t(path, n, s)""")
    got = extract.group_by_directory(df, "path", ["n", "s"]).collect()
    assert sorted(map(tuple, got)) == [("d1/", 3, "d1/a", "d1/c", 5, "y"),
                                       ("d2/", 1, "d2/a", "d2/a", 1, "z")]


def test_union_and_passthrough(spark):
    a = spark.sql("select 1 as id, 'x' as only_a")
    b = spark.sql("select 2 as id, 'y' as only_b")
    got = extract.union_records(a, b)
    assert got.columns == ["id", "only_a", "only_b"] and got.count() == 2
    df = spark.sql("select * from values (1, true), (2, false), (3, null) as t(id, no_extract)")
    assert sorted(r["id"] for r in extract.extractable(df).collect()) == [2, 3]


def test_index_configuration(spark, tmp_path):
    for kind, name, text in (("j", "a.json", json.dumps(VESSEL)),
                             ("c", "b-77.csv", "vessel|flag\nK-3|MT\n")):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / name).write_text(text)
    index = {"json": {"mapping": FIELDS, "na_values": ["-"]},
             "csv": {"mapping": {"ship.id": "vessel"}, "delimiter": "|"},
             "filename": {"mapping": {"sheet": r"-(\d+)\."}}}
    paths = {"json": str(tmp_path / "j"), "csv": str(tmp_path / "c"),
             "filename": str(tmp_path / "c")}
    got = {r["data_type"]: r for r in readers.read_indexed(spark, paths, index).collect()}
    assert got["json"]["ship"]["id"] == "K-17" and got["json"]["depth"] is None
    assert got["csv"]["ship"]["id"] == "K-3" and got["csv"]["sheet"] is None
    assert got["filename"]["sheet"] == "77"
    with pytest.raises(ValueError):
        readers.read_indexed(spark, {}, {"excel": {"mapping": {}}})


def test_a_block_as_value_and_clashing_targets(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": {"b": 1}}')
    got = values(readers.read_json(spark, str(tmp_path), {"whole": "a", "part": "a.b"}))
    assert got == [{"whole": '{"b":"1"}', "part": "1"}]
    with pytest.raises(ValueError):
        extract.nested({"x": F.lit(1), "x.y": F.lit(2)})


def test_csv_files_of_differing_headers(spark, tmp_path):
    """Two orders of the same names, other names, a lone header, an empty file, a blank start."""
    files = {"a.csv": "x,y\n1,2\n", "b.csv": "y,x\n4,3\n", "c c+[1].csv": 'x,"z ""q"""\n5,6\n7,\n',
             "d.csv": "y\n8\n", "e.csv": "x,y\n", "f.csv": "", "g.csv": " \ny,x\n10,9\n",
             "h.csv": "x,y\n" + "".join(f"{n},{n + 1}\n" for n in range(100, 400))}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    mapping = {"at.x": "x", "at.y": "y", "z": 'z "q"'}

    def read(**more):
        return sorted(((r["at"] or {}).get("x") or "", (r["at"] or {}).get("y") or "",
                       r.get("z") or "")
                      for r in values(readers.read_csv(spark, str(tmp_path), mapping, **more)))
    want = [("1", "2", ""), ("3", "4", ""), ("5", "", "6"), ("7", "", ""), ("", "8", ""),
            ("9", "10", ""), *((str(n), str(n + 1), "") for n in range(100, 400))]
    assert read() == sorted(want)
    with pytest.raises(Exception, match="(?i)header"):
        read(one_header=True)


def test_yaml_faults_are_kept_apart(spark):
    df = spark.createDataFrame([(1, "x: .nan\ny: 5\n2020-01-02: z\n"), (2, "x: [1\n"),
                                (3, "x: 7\n---\nx: {\n"), (4, None)], "id int, doc string")
    got = readers.yaml_records(df, "doc", {"x": "x", "y": "y", "z": "2020-01-02"}, keep=["id"])
    assert sorted((r["id"], r["x"], r["y"], r["z"]) for r in got.collect()) == [
        (1, None, "5", "z"), (3, "7", None, None)]
    assert sorted(r["id"] for r in readers.yaml_rejects(df, "doc", ["id"]).collect()) == [2, 3]


def test_json_rejects(spark):
    df = spark.createDataFrame([(1, "{broken"), (2, '{"a": 1}'), (3, None)], "id int, doc string")
    got = extract.json_rejects(df, F.col("doc"), ["id"]).collect()
    assert [(r["id"], r["reason"]) for r in got] == [(1, "malformed")]


def test_headers_are_found_without_sorting_lines(spark, tmp_path):
    for name, text in [("a", "x;y\n1;2\n"), ("b", "\n  \ny;x\n2;1\n"), ("c", "x;y\n")]:
        (tmp_path / f"{name}.csv").write_text(text)
    found = readers._headers(spark, str(tmp_path))
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
    groups = readers._files_by_header(spark, str(tmp_path))
    assert [[f[-5:] for f in files] for files in groups] == [["a.csv", "c.csv"], ["b.csv"]]
