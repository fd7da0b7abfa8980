"""Files of every data type through mappings of their own, against Python's own parsers."""

import csv
import io
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import indexed

FILES = "submission_id int, data_type string, name string, text string"
INDEX = ("submission_id int, data_type string, mapping map<string,string>, delimiter string, "
         "na_values array<string>")


def nested(flat):
    out = {}
    for target, value in flat.items():
        *above, leaf = target.split(".")
        node = out
        for name in above:
            node = node.setdefault(name, {})
        node[leaf] = value
    return json.dumps(out, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def records(spark, files, index):
    got = indexed.mapped_records(spark.createDataFrame(files, FILES),
                                 spark.createDataFrame(index, INDEX))
    return sorted((r.submission_id, r.data_type, r.name, r.at, r.record) for r in got.collect())


def test_delimited_text_as_the_csv_module_reads_it(spark):
    draw = random.Random(2)
    cells = ["", " ", "a", 'say "hi"', "x,y", "line\nend", "crlf\r\nend", '"', "é;|", "5\" wide",
             "n" * 9000, '""' * 800]
    files, index, want = [], [], []
    for number, sep in enumerate([",", ";", "|", "\t", ".", "##"] * 3):
        table = [[draw.choice(cells) for _ in range(4)] for _ in range(6)]
        head = draw.sample(["one", "two", "a b", "it's"], 4)
        out = io.StringIO()
        writer = csv.writer(out, delimiter=sep if len(sep) == 1 else "\x01",
                            lineterminator=draw.choice(["\n", "\r\n"]), quoting=csv.QUOTE_ALL)
        writer.writerows([head, *table])
        files.append((number, "csv", f"f{number}", out.getvalue().replace("\x01", sep)))
        mapping = {"m.first": head[2], "m.deep.er": head[0], "none": "gone", "z": head[3]}
        na = draw.choice([None, ["a"], []])
        index.append((number, "csv", mapping, None if sep == "," else sep, na))
        drop = ["", " "] if na is None else na
        for at, row in enumerate(table):
            flat = {t: row[head.index(s)] for t, s in mapping.items()
                    if s in head and row[head.index(s)] not in drop}
            if flat:
                want.append((number, "csv", f"f{number}", at, nested(flat)))
    assert records(spark, files, index) == sorted(want)


def test_unquoted_and_odd_lines(spark):
    text = 'a#b\n1#5" pipe\n\n2#"open\n3#"x"y\n4\n5#6#7'
    got = records(spark, [(1, "csv", "f", text)], [(1, "csv", {"a": "a", "b": "b"}, "#", None)])
    assert [json.loads(r[4]) for r in got] == [
        {"a": "1", "b": '5" pipe'}, {"a": "2", "b": '"open'}, {"a": "3", "b": '"x"y'}, {"a": "4"},
        {"a": "5", "b": "6"}]


def test_trees(spark):
    doc = {"a": {"b c": [1, {"x": None}], "it's": "q"}, "n": 1.5, "t": True, "none": None}
    mapping = {"p.list": "a.b c", "p.word": "a.it's", "q": "n", "r.s.t": "t", "u": "none", "v": "a.z"}
    flat = {"p.list": '[1,{"x":null}]', "p.word": "q", "q": "1.5", "r.s.t": "true"}
    import yaml
    xml = "<r k='0'><a><w>1</w><w>02</w></a><b>&amp; x</b><c u='m'>7</c></r>"
    got = records(spark, [
        (1, "json", "j", json.dumps(doc)), (1, "yaml", "y", yaml.dump(doc) + "---\nn: 2\n---\n{}\n"),
        (1, "json", "l", json.dumps([{"k": 1}, doc, {"n": 3}])), (1, "xml", "x", xml),
        (2, "json", "other", json.dumps(doc)), (1, "json", "bad", "{"), (1, "json", "no", None)],
        [(1, "json", mapping, None, None), (1, "yaml", mapping, None, None), (1, "xml", {
            "k": "_k", "many": "a.w", "amp": "b", "unit": "c._u", "own": "c._VALUE"}, None, None)])
    assert got == sorted([
        (1, "json", "j", 0, nested(flat)), (1, "yaml", "y", 0, nested(flat)),
        (1, "yaml", "y", 1, nested({"q": "2"})), (1, "json", "l", 1, nested(flat)),
        (1, "json", "l", 2, nested({"q": "3"})),
        (1, "xml", "x", 0, nested({"k": "0", "many": '["1","02"]', "amp": "& x", "unit": "m",
                                   "own": "7"}))])


@pytest.mark.parametrize("pattern", [r"^\d+", r"_(\w)\.", r"(?:x)|y(z)?", r"[(]a", r"\(b", r"(?<n>\d)k",
                                     r"(?i)DAT$", r"(?=k)k."])
def test_file_names(spark, pattern):
    names = ["12_a.dat", "3k(b", "yz", "x", "(a", "_", ""]
    got = {r[2]: json.loads(r[4])["t"] for r in records(
        spark, [(1, "filename", n, None) for n in names], [(1, "filename", {"t": pattern}, None, None)])}
    python = re.compile(pattern.replace("(?<n>", "(?P<n>"))
    want = {n: (m.group(1) if python.groups else m.group()) for n in names if (m := python.search(n))}
    assert got == {n: v for n, v in want.items() if v}


def test_problems_and_rejects_are_named(spark):
    index = spark.createDataFrame([
        (1, "json", {"a": "x", "a.b": "y"}, None, None), (2, "excel", {"a": "x"}, None, None),
        (3, "json", {"a": "[\"'"}, None, None), (4, "json", {"a": "x"}, None, None),
        (4, "yaml", {"a": "x"}, None, None), (4, "xml", {"a": "x"}, None, None)], INDEX)
    problem = indexed.index_problem(F.col("data_type"), F.col("mapping")).alias("p")
    assert [r.p and r.p.split()[0] for r in index.select(problem).collect()] == [
        "a", "no", "a", None, None, None]
    files = spark.createDataFrame([
        (4, "json", "bad", "{"), (4, "json", "good", '{"x": 1}'), (1, "json", "unusable", '{"x": 1}'),
        (4, "yaml", "half", "x: 1\n---\nx: ["), (4, "xml", "cut", "<a>")], FILES)
    assert sorted(r.name for r in indexed.rejected_files(files, index).collect()) == [
        "bad", "cut", "half"]
    assert sorted(r.name for r in indexed.mapped_records(files, index).collect()) == ["good", "half"]


def test_a_document_is_parsed_once(spark):
    got = indexed.mapped_records(spark.createDataFrame([(1, "json", "n", "{}")], FILES),
                                 spark.createDataFrame([(1, "json", {"a": "b"}, None, None)], INDEX))
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"(?i)parse_?json\(", plan)) == 1
