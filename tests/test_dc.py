"""The citation block: whole blocks, names, affiliations, years."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.documents import merge_blocks, merge_maps
from shelfmark.functions.names import creator_name, split_names
from shelfmark.operators import dc
from shelfmark.operators.dc import dc_block, publication_year, tags_and_subjects

ALL = ("title authors affiliations publisher publication_year resource_type description "
       "dataset_doi related_dois subjects").split()


def block(spark, values, schema):
    df = spark.createDataFrame([values], schema)
    fields = {name: name for name in df.columns}
    text = df.select(F.to_json(dc_block(df.schema, fields, "Open Catalog", 2024))).first()[0]
    return json.loads(text)


def test_single_values(spark):
    schema = ", ".join(f"{name} string" for name in ALL)
    got = block(spark, ("Alloys", "Metals Bureau, Northern", "Uni A", "Press", "2017", "Dataset",
                        "About alloys", "10.1", "10.2", "Physics"), schema)
    assert got == {
        "titles": [{"title": "Alloys"}],
        "creators": [{"creatorName": "Metals Bureau, Northern", "familyName": "Metals Bureau",
                      "givenName": "Northern", "affiliations": ["Uni A"]}],
        "publisher": "Press",
        "publicationYear": "2017",
        "resourceType": {"resourceTypeGeneral": "Dataset", "resourceType": "Dataset"},
        "descriptions": [{"description": "About alloys", "descriptionType": "Other"}],
        "identifier": {"identifier": "10.1", "identifierType": "DOI"},
        "relatedIdentifiers": [{"relatedIdentifier": "10.2", "relatedIdentifierType": "DOI",
                                "relationType": "IsPartOf"}],
        "subjects": [{"subject": "Physics"}],
    }


def test_lists(spark):
    listed = {"title", "authors", "affiliations", "related_dois", "subjects"}
    schema = ", ".join(f"{n} {'array<string>' if n in listed else 'string'}" for n in ALL)
    got = block(spark, (["One", "Two"], ["Metals Bureau, Northern", "Okafor, Ada", "Lin Zhao"],
                        ["Uni A", "Lab B"], "Press", "2017", "Dataset", "d", "10.1",
                        ["10.2", "10.3"], ["Physics", "Maths"]), schema)
    both = ["Uni A", "Lab B"]
    assert got["creators"] == [
        {"creatorName": "Metals Bureau, Northern", "familyName": "Metals Bureau",
         "givenName": "Northern", "affiliations": both},
        {"creatorName": "Okafor, Ada", "familyName": "Okafor", "givenName": "Ada",
         "affiliations": both},
        {"creatorName": "Zhao, Lin", "familyName": "Zhao", "givenName": "Lin",
         "affiliations": both},
    ]
    assert got["titles"] == [{"title": "One"}, {"title": "Two"}]
    assert [r["relatedIdentifier"] for r in got["relatedIdentifiers"]] == ["10.2", "10.3"]
    assert got["subjects"] == [{"subject": "Physics"}, {"subject": "Maths"}]


def test_minimum(spark):
    got = block(spark, ("Only", ["Ada Okafor", "Zhao, Lin"]),
                "title string, authors array<string>")
    assert got == {
        "titles": [{"title": "Only"}],
        "creators": [
            {"creatorName": "Okafor, Ada", "familyName": "Okafor", "givenName": "Ada"},
            {"creatorName": "Zhao, Lin", "familyName": "Zhao", "givenName": "Lin"}],
        "publisher": "Open Catalog",
        "publicationYear": "2024",
        "resourceType": {"resourceTypeGeneral": "Dataset", "resourceType": "Dataset"},
    }


@pytest.mark.parametrize("kind, given, want", [
    ("array<string>", ["U", "B"], [["U"], ["B"]]),
    ("string", "U", [["U"], ["U"]]),
    ("array<string>", ["U", "B", "C"], [["U", "B", "C"]] * 2),
    ("array<array<string>>", [["U"], ["U", "B"]], [["U"], ["U", "B"]]),
    ("array<string>", [], [None, None]),
    ("array<array<string>>", None, [None, None]),
])
def test_affiliations(spark, kind, given, want):
    got = block(spark, ("t", ["Ada Okafor", "Zhao, Lin"], given),
                f"title string, authors array<string>, affiliations {kind}")
    assert [c.get("affiliations") for c in got["creators"]] == want


@pytest.mark.parametrize("author, family, given", [
    ("Ada Okafor", "Okafor", "Ada"),
    ("Okafor, Ada", "Okafor", "Ada"),
    ("Okafor; Ada", "Okafor", "Ada"),
    ("Okafor, Ada Ngozi", "Okafor", "Ada Ngozi"),
    ("Ada Ngozi Okafor", "Okafor", "Ada Ngozi"),
    ("Ludwig van Beethoven", "van Beethoven", "Ludwig"),
    ("Juan de la Vega", "de la Vega", "Juan"),
    ("Van Morrison", "Morrison", "Van"),
    ("Prof. Dr. Ada Okafor", "Okafor", "Ada"),
    ("Okafor, Dr. Ada", "Okafor", "Ada"),
    ("John Smith Jr.", "Smith Jr.", "John"),
    ("John Smith, Jr.", "Smith Jr.", "John"),
    ("Smith, John, Jr.", "Smith Jr.", "John"),
    ("Smith, John Jr.", "Smith Jr.", "John"),
    ("John Smith, MD, PhD", "Smith MD, PhD", "John"),
    ("John Smith Ph.D.", "Smith Ph.D.", "John"),
    ('John "Jack" Smith', "Smith", "John"),
    ("John (Jack) Smith", "Smith", "John"),
    ("Ada", "", "Ada"),
    ("  Ada   Okafor ", "Okafor", "Ada"),
    ("", "", ""),
])
def test_names(rows, author, family, given):
    name = split_names(F.array("a"))[0]
    got = rows([(author,)], "a string", family=name["family"], given=name["given"],
               creator=creator_name(name["family"], name["given"]))
    assert got == [(family, given, f"{family}, {given}".strip(" ,"))]


@pytest.mark.parametrize("kind, given, want", [
    ("string", "2017", "2017"), ("string", " 2017 ", "2017"), ("string", "+007", "7"),
    ("string", "2_017", "2017"), ("string", "2017.5", "2024"), ("string", "x", "2024"),
    ("string", "", "2024"), ("string", None, "2024"), ("int", 2001, "2001"),
    ("double", 2000.7, "2000"), ("double", float("inf"), "2024"), ("string", "_2017", "2024"),
])
def test_year(rows, kind, given, want):
    data_type = T.StructType.fromDDL(f"y {kind}")["y"].dataType
    got = rows([(given,)], f"y {kind}", y=publication_year(F.col("y"), data_type, 2024))
    assert got == [(want,)]


def test_unknown_argument(spark):
    df = spark.createDataFrame([("t", "a")], "title string, authors string")
    with pytest.raises(ValueError):
        dc_block(df.schema, {"title": "title", "authors": "authors", "colour": "title"}, "p", 1)
    with pytest.raises(ValueError):
        dc_block(df.schema, {"title": "title"}, "p", 1)


def test_merging_keeps_the_base(spark):
    df = spark.sql("""select map('a', '1') as m, map('a', '2', 'b', '3') as n,
        named_struct('x', 1, 'in', named_struct('p', 1, 'q', cast(null as int))) as s,
        named_struct('x', 9, 'y', 8, 'in', named_struct('q', 7, 'r', 6)) as t""")
    merged = merge_blocks(F.col("s"), df.schema["s"].dataType, F.col("t"), df.schema["t"].dataType)
    row = df.select(merge_maps(F.col("m"), F.col("n")).alias("m"), merged.alias("s")).first()
    assert row["m"] == {"a": "1", "b": "3"}
    assert row["s"].asDict(recursive=True) == {"x": 1, "in": {"p": 1, "q": 7, "r": 6}, "y": 8}


def test_tags_and_subjects_without_either(spark):
    df = spark.sql("select cast(null as struct<subjects:array<struct<subject:string>>>) dc, "
                   "cast(null as array<string>) tags")
    assert df.select(tags_and_subjects(F.col("dc"), F.col("tags"))).first()[0] == []


def test_extra_fields(spark):
    """They are added, nested ones too, and replace nothing."""
    df = spark.sql("""select 'T' as title, 'Doe, Jo' as authors, array('', 'Lab') as places,
        named_struct('publisher', 'other', 'language', 'en', 'resourceType',
            named_struct('resourceType', 'x', 'level', 2)) as more""")
    got = dc.with_dc_block(df, {"title": "title", "authors": "authors", "affiliations": "places"},
                           "Our Lab", 2020, extra="more").first()["dc"]
    assert got["publisher"] == "Our Lab" and got["language"] == "en"
    assert got["resourceType"]["level"] == 2 and got["resourceType"]["resourceType"] == "Dataset"
    assert got["creators"][0]["affiliations"] == ["Lab"]


def test_blank_affiliations_keep_places(spark):
    df = spark.sql("select 'T' as title, array('A B', 'C D') as authors, array('', 'Lab') as places, "
                   "'' as none")
    args = {"title": "title", "authors": "authors"}
    got = dc.with_dc_block(df, {**args, "affiliations": "places"}, "p", 2020).first()["dc"]
    assert [c["affiliations"] for c in got["creators"]] == [None, ["Lab"]]
    got = dc.with_dc_block(df, {**args, "affiliations": "none"}, "p", 2020).first()["dc"]
    assert [c["affiliations"] for c in got["creators"]] == [None, None]
