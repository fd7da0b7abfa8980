"""Input tables of the registered queries, as Spark views over the given parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.catalog import with_versions
from shelfmark.session import configure

ROWS_PER_TASK = 50_000  # of rows that cost much each


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt out evenly if the file is read by too few tasks for work on every row.

    A compressed file is cut by bytes, so that one task may get millions of rows.
    """
    wanted = -(-rows.count() // ROWS_PER_TASK)
    return rows if wanted <= rows.rdd.getNumPartitions() else rows.repartition(wanted)


def submissions(spark: SparkSession, folder: str) -> DataFrame:
    """Submissions without their version, one per order."""
    key = F.col("o_orderkey")
    open_code = (F.when(key % 5 == 0, "SSX").when(key % 5 == 1, "zzz").when(key % 5 == 2, "SRS")
                 .when(key % 5 == 3, "SRM").otherwise("MMM"))
    return table(spark, folder, "orders").select(
        key.alias("source_key"),
        F.col("o_custkey").alias("owner"),
        F.concat(F.lit("ds_"), F.col("o_custkey").cast("string")).alias("source_name"),
        F.col("o_orderdate").alias("submission_time"),
        (F.col("o_orderstatus") == "P").alias("active"),
        (key % 10 == 0).alias("test"),
        F.when(F.col("o_orderstatus") == "F", "SSF").when(F.col("o_orderstatus") == "P", "SPz")
        .otherwise(open_code).alias("status_code"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("organization"),
        F.col("o_totalprice").alias("size_mb"),
    )


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Submissions with version and source id."""
    return with_versions(submissions(spark, folder))


def edit_log(spark: SparkSession, folder: str) -> DataFrame:
    """Edits, one per event, in the order ``seq`` of time and event id."""
    return edits(table(spark, folder, "events"))


def edits(events: DataFrame) -> DataFrame:
    op = (F.when(F.col("event_type") == "view", "append")
          .when(F.col("event_type") == "click", "upsert")
          .when(F.col("event_type") == "purchase", "delete")
          .when(F.col("event_type") == "signup", "set").otherwise("clear"))
    return events.select(
        F.col("user_id").alias("submission_id"),
        F.struct("ts", "event_id").alias("seq"),
        op.alias("op"),
        F.concat(F.lit("k"), (F.col("event_id") % 5).cast("string")).alias("key"),
        F.col("props").alias("payload"),
        "event_id", "value",
    )


def builder_log(spark: SparkSession, folder: str) -> DataFrame:
    """Builder calls, one per event, on every kind of field."""
    return builder_calls(table(spark, folder, "events"))


def builder_calls(events: DataFrame) -> DataFrame:
    kind, n = F.col("event_type"), F.col("event_id")
    by_kind = lambda view, click, purchase, signup, error: (
        F.when(kind == "view", view).when(kind == "click", click)
        .when(kind == "purchase", purchase).when(kind == "signup", signup).otherwise(error))
    none, value, props = F.lit(None).cast("string"), F.col("value"), F.col("props")
    key = F.concat(F.lit("k"), (n % 5).cast("string"))
    text = lambda prefix, number: F.concat(F.lit(f'"{prefix}'), number.cast("string"), F.lit('"'))
    return events.select(
        F.col("user_id").alias("submission_id"),
        n.alias("seq"),
        by_kind(F.lit("append"), F.lit("upsert"), F.lit("upsert"), F.lit("set"),
                F.when(n % 3 == 2, "reset").otherwise("clear")).alias("op"),
        by_kind(F.lit("tags"), F.lit("services"), F.lit("projects"), F.lit("organization"),
                F.when(n % 3 == 0, "tags").when(n % 3 == 1, "services")).alias("field"),
        by_kind(none, key, key, none, none).alias("key"),
        by_kind(text("t", n % 100),
                F.when(value < 3, none).when(value < 6, "false").otherwise(props),
                F.when(value < 3, "null").otherwise(props), text("org ", n % 5), none)
        .alias("payload"))


def dc_input(spark: SparkSession, folder: str) -> DataFrame:
    """Flat citation input, one row per part."""
    key, size = F.col("p_partkey"), F.col("p_size")
    first, second = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    written = (F.when(key % 6 == 0, F.col("p_name"))
               .when(key % 6 == 1, F.concat(F.lit("Dr. "), F.col("p_name")))
               .when(key % 6 == 2, F.concat(second, F.lit(", "), first))
               .when(key % 6 == 3, F.concat(second, F.lit("; "), first))
               .when(key % 6 == 4, F.concat(first, F.lit(" van "), second))
               .otherwise(F.concat(F.col("p_name"), F.lit(" Jr."))))
    return spread(table(spark, folder, "part")).select(
        key.alias("submission_id"),
        F.when(key % 50 == 0, "").otherwise(F.col("p_name")).alias("title"),
        F.when(size % 10 != 0, F.col("p_name")).alias("author1"),
        F.when(size % 3 != 0, F.concat("p_type", F.lit(", "), "p_brand")).alias("author2"),
        F.when(size % 10 != 0, written).alias("author3"),
        F.when(size % 4 != 0, F.concat(F.lit("Org "), size.cast("string"))).alias("aff1"),
        F.when(size % 4 >= 2, F.concat(F.lit("Lab "), "p_type")).alias("aff2"),
        F.when(key % 3 == 1, (1990 + size).cast("string")).when(key % 3 == 2, "n/a")
        .alias("publication_year"),
        F.when(key % 4 == 0, F.concat(F.lit("10.5555/"), key.cast("string"))).alias("dataset_doi"),
        F.col("p_type").alias("subject1"),
        F.col("p_brand").alias("tag1"),
        F.when(size % 2 == 1, F.col("p_brand")).alias("publisher"),
        size.alias("size"),
    )


def present(*cols: str) -> Column:
    """The given columns as a list without missing ones."""
    return F.array_compact(F.array(*cols))


def acl_input(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("source_key"),
        F.when(F.col("c_nationkey") % 4 != 0,
               F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))).alias("base_acl"),
        F.when(F.col("c_custkey") % 3 == 0,
               F.concat(F.lit("seg_"), "c_mktsegment")).alias("dataset_acl"),
    ).select("source_key", present("base_acl").alias("acl"),
             present("dataset_acl").alias("dataset_acl"))


def principals(spark: SparkSession, folder: str) -> DataFrame:
    """The identities of one requester: the nations of a region, and a segment."""
    nations = table(spark, folder, "nation").where("n_regionkey = 1").select(
        F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")).alias("principal"))
    segment = table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("seg_"), "c_mktsegment").alias("principal"))
    return nations.unionByName(segment.distinct())


def memberships(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as members of their nation's group, in three roles."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.concat(F.lit("supplier_"), key.cast("string")).alias("principal"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("group"),
        F.when(key % 3 == 0, "member").when(key % 3 == 1, "manager").otherwise("admin")
        .alias("role"))


def curation_tasks(spark: SparkSession, folder: str) -> DataFrame:
    """Active submissions wait for curation."""
    c = catalog(spark, folder).where("active")
    return c.select(
        "source_id",
        F.struct(F.col("owner").alias("submitter")).alias("submission_info"),
        F.col("submission_time").alias("curation_start_date"),
        F.concat(F.lit("Extracted "), F.col("version").cast("string"), F.lit(" records"))
        .alias("extraction_summary"),
        present("organization").alias("acl"),
        "source_key",
    )


def verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on the tasks, some unusable and some for tasks that are gone."""
    key = F.col("source_key")
    return catalog(spark, folder).where("active").select(
        F.when(key % 11 == 0, F.concat("source_id", F.lit("_gone")))
        .otherwise(F.col("source_id")).alias("source_id"),
        F.when(key % 4 == 0, " Accept\n").when(key % 4 == 1, "REJECT").when(key % 4 == 2, "accept")
        .otherwise("maybe").alias("action"),
        F.when(key % 3 == 0, " ").when(key % 3 == 1, "because").alias("reason"),
        "source_key",
    )


def org_registry(spark: SparkSession, folder: str) -> DataFrame:
    return (table(spark, folder, "orders").where("o_orderpriority <> '5-LOW'")
            .select(F.col("o_orderpriority").alias("organization")).distinct())


def org_parents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").where("p_partkey > 0").select(
        F.col("p_partkey").alias("org"),
        F.floor(F.col("p_partkey") / 2).cast("bigint").alias("parent"))


def metadata_updates(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("source_key")
    return catalog(spark, folder).select(
        "source_id",
        (F.col("owner") + key % 2).alias("requester"),
        F.when(key % 3 != 0, F.concat(F.lit("new title "), key.cast("string"))).alias("title"))


def incoming(spark: SparkSession, folder: str) -> DataFrame:
    """New submissions, one per customer; every fifth nation sends new names."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("incoming_key"),
        F.concat(F.when(F.col("c_nationkey") % 5 == 0, "new_").otherwise("ds_"),
                 key.cast("string")).alias("source_name"),
        (key % 3 == 0).alias("update"),
        F.when(key % 2 == 0, F.concat(F.lit("org "), "c_mktsegment")).alias("organization"),
        F.when(key % 4 == 0, F.col("c_acctbal")).alias("size_mb"))


def locations(spark: SparkSession, folder: str) -> DataFrame:
    """Data locations: page URLs, web-app links, endpoint and drive locations."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    links = nation.select(
        (1000000 + F.col("n_nationkey").cast("bigint")).alias("page_id"),
        F.concat(F.lit("https://www.globus.org/app/transfer?origin_id=ep"),
                 F.col("n_nationkey").cast("string"), F.lit("&origin_path=%2Fdata%2F"),
                 "n_name", F.lit("%2F")).alias("url"))
    endpoints = region.select(
        (2000000 + F.col("r_regionkey").cast("bigint")).alias("page_id"),
        F.concat(F.lit("globus://ep"), F.col("r_regionkey").cast("string"),
                 F.lit("/data/")).alias("url"))
    drives = region.select(
        (3000000 + F.col("r_regionkey").cast("bigint")).alias("page_id"),
        F.concat(F.lit("googledrive:///"), "r_name", F.lit(".zip")).alias("url"))
    return pages.unionByName(links).unionByName(endpoints).unionByName(drives)


def delimited(spark: SparkSession, folder: str) -> DataFrame:
    """Delimited text, one line per line item."""
    status = F.when(F.col("l_linestatus") == "F", " ").otherwise(F.col("l_linestatus"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.concat_ws("#", F.col("l_linenumber").cast("string"), "l_returnflag", status)
        .alias("line"))


def part_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Nested JSON documents, one per part: names with quotes and brackets, lists, a price that is
    sometimes written as not available."""
    priced = F.when(F.col("p_partkey") % 4 == 1, "n/a").otherwise(
        F.col("p_retailprice").cast("string"))
    box = F.struct(F.col("p_size").alias("units"))
    entry = F.struct(F.col("p_brand").alias("maker's mark"), F.split("p_name", " ").alias("words"),
                     box.alias("box [outer]"))
    doc = F.struct(F.struct(entry.alias("entry")).alias("stock"), priced.alias("price"))
    return table(spark, folder, "part").select("p_partkey", F.to_json(doc).alias("document"))


def indexed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files of five data types from 15 submissions, one per part."""
    key, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    kind, form = key % 5, F.floor(key % 15 / 5)
    entry = F.to_json(F.struct(
        F.struct(F.struct(F.col("p_type").alias("grade")).alias("it's")).alias("lot"),
        F.array(F.col("p_size"), F.col("p_size") + 1).alias("sizes"), key.alias("id")))
    document = F.when(key % 2 == 0, F.format_string("[%s, {\"id\": -1}]", entry)).otherwise(entry)
    sep = F.when(form == 0, ",").when(form == 1, ";").otherwise("##")
    quoted = F.format_string('"%s ""x"",\n"', F.col("p_type"))
    line = lambda *cells: F.array_join(F.array(*cells), "\x00")
    lines = F.when(form < 2, F.concat(
        line(F.lit("code"), F.lit("grade"), F.lit("remark")), F.lit("\r\n"),
        line(text, quoted, F.lit(" ")), F.lit("\r\n\n"),
        line(F.lit("end"), F.col("p_type"), F.lit("ok")))).otherwise(F.concat(
            line(F.lit("remark"), F.lit("code")), F.lit("\n"),
            line(F.lit('5" wide'), text), F.lit("\n")))
    lines = F.replace(lines, F.lit("\x00"), sep)
    markup = F.format_string(
        '<lot kind="k%s"><part><grade>%s</grade></part><size>0%s</size></lot>', text,
        F.col("p_type"), F.col("p_size").cast("string"))
    listed = F.format_string("part:\n  grade: '%s'\n  id: %s\n---\npart: {id: %s}\n",
                             F.col("p_type"), text, text)
    return table(spark, folder, "part").select(
        key.alias("file_key"), (key % 15).alias("submission_id"),
        F.when(kind == 0, "json").when(kind == 1, "csv").when(kind == 2, "xml")
        .when(kind == 3, "yaml").otherwise("filename").alias("data_type"),
        F.format_string("%s-%s_%s.dat", F.col("p_brand"), text, F.col("p_name")).alias("name"),
        F.when(kind == 0, document).when(kind == 1, lines).when(kind == 2, markup)
        .when(kind == 3, listed).alias("text"))


def file_index(spark: SparkSession) -> DataFrame:
    """The mapping of each of the 15 submissions."""
    grade = {"a.grade": "lot.it's.grade"}
    rows = [
        (0, "json", {**grade, "a.id": "id"}, None, None),
        (5, "json", {**grade, "b": "sizes"}, None, ["PROMO"]),
        (10, "json", {"c.d.e": "lot.none", "c.id": "id"}, None, None),
        (1, "csv", {"a.grade": "grade", "a.code": "code", "note": "remark"}, None, None),
        (6, "csv", {"a.code": "code", "note": "remark"}, ";", ["ok"]),
        (11, "csv", {"note": "remark", "a.gone": "grade"}, "##", None),
        (2, "xml", {"a.grade": "part.grade", "a.kind": "_kind"}, None, None),
        (7, "xml", {"b": "size"}, None, None), (12, "xml", {"c.x": "part"}, None, None),
        (3, "yaml", {"a.grade": "part.grade", "a.id": "part.id"}, None, None),
        (8, "yaml", {"b": "part.id"}, None, None), (13, "yaml", {"a.grade": "part.grade"}, None, None),
        (4, "filename", {"a.brand": r"^Brand#(\d+)", "a.id": r"-(\d+)_"}, None, None),
        (9, "filename", {"b": r"[a-z]+\.dat$"}, None, None),
        (14, "filename", {"c.none": "xyz"}, None, None)]
    return spark.createDataFrame(rows, "submission_id bigint, data_type string, "
                                       "mapping map<string,string>, delimiter string, "
                                       "na_values array<string>")
