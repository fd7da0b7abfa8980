"""Status words, texts, ISO times, locations and source ids."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.functions import locations, status
from shelfmark.functions.times import hour_number, iso_time


def word(code):
    """The rules, first match wins, for one code."""
    if not code:
        return "Unknown"
    for holds, name in [("F" in code, "Failed"), ("P" in code, "Processing"),
                        (code[-1] == "S", "Succeeded"), (code[-1] == "X", "Cancelled"),
                        (code[0] == "z", "Not started"), ("R" in code, "Retrying error")]:
        if holds:
            return name
    return "Unknown"


@pytest.mark.parametrize("code, want", [
    ("SSF", "Failed"), ("SPz", "Processing"), ("SRS", "Succeeded"), ("SSX", "Cancelled"),
    ("zzz", "Not started"), ("SRM", "Retrying error"), ("MMM", "Unknown"), ("", "Unknown"),
    (None, "Unknown"), ("ssf", "Unknown"),
])
def test_status_word(rows, code, want):
    assert rows([(code,)], "c string", w=status.status_word(F.col("c"))) == [(want,)]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("SFPXzRM", max_size=5), min_size=50, max_size=80))
def test_status_word_equals_model(rows, codes):
    got = rows([(c,) for c in codes], "c string", w=status.status_word(F.col("c")))
    assert [w for w, in got] == [word(c) for c in codes]


def test_texts(rows):
    flow = F.col("flow")
    got = rows([("a_v1.1", "ACTIVE", True, "SPz"), ("b_v1.1", "DONE", False, "SSF"),
                ("c_v1.1", None, False, "zzz")],
               "id string, flow string, active boolean, code string",
               short=status.short_line(F.col("id"), flow),
               full=status.full_text(F.lit("shown"), flow),
               report=status.report_line(F.col("id"), F.col("active"), F.col("code")))
    running = "This submission is still processing."
    over = "This submission is no longer processing."
    missing = "Error: No status found for this submission."
    assert got == [
        (f"a_v1.1: {running}", f"shown\n{running}", "a_v1.1: Processing - Processing"),
        (f"b_v1.1: {over}", f"shown\n{over}", "b_v1.1: Not processing - Failed"),
        (missing, missing, "c_v1.1: Not processing - Not started"),
    ]


@pytest.mark.parametrize("time", [
    datetime(2020, 2, 11), datetime(2020, 2, 11, 1, 2, 3), datetime(2020, 2, 11, 0, 0, 0, 500000),
    datetime(1969, 12, 31, 23, 59, 59, 120)])
def test_iso_time_and_hour(rows, time):
    hours = (time - datetime(1970, 1, 1)).total_seconds() // 3600
    got = rows([(time,)], "t timestamp_ntz", iso=iso_time(F.col("t")), h=hour_number(F.col("t")))
    assert got == [(time.isoformat("T") + "Z", hours)]


@pytest.mark.parametrize("url, scheme, host, path", [
    ("https://example.com/path/data.zip", "https", "example.com", "/path/data.zip"),
    ("http://u@h.org:80/x?y=1#z", "http", "h.org", "/x"),
    ("globus://ep1/path/with blank/", "globus", "ep1", "/path/with blank/"),
    ("googledrive:///my data.zip", "googledrive", None, "/my data.zip"),
    ("no location", None, None, None),
])
def test_url_parts(rows, url, scheme, host, path):
    u = F.col("u")
    assert rows([(url,)], "u string", s=locations.scheme(u), h=locations.host(u),
                p=locations.path(u)) == [(scheme, host, path)]


APP = "https://www.globus.org/app/transfer"


@pytest.mark.parametrize("url, want, is_destination, is_http", [
    (f"{APP}?origin_id=ab-1&origin_path=%2Fa%20b%2F", "globus://ab-1/a b/", True, False),
    (f"{APP}?origin_path=%2Fx&origin_id=e", "globus://e/x", True, False),
    (f"{APP}?origin_id=e", "globus://e/", True, False),
    (f"{APP}?123", f"{APP}?123", False, True),
    ("globus://e/x", "globus://e/x", True, False),
    ("HTTP://a.b/c", "HTTP://a.b/c", False, True),
    ("googledrive:///z.zip", "googledrive:///z.zip", False, False),
])
def test_web_app_links(rows, url, want, is_destination, is_http):
    u = F.col("u")
    assert rows([(url,)], "u string", c=locations.canonical(u), d=locations.is_destination(u),
                h=locations.is_http(u)) == [(want, is_destination, is_http)]


@pytest.mark.parametrize("sid, want", [
    ("my_set_v2.1", (False, "my_set", 2, 1)), ("_test_my_set_v1.12", (True, "my_set", 1, 12)),
    ("a_v3.1_v4.2", (False, "a_v3.1", 4, 2)), ("plain", None),
])
def test_source_id_parts(rows, sid, want):
    (got,), = rows([(sid,)], "s string", p=locations.source_id_parts(F.col("s")))
    assert got == want if want is None else tuple(got) == want


def test_source_ids_and_names(rows):
    got = rows([("set", 3, True, "  The Ångström-Set (v2)! ")],
               "n string, v int, t boolean, title string",
               plain=locations.source_id(F.col("n"), F.col("v")),
               test=locations.source_id(F.col("n"), F.col("v"), F.col("t")),
               clean=locations.clean_source_name(F.col("title")))
    assert got == [("set_v3.1", "_test_set_v3.1", "the_ngstr_m_set_v2")]
