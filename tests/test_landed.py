"""Landed search pages and details, and the whole job over files."""

from __future__ import annotations

import datetime
import json
from decimal import Decimal

import pytest

from curate.plans import catalogue as cat
from curate.sources import lookup_details, read_json_records, read_parquet, search_hits


def page(*titles, response="True"):
    return json.dumps({"Response": response, "Search": [{"Title": t, "Year": "1"} for t in titles]})


PAGES = [
    ("sand", 1, page("One", "Two")),
    ("sand", 2, page("Three")),
    ("sand", 2, page("Three")),
    ("sand", 3, page(response="False")),
    ("sand", 4, page("Never")),
    ("lush", 1, page("One")),
    ("lush", 3, page("Never")),
    ("dune", 1, '{"Response": "True", "Search": [{"Ti'),
    ("dune", 2, page("Never")),
    ("mist", 2, page("Never")),
    ("long", 1, page("P1")), ("long", 2, page("P2")), ("long", 3, page("P3")),
    ("long", 4, page("P4")), ("long", 5, page("P5")), ("long", 6, page("P6")),
    ("null", 1, None),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "query string, page int, body string")


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_search_stops_at_the_first_bad_page(pages):
    assert found(search_hits(pages, max_pages=5)) == [
        ("long", 1, 0, "P1"), ("long", 2, 0, "P2"), ("long", 3, 0, "P3"), ("long", 4, 0, "P4"),
        ("long", 5, 0, "P5"), ("lush", 1, 0, "One"), ("sand", 1, 0, "One"), ("sand", 1, 1, "Two"),
        ("sand", 2, 0, "Three"),
    ]
    every = found(search_hits(pages))
    assert ("long", 6, 0, "P6") in every and len(every) == 10


def test_search_keeps_pages_of_a_null_query(spark):
    rows = [(None, 1, page("A")), (None, 2, page("B")), (None, 4, page("D"))]
    df = spark.createDataFrame(rows, "query string, page int, body string")
    assert [(r.page, r.title) for r in search_hits(df).orderBy("page").collect()] == [(1, "A"), (2, "B")]


def record(title, key, **fields):
    base = {c: "N/A" for c in cat.RAW_COLUMNS if c not in ("Ratings", "totalSeasons")}
    base |= {"Title": title, "imdbID": key, "Response": "True", "Ratings": []} | fields
    return json.dumps(base)


DETAILS = [
    (
        "One",
        record(
            "One", "tt1", Year="1977", Released="25 May 1977", Runtime="121 min", imdbRating="8.6",
            imdbVotes="1,234,567", BoxOffice="$460,998,507", Type="movie",
            Ratings=[
                {"Source": "Internet Movie Database", "Value": "8.6/10"},
                {"Source": "Rotten Tomatoes", "Value": "93%"},
                {"Source": "Metacritic", "Value": "90/100"},
            ],
        ),
    ),
    ("Two", record("Two", "tt2", Response="False")),
    ("Three", record("Three", "tt3", Year="1999–2003", totalSeasons="4")),
    ("P1", record("P1", "tt3")),
    ("P2", "{cut"),
    ("P3", record("P3", None)),
    ("P3", record("P3", None)),
]


@pytest.fixture(scope="module")
def details(spark):
    return spark.createDataFrame(DETAILS, "title string, body string")


def test_lookup_repeats_and_reports(spark, pages, details):
    records, missing = lookup_details(search_hits(pages), details, cat.RAW_SCHEMA)
    assert records.columns == list(cat.RAW_COLUMNS)
    assert sorted(r.Title for r in records.collect()) == ["One", "One", "P1", "P3", "Three"]
    assert sorted(r.title for r in missing.collect()) == ["P2", "P4", "P5", "P6", "Two"]


def test_a_hit_without_title_is_missing(spark, details):
    hits = spark.createDataFrame([("q", 1, 0, None)], "query string, page int, pos int, title string")
    records, missing = lookup_details(hits, details, cat.RAW_SCHEMA)
    assert records.count() == 0 and missing.count() == 1


def test_job_end_to_end(spark, pages, details, tmp_path, caplog):
    raw, main, copies, report = (str(tmp_path / n) for n in ("raw", "main", "copies", "report"))
    missing = cat.extract(pages, details, raw)
    assert missing.count() == 5
    cat.transform(spark, raw, main, copies, report)
    rows = {r.imdbID: r for r in read_parquet(spark, main).collect()}
    assert set(rows) == {"tt1", "tt3"}
    one = rows["tt1"]
    assert tuple(one.asDict()) == cat.OUTPUT_COLUMNS
    assert (one.Year, one.Released, one.Runtime) == (1977, datetime.date(1977, 5, 25), 121)
    assert (one.imdbRating, one.imdbVotes, one.Rotten) == (Decimal("8.6"), 1234567, 93)
    assert (one.Metacritic, one.BoxOffice, one.totalSeasons) == (Decimal("90.0"), 460998507, "0")
    assert rows["tt3"].Rotten == 0 and rows["tt3"].Year is None
    held = read_parquet(spark, copies)
    assert sorted((r.imdbID or "", r.reason) for r in held.collect()) == [
        ("", "missing key"), ("tt1", "repeated key"), ("tt1", "repeated key"),
        ("tt3", "repeated key"), ("tt3", "repeated key"),
    ]
    rules = {r["rule"]: r.failed_rows for r in read_parquet(spark, f"{report}/rules").collect()}
    assert rules == {"range": 0, "not_null": 1, "unique": 2}
    assert "unique(imdbID): 2 failed" in caplog.text
    sizes = {r["size"]: r["count"] for r in read_parquet(spark, f"{report}/rating_counts").collect()}
    assert sizes == {3: 2, 0: 3}
    profile = {
        (r.stage, r["column"]): (r.nulls, r.sentinels)
        for r in read_parquet(spark, f"{report}/profile").collect()
    }
    assert profile[("flat", "DVD")] == (0, 5)
    assert profile[("flat", "Rotten")] == (3, 0)
    assert profile[("clean", "Rotten")] == (0, 0)
    assert profile[("clean", "DVD")] == (0, 5)
    assert profile[("typed", "Released")] == (3, 0)
    casts = dict(cat.for_load(read_parquet(spark, main)).dtypes)
    assert casts["imdbRating"] == casts["Metacritic"] == "float" and casts["Released"] == "date"


def test_a_changed_layout_stops_the_job(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame([("x",)], "Title string").write.parquet(raw)
    with pytest.raises(ValueError, match="imdbID"):
        cat.transform(spark, raw, str(tmp_path / "main"), str(tmp_path / "copies"))


def test_json_records_fill_missing_fields_with_null(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text('{"Title": "A", "Ratings": [{"Source": "s", "Value": "v"}]}\n{"Year": "1"}\n')
    rows = read_json_records(spark, str(path), cat.RAW_SCHEMA).orderBy("Title").collect()
    assert rows[0].Title is None and rows[0].Year == "1"
    assert rows[1].Ratings[0].Source == "s" and rows[1].imdbID is None


def test_pages_of_hot_and_ordinary_queries_give_the_same_hits(spark):
    import random

    from curate.operators import HotLimits

    pick = random.Random(4)
    rows = []
    for _ in range(300):
        body = pick.choice([
            '{"Response":"True","Search":[{"Title":"a"},{"Title":"b"}]}',
            '{"Response":"True","Search":[{"Title":"c"}]}',
            '{"Response":"False"}', '{"Response":"True","Sea',
        ])
        rows.append((pick.choice(["q", "q", "r", None]), pick.randint(0, 90), body))
    rows += [("q", i, rows[0][2]) for i in range(1, 30)]
    pages = spark.createDataFrame(rows, "query string, page int, body string")
    plain = sorted(map(tuple, search_hits(pages).collect()), key=str)
    hot = sorted(map(tuple, search_hits(pages, limits=HotLimits(0, 1000)).collect()), key=str)
    assert plain == hot and len(plain) > 20


def test_pages_are_scanned_once(spark):
    from curate.registry.landing import landed_pages

    found = search_hits(landed_pages(spark, "/root/testdata/sf0.001"))
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
