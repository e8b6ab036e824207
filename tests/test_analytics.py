"""Questions on small literal tables, and running values against brute force."""

from __future__ import annotations

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from curate import operators as op
from curate.operators import skew
from curate.plans import music, sales
from curate.sources import read_csv

# A price on the bound, one just above it, a line of nothing, a line without a city.
LINES = [
    ("L1", "kiln", "pottery", 150.0, 1, "Porto"),
    ("L2", "glaze", "pottery", 150.25, 4, None),
    ("L3", "wheel", "pottery", 900.5, 0, "Turin"),
    ("L4", "loom", "weaving", 900.5, 2, "Turin"),
    ("L5", "yarn", "weaving", 6.5, 40, None),
    ("L6", "shuttle", None, 31.0, 3, "Porto"),
    ("L7", "spare", "weaving", None, 5, "Porto"),
]
# Peers on one day, a day without a price, days out of order, a category that no
# department has.
PRICES = [
    ("kiln", "pottery", 640.0, "2031-05-09"),
    ("kiln", "pottery", 655.5, "2031-05-04"),
    ("kiln", "pottery", 610.0, "2031-05-04"),
    ("kiln", "pottery", None, "2031-05-06"),
    ("kiln", "pottery", 700.0, "2031-05-11"),
    ("loom", "weaving", 88.0, "2031-05-04"),
    ("anvil", "smithing", 12.0, "2031-05-04"),
]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(
        LINES, "id string, product string, category string, price float, quantity int, city string"
    )


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame(PRICES, "product string, category string, price float, day string")


def test_filters(lines):
    both = sales.in_category_above(lines, "pottery", 150)
    assert {r.id for r in both.collect()} == {"L2", "L3"}
    assert {r.id for r in sales.priced_above(lines, 150).collect()} == {"L2", "L3", "L4"}


def test_totals_and_missing_city(lines):
    found = {r.id: (r.total, r.city) for r in sales.with_total(lines, "nowhere").collect()}
    assert found["L1"] == (150.0, "Porto")
    assert found["L2"] == (601.0, "nowhere")
    assert found["L3"] == (0.0, "Turin")
    assert found["L7"] == (None, "Porto")


def test_category_summary(lines):
    found = {r.category: (r.mean_price, r.sum_price) for r in sales.category_summary(lines).collect()}
    assert found == {
        "pottery": (400.25, 1200.75), "weaving": (453.5, 907.0), None: (31.0, 31.0),
    }


def test_running_max_gives_peers_the_same_value(prices):
    found = sales.highest_price_so_far(prices).filter("product = 'kiln'")
    by_row = {(r.day, r.price): r.highest for r in found.collect()}
    assert by_row == {
        ("2031-05-04", 655.5): 655.5, ("2031-05-04", 610.0): 655.5,
        ("2031-05-06", None): 655.5, ("2031-05-09", 640.0): 655.5,
        ("2031-05-11", 700.0): 700.0,
    }


@pytest.mark.parametrize("limit", ["broadcast", "shuffle"])
def test_departments(spark, prices, monkeypatch, limit):
    if limit == "shuffle":
        monkeypatch.setattr("curate.operators.analytics.fits_broadcast", lambda df: False)
    departments = spark.createDataFrame(
        [("pottery", "clay hall"), ("weaving", "cloth hall"), ("glass", "empty hall")],
        "category string, department string",
    )
    found = sales.with_department(prices, departments)
    assert found.columns == ["category", "product", "price", "day", "department"]
    assert Counter(r.department for r in found.collect()) == {"clay hall": 5, "cloth hall": 1}


def brute_running_max(rows):
    out = Counter()
    for p, o, v in rows:
        seen = [
            w for q, x, w in rows
            if q == p and w is not None and (x is None or (o is not None and x <= o))
        ]
        out[(p, o, v, max(seen, default=None))] += 1
    return out


@pytest.mark.parametrize("coarse", [False, True])
@pytest.mark.parametrize("parts", [None, 3, 1000])
def test_running_max_with_nulls_and_hot_partition(spark, monkeypatch, coarse, parts):
    """No partition hot, the largest one hot, all of them hot."""
    if parts is not None:
        monkeypatch.setattr(skew, "HOT_ROWS", 0)
        monkeypatch.setattr(skew, "HOT_PARTS", parts)
    pick = random.Random(7)
    start = datetime.datetime(2024, 1, 1)
    rows = []
    for _ in range(300):
        p = pick.choice(["hot", "hot", "a", "b", None])
        o = pick.choice([None, *(start + datetime.timedelta(minutes=13 * i) for i in range(40))])
        rows.append((p, o, pick.choice([None, *map(float, range(50))])))
    df = spark.createDataFrame(rows, "p string, o timestamp_ntz, v double")
    step = None if coarse else F.lit(0)
    found = op.running_max(df, ["p"], "o", "v", "m", coarse=step)
    assert Counter(tuple(r) for r in found.collect()) == brute_running_max(rows)


def test_top_k_puts_null_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 9)], "id int, v int")
    assert [r.id for r in op.top_k(df, "v", 3, ["id"]).collect()] == [4, 2, 3]
    assert [r.id for r in op.top_k(df, "v", 9, ["id"]).collect()] == [4, 2, 3, 1]


def test_counts_means_and_ranks_keep_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", None), (None, 3), (None, 4), ("b", 7)], "g string, v int"
    )
    assert {tuple(r) for r in op.count_by(df, "g").collect()} == {("a", 2), (None, 2), ("b", 1)}
    assert {tuple(r) for r in op.mean_by(df, ["g"], "v", "m").collect()} == {
        ("a", 1.0), (None, 3.5), ("b", 7.0),
    }
    top = op.top_n_per_group(df, ["g"], "v", 1)
    assert {tuple(r) for r in top.collect()} == {("a", 1, 1), (None, 4, 1), ("b", 7, 1)}


MUSIC = """name,artists,year,popularity,duration_ms
"Say ""Hi"", now","['A', 'B']",2016,80,90000
Old,['A'],2015,99,60000
Tie one,['C'],2017,70,120000.0
Tie two,['D'],2017,70,30000
No number,['C'],2018,unknown,
No year,"['B', 'C']",,75,600000
"""


@pytest.fixture(scope="module")
def songs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("music") / "songs.csv"
    path.write_text(MUSIC)
    return music.typed_songs(read_csv(spark, str(path)))


def test_csv_is_all_text_with_doubled_quotes(spark, tmp_path):
    path = tmp_path / "songs.csv"
    path.write_text(MUSIC)
    raw = read_csv(spark, str(path))
    assert {t for _, t in raw.dtypes} == {"string"}
    assert raw.filter("year = '2016'").first().name == 'Say "Hi", now'
    declared = read_csv(spark, str(path), "name string, artists string, year int, popularity string, duration_ms double")
    assert dict(declared.dtypes)["year"] == "int"


def test_music_questions(songs):
    popular = [tuple(r) for r in music.most_popular(songs).collect()]
    assert popular == [
        ('Say "Hi", now', "A, B", 2016, 80),
        ("Tie one", "C", 2017, 70),
        ("Tie two", "D", 2017, 70),
        ("No number", "C", 2018, None),
    ]
    assert [r.name for r in music.most_popular(songs, k=2).collect()] == ['Say "Hi", now', "Tie one"]
    assert [(r.name, r.minutes) for r in music.longest(songs, k=2).collect()] == [
        ("Tie one", 2.0), ('Say "Hi", now', 1.5),
    ]
    counts = {(r.artists, r.year): r.songs for r in music.songs_per_artist_year(songs).collect()}
    assert counts[("B, C", None)] == 1 and len(counts) == 6
    means = {r.artists: r.mean_popularity for r in music.mean_popularity(songs).collect()}
    assert means == {"A, B": 80.0, "A": 99.0, "C": 70.0, "D": 70.0, "B, C": 75.0}
    assert set(r.artists for r in music.mean_popularity(songs, 2017).collect()) == {"C", "D"}
    top = {(r.year, r.artists, r["rank"]) for r in music.top_artists_per_year(songs, 1).collect()}
    assert top == {(2016, "A, B", 1), (2015, "A", 1), (2017, "C", 1), (2018, "C", 1), (None, "B, C", 1)}
    single = {(r.year, r.artists) for r in music.top_artists_per_year(songs, split=True).collect()}
    assert {a for y, a in single if y == 2016} == {"A", "B"}
