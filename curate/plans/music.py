"""Questions about songs: popular, long, prolific."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.functions import ms_to_minutes, split_list, strip_list_markup, to_double, to_int
from curate.operators.analytics import count_by, mean_by, top_k, top_n_per_group


def typed_songs(raw: DataFrame) -> DataFrame:
    """Typed columns over an all-text table, and the length in minutes.

    ``artist_list`` keeps the artists of a song apart; ``artists`` is the
    plain text.
    """
    ms = to_double(F.col("duration_ms"))
    return raw.withColumns(
        {
            "popularity": to_int(F.col("popularity")),
            "duration_ms": ms,
            "minutes": ms_to_minutes(ms),
            "year": to_int(F.col("year")),
            "artist_list": split_list(F.col("artists")),
            "artists": strip_list_markup(F.col("artists")),
        }
    )


def since(songs: DataFrame, min_year: int | None) -> DataFrame:
    return songs if min_year is None else songs.filter(F.col("year") >= min_year)


def most_popular(songs: DataFrame, k: int = 10, min_year: int | None = 2016) -> DataFrame:
    columns = ["name", "artists", "year", "popularity"]
    return top_k(since(songs, min_year).select(*columns), "popularity", k, columns[:3])


def longest(songs: DataFrame, k: int = 10, min_year: int | None = 2016) -> DataFrame:
    """Whole rows of the longest songs; name and artists break ties."""
    return top_k(since(songs, min_year), "minutes", k, ["name", "artists", "year"])


def songs_per_artist_year(songs: DataFrame) -> DataFrame:
    return count_by(songs, "artists", "year", name="songs")


def mean_popularity(songs: DataFrame, min_year: int | None = None) -> DataFrame:
    """Average popularity per artist, over all years unless told otherwise."""
    return mean_by(since(songs, min_year), ["artists"], "popularity", "mean_popularity")


def top_artists_per_year(songs: DataFrame, n: int = 5, split: bool = False) -> DataFrame:
    """The n artists with most songs of each year.

    With ``split`` every artist of a song counts; otherwise the artists text
    as a whole is one artist.
    """
    if split:
        songs = songs.select("year", F.explode("artist_list").alias("artists"))
    counts = count_by(songs, "year", "artists", name="songs")
    return top_n_per_group(counts, ["year"], "songs", n, ["artists"], "rank")
