"""Parsing, standardising and flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from curate.functions import (
    array_size_histogram,
    distinct_entry_keys,
    launch_year,
    parse_money,
    parse_score,
    parse_unit,
    pivot_entries,
    strip_list_markup,
    to_date_strict,
    to_int,
)
from curate.operators import in_order
from curate.operators.clean import apply_types
from curate.operators.contracts import check_layout
from curate.plans import catalogue as cat
from curate.registry.derived import derived, derived_sql
from curate.registry.entries import Registry, table
from curate.sinks import shared_folder
from curate.sources import read_csv

REGISTRY = Registry()

DIRTY = derived_sql("dirty")
CATALOGUE = derived_sql("catalogue")


def int_sql(text: str) -> str:
    """Text to int with the fraction cut, as the library reads it."""
    return (
        f"case when regexp_full_match(trim({text}), '[+-]?[0-9]+([.][0-9]*)?') "
        f"then try_cast(split_part(trim({text}), '.', 1) as integer) end"
    )


def date_sql(text: str) -> str:
    return (
        f"case when regexp_full_match({text}, '[0-9]{{2}} [A-Z][a-z]{{2}} [0-9]{{4}}') "
        f"then cast(try_strptime({text}, '%d %b %Y') as date) end"
    )


@REGISTRY.query(
    f"with {DIRTY} select item_id, year_txt, released_txt, runtime_txt, gross_txt from dirty"
)
def dirty_source(spark, sf_dir):
    return derived(spark, sf_dir, "dirty").drop("ratings")


@REGISTRY.query(
    f"""with {DIRTY}
    select item_id, {int_sql("year_txt")} as year, {date_sql("released_txt")} as released,
      {int_sql("replace(runtime_txt, ' min', '')")} as runtime,
      {int_sql("replace(replace(gross_txt, '$', ''), ',', '')")} as gross
    from dirty"""
)
def clean_typed(spark, sf_dir):
    return derived(spark, sf_dir, "dirty").select(
        "item_id",
        to_int(F.col("year_txt")).alias("year"),
        to_date_strict(F.col("released_txt")).alias("released"),
        parse_unit(F.col("runtime_txt"), " min").alias("runtime"),
        parse_money(F.col("gross_txt")).alias("gross"),
    )


@REGISTRY.query(
    f"""with {DIRTY}
    select item_id, year_txt,
      try_cast(regexp_extract(year_txt, '^\\s*([0-9]{{4}})', 1) as integer) as first_year
    from dirty""",
    name="launch_year",
)
def first_year(spark, sf_dir):
    dirty = derived(spark, sf_dir, "dirty")
    return dirty.select("item_id", "year_txt", launch_year(F.col("year_txt")).alias("first_year"))


@REGISTRY.query(
    f"""with {DIRTY}, found as (
      select item_id,
        list_filter(ratings, lambda x: x.Source = 'alpha')[1]."Value" as alpha_txt,
        list_filter(ratings, lambda x: x.Source = 'beta')[1]."Value" as beta_txt
      from dirty)
    select item_id, {int_sql("replace(alpha_txt, '%', '')")} as alpha,
      try_cast(split_part(beta_txt, '/', 1) as decimal(3,1)) as beta
    from found""",
    name="pivot_entries",
)
def pivoted_entries(spark, sf_dir):
    dirty = derived(spark, sf_dir, "dirty").select("item_id", "ratings")
    wide = pivot_entries(dirty, "ratings", {"alpha": "alpha", "beta": "beta"})
    return apply_types(
        wide, {"alpha": lambda c: parse_unit(c, "%"), "beta": parse_score}
    )


@REGISTRY.query(
    f"""with {DIRTY} select distinct u.e.Source as "Source"
    from (select unnest(ratings) as e from dirty) u"""
)
def entry_keys(spark, sf_dir):
    return distinct_entry_keys(derived(spark, sf_dir, "dirty"), "ratings")


@REGISTRY.query(
    f"""with {CATALOGUE}
    select cast(coalesce(len("Ratings"), -1) as integer) as size, count(*) as "count"
    from catalogue group by 1"""
)
def entry_size_hist(spark, sf_dir):
    return array_size_histogram(derived(spark, sf_dir, "catalogue"), "Ratings")


def flat_sql() -> str:
    """The catalogue with one text column per rating source, as ``flat``."""
    picks = ", ".join(
        f"list_filter(\"Ratings\", lambda x: x.Source = '{source}')[1].\"Value\" as \"{out}\""
        for source, out in cat.RATING_COLUMNS.items()
    )
    return f'flat as (select * exclude ("Ratings"), {picks} from catalogue)'


def clean_sql() -> str:
    """``flat`` after sentinels and defaults, as ``clean``."""
    columns = []
    for name in [c for c in cat.RAW_COLUMNS if c != "Ratings"] + list(cat.RATING_COLUMNS.values()):
        value = f'"{name}"'
        if name in cat.SENTINEL_COLUMNS:
            value = f"nullif({value}, 'N/A')"
        if name in cat.DEFAULTS:
            value = f"coalesce({value}, '{cat.DEFAULTS[name]}')"
        columns.append(f'{value} as "{name}"')
    return f"clean as (select {', '.join(columns)} from flat)"


def typed_sql() -> str:
    """``clean`` with typed values, as ``typed``."""
    replaced = {
        "Year": int_sql('"Year"'),
        "Released": date_sql('"Released"'),
        "Runtime": int_sql("replace(\"Runtime\", ' min', '')"),
        "Metascore": int_sql('"Metascore"'),
        "imdbRating": 'try_cast("imdbRating" as decimal(3,1))',
        "imdbVotes": int_sql("replace(\"imdbVotes\", ',', '')"),
        "BoxOffice": int_sql("replace(replace(\"BoxOffice\", '$', ''), ',', '')"),
        "Rotten": int_sql("replace(\"Rotten\", '%', '')"),
        "IMDB": "split_part(\"IMDB\", '/', 1)",
        "Metacritic": "try_cast(split_part(\"Metacritic\", '/', 1) as decimal(3,1))",
    }
    body = ", ".join(f'{expression} as "{name}"' for name, expression in replaced.items())
    return f"typed as (select * replace ({body}) from clean)"


def output_sql() -> str:
    return ", ".join(f'"{c}"' for c in cat.OUTPUT_COLUMNS)


STAGES = f"{CATALOGUE}, {flat_sql()}, {clean_sql()}, {typed_sql()}"

STANDARD = ["imdbID", "Title", *cat.DEFAULTS]


@REGISTRY.query(
    f"""with {CATALOGUE}, {flat_sql()}, {clean_sql()}
    select {', '.join(f'"{c}"' for c in STANDARD)} from clean"""
)
def sentinel_standard(spark, sf_dir):
    raw = derived(spark, sf_dir, "catalogue")
    return cat.standardise(cat.flatten(raw)).select(*STANDARD)


@REGISTRY.query(f"with {STAGES} select * from typed")
def typed_catalogue(spark, sf_dir):
    return cat.typed(derived(spark, sf_dir, "catalogue"))


CONTRACT = [c for c in cat.OUTPUT_COLUMNS if c in cat.RAW_COLUMNS]


@REGISTRY.query(f"with {CATALOGUE} select {', '.join(f'"{c}"' for c in CONTRACT)} from catalogue")
def layout_contract(spark, sf_dir):
    raw = check_layout(derived(spark, sf_dir, "catalogue"), cat.RAW_COLUMNS)
    return in_order(raw, CONTRACT)


@REGISTRY.query(
    f"""with {derived_sql("songs")}
    select name, replace(replace(replace(artists, '[', ''), ']', ''), '''', '') as artists,
      year, popularity, nullif(duration_ms, '') as duration_ms
    from songs"""
)
def csv_roundtrip(spark, sf_dir):
    """Songs written as CSV and read back; an empty text comes back as null."""
    path = f"{shared_folder(spark)}/songs"
    songs = derived(spark, sf_dir, "songs")
    songs.write.option("header", True).option("quote", '"').option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)
    return read_csv(spark, path).withColumn("artists", strip_list_markup(F.col("artists")))


@REGISTRY.query("select * from part")
def parquet_scan(spark, sf_dir):
    return table(spark, sf_dir, "part")
