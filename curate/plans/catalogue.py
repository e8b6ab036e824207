"""The catalogue job: raw records to a clean, typed, checked and unique table.

Three stages that any scheduler can call: :func:`extract`, :func:`transform`
and :func:`load`. Everything between reading and writing is also offered as
plain DataFrame functions.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions import (
    array_size_histogram,
    distinct_entry_keys,
    parse_grouped_int,
    parse_money,
    parse_score,
    parse_unit,
    pivot_entries,
    score_text,
    to_date_strict,
    to_decimal,
    to_float,
    to_int,
    to_iso_date,
)
from curate.operators.clean import apply_types, fill_defaults, sentinel_to_null
from curate.operators.contracts import check_layout, in_order
from curate.operators.dedup import (
    REASON,
    keep_one,
    label_quarantine,
    repeated_keys,
    rows_with_repeated_keys,
    split_duplicates,
)
from curate.operators.profile import profile_stages, stage_counts
from curate.operators.rules import (
    RowRule,
    check_rules,
    log_rules,
    row_rule_counts,
    rule_not_null,
    rule_range,
    rule_unique,
    with_status,
)
from curate.operators.skew import fits_broadcast
from curate.sinks import (
    delete_folder,
    load_jdbc,
    move_folder,
    stored,
    write_parquet,
    write_parts,
)
from curate.sinks.versions import VersionedTable
from curate.sources import lookup_details, probe_jdbc, read_parquet, search_hits

logger = logging.getLogger(__name__)

STAGES = ("flat", "clean", "typed")
_HIT, _PART, _KEYLESS = "hit__", "part__", "__keyless"

# The field names of a raw record, the output contract, the
# rating sources, the defaults and the bounds of the year rule.
RAW_COLUMNS = (
    "Title", "Year", "Rated", "Released", "Runtime", "Genre", "Director", "Writer",
    "Actors", "Plot", "Language", "Country", "Awards", "Poster", "Ratings", "Metascore",
    "imdbRating", "imdbVotes", "imdbID", "Type", "DVD", "BoxOffice", "Production",
    "Website", "Response", "totalSeasons",
)
OUTPUT_COLUMNS = (
    "imdbID", "Title", "Year", "Released", "Runtime", "Genre", "Director", "Actors",
    "Language", "Country", "Type", "imdbRating", "imdbVotes", "Rotten", "Metacritic",
    "BoxOffice", "totalSeasons",
)
RATING_COLUMNS = {
    "Rotten Tomatoes": "Rotten",
    "Internet Movie Database": "IMDB",
    "Metacritic": "Metacritic",
}
SENTINEL_COLUMNS = ("Awards", "DVD", "Metascore", "BoxOffice", "Production", "Website")
DEFAULTS = {
    "Awards": "N/A",
    "Metascore": "0",
    "DVD": "N/A",
    "BoxOffice": "0",
    "Production": "N/A",
    "Website": "N/A",
    "totalSeasons": "0",
    "Rotten": "0",
    "Metacritic": "0",
}
YEAR_RANGE = (1870, 2026)
KEY = "imdbID"

RAW_SCHEMA = T.StructType(
    [
        T.StructField(
            name,
            T.ArrayType(
                T.StructType(
                    [T.StructField("Source", T.StringType()), T.StructField("Value", T.StringType())]
                )
            )
            if name == "Ratings"
            else T.StringType(),
        )
        for name in RAW_COLUMNS
    ]
)

PARSERS = {
    "Year": to_int,
    "Released": to_date_strict,
    "Runtime": partial(parse_unit, unit=" min"),
    "Metascore": to_int,
    "imdbRating": to_decimal,
    "imdbVotes": parse_grouped_int,
    "BoxOffice": parse_money,
    "Rotten": partial(parse_unit, unit="%"),
    "IMDB": score_text,
    "Metacritic": parse_score,
}


def flatten(raw: DataFrame) -> DataFrame:
    """Check the layout and give each rating source its own text column."""
    checked = check_layout(raw, RAW_COLUMNS)
    return pivot_entries(checked, "Ratings", RATING_COLUMNS)


def standardise(flat: DataFrame, defaults: Mapping[str, str] = DEFAULTS) -> DataFrame:
    """Sentinel text to null, then null to the default of its column."""
    return fill_defaults(sentinel_to_null(flat, SENTINEL_COLUMNS), defaults)


def typed(raw: DataFrame, defaults: Mapping[str, str] = DEFAULTS) -> DataFrame:
    """All columns of a raw record, cleaned and typed."""
    return apply_types(standardise(flatten(raw), defaults), PARSERS)


def records(raw: DataFrame, defaults: Mapping[str, str] = DEFAULTS) -> DataFrame:
    """The output columns before repeated keys are dealt with."""
    return in_order(typed(raw, defaults), OUTPUT_COLUMNS)


def curated(
    raw: DataFrame, order_by: Sequence[str] = (), null_keys: str = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """(main, quarantine) of a raw table; see ``split_duplicates``."""
    return split_duplicates(records(raw), KEY, order_by, null_keys)


def rules() -> list:
    return [rule_range("Year", *YEAR_RANGE), rule_not_null(KEY), rule_unique(KEY)]


@dataclass(frozen=True)
class Reports:
    """What is known about a raw table before it is curated."""

    sources: DataFrame
    rating_counts: DataFrame
    profile: DataFrame
    rules: DataFrame


def staged(raw: DataFrame) -> DataFrame:
    """The typed columns, and each state on the way as a struct: flat, clean, typed."""
    flat = flatten(raw)
    with_flat = flat.withColumn("flat", F.struct(*flat.columns))
    clean = standardise(with_flat)
    with_clean = clean.withColumn("clean", F.struct(*flat.columns))
    done = apply_types(with_clean, PARSERS)
    return done.withColumn("typed", F.struct(*flat.columns))


def reports(raw: DataFrame) -> Reports:
    """Rating sources, ratings per record, column profile and rule results.

    The profile covers the flat, the standardised and the typed state of the
    table in one scan.
    """
    return Reports(
        distinct_entry_keys(raw, "Ratings"),
        array_size_histogram(raw, "Ratings"),
        profile_stages(staged(raw), STAGES),
        check_rules(typed(raw), rules()),
    )


@dataclass(frozen=True)
class Split:
    """What a written split knows: the repeated keys, and one row of counts over all rows."""

    repeated: DataFrame
    counted: DataFrame | None


def write_split(
    df: DataFrame,
    key: str,
    main_path: str,
    quarantine_path: str,
    order_by: Sequence[str] = (),
    null_keys: str = "quarantine",
    columns: Sequence[str] | None = None,
    counts: Sequence[Column] = (),
) -> Split:
    """Write both halves of ``split_duplicates`` without shuffling unique rows.

    The repeated keys are stored once. When that list is small enough to
    broadcast, which is measured, whole rows are read once: one write deals them
    into folders for unique, repeated and missing keys, beside the main path. The
    quarantine and the survivors are made from the latter two, the survivors join
    the unique rows, and that folder takes the place of the main path last, so a
    run that stops leaves the old main table. Otherwise both halves are shuffled.
    The quarantine is written even when it is empty, so no earlier one is left
    behind. On object stores the last move copies files within the store.

    ``columns`` names what is written, all columns by default. ``counts`` are whole-number
    aggregates with names over all rows of ``df``; they ride on the one write, whose
    tasks count once however often they run, and take one more scan where rows are
    shuffled, as tasks before a shuffle may count twice.
    """
    if null_keys not in ("quarantine", "collapse"):
        raise ValueError(f"null_keys must be 'quarantine' or 'collapse', not {null_keys!r}")
    columns = list(columns or df.columns)
    rows = df.select(*columns)
    if null_keys == "quarantine" and REASON in columns:
        raise ValueError(f"the table has a column {REASON!r} of its own; rename it first")
    keyed = rows.filter(F.col(key).isNotNull())
    repeated = stored(repeated_keys(keyed, key), "repeated_keys")
    if fits_broadcast(repeated):
        counted = _write_dealt(
            df, key, columns, repeated, main_path, quarantine_path, order_by, null_keys, counts
        )
        return Split(repeated, counted)
    copies = rows_with_repeated_keys(keyed, key, repeated)
    _write_quarantine(copies, rows, key, quarantine_path, null_keys)
    main = keep_one(keyed, key, order_by)
    if null_keys == "collapse":
        main = main.unionByName(keep_one(rows.filter(F.col(key).isNull()), key, order_by))
    write_parquet(main, main_path)
    return Split(repeated, stored(df.agg(*counts), "counts") if counts else None)


def _write_quarantine(
    copies: DataFrame, rows: DataFrame, key: str, path: str, null_keys: str
) -> None:
    quarantine = label_quarantine(copies, rows, key) if null_keys == "quarantine" else copies
    rest = [c for c in quarantine.columns if c != key]
    write_parquet(quarantine.select(key, *rest), path)


def _write_dealt(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    repeated: DataFrame,
    main_path: str,
    quarantine_path: str,
    order_by: Sequence[str],
    null_keys: str,
    counts: Sequence[Column],
) -> DataFrame | None:
    spark = df.sparkSession
    folder = f"{main_path.rstrip('/')}.parts-{uuid.uuid4().hex}"
    seen = Observation() if counts else None
    watched = df.observe(seen, *counts) if counts else df
    hits = F.broadcast(repeated.select(key, F.lit(True).alias(_HIT)))
    part = (
        F.when(F.col(key).isNull(), "missing").when(F.col(_HIT), "repeated").otherwise("unique")
    )
    dealt = watched.join(hits, key, "left").select(*columns, part.alias(_PART))
    write_parts(dealt, _PART, folder)
    parts = read_parquet(spark, folder, dealt.schema)
    copies, missing = (
        parts.filter(F.col(_PART) == name).drop(_PART) for name in ("repeated", "missing")
    )
    _write_quarantine(copies, missing, key, quarantine_path, null_keys)
    survivors = keep_one(copies, key, order_by)
    if null_keys == "collapse":
        survivors = survivors.unionByName(keep_one(missing, key, order_by))
    unique = f"{folder}/{_PART}=unique"
    write_parquet(survivors, unique, "append")
    move_folder(spark, unique, main_path)
    delete_folder(spark, folder)
    if seen is None:
        return None
    return spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in seen.get.items()])


def extract(
    pages: DataFrame, details: DataFrame, raw_path: str, max_pages: int | None = None
) -> DataFrame:
    """Landed search pages and details to raw Parquet; returns the missing hits."""
    found, missing = lookup_details(search_hits(pages, max_pages), details, RAW_SCHEMA)
    write_parquet(found, raw_path)
    return missing


def transform(
    spark: SparkSession,
    raw_path: str,
    main_path: str,
    quarantine_path: str,
    report_path: str | None = None,
    null_keys: str = "quarantine",
) -> None:
    """Raw Parquet to curated Parquet, with reports beside it when asked for.

    The profile and the rules are counted while the rows are written, and the unique
    rule by the list of repeated keys, so only the two reports on ratings read the
    input on their own. Reports say, they never stop the write: it comes first.
    """
    raw = read_parquet(spark, raw_path)
    if report_path is None:
        write_split(records(raw), KEY, main_path, quarantine_path, null_keys=null_keys)
        return
    states = staged(raw)
    profile = stage_counts(states, STAGES)
    by_row = [r for r in rules() if isinstance(r, RowRule)]
    checks = row_rule_counts(by_row)
    keyless = F.count_if(F.col(KEY).isNull()).alias(_KEYLESS)
    split = write_split(
        states, KEY, main_path, quarantine_path, null_keys=null_keys,
        columns=OUTPUT_COLUMNS,
        counts=[*profile.aggregates, *checks.aggregates, keyless],
    )
    unique = split.counted.select(
        F.lit("unique").alias("rule"),
        F.lit(KEY).alias("column"),
        (F.lit(split.repeated.count()) + (F.col(_KEYLESS) > 1).cast("long")).alias("failed_rows"),
    )
    found = Reports(
        distinct_entry_keys(raw, "Ratings"),
        array_size_histogram(raw, "Ratings"),
        profile.lines_of(split.counted),
        with_status(checks.lines_of(split.counted).unionByName(unique)),
    )
    for name in ("sources", "rating_counts", "profile", "rules"):
        write_parquet(getattr(found, name), f"{report_path}/{name}")
    log_rules(read_parquet(spark, f"{report_path}/rules"))


def refresh(spark: SparkSession, raw_path: str, table_path: str) -> int:
    """Curate the raw files that came in since the last run and upsert their records.

    Returns the number of files. The table is created by the first run; running again
    over the same files changes nothing. See ``VersionedTable``.
    """
    schema = records(spark.createDataFrame([], RAW_SCHEMA)).schema
    table = VersionedTable.create(spark, table_path, schema, KEY)
    return table.load_files(raw_path, RAW_SCHEMA, prepare=records)


def for_load(main: DataFrame) -> DataFrame:
    """Final casts before the load: scores as float, the date as a date."""
    return apply_types(
        main, {"imdbRating": to_float, "Metacritic": to_float, "Released": to_iso_date}
    )


def load(spark: SparkSession, main_path: str, url: str, table: str, **options: object) -> int:
    """Curated Parquet to a database table; returns the rows written.

    The connection is probed first, so an unreachable database costs no read.
    """
    probe_jdbc(spark, url, **{k: options[k] for k in ("user", "password", "driver") if k in options})
    return load_jdbc(for_load(read_parquet(spark, main_path)), url, table, **options)
