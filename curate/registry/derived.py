"""Untidy tables derived from the given ones by equal expressions in both engines.

The given tables are clean and typed, so text that needs parsing, missing
values, nested entries and repeated keys are made from their columns. Every
derived table keeps all rows of its source.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from curate.registry.entries import table


class Dialect(Protocol):
    text: str

    def date_text(self, date: str) -> str: ...
    def grouped(self, number: str) -> str: ...
    def entries(self, *pairs: tuple[str, str, str]) -> str: ...


@dataclass(frozen=True)
class SparkDialect:
    text: str = "string"

    def date_text(self, date: str) -> str:
        return f"date_format({date}, 'dd MMM yyyy')"

    def grouped(self, number: str) -> str:
        return f"format_number({number}, 0)"

    def entries(self, *pairs: tuple[str, str, str]) -> str:
        items = ", ".join(
            f"case when {when} then named_struct('Source', '{source}', 'Value', {value}) end"
            for when, source, value in pairs
        )
        return f"filter(array({items}), x -> x is not null)"


@dataclass(frozen=True)
class DuckDialect:
    text: str = "varchar"

    def date_text(self, date: str) -> str:
        return f"strftime({date}, '%d %b %Y')"

    def grouped(self, number: str) -> str:
        return f"format('{{:,}}', {number})"

    def entries(self, *pairs: tuple[str, str, str]) -> str:
        items = ", ".join(
            f"case when {when} then struct_pack(Source := '{source}', \"Value\" := {value}) end"
            for when, source, value in pairs
        )
        return f"list_filter(list_value({items}), lambda x: x is not null)"


SPARK = SparkDialect()
DUCK = DuckDialect()


def _dirty(d: Dialect) -> dict[str, str]:
    key = "case when o_orderkey % 13 = 0 then o_orderkey - o_orderkey % 26 else o_orderkey end"
    return {
        "item_id": f"concat('tt', lpad(cast({key} as {d.text}), 9, '0'))",
        "year_txt": "case when o_orderkey % 11 = 0 "
        "then concat(year(o_orderdate), '–', year(o_orderdate) + 3) "
        f"else cast(year(o_orderdate) as {d.text}) end",
        "released_txt": "case when o_orderkey % 7 = 0 then 'N/A' "
        f"else {d.date_text('o_orderdate')} end",
        "runtime_txt": "concat(o_orderkey % 180, ' min')",
        "gross_txt": "case when o_orderkey % 5 = 0 then 'N/A' "
        f"else concat('$', {d.grouped('cast(floor(o_totalprice) as bigint)')}) end",
        "ratings": d.entries(
            ("o_orderkey % 2 = 0", "alpha", "concat(o_orderkey % 101, '%')"),
            ("o_orderkey % 3 = 0", "beta", "concat(o_orderkey % 101, '/100')"),
        ),
    }


def _catalogue(d: Dialect) -> dict[str, str]:
    dirty = _dirty(d)
    ratings = d.entries(
        ("o_orderkey % 2 = 0", "Internet Movie Database", "concat(o_orderkey % 10, '.3/10')"),
        ("o_orderkey % 3 = 0", "Rotten Tomatoes", "concat(o_orderkey % 101, '%')"),
        ("o_orderkey % 5 <> 0", "Metacritic", "concat(o_orderkey % 101, '/100')"),
    )
    return {
        "Title": "concat('Work ', o_custkey)",
        "Year": dirty["year_txt"],
        "Rated": "o_orderstatus",
        "Released": dirty["released_txt"],
        "Runtime": "case when o_orderkey % 17 = 0 then 'N/A' "
        "else concat(o_orderkey % 180, ' min') end",
        "Genre": "case when o_orderkey % 14 = 0 then 'N/A' else o_orderpriority end",
        "Director": "concat('Director ', o_custkey % 97)",
        "Writer": "concat('Writer ', o_custkey % 89)",
        "Actors": "concat('Actor ', o_custkey % 83, ', Actor ', o_orderkey % 79)",
        "Plot": "concat('Plot of ', o_orderkey)",
        "Language": "concat('Language ', o_custkey % 9)",
        "Country": "concat('Country ', o_custkey % 25)",
        "Awards": "case when o_orderkey % 4 = 0 then 'N/A' when o_orderkey % 4 = 1 then null "
        "else concat(o_orderkey % 9, ' wins') end",
        "Poster": "concat('poster-', o_orderkey)",
        "Ratings": f"case when o_orderkey % 37 = 0 then null else {ratings} end",
        "Metascore": "case when o_orderkey % 6 = 0 then 'N/A' when o_orderkey % 6 = 1 then null "
        f"else cast(o_orderkey % 101 as {d.text}) end",
        "imdbRating": "case when o_orderkey % 19 = 0 then 'N/A' when o_orderkey % 23 = 0 then '100' "
        "else concat(o_orderkey % 10, '.', o_orderkey % 7) end",
        "imdbVotes": "case when o_orderkey % 41 = 0 then 'N/A' "
        f"else {d.grouped('cast(floor(o_totalprice) as bigint)')} end",
        "imdbID": f"case when o_orderkey % 50 = 7 then null else {dirty['item_id']} end",
        "Type": "case when o_orderkey % 8 = 0 then 'series' else 'movie' end",
        "DVD": "case when o_orderkey % 3 = 0 then 'N/A' when o_orderkey % 3 = 1 then null "
        f"else {d.date_text('o_orderdate')} end",
        "BoxOffice": "case when o_orderkey % 5 = 0 then 'N/A' when o_orderkey % 5 = 1 then null "
        f"else concat('$', {d.grouped('cast(floor(o_totalprice) * 4500 as bigint)')}) end",
        "Production": "case when o_orderkey % 2 = 0 then 'N/A' else o_orderpriority end",
        "Website": f"case when o_orderkey % 2 = 0 then cast(null as {d.text}) else 'N/A' end",
        "Response": "'True'",
        "totalSeasons": "case when o_orderkey % 8 = 0 "
        f"then cast(o_orderkey % 12 as {d.text}) else null end",
    }


def _songs(d: Dialect) -> dict[str, str]:
    return {
        "name": "concat('Song \"', o_orderkey, '\", take ', o_custkey % 5)",
        "artists": "case when o_orderkey % 3 = 0 "
        "then concat('[''Artist ', o_custkey, ''', ''Artist ', o_custkey % 40, ''']') "
        "else concat('[''Artist ', o_custkey % 200, ''']') end",
        "year": "case when o_orderkey % 29 = 0 then 'n/a' "
        f"else cast(year(o_orderdate) + 18 as {d.text}) end",
        "popularity": "case when o_orderkey % 31 = 0 then 'unknown' "
        f"else cast(o_orderkey * 37 % 101 as {d.text}) end",
        "duration_ms": "case when o_orderkey % 43 = 0 then '' "
        f"else concat(cast(floor(o_totalprice) as bigint), '.5') end",
    }


def _lines(d: Dialect) -> dict[str, str]:
    return {
        "order_id": "l_orderkey",
        "line": "l_linenumber",
        "product": "l_partkey",
        "category": "l_returnflag",
        "price": "l_extendedprice",
        "quantity": "l_quantity",
        "city": "case when l_linestatus = 'F' then null else l_linestatus end",
        "day": "cast(l_shipdate as date)",
    }


_DERIVED = {
    "dirty": ("orders", _dirty),
    "catalogue": ("orders", _catalogue),
    "songs": ("orders", _songs),
    "lines": ("lineitem", _lines),
}


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = _DERIVED[name]
    return table(spark, sf_dir, source).selectExpr(
        *[f"{expression} as {alias}" for alias, expression in columns(SPARK).items()]
    )


def derived_sql(name: str) -> str:
    """The same table as a common table expression."""
    source, columns = _DERIVED[name]
    body = ", ".join(f'{expression} as "{alias}"' for alias, expression in columns(DUCK).items())
    return f"{name} as (select {body} from {source})"
