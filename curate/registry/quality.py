"""Profiles, rules, repeated keys and the curated table."""

from __future__ import annotations

from pyspark.sql import functions as F

from curate.operators import (
    check_rules,
    drift_rules,
    histograms,
    profile_columns,
    repeated_keys,
    rows_with_repeated_keys,
    rule_in_set,
    rule_matches,
    rule_range,
    rule_references,
    rule_unique,
    split_duplicates,
)
from curate.plans import catalogue as cat
from curate.registry.cleaning import DIRTY, STAGES, output_sql
from curate.registry.derived import derived
from curate.registry.entries import Registry, table
from curate.sinks import shared_folder, write_parquet
from curate.sources import read_parquet

REGISTRY = Registry()

SCALARS = ["item_id", "year_txt", "released_txt", "runtime_txt", "gross_txt"]


def profile_sql(source: str, columns: list[tuple[str, str]], stage: str | None = None) -> str:
    """One line per column; the second part of each pair is its Spark type."""
    lines = []
    for name, dtype in columns:
        sentinels = f"count_if(\"{name}\" = 'N/A')" if dtype == "string" else "0"
        head = f"'{stage}' as stage, " if stage else ""
        lines.append(
            f"select {head}'{name}' as \"column\", '{dtype}' as \"type\", "
            f'count_if("{name}" is null)::bigint as nulls, '
            f"{sentinels}::bigint as sentinels from {source}"
        )
    return " union all ".join(lines)


ENTRY_TYPE = "array<struct<Source:string,Value:string>>"


@REGISTRY.query(
    f"with {DIRTY} "
    + profile_sql("dirty", [(c, "string") for c in SCALARS] + [("ratings", ENTRY_TYPE)]),
    name="profile_columns",
)
def column_profile(spark, sf_dir):
    return profile_columns(derived(spark, sf_dir, "dirty"))


FLAT = [c for c in cat.RAW_COLUMNS if c != "Ratings"] + list(cat.RATING_COLUMNS.values())
TYPED = {
    "Year": "int", "Released": "date", "Runtime": "int", "Metascore": "int",
    "imdbRating": "decimal(3,1)", "imdbVotes": "int", "BoxOffice": "int", "Rotten": "int",
    "Metacritic": "decimal(3,1)",
}


PROFILE_SQL = (
    f"with {STAGES} "
    + " union all ".join(
        [
            profile_sql("flat", [(c, "string") for c in FLAT], "flat"),
            profile_sql("clean", [(c, "string") for c in FLAT], "clean"),
            profile_sql("typed", [(c, TYPED.get(c, "string")) for c in FLAT], "typed"),
        ]
    )
)


@REGISTRY.query(PROFILE_SQL)
def stage_profile(spark, sf_dir):
    return cat.reports(derived(spark, sf_dir, "catalogue")).profile


def rule_sql(rule: str, column: str, count: str) -> str:
    return (
        f"select '{rule}' as \"rule\", '{column}' as \"column\", ({count})::bigint as failed_rows, "
        f"case when ({count}) > 0 then 'warn' else 'ok' end as status"
    )


RULES_SQL = (
    f"with {STAGES} "
    + " union all ".join(
        [
            rule_sql("range", "Year", 'select count(*) from typed where "Year" < 1870 or "Year" > 2026'),
            rule_sql("not_null", "imdbID", 'select count(*) from typed where "imdbID" is null'),
            rule_sql(
                "unique",
                "imdbID",
                'select count(*) from (select 1 from typed group by "imdbID" having count(*) > 1)',
            ),
        ]
    )
)


@REGISTRY.query(RULES_SQL)
def rule_results(spark, sf_dir):
    return cat.reports(derived(spark, sf_dir, "catalogue")).rules


@REGISTRY.query(
    " union all ".join(
        [
            rule_sql("range", "l_discount", "select count(*) from lineitem where l_discount < 0.02 or l_discount > 0.07"),
            rule_sql("matches", "l_returnflag", "select count(*) from lineitem where not regexp_matches(l_returnflag, '^[AN]$')"),
            rule_sql("in_set", "l_linestatus", "select count(*) from lineitem where l_linestatus not in ('O')"),
            rule_sql("references", "l_suppkey", "select count(*) from lineitem where l_suppkey not in (select s_suppkey from supplier)"),
            rule_sql("unique", "l_orderkey", "select count(*) from (select 1 from lineitem group by l_orderkey having count(*) > 1)"),
            rule_sql("references", "l_orderkey", "select count(*) from lineitem where not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')"),
        ]
    )
)
def more_rules(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return check_rules(
        lines,
        [
            rule_range("l_discount", 0.02, 0.07),
            rule_matches("l_returnflag", "^[AN]$"),
            rule_in_set("l_linestatus", ["O"]),
            rule_references("l_suppkey", table(spark, sf_dir, "supplier"), "s_suppkey"),
            rule_references("l_orderkey", orders, "o_orderkey"),
            rule_unique("l_orderkey"),
        ],
    )


REPEATED = "select item_id, count(*) as \"count\" from dirty group by item_id having count(*) > 1"


@REGISTRY.query(f"with {DIRTY} {REPEATED}", name="repeated_keys")
def repeated_key_counts(spark, sf_dir):
    return repeated_keys(derived(spark, sf_dir, "dirty"), "item_id")


@REGISTRY.query(
    f"with {DIRTY} select {', '.join(SCALARS)} from dirty "
    f"where item_id in (select item_id from ({REPEATED}))"
)
def rows_repeated(spark, sf_dir):
    return rows_with_repeated_keys(derived(spark, sf_dir, "dirty").select(*SCALARS), "item_id")


NULLED = (
    f"{DIRTY}, keyed as (select case when year_txt like '%–%' then null else item_id end "
    "as item_id, year_txt, released_txt, runtime_txt, gross_txt from dirty)"
)


def first_rows_sql(source: str, key: str, columns: list[str]) -> str:
    """The first row per key by all other columns, nulls first."""
    order = ", ".join(f'"{c}" nulls first' for c in columns if c != key)
    names = ", ".join(f'"{c}"' for c in columns)
    return (
        f'select {names} from (select *, row_number() over (partition by "{key}" '
        f"order by {order}) as turn from {source}) where turn = 1"
    )


def keyed_dirty(spark, sf_dir):
    """Dirty rows, a part of them without a key."""
    key = F.when(~F.col("year_txt").contains("–"), F.col("item_id"))
    return derived(spark, sf_dir, "dirty").select(*SCALARS).withColumn("item_id", key)


@REGISTRY.query(
    f"with {NULLED} "
    + first_rows_sql("(select * from keyed where item_id is not null)", "item_id", SCALARS)
)
def dedup_main(spark, sf_dir):
    return split_duplicates(keyed_dirty(spark, sf_dir), "item_id")[0]


@REGISTRY.query(
    f"""with {NULLED}
    select *, case when item_id is null then 'missing key' else 'repeated key' end as reason
    from keyed where item_id is null
      or item_id in (select item_id from keyed group by 1 having count(*) > 1)"""
)
def dedup_quarantine(spark, sf_dir):
    return split_duplicates(keyed_dirty(spark, sf_dir), "item_id")[1]


OUTPUT = list(cat.OUTPUT_COLUMNS)
CURATED_SQL = f"with {STAGES} " + first_rows_sql("typed", "imdbID", OUTPUT)
QUARANTINE_SQL = f"""with {STAGES} select {output_sql()} from typed where "imdbID" in
    (select "imdbID" from typed group by 1 having count(*) > 1)"""


@REGISTRY.query(CURATED_SQL)
def flagship_curated(spark, sf_dir):
    """One row per key, rows without a key as one more: the original meaning."""
    return cat.curated(derived(spark, sf_dir, "catalogue"), null_keys="collapse")[0]


@REGISTRY.query(QUARANTINE_SQL)
def flagship_quarantine(spark, sf_dir):
    return cat.curated(derived(spark, sf_dir, "catalogue"), null_keys="collapse")[1]


@REGISTRY.query(
    f"with {STAGES} "
    + first_rows_sql('(select * from typed where "imdbID" is not null)', "imdbID", OUTPUT)
)
def curated_main(spark, sf_dir):
    return cat.curated(derived(spark, sf_dir, "catalogue"))[0]


@REGISTRY.query(
    f"""with {STAGES}
    select {output_sql()},
      case when "imdbID" is null then 'missing key' else 'repeated key' end as reason
    from typed where "imdbID" is null
      or "imdbID" in (select "imdbID" from typed group by 1 having count(*) > 1)"""
)
def curated_quarantine(spark, sf_dir):
    return cat.curated(derived(spark, sf_dir, "catalogue"))[1]


@REGISTRY.query(CURATED_SQL)
def transform_written(spark, sf_dir):
    """The transform stage with its files: raw, quarantine and main Parquet."""
    folder = shared_folder(spark)
    raw, main, copies = (f"{folder}/{name}" for name in ("raw", "main", "quarantine"))
    write_parquet(derived(spark, sf_dir, "catalogue"), raw)
    cat.transform(spark, raw, main, copies, null_keys="collapse")
    return read_parquet(spark, main)


@REGISTRY.query(
    f"""with {STAGES}
    select {output_sql()},
      case when "imdbID" is null then 'missing key' else 'repeated key' end as reason
    from typed where "imdbID" is null
      or "imdbID" in (select "imdbID" from typed group by 1 having count(*) > 1)"""
)
def quarantine_written(spark, sf_dir):
    """The quarantine that the transform stage wrote, read back."""
    folder = shared_folder(spark)
    raw, main, copies = (f"{folder}/{name}" for name in ("raw", "main", "quarantine"))
    write_parquet(derived(spark, sf_dir, "catalogue"), raw)
    cat.transform(spark, raw, main, copies)
    return read_parquet(spark, copies)


def report_written(spark, sf_dir, name):
    """A report that the transform counted while it wrote its tables, read back."""
    folder = shared_folder(spark)
    raw = f"{folder}/raw"
    write_parquet(derived(spark, sf_dir, "catalogue"), raw)
    cat.transform(spark, raw, f"{folder}/main", f"{folder}/quarantine", f"{folder}/reports")
    return read_parquet(spark, f"{folder}/reports/{name}")


@REGISTRY.query(PROFILE_SQL)
def profile_written(spark, sf_dir):
    return report_written(spark, sf_dir, "profile")


@REGISTRY.query(RULES_SQL)
def rules_written(spark, sf_dir):
    return report_written(spark, sf_dir, "rules")


@REGISTRY.query(
    f"""with {STAGES}, main as ({first_rows_sql("typed", "imdbID", OUTPUT)})
    select * replace ("imdbRating"::float as "imdbRating", "Metacritic"::float as "Metacritic")
    from main"""
)
def load_casts(spark, sf_dir):
    return cat.for_load(flagship_curated(spark, sf_dir))


# Orders of the years up to 1996 against later ones.
DRIFT = {"o_orderstatus": None, "o_orderpriority": None, "o_totalprice": 10_000.0}


@REGISTRY.query(
    """with cells as (
      select year(o_orderdate) > 1996 as late, 'o_orderstatus' as col, o_orderstatus as bucket from orders
      union all
      select year(o_orderdate) > 1996, 'o_orderpriority', o_orderpriority from orders
      union all
      select year(o_orderdate) > 1996, 'o_totalprice', floor(o_totalprice / 10000.0)::bigint::varchar from orders),
    n as (
      select col, bucket, count(*) filter (late) as new, count(*) filter (not late) as old
      from cells group by 1, 2),
    d as (
      select col, round(sum(abs(new::double / (select count(*) from orders where year(o_orderdate) > 1996)
        - old::double / (select count(*) from orders where year(o_orderdate) <= 1996))) / 2, 6) as distance
      from n group by 1)
    select 'drift' as rule, col as "column", distance,
      case when distance <= case col when 'o_orderstatus' then 0.2 else 0.05 end then 'ok' else 'warn' end as status
    from d"""
)
def drift_between_loads(spark, sf_dir):
    """Rules on how far columns moved between two loads."""
    orders = table(spark, sf_dir, "orders")
    late = F.year("o_orderdate") > 1996
    before, after = (histograms(orders.filter(which), DRIFT) for which in (~late, late))
    return drift_rules(
        before, after, {"o_orderstatus": 0.2, "o_orderpriority": 0.05, "o_totalprice": 0.05}
    )
