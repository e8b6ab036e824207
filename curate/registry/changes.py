"""Incremental loads (extensions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from curate.operators import (
    HotLimits,
    as_of,
    classify_changes,
    history,
    merge_history,
    new_rows,
    upsert,
    write_upsert,
)
from curate.registry.entries import Registry, table
from curate.sinks import shared_folder
from curate.sinks.versions import VersionedTable

REGISTRY = Registry()

# The target lacks the customers of one segment, the incoming table has other
# balances for those of another.
TABLES = """target as (
    select c_custkey, c_name, c_acctbal from customer where c_mktsegment <> 'HOUSEHOLD'),
  incoming as (
    select c_custkey, c_name,
      case when c_mktsegment = 'MACHINERY' then c_acctbal + 1 else c_acctbal end as c_acctbal
    from customer where c_mktsegment <> 'FURNITURE')"""

COLUMNS = ["c_custkey", "c_name", "c_acctbal"]


def target(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return customers.filter(F.col("c_mktsegment") != "HOUSEHOLD").select(*COLUMNS)


def incoming(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "FURNITURE")
    moved = F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 1)
    return customers.withColumn("c_acctbal", F.coalesce(moved, "c_acctbal")).select(*COLUMNS)


@REGISTRY.query(
    f"with {TABLES} select * from incoming where c_custkey not in (select c_custkey from target)"
)
def increment(spark, sf_dir):
    return new_rows(incoming(spark, sf_dir), target(spark, sf_dir), "c_custkey")


@REGISTRY.query(
    f"""with {TABLES} select i.*, case when t.c_custkey is null then 'new'
      when i.c_name is not distinct from t.c_name
        and i.c_acctbal is not distinct from t.c_acctbal then 'same'
      else 'changed' end as action
    from incoming i left join target t using (c_custkey)"""
)
def change_actions(spark, sf_dir):
    return classify_changes(incoming(spark, sf_dir), target(spark, sf_dir), "c_custkey")


@REGISTRY.query(
    f"""with {TABLES} select * from incoming union all
    select * from target where c_custkey not in (select c_custkey from incoming)"""
)
def upserted(spark, sf_dir):
    return upsert(incoming(spark, sf_dir), target(spark, sf_dir), "c_custkey")


@REGISTRY.query(
    f"""with {TABLES} select * from incoming union all
    select * from target where c_custkey not in (select c_custkey from incoming)"""
)
def upsert_written(spark, sf_dir):
    path = f"{shared_folder(spark)}/customers"
    return write_upsert(incoming(spark, sf_dir), target(spark, sf_dir), "c_custkey", path)


# Three in four incoming rows have no key.
KEYLESS = f"""{TABLES}, keyless as (
    select case when c_custkey % 4 = 0 then c_custkey end as c_custkey, c_name, c_acctbal
    from incoming)"""


def keyless(spark, sf_dir):
    key = F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey"))
    return incoming(spark, sf_dir).withColumn("c_custkey", key)


@REGISTRY.query(
    f"""with {KEYLESS} select * from keyless k
    where not exists (select 1 from target t where t.c_custkey = k.c_custkey)"""
)
def increment_keyless(spark, sf_dir):
    return new_rows(keyless(spark, sf_dir), target(spark, sf_dir), "c_custkey")


@REGISTRY.query(
    f"""with {KEYLESS} select k.*, case when t.c_custkey is null then 'new'
      when k.c_name is not distinct from t.c_name
        and k.c_acctbal is not distinct from t.c_acctbal then 'same'
      else 'changed' end as action
    from keyless k left join target t on k.c_custkey = t.c_custkey"""
)
def change_actions_keyless(spark, sf_dir):
    return classify_changes(keyless(spark, sf_dir), target(spark, sf_dir), "c_custkey")


@REGISTRY.query(
    """with one as (
      select o_custkey, o_orderdate::date as day, min(o_orderstatus) as o_orderstatus
      from orders group by 1, 2),
    marked as (
      select *, lag(o_orderstatus) over (partition by o_custkey order by day) as before
      from one),
    kept as (select * from marked where before is null or before <> o_orderstatus)
    select o_custkey, o_orderstatus, day as valid_from,
      lead(day) over (partition by o_custkey order by day) as valid_to
    from kept""",
    name="history",
)
def status_history(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus"
    )
    return history(orders, "o_custkey", "day", ["o_orderstatus"])


@REGISTRY.query(
    """with one as (
      select user_id, ts, min(event_type) as event_type from events group by 1, 2),
    marked as (
      select *, lag(event_type) over (partition by user_id order by ts) as before from one),
    kept as (select * from marked where before is null or before <> event_type)
    select user_id, event_type, ts as valid_from,
      lead(ts) over (partition by user_id order by ts) as valid_to
    from kept"""
)
def event_history(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return history(events, "user_id", "ts", ["event_type"])


#: Under these limits every key with more than one in a thousand rows is hot.
HOT = HotLimits(rows=0, parts=1000)
RANGES = 16

# Every ninth order comes without a customer, every fifth comes late.
STATUS = """versions as (
      select case when o_orderkey % 9 <> 0 then o_custkey % 50 end as customer,
        o_orderdate as moment, o_orderstatus from orders),
    one as (
      select customer, moment, min(o_orderstatus) as o_orderstatus from versions group by 1, 2),
    marked as (
      select *, lag(o_orderstatus) over (partition by customer order by moment) as before from one),
    kept as (select * from marked where before is null or before <> o_orderstatus)
    select customer, o_orderstatus, moment as valid_from,
      lead(moment) over (partition by customer order by moment) as valid_to
    from kept"""


def status_versions(spark, sf_dir):
    customer = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey") % 50)
    late = F.col("o_orderkey") % 5 == 0
    return table(spark, sf_dir, "orders").select(
        customer.alias("customer"), F.col("o_orderdate").alias("moment"), "o_orderstatus", late.alias("late")
    )


@REGISTRY.query(f"with {STATUS}")
def history_hot(spark, sf_dir):
    """Histories of few keys, linked from range to range."""
    versions = status_versions(spark, sf_dir)
    return history(versions, "customer", "moment", ["o_orderstatus"], limits=HOT, ranges=RANGES)


@REGISTRY.query(f"with {STATUS}")
def history_merged(spark, sf_dir):
    """A stored history after late versions equals the history of all versions."""
    every = status_versions(spark, sf_dir)
    versions, late = every.filter(~F.col("late")), every.filter("late")
    path = f"{shared_folder(spark)}/held"
    history(versions, "customer", "moment", ["o_orderstatus"]).write.parquet(path)
    return merge_history(
        spark.read.parquet(path), versions, late, "customer", "moment", ["o_orderstatus"]
    )


# What a user last clicked and how much it was worth, at each of their other events.
CLICKS = """with clicks as (
      select user_id, ts, min(struct_pack(v := value, p := props)) as s
      from events where event_type = 'click' group by 1, 2)
    select e.event_id, e.user_id, e.ts, c.s.v as clicked_value, c.s.p as clicked_props
    from (select * from events where event_type <> 'click') e
    asof left join clicks c on e.user_id = c.user_id and e.ts >= c.ts"""


def clicks_as_of(spark, sf_dir, **options):
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "event_type",
        F.col("value").alias("clicked_value"), F.col("props").alias("clicked_props"),
    )
    clicks = events.filter(F.col("event_type") == "click")
    others = events.filter(F.col("event_type") != "click").select("event_id", "user_id", "ts")
    return as_of(others, clicks, "user_id", "ts", ["clicked_value", "clicked_props"], **options)


@REGISTRY.query(CLICKS)
def events_as_of(spark, sf_dir):
    return clicks_as_of(spark, sf_dir)


@REGISTRY.query(CLICKS)
def events_as_of_hot(spark, sf_dir):
    """The same with the last value carried from range to range."""
    return clicks_as_of(spark, sf_dir, limits=HotLimits(rows=0, parts=1_000_000), ranges=RANGES)


@REGISTRY.query(
    f"""with {KEYLESS} select * from keyless union all
    select * from target where c_custkey not in (select c_custkey from keyless where c_custkey is not null)"""
)
def upsert_versioned(spark, sf_dir):
    """A target in versions, changed in the buckets that the incoming rows touch; the same
    batch a second time changes nothing."""
    held = target(spark, sf_dir)
    customers = VersionedTable.create(
        spark, f"{shared_folder(spark)}/customers", held.schema, "c_custkey", buckets=16
    )
    customers.upsert(held, "first")
    for _ in range(2):
        customers.upsert(keyless(spark, sf_dir), "second")
    return customers.read()


@REGISTRY.query(
    f"""with {KEYLESS} select * from keyless union all
    select * from target where c_custkey not in (select c_custkey from keyless where c_custkey is not null)"""
)
def increment_once(spark, sf_dir):
    """Landed files are loaded once each, however often the load runs."""
    folder = shared_folder(spark)
    schema = target(spark, sf_dir).schema
    customers = VersionedTable.create(spark, f"{folder}/customers", schema, "c_custkey", buckets=16)
    for rows in (target(spark, sf_dir), keyless(spark, sf_dir)):
        rows.write.mode("append").parquet(f"{folder}/landed")
        for _ in range(2):
            customers.load_files(f"{folder}/landed", schema)
    return customers.read()
