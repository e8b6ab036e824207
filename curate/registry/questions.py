"""Top-k, counts, summaries, running values and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.functions import ms_to_minutes
from curate.operators import (
    count_by,
    join_unique,
    mean_and_sum_by,
    mean_by,
    running_max,
    top_k,
    top_n_per_group,
)
from curate.operators.clean import clamp_negative, fill_with_mean, with_flag
from curate.operators.skew import HotLimits
from curate.plans import music, sales
from curate.registry.cleaning import int_sql
from curate.registry.derived import derived, derived_sql
from curate.registry.entries import Registry, table

REGISTRY = Registry()

SONGS = f"""{derived_sql("songs")}, marked as (
    select * replace (
      {int_sql("year")} as year,
      {int_sql("popularity")} as popularity,
      try_cast(duration_ms as double) as duration_ms,
      replace(replace(replace(artists, '[', ''), ']', ''), '''', '') as artists)
    from songs),
  typed as (
    select *, duration_ms / 60000.0::double as minutes,
      list_filter(list_transform(string_split(artists, ','), lambda a: trim(a)),
        lambda a: a <> '') as artist_list
    from marked)"""


def typed_songs(spark, sf_dir):
    return music.typed_songs(derived(spark, sf_dir, "songs"))


@REGISTRY.query(
    f"""with {SONGS} select name, artists, year, popularity from typed where year >= 2016
    order by popularity desc nulls last, name, artists, year limit 10"""
)
def songs_most_popular(spark, sf_dir):
    return music.most_popular(typed_songs(spark, sf_dir))


@REGISTRY.query(
    f"""with {SONGS} select * exclude (artist_list) from typed where year >= 2016
    order by minutes desc nulls last, name, artists, year limit 10"""
)
def songs_longest(spark, sf_dir):
    return music.longest(typed_songs(spark, sf_dir)).drop("artist_list")


@REGISTRY.query(
    f"with {SONGS} select artists, year, count(*) as songs from typed group by artists, year"
)
def songs_per_artist_year(spark, sf_dir):
    return music.songs_per_artist_year(typed_songs(spark, sf_dir))


@REGISTRY.query(
    f"with {SONGS} select artists, avg(popularity) as mean_popularity from typed group by artists"
)
def songs_mean_popularity(spark, sf_dir):
    return music.mean_popularity(typed_songs(spark, sf_dir))


@REGISTRY.query(
    f"""with {SONGS} select artists, avg(popularity) as mean_popularity
    from typed where year >= 2017 group by artists"""
)
def songs_mean_popularity_recent(spark, sf_dir):
    return music.mean_popularity(typed_songs(spark, sf_dir), 2017)


TOP_ARTISTS = """select * from (
    select year, artists, songs, cast(row_number() over (
      partition by year order by songs desc, artists) as integer) as rank
    from counted) where rank <= 5"""


@REGISTRY.query(
    f"""with {SONGS}, counted as (
      select year, artists, count(*) as songs from typed group by year, artists)
    {TOP_ARTISTS}"""
)
def songs_top_artists(spark, sf_dir):
    return music.top_artists_per_year(typed_songs(spark, sf_dir))


@REGISTRY.query(
    f"""with {SONGS}, single as (select year, unnest(artist_list) as artists from typed),
    counted as (select year, artists, count(*) as songs from single group by year, artists)
    {TOP_ARTISTS}"""
)
def songs_top_single_artists(spark, sf_dir):
    return music.top_artists_per_year(typed_songs(spark, sf_dir), split=True)


LINES = derived_sql("lines")


@REGISTRY.query(f"with {LINES} select * from lines where category = 'A' and price > 50000")
def filter_and(spark, sf_dir):
    return sales.in_category_above(derived(spark, sf_dir, "lines"), "A", 50000.0)


@REGISTRY.query(f"with {LINES} select * from lines where price > 40000")
def lines_filter_price(spark, sf_dir):
    return sales.priced_above(derived(spark, sf_dir, "lines"), 40000.0)


@REGISTRY.query("select p_partkey, p_name, p_size from part where p_size < 10 or p_size > 40")
def filter_or(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return parts.filter((F.col("p_size") < 10) | (F.col("p_size") > 40))


@REGISTRY.query(
    f"""with {LINES} select * replace (coalesce(city, 'no city') as city),
    price * quantity as total from lines"""
)
def line_total_filled(spark, sf_dir):
    return sales.with_total(derived(spark, sf_dir, "lines"))


@REGISTRY.query(
    f"""with {LINES} select category, round(avg(price::decimal(18,2)), 2) as mean_price,
    sum(price::decimal(18,2))::double as sum_price from lines group by category"""
)
def lines_category_summary(spark, sf_dir):
    price = F.col("price").cast("decimal(18,2)")
    lines = derived(spark, sf_dir, "lines").withColumn("price", price)
    return sales.category_summary(lines).select(
        "category",
        F.round(F.col("mean_price").cast("double"), 2).alias("mean_price"),
        F.col("sum_price").cast("double").alias("sum_price"),
    )


@REGISTRY.query(
    f"""with {LINES} select *, max(price) over (partition by product order by day) as highest
    from lines"""
)
def lines_highest_price(spark, sf_dir):
    return sales.highest_price_so_far(derived(spark, sf_dir, "lines"))


@REGISTRY.query(
    """select o_orderkey, o_custkey, o_orderdate::date as day, o_totalprice,
    max(o_totalprice) over (partition by o_custkey order by o_orderdate::date) as highest
    from orders"""
)
def running_max_price(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_totalprice"
    )
    return running_max(orders, ["o_custkey"], "day", "o_totalprice", "highest")


@REGISTRY.query(
    """select l_orderkey, l_linenumber,
      (epoch_ms(l_shipdate) - epoch_ms(o_orderdate)) / 60000.0::double as minutes
    from lineitem join orders on l_orderkey = o_orderkey
    order by minutes desc nulls last, l_orderkey, l_linenumber limit 10"""
)
def longest_lead(spark, sf_dir):
    """Order lines that took longest from order to shipment."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    seconds = (F.col("l_shipdate") - F.col("o_orderdate")).cast(T.DayTimeIntervalType(3, 3))
    ms = seconds.cast("decimal(18,6)").cast("double") * 1000
    leads = join_unique(lines, orders, ["l_orderkey"]).select(
        "l_orderkey", "l_linenumber", ms_to_minutes(ms).alias("minutes")
    )
    return top_k(leads, "minutes", 10, ["l_orderkey", "l_linenumber"])


@REGISTRY.query(
    """select event_id, ts, event_type, value,
    max(value) over (partition by event_type order by ts) as highest from events"""
)
def events_running_max(spark, sf_dir):
    """Few event types and fine time stamps."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return running_max(events, ["event_type"], "ts", "value", "highest")


#: Under these limits every event type is hot, at any size of the table.
ALL_HOT = HotLimits(rows=0, parts=1000)


@REGISTRY.query(
    """select event_id, ts, event_type, value,
    max(value) over (partition by event_type order by ts) as highest from events"""
)
def events_running_max_hot(spark, sf_dir):
    """The same by peaks and carried values, as for types that a task cannot hold."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return running_max(events, ["event_type"], "ts", "value", "highest", limits=ALL_HOT)


#: Enough ranges that a flag lies in several, at any size of the table.
RANGES = 16


@REGISTRY.query(
    """select l_orderkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice,
    max(l_extendedprice) over (partition by l_returnflag order by l_orderkey) as highest
    from lineitem"""
)
def lines_running_max_hot(spark, sf_dir):
    """Three flags and an order by number, from range to range."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_extendedprice"
    )
    return running_max(
        lines, ["l_returnflag"], "l_orderkey", "l_extendedprice", "highest",
        limits=ALL_HOT, ranges=RANGES,
    )


@REGISTRY.query(
    """select * from (
      select l_orderkey, l_linenumber, l_returnflag, l_extendedprice,
        row_number() over (partition by l_returnflag
          order by l_extendedprice desc nulls last, l_orderkey, l_linenumber)::integer as rank
      from lineitem)
    where rank <= 5000"""
)
def top_lines_per_flag(spark, sf_dir):
    """More rows per group than Spark cuts groups to, counted along ranges."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return top_n_per_group(
        lines, ["l_returnflag"], "l_extendedprice", 5000, ["l_orderkey", "l_linenumber"],
        ranges=RANGES,
    )


@REGISTRY.query(
    """select event_id, event_type, value,
    max(value) over (partition by event_type) as peak from events"""
)
def events_with_peak_hot(spark, sf_dir):
    """Each event beside the peak of its type, by a join that spreads every type."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    peaks = events.groupBy("event_type").agg(F.max("value").alias("peak"))
    return join_unique(events, peaks, ["event_type"], limits=ALL_HOT).select(
        "event_id", "event_type", "value", "peak"
    )


@REGISTRY.query(
    """select c_nationkey as category, c_custkey, c_name, c_mktsegment, n_name as department
    from customer join nation on c_nationkey = n_nationkey"""
)
def enrich_broadcast(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("category"), "c_custkey", "c_name", "c_mktsegment"
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("category"), F.col("n_name").alias("department")
    )
    return sales.with_department(customers, nations)


@REGISTRY.query(
    """select o_orderkey, o_totalprice from orders where year(o_orderdate) >= 1997
    order by o_totalprice desc nulls last, o_orderkey limit 10"""
)
def top_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter(F.year("o_orderdate") >= 1997)
    return top_k(orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10, ["o_orderkey"])


@REGISTRY.query(
    """select o_custkey, cast(year(o_orderdate) as integer) as year, count(*) as orders
    from orders group by 1, 2"""
)
def orders_per_customer_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return count_by(
        orders.select("o_custkey", F.year("o_orderdate").alias("year")),
        "o_custkey", "year", name="orders",
    )


@REGISTRY.query(
    """select o_orderstatus, round(avg(o_totalprice::decimal(18,2)), 2) as mean_price
    from orders group by 1"""
)
def avg_price_by_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    means = mean_by(orders, ["o_orderstatus"], "price", "mean_price")
    return means.withColumn("mean_price", F.round(F.col("mean_price").cast("double"), 2))


@REGISTRY.query(
    """select year, o_custkey, orders, rank from (
      select *, cast(row_number() over (
        partition by year order by orders desc, o_custkey) as integer) as rank
      from (select cast(year(o_orderdate) as integer) as year, o_custkey, count(*) as orders
            from orders group by 1, 2)) where rank <= 5"""
)
def top5_customers_per_year(spark, sf_dir):
    counts = orders_per_customer_year(spark, sf_dir)
    return top_n_per_group(counts, ["year"], "orders", 5, ["o_custkey"])


@REGISTRY.query(
    """select c_mktsegment, round(avg(c_acctbal::decimal(18,2)), 2) as mean_balance,
    sum(c_acctbal::decimal(18,2))::double as sum_balance from customer group by 1"""
)
def segment_summary(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").alias("balance")
    )
    summary = mean_and_sum_by(
        customers, ["c_mktsegment"], "balance", "mean_balance", "sum_balance"
    )
    return summary.select(
        "c_mktsegment",
        F.round(F.col("mean_balance").cast("double"), 2).alias("mean_balance"),
        F.col("sum_balance").cast("double").alias("sum_balance"),
    )


@REGISTRY.query(
    """select c_custkey, greatest(c_acctbal, 0.0::double) as balance, c_acctbal < 1000 as low
    from customer"""
)
def clamped_balances(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("balance")
    )
    flagged = with_flag(customers, "low", F.col("balance") < 1000)
    return clamp_negative(flagged, "balance")


@REGISTRY.query(
    f"""with {SONGS} select name, year, popularity is null as filled,
    coalesce(popularity::double, (select avg(popularity) from typed)) as popularity
    from typed"""
)
def songs_filled_popularity(spark, sf_dir):
    songs = typed_songs(spark, sf_dir).select("name", "year", "popularity")
    return fill_with_mean(songs, "popularity", "filled")
