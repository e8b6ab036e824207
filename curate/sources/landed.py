"""Search pages and detail records as an API returned them, landed as text.

A search page is (query, page, body), a detail is (title, body); both bodies
are JSON. Fetching them is left to whatever lands the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curate.operators.dedup import keep_one
from curate.operators.skew import HotLimits, has_hot_keys, join_unique
from curate.sinks.files import stored

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("Response", T.StringType()),
        T.StructField("Error", T.StringType()),
        T.StructField(
            "Search",
            T.ArrayType(T.StructType([T.StructField("Title", T.StringType())])),
        ),
    ]
)


def is_success(response: Column) -> Column:
    """Only the text ``True`` marks a usable response."""
    return F.coalesce(response == "True", F.lit(False))


def search_hits(
    pages: DataFrame, max_pages: int | None = None, limits: HotLimits | None = None
) -> DataFrame:
    """Titles found per query: (query, page, pos, title), repeats kept.

    A query is read from page 1 on, up to ``max_pages`` where that is given, and
    ends at its first page that is absent, unreadable or unsuccessful; later pages
    of it are ignored. A page landed more than once counts once.

    Where no query holds a hot share of the pages, which is measured, the pages of
    each are numbered, and one is reached if its number is its place. Otherwise good
    pages are stored, and the end is found by keys: the least page whose successor is
    not there. So no task gathers the pages of a hot query to number them.
    """
    wanted = F.col("page") >= 1
    if max_pages is not None:
        wanted = wanted & (F.col("page") <= max_pages)
    pages = pages.filter(wanted)
    parsed = pages.select("query", "page", F.from_json("body", PAGE_SCHEMA).alias("result"))
    good = parsed.filter(is_success(F.col("result.Response"))).select(
        "query", "page", F.col("result.Search.Title").alias("titles")
    )
    if has_hot_keys(pages, ["query"], limits):
        reached = _reached_by_keys(stored(keep_one(good, ["query", "page"]), "pages"))
    else:
        # Both windows take the rows of a query where one shuffle brings them.
        place = F.dense_rank().over(Window.partitionBy("query").orderBy("page"))
        copy = F.row_number().over(Window.partitionBy("query", "page").orderBy("titles"))
        numbered = good.withColumn("place", place).filter(F.col("place") == F.col("page"))
        reached = numbered.withColumn("copy", copy).filter(F.col("copy") == 1)
    return reached.select("query", "page", F.posexplode("titles").alias("pos", "title"))


def _reached_by_keys(good: DataFrame) -> DataFrame:
    keys = good.select("query", "page")
    there = keys.select(F.col("query").alias("q"), F.col("page").alias("p"))
    before_first = keys.select("query").distinct().withColumn("page", F.lit(0).cast("int"))
    stops = (
        keys.unionByName(before_first)
        .withColumn("page", F.col("page") + 1)
        .join(there, F.col("query").eqNullSafe(F.col("q")) & (F.col("page") == F.col("p")), "left_anti")
        .groupBy(F.col("query").alias("q"))
        .agg(F.min("page").alias("stop"))
    )
    return good.join(
        stops, F.col("query").eqNullSafe(F.col("q")) & (F.col("page") < F.col("stop"))
    )


def accepted_details(details: DataFrame, schema: T.StructType) -> DataFrame:
    """One usable record per title: (title, record)."""
    parsed = details.select("title", F.from_json("body", schema).alias("record"))
    usable = parsed.filter(is_success(F.col("record.Response")))
    return keep_one(usable, "title")


def lookup_details(
    hits: DataFrame, details: DataFrame, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Look up every hit by title and return (records, missing hits).

    A title that was found twice gives its record twice. Hits whose title has
    no usable detail are reported, not dropped. The hits are stored first: they are
    narrow, and every later step reads them instead of the pages.
    """
    hits = stored(hits, "hits")
    usable = accepted_details(details, schema)
    records = join_unique(hits, usable, ["title"]).select("record.*")
    untitled = hits.filter(F.col("title").isNull())
    titled = hits.filter(F.col("title").isNotNull())
    missing = join_unique(titled, usable.select("title"), ["title"], "left_anti")
    return records, missing.unionByName(untitled)
