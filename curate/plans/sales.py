"""Questions about order lines and prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.operators.analytics import enrich, mean_and_sum_by, running_max
from curate.operators.clean import fill_defaults


def in_category_above(lines: DataFrame, category: str, price: float) -> DataFrame:
    return lines.filter((F.col("category") == category) & (F.col("price") > price))


def priced_above(lines: DataFrame, price: float) -> DataFrame:
    return lines.filter(F.col("price") > price)


def with_total(lines: DataFrame, no_city: str = "no city") -> DataFrame:
    """Price times quantity, and a text where the city is missing."""
    totals = lines.withColumn("total", F.col("price") * F.col("quantity"))
    return fill_defaults(totals, {"city": no_city})


def category_summary(lines: DataFrame) -> DataFrame:
    """Mean and sum of the prices per category, quantities left aside."""
    return mean_and_sum_by(lines, ["category"], "price", "mean_price", "sum_price")


def highest_price_so_far(prices: DataFrame) -> DataFrame:
    return running_max(prices, ["product"], "day", "price", "highest")


def with_department(lines: DataFrame, departments: DataFrame) -> DataFrame:
    """Lines of the categories that have a department, category first."""
    joined = enrich(lines, departments, ["category"])
    return joined.select("category", *[c for c in joined.columns if c != "category"])
