"""Credits: one per scraped page, one per ten requested search results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scrape_credit(pages: Column | None = None) -> Column:
    """Credits of a scrape; further formats of the same URL are free."""
    return (pages if pages is not None else F.lit(1)).cast("bigint")


def search_credit(num: Column) -> Column:
    """Credits of a search by the number of results *requested*, rounded up to tens."""
    return F.ceil(num / F.lit(10)).cast("bigint")


def scrape_credits(requests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pages scraped with success, and their credits."""
    ok = requests.where(F.col("status").between(200, 299))
    return ok.groupBy(*by).agg(F.count(F.lit(1)).alias("pages"), F.sum(scrape_credit()).alias("credits"))


def search_credits(requests: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return requests.groupBy(*by).agg(
        F.count(F.lit(1)).alias("searches"), F.sum(search_credit(F.col("num"))).alias("credits")
    )


def ledger(scrapes: DataFrame, searches: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Both kinds of request as one table of `(kind, *keep, credits)`; repeats stay."""
    a = scrapes.select(F.lit("scrape").alias("kind"), *keep, scrape_credit().alias("credits"))
    b = searches.select(F.lit("search").alias("kind"), *keep, search_credit(F.col("num")).alias("credits"))
    return a.unionByName(b)


def credit_ledger(entries: DataFrame, by: Sequence[str]) -> DataFrame:
    """Credits per group with sub-totals and the grand total (`level` counts the columns rolled up)."""
    return entries.rollup(*by).agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("requests"), F.sum("credits").alias("credits")
    )
