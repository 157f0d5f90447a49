"""Plans over several sources: names, searches, unions and caps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from papyrine.config import Settings
from papyrine.operators import mappers
from papyrine.sources import REGISTRY, register


class UnknownSource(ValueError):
    pass


def resolve(names: str) -> list[str]:
    """`all`, or a list with commas; all names are checked before anything runs, and a repeated one runs again."""
    wanted = list(REGISTRY) if names == "all" else [n.strip() for n in names.split(",")]
    for n in wanted:
        if n not in REGISTRY:
            raise UnknownSource(f"unknown source '{n}'; there are {', '.join(REGISTRY)}")
    return wanted


def options(name: str, settings: Settings) -> dict[str, str]:
    """What a connector gets from the settings."""
    given = {
        "pubmed": {"api_key": settings.ncbi_api_key, "email": settings.ncbi_email},
        "uspto": {"api_key": settings.uspto_api_key},
        "epo": {"key": settings.epo_key, "secret": settings.epo_secret},
        "google_patents": {"api_key": settings.serpapi_key},
    }[name]
    return {k: v for k, v in given.items() if v}


def search(spark: SparkSession, name: str, query: str, max_results: int = 100, date_from: str | None = None, date_to: str | None = None, **more: str) -> DataFrame:
    """Documents of one source.

    For pubmed and epo max_results bounds raw records (dropped ones aren't
    replaced), for the others valid documents.
    """
    register(spark)
    given = {"query": query, "max_results": str(max_results), "date_from": date_from, "date_to": date_to} | more
    raw = spark.read.format(name).options(**{k: v for k, v in given.items() if v is not None}).load()
    if name == "pubmed":
        return mappers.medline(mappers.medline_records(raw))
    if name == "uspto":
        return mappers.patentsview(raw)
    if name == "epo":
        return mappers.exchange_xml(raw).limit(max_results)
    return (mappers.search_api(raw) if "api_key" in more else mappers.search_html(raw)).limit(max_results)


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def spread(df: DataFrame) -> DataFrame:
    """df's rows in four partitions a core, by a hash of all columns, for a step whose rows cost much more than their bytes.

    A scan has no more tasks than its files have row groups, and none the less
    where its columns are small: a million keys that a query makes payloads of
    may lie in one.  Spread them before, not the payloads.
    """
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *df.columns)


def cap(df: DataFrame, n: int, order: list[Column], by: str = "source") -> DataFrame:
    """The first n rows of each source; Spark keeps n a partition and group before it shuffles."""
    return df.withColumn("_at", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_at") <= n).drop("_at")


def limit_then_filter(df: DataFrame, n: int, keep: Column, order: list[Column]) -> DataFrame:
    """n bounds raw rows: dropped ones aren't replaced."""
    return df.orderBy(*order).limit(n).where(keep)


def filter_then_limit(df: DataFrame, n: int, keep: Column, order: list[Column]) -> DataFrame:
    """n bounds the rows that are kept."""
    return df.where(keep).orderBy(*order).limit(n)


def counts(df: DataFrame) -> DataFrame:
    """Documents by source, and (source null) of all, in one aggregation."""
    return df.rollup("source").agg(F.count("*").alias("n"))
