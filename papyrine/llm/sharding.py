"""Proportional stratified interleaving.

Within each source the rows stand in the order of a seeded hash; a row's
fractional rank is (rank - 1/2) / rows of the source.  Sorted by fractional rank,
any stretch of the whole has the mixture of the whole, so shards are equal cuts of
that order.  Ranks are counted by buckets: rows are ranked within buckets of the
hash and within slices of the fractional rank, and offsets come from grouped
counts, so neither a source with most of the rows nor the global order is ever
sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papyrine.llm.common import cut

SEED = 42
SHARDS = 64
#: Rows of a bucket, about.
BUCKET_ROWS = 20_000


def _ranked(rows: DataFrame, part: list[str], bucket: str, order: list[Column], name: str) -> DataFrame:
    """rows with their place (from 1) by bucket and order within part."""
    counts = rows.groupBy(*part, bucket).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*part, bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(Window.partitionBy(*part)).alias(f"{name}_of"))
    inside = F.row_number().over(Window.partitionBy(*part, bucket).orderBy(*order))
    return rows.withColumn("inside", inside).join(counts, [*part, bucket]).withColumn(name, F.col("inside") + F.col("offset")).drop("inside", "offset", bucket)


def interleave(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, shard, position) for every row.

    position counts from 0 within a shard.  Shards hold equal numbers of rows but
    for one, and of each source its share but for two rows at most.  The hash is
    md5 of the seed and doc_id; ties (null and repeated ids) stand in order of
    doc_id, and between rows that are alike in both columns the order is free.
    A null source is a source of its own; an empty table gives no rows.
    """
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(F.col("doc_id"), F.col("source").cast("string").alias("source"), h.alias("h")).withColumn("has", F.col("source").isNotNull()).withColumn("s", F.coalesce("source", F.lit("")))
    total = rows.count()
    buckets = max(1, min(1 << 24, total // bucket_rows))
    number = F.conv(F.substring("h", 1, 6), 16, 10).cast("long")
    rows = rows.withColumn("b", F.floor(number * F.lit(buckets) / F.lit(1 << 24)))
    rows = _ranked(rows, ["has", "s"], "b", [F.col("h"), F.col("doc_id").asc_nulls_first()], "rank")
    # twice the fractional rank, as a fraction of whole numbers: exact in any engine up to 2**53 rows
    frac = (2 * F.col("rank") - 1).cast("double") / (2 * F.col("rank_of")).cast("double")
    rows = cut(rows.select("doc_id", "source", "has", "s", "h", frac.alias("frac"), F.floor(frac * F.lit(buckets)).alias("slice"), F.lit(0).alias("all")))
    rows = _ranked(rows, ["all"], "slice", [F.col("frac"), F.col("has"), F.col("s"), F.col("h"), F.col("doc_id").asc_nulls_first()], "place")
    shard = F.floor((F.col("place") - 1) * F.lit(shards) / F.col("place_of"))
    first = F.ceil(shard * F.col("place_of") / F.lit(shards))
    return rows.select("doc_id", "source", shard.cast("int").alias("shard"), (F.col("place") - 1 - first).cast("long").alias("position"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Whole rows of docs as one sorted Parquet file for each shard; doc_id must be unique."""
    placed = interleave(docs, shards, seed).select(F.col("doc_id").alias("_id"), F.col("shard").alias("_shard"), F.col("position").alias("_position"))
    out = docs.join(placed, docs["doc_id"].eqNullSafe(placed["_id"])).drop("_id")
    out.repartition(shards, "_shard").sortWithinPartitions("_shard", "_position").drop("_position").write.partitionBy("_shard").parquet(path)
