"""Pieces that several operators share: row identity, cut lineage, groups of near copies."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At most so many 64-bit ids are sent to every task as a filter; more are joined by a shuffle.
FILTER_IDS = 2_000_000
#: Ids of a larger bucket aren't paired: its components are bridged where their sets lie side by side.
PAIRED = 16
#: Set items of a part of a bucket; every two parts of a larger bucket are laid side by side.
PART_ITEMS = 400_000
#: Pairs of sets, or items that they share, that are counted at once.
AT_ONCE = 2_000_000
#: At most so many edges are joined into components on the driver (16 bytes each); more by shuffles.
DRIVER_EDGES = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one of this machine's, and then only in local mode."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "papyrine-checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint in the folder that the cluster names in spark.checkpoint.dir."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def wrapped(docs: DataFrame, **more: Column) -> DataFrame:
    """All columns of docs as one struct `row`, beside columns of our own: no names can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in more.items()])


def unwrapped(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def texts(docs: DataFrame) -> DataFrame:
    """(id, text): the identity of the text, and the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(text).alias("id"), text.alias("text"))


def column(df: DataFrame, name: str) -> np.ndarray:
    """A 64-bit column on the driver, without nulls."""
    return df.select(F.col(name).cast("long").alias(name)).where(F.col(name).isNotNull()).toArrow().column(name).to_numpy()


def _sent(ids: DataFrame, key: str, limit: int):
    """Distinct ids as a column of that name, and those as a sorted broadcast (None beyond the limit)."""
    ids = ids.select(F.col(ids.columns[0]).alias(key)).distinct()
    head = column(ids.limit(limit + 1), key)
    return ids, ids.sparkSession.sparkContext.broadcast(np.sort(head)) if len(head) <= limit else None


def _among(batch: pa.RecordBatch, key: str, have: np.ndarray, anti: bool = False) -> pa.RecordBatch:
    col = batch.column(batch.schema.get_field_index(key))
    mine = col.fill_null(0).to_numpy(zero_copy_only=False)
    at = np.searchsorted(have, mine)
    hit = (have[np.minimum(at, len(have) - 1)] == mine) if len(have) else np.zeros(len(mine), bool)
    hit &= ~col.is_null().to_numpy(zero_copy_only=False)
    return batch.filter(pa.array(hit != anti))


def in_ids(df: DataFrame, ids: DataFrame, key: str = "id", limit: int = FILTER_IDS, anti: bool = False) -> DataFrame:
    """Rows of df whose key is (with anti: is not) in ids.

    Up to `limit` ids go to the tasks as a sorted array, so that df isn't
    shuffled; beyond, it is a shuffled semi-join.  The rows are the same.
    """
    ids, known = _sent(ids, key, limit)
    if known is None:
        return df.join(ids, key, "left_anti" if anti else "left_semi")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _among(batch, key, known.value, anti)

    return df.mapInArrow(keep, df.schema)


def mapped(rows: DataFrame, each: Callable, schema: str, ids: DataFrame | None = None, key: str = "key", limit: int = FILTER_IDS) -> DataFrame:
    """rows.mapInArrow(each, schema); with ids, only those of its rows whose key is in ids.

    The rows are those of in_ids, but ids that can be sent are looked up where
    `each` runs: a second Python worker a task would cost memory and a copy of all rows.
    """
    if ids is None:
        return rows.mapInArrow(each, schema)
    ids, known = _sent(ids, key, limit)
    if known is None:
        return rows.mapInArrow(each, schema).join(ids, key, "left_semi")

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            yield _among(batch, key, known.value)

    return rows.mapInArrow(some, schema)


def _union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ends of edges and the least end that each is connected with."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = np.arange(len(ids))
    x, y = at[: len(a)], at[len(a) :]
    while True:
        least = np.minimum(low[x], low[y])
        new = low.copy()
        np.minimum.at(new, low[x], least)
        np.minimum.at(new, low[y], least)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, low):
            return ids, ids[low]
        low = new


def spread(spark: SparkSession, **cols: np.ndarray) -> DataFrame:
    """A DataFrame of 64-bit columns that are on the driver: they are sent as a broadcast, not kept in the plan."""
    names, shared = list(cols), spark.sparkContext.broadcast(list(cols.values()))
    n = len(next(iter(cols.values())))
    parts = 1 + n // 50_000

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                at = slice(k * n // parts, (k + 1) * n // parts)
                yield pa.RecordBatch.from_arrays([pa.array(x[at], pa.int64()) for x in shared.value], names=names)

    return spark.range(0, parts, 1, parts).mapInArrow(each, ", ".join(f"{c} long" for c in names))


def components(edges: DataFrame, driver_edges: int = DRIVER_EDGES) -> DataFrame:
    """(id, label) for the ends of edges (a, b): label is the least id of the connected component.

    Up to driver_edges distinct edges are joined on the driver; more by
    large-star and small-star steps until nothing moves.  Each step is one
    grouped minimum and one join, so a node with millions of neighbours isn't
    gathered.  Both ways give the same rows.
    """
    spark = edges.sparkSession
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    if e.count() <= driver_edges:
        ends = e.toArrow()  # toPandas would make a Python object of every row
        ids, label = _union_find(ends.column("a").to_numpy(), ends.column("b").to_numpy())
        return spread(spark, id=ids, label=label)
    state = None
    while True:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        e = cut(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
    return e.select(F.col("a").alias("id"), F.col("b").alias("label")).union(e.select(F.col("b").alias("id"), F.col("b").alias("label"))).distinct()


def jaccard(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sets (id, items) have at least this Jaccard similarity, with it."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(F.least(F.size("x"), F.size("y")) >= F.lit(threshold) * F.greatest(F.size("x"), F.size("y")))
        .select("a", "b", (both / (F.size("x") + F.size("y") - both)).alias("jaccard"))
        .where(F.col("jaccard") >= threshold)
    )


def bridges(label: np.ndarray, items: np.ndarray, firsts: np.ndarray, threshold: float, at_once: int = AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of similar sets (row i has items firsts[i] to firsts[i + 1]) that connect rows of different labels as all similar pairs do.

    From each label the rows that it reaches are followed breadth-first: every row
    is compared with those that aren't reached yet, so at most one pair a label comes
    out, and large groups of similar sets are soon left.
    """
    n, size = len(firsts) - 1, np.diff(firsts)
    label = np.unique(label, return_inverse=True)[1]
    item = np.unique(items, return_inverse=True)[1]
    by_label = np.argsort(label, kind="stable")
    begins = np.searchsorted(label[by_label], np.arange(label.max(initial=-1) + 2))
    of = np.repeat(np.arange(n), size)
    left = np.ones(n, dtype=bool)
    alive, n_left = np.zeros(0, np.int64), n
    out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for g in range(len(begins) - 1):
        mine = by_label[begins[g] : begins[g + 1]]
        if not left[mine[0]]:
            continue
        left[mine] = False
        n_left -= len(mine)
        frontier = mine
        while len(frontier) and n_left:
            if 2 * n_left < len(alive) or not len(alive):  # the rows of each item, anew when half of them are reached
                alive = np.flatnonzero(left)
                place = np.zeros(n, np.int64)
                place[alive] = np.arange(len(alive))
                some = np.flatnonzero(left[of])
                some = some[np.argsort(item[some], kind="stable")]
                rows_of, starts = place[of[some]], np.searchsorted(item[some], np.arange(item.max(initial=-1) + 2))
            count = size[frontier]
            flat = item[np.arange(count.sum()) + np.repeat(firsts[frontier] - (np.cumsum(count) - count), count)]
            times = starts[flat + 1] - starts[flat]
            ends = np.concatenate([[0], np.cumsum(count)])
            work = np.maximum(np.diff(np.concatenate([[0], np.cumsum(times)])[ends]), len(alive))
            batch, reached = np.cumsum(work) // at_once, []
            for edge in np.split(np.arange(len(frontier)), np.flatnonzero(np.diff(batch)) + 1):
                lo, hi = ends[edge[0]], ends[edge[-1] + 1]
                many = times[lo:hi]
                other = rows_of[np.arange(many.sum()) + np.repeat(starts[flat[lo:hi]] - (np.cumsum(many) - many), many)]
                row = np.repeat(np.repeat(np.arange(len(edge)), count[edge]), many)
                both = np.bincount(row * len(alive) + other, minlength=len(edge) * len(alive))
                hit = np.flatnonzero(both)
                both, x, y = both[hit], frontier[edge][hit // len(alive)], alive[hit % len(alive)]
                good = left[y] & (both / (size[x] + size[y] - both) >= threshold) & (np.minimum(size[x], size[y]) >= threshold * np.maximum(size[x], size[y]))
                x, y = x[good], y[good]
                new, once = np.unique(label[y], return_index=True)
                out_a.append(x[once])
                out_b.append(y[once])
                for k in new:
                    mine = by_label[begins[k] : begins[k + 1]]
                    left[mine] = False
                    n_left -= len(mine)
                    reached.append(mine)
            frontier = np.concatenate(reached) if reached else mine[:0]
    return np.concatenate(out_a), np.concatenate(out_b)


def bridged(one: DataFrame, sets: DataFrame, threshold: float, part_items: int = PART_ITEMS) -> DataFrame:
    """Edges (a, b) that connect the labels of each key of one (key, id, label) as all similar pairs of ids with that key do.

    A key of more than part_items items is cut into parts, and every two parts are
    compared, so that no task holds more than two.
    """
    total = one.join(sets.select("id", F.size("items").alias("n")), "id").groupBy("key").agg(F.ceil(F.sum("n") / part_items).alias("parts"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts"))
    at = one.join(total, "key").select("key", "id", "label", part.alias("p"), "parts")
    others = F.when(F.col("parts") == 1, F.array(F.col("p"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda q: q != F.col("p")))
    at = at.select("key", "id", "label", "p", F.explode(others).alias("q")).select("key", F.least("p", "q").alias("lo"), F.greatest("p", "q").alias("hi"), "id", "label").join(sets, "id")

    def each(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, col = rows.column("id").to_numpy(), rows.column("items").combine_chunks()
        firsts = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy())])
        a, b = bridges(rows.column("label").to_numpy(), col.flatten().to_numpy(), firsts, threshold)
        return pa.table({"a": ids[a], "b": ids[b]})

    return at.select("key", "lo", "hi", "id", "label", "items").groupBy("key", "lo", "hi").applyInArrow(each, "a long, b long")


def near_groups(keys: Callable[..., DataFrame], sets_of: Callable[[DataFrame], DataFrame], threshold: float, paired: int = PAIRED, part_items: int = PART_ITEMS) -> DataFrame:
    """(id, label): connected components of ids that share a key and are similar.

    keys() gives (id, key), the places in hash tables, keys(ids) those with these
    keys, and sets_of(ids) gives (id, items).
    Every pair in a bucket counts, and no bucket is gathered beyond two parts of
    part_items items: buckets are found by their least and greatest id, counted before
    the shuffle.  First each id is verified against the least id that it meets in any
    bucket.  What those edges leave in different components is compared bucket by
    bucket: in those of up to `paired` ids by a join of pairs, in larger ones, whose
    pairs would grow with the square of the input, by bridges of their components.
    Groups of thousands of copies cost about one comparison for each member, and no
    similar pair is missed.
    """
    buckets = cut(keys().groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least <> most").select("key", "least"))
    member = cut(keys(buckets.select("key")).distinct().join(buckets, "key"))
    first = cut(member.where("id <> least").groupBy("id").agg(F.min("least").alias("b")).select(F.col("id").alias("a"), "b"))
    everyone = member.select("id").distinct()
    sets = cut(sets_of(everyone))
    sure = cut(jaccard(first, sets, threshold))
    label = components(sure)
    at = member.select("key", "id").join(label, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    mixed = at.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("ids")).where("lo <> hi").select("key", "ids")
    one = cut(at.join(mixed, "key"))
    small = one.where(F.col("ids") <= paired).drop("ids")
    other = small.select("key", F.col("id").alias("b"), F.col("label").alias("other"))
    pairs = small.select("key", F.col("id").alias("a"), "label").join(other, "key").where("a > b AND label <> other").select("a", "b").distinct().join(first, ["a", "b"], "left_anti")
    rest = jaccard(pairs, sets, threshold).select("a", "b").unionByName(bridged(one.where(F.col("ids") > paired).drop("ids"), sets, threshold, part_items))
    return components(sure.select("a", "b").unionByName(rest))


def later(found: DataFrame, key: str, again: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(uid, doc_id, span, kept_doc_id): rows of found (key, uid, doc_id, span) that aren't the first of their key, and the first's doc_id.

    First is by doc_id (nulls last), uid and span; rows that are equal to the first
    don't count.  The first is found by a grouped minimum, counted before the
    shuffle, and joined back, so that no key is sorted or gathered in one task.
    again(keys): the rows of found with these keys, where those that are repeated are
    to be picked before a shuffle (found is then read twice).
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid", "span")
    first = cut(found.groupBy(key).agg(F.min(order).alias("f"), F.count("*").alias("n")).where("n > 1").select(key, "f"))
    rows = found if again is None else again(first.select(key))
    return rows.join(first, key).where("uid <> f.uid OR span <> f.span").select("uid", "doc_id", "span", F.col("f.doc_id").alias("kept_doc_id"))
