"""MinHash near-dedup with tensored banding.

Two collections of `side` short minhash vectors are computed; each of the
side * side tables is keyed by one vector of either, so that side * side tables
of 2 * half rows take 2 * side * half minhashes instead of side * side * 2 * half.
Documents that share a table key are compared by the exact Jaccard similarity of
their sets of word shingles, and connected components of similar documents are
the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import cut, in_ids, mapped, near_groups, texts, unwrapped, wrapped
from papyrine.llm.text import U, grams, lists, minhashes, mix, signed, slices

SHINGLE = 3
SIDE = 10
HALF = 2
THRESHOLD = 0.5
SEED = 11


def tensored_keys(docs: DataFrame, shingle: int = SHINGLE, side: int = SIDE, half: int = HALF, seed: int = SEED, ids: DataFrame | None = None) -> DataFrame:
    """(id, key) for each of the side * side tables of every document that has words; with ids, those whose key is among them."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                rows, mh = minhashes(*grams(w, shingle), 2 * side * half, seed)
                short = np.zeros((len(rows), 2 * side), dtype=np.uint64)
                for v in range(2 * side):
                    for j in range(half):
                        short[:, v] = mix(short[:, v] * U(0x9E3779B97F4A7C15) + mh[:, v * half + j])
                left, right = short[:, :side], short[:, side:]
                table = np.arange(1, side * side + 1, dtype=np.uint64).reshape(1, side, side)
                key = mix(left[:, :, None] * U(0xD6E8FEB86659FD93) + right[:, None, :] + table)
                ids = part.column(0).to_numpy(zero_copy_only=False)[rows]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, side * side)), pa.array(signed(key.reshape(-1)))], names=["id", "key"])

    return mapped(texts(docs), keys, "id long, key long", ids)


def shingle_sets(docs: DataFrame, ids: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(id, items): the distinct 32-bit shingle hashes of the texts with these ids."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                g, firsts = grams(w, shingle)
                row = np.repeat(np.arange(w.rows, dtype=np.uint64), np.diff(firsts))
                both = np.unique((row << U(32)) | (g >> U(32)))
                at = np.searchsorted(both >> U(32), np.arange(w.rows + 1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays([part.column(0), lists((both & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32), at, pa.int32())], names=["id", "items"])

    return in_ids(texts(docs), ids).dropDuplicates(["id"]).mapInArrow(sets, "id long, items array<int>")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, side: int = SIDE, half: int = HALF) -> DataFrame:
    """(doc_id, group_id, kept) for each row that is in a group of copies.

    A group holds rows with equal texts and rows of similar texts (Jaccard of
    word shingles at least `threshold`, transitively).  Exactly one row of each
    group has kept = true: the one of the least doc_id (nulls last, ties of
    equal ids are broken by the text's hash, and between repeated rows by
    chance); group_id is its doc_id.  Texts that are null or have no words are
    in no group.  Texts of fewer words than a shingle are one shingle; very long
    texts are compared whole.  An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    docs = docs.select("doc_id", "text")
    return _numbered(docs, threshold, shingle, side, half).select("doc_id", "group_id", "kept")


def _numbered(docs: DataFrame, threshold: float, shingle: int, side: int, half: int) -> DataFrame:
    """(doc_id, id, group_id, kept) of the rows in groups of at least two."""
    keys = lambda ids=None: tensored_keys(docs, shingle, side, half, ids=ids)
    label = cut(near_groups(keys, lambda ids: shingle_sets(docs, ids, shingle), threshold))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.where(text.rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")).select("doc_id", F.xxhash64(text).alias("id"))
    group = rows.join(label, "id", "left").select("doc_id", "id", F.coalesce("label", "id").alias("label"))
    each = group.groupBy("label", "doc_id", "id").agg(F.count("*").alias("times"))  # repeated rows are counted before they meet
    head = each.groupBy("label").agg(F.sum("times").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("f")).where("n > 1")
    return (
        each.join(head, "label")
        .select("doc_id", "id", F.col("f.doc_id").alias("group_id"), (F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("id") == F.col("f.id"))).alias("is_head"), F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
        .select("doc_id", "id", "group_id", (F.col("is_head") & (F.col("copy") == 1)).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE, side: int = SIDE, half: int = HALF) -> DataFrame:
    """docs without the rows that near_duplicates marks as not kept; all columns stay.

    Of repeated rows with equal doc_id and text one stays.  Null texts and texts
    without words stay, whatever their ids; very long texts are compared whole; an
    empty table stays empty.
    """
    found = cut(_numbered(docs.select("doc_id", "text"), threshold, shingle, side, half))
    key = F.xxhash64("doc_id", "id")
    each = found.groupBy(key.alias("key")).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = wrapped(docs, key=F.xxhash64(F.col("doc_id"), F.xxhash64(text)))
    plain = in_ids(rows, each.select("key"), "key", anti=True)
    single = in_ids(rows, each.where("kept and n = 1").select("key"), "key")
    repeated = in_ids(rows, each.where("kept and n > 1").select("key"), "key").dropDuplicates(["key"])
    return unwrapped(plain.unionByName(single).unionByName(repeated))
