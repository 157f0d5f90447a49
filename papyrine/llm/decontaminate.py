"""Benchmark decontamination by winnowing.

Both sides keep the least hash of every window of WINDOW consecutive k-grams of
words, so any shared run of at least SPAN = WINDOW + K - 1 words has a
fingerprint in common.  A common fingerprint is extended along its diagonal to
the maximal equal run of words, and runs of at least SPAN words are reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import cut, in_ids, unwrapped, wrapped
from papyrine.llm.text import grams, runs, signed, slices, winnow, words

K = 8
SPAN = 13
#: A benchmark of at most so many words goes to every task; a larger one is joined by a shuffle of fingerprints.
BROADCAST_WORDS = 4_000_000
SCHEMA = "doc_id long, item_id long, doc_start int, item_start int, n_words int"


def prints(w, k: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, their row, and the word of the row at which each begins."""
    g, firsts = grams(w, k, short=False)
    at = winnow(g, firsts, span - k + 1)
    row = np.searchsorted(firsts, at, side="right") - 1
    return g[at], row, at - firsts[row]


def equal_runs(doc: np.ndarray, item: np.ndarray, diagonal: int, span: int) -> list[tuple[int, int, int]]:
    """(doc_start, item_start, n_words) of maximal equal runs of at least span words where doc position - item position = diagonal."""
    lo = max(0, diagonal)
    hi = min(len(doc), len(item) + diagonal)
    if hi - lo < span:
        return []
    starts, ends = runs(doc[lo:hi] == item[lo - diagonal : hi - diagonal])
    return [(lo + int(s), lo + int(s) - diagonal, int(e - s)) for s, e in zip(starts, ends) if e - s >= span]


class Index:
    """The benchmark's words and fingerprints, to look documents up in."""

    def __init__(self, item_ids: pa.Array, text: pa.Array, k: int, span: int):
        w = words(text)
        self.k, self.span, self.ids = k, span, item_ids.to_pylist()
        self.items = [w.hash[w.first[i] : w.first[i + 1]] for i in range(w.rows)]
        fp, row, pos = prints(w, k, span)
        order = np.argsort(fp, kind="stable")
        self.fp, self.row, self.pos = fp[order], row[order], pos[order]

    def look_up(self, w) -> Iterator[tuple[int, int, tuple[int, int, int]]]:
        """(row of w, item, run) for every run."""
        fp, row, pos = prints(w, self.k, self.span)
        if not len(self.fp) or not len(fp):
            return
        lo = np.searchsorted(self.fp, fp)
        hit = np.flatnonzero(self.fp[np.minimum(lo, len(self.fp) - 1)] == fp)
        seen = set()
        for h in hit:
            for j in range(lo[h], np.searchsorted(self.fp, fp[h], side="right")):
                r, item, diagonal = int(row[h]), int(self.row[j]), int(pos[h] - self.pos[j])
                if (r, item, diagonal) not in seen:
                    seen.add((r, item, diagonal))
                    doc = w.hash[w.first[r] : w.first[r + 1]]
                    for run in equal_runs(doc, self.items[item], diagonal, self.span):
                        yield r, item, run


def small_index(benchmark: DataFrame, k: int, span: int, limit: int):
    """The benchmark as a broadcast Index, or None where it has more words than limit."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size > 2 * limit:
        return None
    t = items.toArrow()
    text = t.column("text").combine_chunks()
    return benchmark.sparkSession.sparkContext.broadcast(Index(t.column("item_id").combine_chunks(), text.cast(pa.string()), k, span))


def _fingerprints(rows: DataFrame, k: int, span: int) -> DataFrame:
    """(fp, id, pos) of rows (id, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                fp, row, pos = prints(w, k, span)
                ids = part.column(0).to_numpy(zero_copy_only=False)[row]
                yield pa.RecordBatch.from_arrays([pa.array(signed(fp)), pa.array(ids), pa.array(pos.astype(np.int32))], names=["fp", "id", "pos"])

    return rows.mapInArrow(each, "fp long, id long, pos int")


def _joined(docs: DataFrame, benchmark: DataFrame, k: int, span: int) -> DataFrame:
    """Rows (doc_id, item_id, run, id) by a shuffled join of fingerprints."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.xxhash64(F.col("doc_id"), text).alias("id"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    b = benchmark.select(F.xxhash64(F.col("item_id"), text).alias("item"), F.col("item_id").cast("long").alias("item_id"), text.alias("item_text")).distinct()
    fd = _fingerprints(d.select("id", "text"), k, span)
    fb = _fingerprints(b.select(F.col("item").alias("id"), F.col("item_text").alias("text")), k, span)
    hits = cut(fd.join(fb.select("fp", F.col("id").alias("item"), F.col("pos").alias("item_pos")), "fp").select("id", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct())
    both = in_ids(d, hits.select("id")).dropDuplicates(["id"]).join(hits.groupBy("id", "item").agg(F.collect_set("diagonal").alias("diagonals")), "id").join(b, "item").select("doc_id", "item_id", "text", "item_text", "diagonals", "id")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ids = [], []
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                x, y = words(one.column(2)).hash, words(one.column(3)).hash
                for g in one.column(4)[0].as_py():
                    found = equal_runs(x, y, g, span)
                    out += [(one.column(0)[0].as_py(), one.column(1)[0].as_py(), *run) for run in found]
                    ids += [one.column(5)[0].as_py()] * len(found)
            yield _found(out).append_column("id", pa.array(ids, pa.int64()))

    return both.mapInArrow(extend, SCHEMA + ", id long")


def _found(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "item_id", "doc_start", "item_start", "n_words"])


def contamination(docs: DataFrame, benchmark: DataFrame, k: int = K, span: int = SPAN, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words): every maximal run of at least `span` words that a document shares with a benchmark item.

    Starts count words from 0.  Null texts are empty; texts and items shorter
    than span have no rows; repeated rows give their rows once; null ids are
    carried as null.  All runs are found whatever the size of either table.
    """
    index = small_index(benchmark, k, span, broadcast_words)
    if index is None:
        return _joined(docs, benchmark, k, span).drop("id").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                ids = part.column(0)
                yield _found([(ids[r].as_py(), index.value.ids[i], *run) for r, i, run in index.value.look_up(w)])

    return rows.mapInArrow(each, SCHEMA).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = K, span: int = SPAN, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """docs without the rows that share a run of at least `span` words with a benchmark item; all columns stay.

    Rows with null or short texts stay; rows with equal doc_id are judged each by its own text.
    """
    index = small_index(benchmark, k, span, broadcast_words)
    if index is None:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        bad = cut(_joined(docs, benchmark, k, span).select("id").distinct())
        return unwrapped(in_ids(wrapped(docs, key=F.xxhash64("doc_id", text)), bad, "key", anti=True))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                clean = np.ones(part.num_rows, dtype=bool)
                for r, _, _ in index.value.look_up(w):
                    clean[r] = False
                yield part.filter(pa.array(clean))

    return docs.mapInArrow(each, docs.schema)
