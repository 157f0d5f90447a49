"""Repeated passages: shared runs of words, repeated sentences, paragraph MinHash banding, components.

Three things of a text are compared with those of all other texts and of the
same text.  *Passages* are runs of at least PASSAGE_WORDS words that occur earlier,
word for word: each is found whole, whatever sentences, lines and punctuation it
has.  Every run of PASSAGE_WORDS words belongs to the least of its K-grams, which
equal runs have in common; only those anchors are shuffled, with the hashes of the
runs that belong to them.  *Paragraphs* are lines of at least PARAGRAPH_WORDS words:
their word bigrams are minhashed into BANDS tables of ROWS rows, paragraphs that
collide are verified by exact Jaccard similarity, and of each connected component
the first occurrence stays.  *Sentences* find shorter passages that begin or end
inside a line: they are compared as a whole (one band of the full hash), and
contiguous repeated sentences of at least RUN_WORDS words together are removed,
but for the first occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import FILTER_IDS, column, cut, in_ids, later, mapped, near_groups, unwrapped, wrapped
from papyrine.llm.text import U, Words, lists, minhashes, mix, powers, runs, signed, slices, spans

PARAGRAPH_WORDS = 20
SENTENCE_WORDS = 6
RUN_WORDS = 20
PASSAGE_WORDS = 50
K = 16
#: Bytes of a run's hash that are kept beside its anchor's 64 bits.
HASH_BYTES = 5
#: Anchors of more places are compared run by run, which no task does alone; the rows are the same.
HOT_ROWS = 1_000_000
#: Longer sentences are also cut between pairs of words whose hash ends in three zeros.
LONG_SENTENCE = 12
BANDS = 8
ROWS = 3
THRESHOLD = 0.7
SEED = 23

IS_STOP = np.zeros(256, dtype=bool)
IS_STOP[[ord(c) for c in ".!?\n"]] = True


def _after(w: Words, special: np.ndarray) -> np.ndarray:
    """Whether a special byte follows each word before the next; true for a row's last word."""
    seen = np.concatenate([[0], np.cumsum(special[w.buf], dtype=np.int32)])
    nxt = np.append(w.start[1:], len(w.buf))
    out = seen[nxt] > seen[w.end]
    last = w.first[1:][np.diff(w.first) > 0] - 1
    out[last] = True
    return out


def _segments(w: Words, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and hash of the segments that end after the marked words."""
    stop = np.flatnonzero(ends) + 1
    start = np.concatenate([[0], stop[:-1]]) if len(stop) else stop
    p, inv = powers(len(w.hash) + 1)
    acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * p[: len(w.hash)], dtype=np.uint64)])
    return start, stop - start, mix((acc[stop] - acc[start]) * inv[start] + (stop - start).astype(np.uint64))


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentences, each with the shorter ones before it; long ones are cut where the words' hashes say so, wherever they stand."""
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = _after(w, IS_STOP)
    stop = np.flatnonzero(ends) + 1
    n = np.diff(np.concatenate([[0], stop]))
    pair = mix(w.hash[:-1] * U(0xD6E8FEB86659FD93) + w.hash[1:])
    ends[:-1] |= (np.repeat(n, n)[:-1] > LONG_SENTENCE) & ((pair & U(7)) == 0)
    stop = np.flatnonzero(ends) + 1
    n = np.diff(np.concatenate([[0], stop]))
    row_end = np.zeros(len(ends) + 1, dtype=bool)
    row_end[w.first[1:]] = True
    keep = (n >= SENTENCE_WORDS) | row_end[stop]
    ends[:] = False
    ends[stop[keep] - 1] = True
    start, n, h = _segments(w, ends)
    long = n >= SENTENCE_WORDS
    return start[long], n[long], h[long]


def anchors(w: Words, run_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all runs of run_words words: hash of the anchor, first word and number of the runs that belong to it one after another, and the hashes of all runs."""
    k = min(K, run_words)
    count = np.maximum(np.diff(w.first) - run_words + 1, 0)
    if not count.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = w.hash[: len(w.hash) - k + 1].copy()  # those across rows are in no run
    for j in range(1, k):
        g *= U(0xD6E8FEB86659FD93)
        g += w.hash[j : len(g) + j]
    g = mix(g)
    best, at, have, window = g, np.arange(len(g)), 1, run_words - k + 1
    while have < window:  # the least (the last of equals) of windows twice as long
        step = min(have, window - have)
        other, there = best[step:], at[step:]
        n = len(other)
        take = other <= best[:n]
        best, at, have = np.where(take, other, best[:n]), np.where(take, there, at[:n]), have + step
    firsts = np.concatenate([[0], np.cumsum(count)])
    start = np.arange(firsts[-1]) + np.repeat(w.first[:-1] - firsts[:-1], count)
    at = at[start]
    new = np.append(True, (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))
    new[firsts[:-1][count > 0]] = True
    head = np.flatnonzero(new)
    p, inv = powers(len(w.hash) + 1)
    acc = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hash * p[: len(w.hash)], dtype=np.uint64)])
    return g[at[head]], start[head], np.diff(np.append(head, len(start))), mix((acc[start + run_words] - acc[start]) * inv[start] + U(run_words))


def paragraphs(w: Words, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of at least so many words."""
    if not len(w.hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    line = np.zeros(256, dtype=bool)
    line[10] = True
    start, n, h = _segments(w, _after(w, line))
    long = n >= least
    return start[long], n[long], h[long]


def _bigrams(w: Words, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word bigrams of each segment, and where each segment's begin."""
    if len(w.hash) < 2:
        return np.zeros(0, np.uint64), np.zeros(len(n) + 1, np.int64)
    g = mix(w.hash[:-1] * U(0xD6E8FEB86659FD93) + w.hash[1:])
    firsts = np.concatenate([[0], np.cumsum(n - 1)])
    return g[np.arange(firsts[-1]) + np.repeat(start - firsts[:-1], n - 1)], firsts


def _rows(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, text)"""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col("doc_id"), text).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def _place(part: pa.RecordBatch, w: Words, start: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """uid, doc_id and first word in the row of segments."""
    row = np.searchsorted(w.first, start, side="right") - 1
    at = pa.array(row)
    return part.column(0).take(at), part.column(1).take(at), start - w.first[row]


def repeated_sentences(rows: DataFrame) -> DataFrame:
    """(uid, doc_id, span, kept_doc_id): later occurrences of sentences; span is first word << 32 | words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                start, n, h = sentences(w)
                u, d, at = _place(part, w, start)
                yield pa.RecordBatch.from_arrays([pa.array(signed(h)), u, d, pa.array((at << 32) | n)], names=["key", "uid", "doc_id", "span"])

    found = lambda ids=None: mapped(rows, each, "key long, uid long, doc_id long, span long", ids)
    return later(found(), "key", found)


def later_runs(batches: Iterator[pa.RecordBatch], run_words: int) -> Iterator[pa.RecordBatch]:
    """Runs that aren't the first of their hash, of rows (key, uid, doc_id, at, hashes) in order; those of a key that goes on in the next batch are kept in sorted levels, each over twice as long as the next, so that a key's cost doesn't grow with the square of its places."""
    none = np.iinfo(np.int64).max
    last: int | None = None
    levels: list[list[np.ndarray]] = []  # of the last key: run, uid, word, doc_id of each first
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy()
        same = key[1:] == key[:-1]
        more = np.append(False, same) | np.append(same, True)  # the last may go on in the next batch
        more[0] |= bool(levels) and last == key[0]
        row = np.flatnonzero(more)
        part = batch.take(pa.array(row))
        col = part.column(4)
        ends = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(col.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, HASH_BYTES)
        n = np.diff(ends) // HASH_BYTES
        of = np.repeat(np.arange(len(n)), n)
        h = np.zeros((len(of), 8), np.uint8)
        h[:, :HASH_BYTES] = data
        word = part.column(3).to_numpy()[of].astype(np.int64) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        k, u, d = key[row][of], part.column(1).to_numpy()[of], part.column(2).fill_null(none).to_numpy()[of]
        run, first, inv = np.unique(mix(k.view(np.uint64) + mix(h.reshape(-1).view("<u8"))), return_index=True, return_inverse=True)
        fu, fw, fd, new = u[first], word[first], d[first], np.ones(len(first), dtype=bool)
        if last != key[0]:
            levels = []
        for have in levels:
            at = np.minimum(np.searchsorted(have[0], run), len(have[0]) - 1)
            old = have[0][at] == run
            fu[old], fw[old], fd[old], new[old] = have[1][at[old]], have[2][at[old]], have[3][at[old]], False
        if last != key[-1]:
            levels = []
        last = int(key[-1])
        new &= k[first] == last
        if new.any():
            levels.append([x[new] for x in (run, fu, fw, fd)])
        while len(levels) > 1 and len(levels[-2][0]) <= 2 * len(levels[-1][0]):
            both = [np.concatenate(x) for x in zip(*levels[-2:])]
            order = np.argsort(both[0], kind="stable")
            levels[-2:] = [[x[order] for x in both]]
        gone = np.flatnonzero((fu[inv] != u) | (fw[inv] != word))  # equal places are repeated rows
        if not len(gone):
            continue
        begins = np.flatnonzero(np.append(True, (of[gone][1:] != of[gone][:-1]) | (gone[1:] != gone[:-1] + 1)))
        words = np.diff(np.append(begins, len(gone))) + run_words - 1
        kept = np.minimum.reduceat(fd[inv][gone], begins)
        who = pa.array(of[gone[begins]])
        yield pa.RecordBatch.from_arrays([part.column(1).take(who), part.column(2).take(who), pa.array((word[gone[begins]] << 32) | words), pa.array(kept, mask=kept == none)], names=["uid", "doc_id", "span", "kept_doc_id"])


def repeated_runs(rows: DataFrame, run_words: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(uid, doc_id, span, kept_doc_id): later occurrences of runs of run_words words, joined as far as they have an anchor in common; span is first word << 32 | words.

    Anchors are counted first, before the shuffle; those that occur once are left
    out, and those of more than hot_rows places are compared run by run, so that a
    passage that a third of all texts share isn't one task's work.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                key, start, n, h = anchors(w, run_words)
                u, d, at = _place(part, w, start)
                data = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES])
                ends = np.concatenate([[0], np.cumsum(n * HASH_BYTES)]).astype(np.int32)
                hashes = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), u, d, pa.array(at.astype(np.int32)), hashes], names=["key", "uid", "doc_id", "at", "hashes"])

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.frombuffer(batch.column(4).buffers()[1], np.int32)[batch.column(4).offset :][: batch.num_rows + 1].astype(np.int64)
            n = np.diff(ends) // HASH_BYTES
            of = np.repeat(np.arange(len(n)), n)
            h = np.zeros((len(of), 8), np.uint8)
            if len(of):
                h[:, :HASH_BYTES] = np.frombuffer(batch.column(4).buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(-1, HASH_BYTES)
            key = mix(batch.column(0).to_numpy()[of].view(np.uint64) + mix(h.reshape(-1).view("<u8")))
            word = batch.column(3).to_numpy()[of].astype(np.int64) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(signed(key)), batch.column(1).take(pa.array(of)), batch.column(2).take(pa.array(of)), pa.array((word << 32) | run_words)], names=["key", "uid", "doc_id", "span"])

    found = lambda ids=None: mapped(rows, each, "key long, uid long, doc_id long, at int, hashes binary", ids)
    counts = cut(found().select("key").groupBy("key").count().where("count > 1"))
    some = found(counts.where(F.col("count") <= hot_rows).select("key"))
    out = some.repartition("key").sortWithinPartitions("key", F.col("doc_id").asc_nulls_last(), "uid", "at").mapInArrow(lambda batches: later_runs(batches, run_words), "uid long, doc_id long, span long, kept_doc_id long")
    hot = counts.where(F.col("count") > hot_rows).select("key")
    if hot.isEmpty():
        return out
    runs_ = found(hot).mapInArrow(single, "key long, uid long, doc_id long, span long")
    return out.unionByName(later(runs_, "key", lambda ids: in_ids(runs_, ids, "key")))


def repeated_paragraphs(rows: DataFrame, paragraph_words: int, bands: int, band_rows: int, threshold: float) -> DataFrame:
    """(uid, doc_id, span, kept_doc_id): paragraphs that are similar to an earlier one of their component."""
    spark = rows.sparkSession

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, w in slices(batch):
                start, n, h = paragraphs(w, paragraph_words)
                _, once = np.unique(h, return_index=True)
                start, n, h = start[once], n[once], h[once]
                _, mh = minhashes(*_bigrams(w, start, n), bands * band_rows, SEED)
                key = np.zeros((len(h), bands), dtype=np.uint64)
                for b in range(bands):
                    key[:, b] = U(b + 1)
                    for j in range(band_rows):
                        key[:, b] = mix(key[:, b] * U(0x9E3779B97F4A7C15) + mh[:, b * band_rows + j])
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(signed(h), bands)), pa.array(signed(key.reshape(-1)))], names=["id", "key"])

    def chosen(ids: DataFrame):
        head = column(ids.limit(FILTER_IDS + 1), "id")
        return spark.sparkContext.broadcast(np.sort(head)) if len(head) <= FILTER_IDS else None

    def pick(known, h: np.ndarray) -> np.ndarray:
        if known is None:
            return np.ones(len(h), dtype=bool)
        at = np.searchsorted(known.value, signed(h))
        return known.value[np.minimum(at, len(known.value) - 1)] == signed(h) if len(known.value) else np.zeros(len(h), dtype=bool)

    def sets_of(ids: DataFrame) -> DataFrame:
        known = chosen(ids)

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, w in slices(batch):
                    start, n, h = paragraphs(w, paragraph_words)
                    mine = pick(known, h)
                    start, n, h = start[mine], n[mine], h[mine]
                    _, once = np.unique(h, return_index=True)
                    start, n, h = start[once], n[once], h[once]
                    g, firsts = _bigrams(w, start, n)
                    both = np.unique((np.repeat(np.arange(len(h), dtype=np.uint64), n - 1) << U(32)) | (g >> U(32)))
                    at = np.searchsorted(both >> U(32), np.arange(len(h) + 1, dtype=np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(signed(h)), lists((both & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32), at, pa.int32())], names=["id", "items"])

        out = rows.select("text").mapInArrow(sets, "id long, items array<int>").dropDuplicates(["id"])
        return out if known is not None else out.join(ids, "id", "left_semi")

    label = cut(near_groups(lambda ids=None: mapped(rows.select("text"), keys, "id long, key long", ids), sets_of, threshold))
    known = chosen(label.select("id"))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                start, n, h = paragraphs(w, paragraph_words)
                mine = pick(known, h)
                u, d, at = _place(part, w, start[mine])
                yield pa.RecordBatch.from_arrays([pa.array(signed(h[mine])), u, d, pa.array((at << 32) | n[mine])], names=["id", "uid", "doc_id", "span"])

    found = rows.mapInArrow(occurrences, "id long, uid long, doc_id long, span long").join(label, "id")
    return later(cut(found.select("label", "uid", "doc_id", "span")), "label")


def _removals(docs: DataFrame, paragraph_words: int, run_words: int, bands: int, band_rows: int, threshold: float, passage_words: int) -> DataFrame:
    """(uid, doc_id, starts, words, kept): the runs of words to remove from each text, in order and apart."""
    rows = _rows(docs)
    whole = repeated_paragraphs(rows, paragraph_words, bands, band_rows, threshold).unionByName(repeated_runs(rows, passage_words)).withColumn("whole", F.lit(True))
    found = repeated_sentences(rows).withColumn("whole", F.lit(False)).unionByName(whole)  # what repeated rows give twice does no harm
    each = found.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("span", "whole", "kept_doc_id")).alias("found"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            flat = batch.column(2).flatten()
            at = batch.column(2).value_lengths().to_numpy().cumsum()
            span, is_whole = flat.field(0).to_numpy(), flat.field(1).to_numpy(zero_copy_only=False)
            kept_ids = flat.field(2).to_pylist()
            begin = 0
            for end in at:
                s, n, whole_ = span[begin:end] >> 32, span[begin:end] & 0xFFFFFFFF, is_whole[begin:end]
                gone = np.zeros(int((s + n).max()), dtype=np.int8)
                for a, b in zip(s[~whole_], n[~whole_]):
                    gone[a : a + b] = 1
                for a, b in zip(*runs(gone == 1)):
                    if b - a < run_words:
                        gone[a:b] = 0
                for a, b in zip(s[whole_], n[whole_]):
                    gone[a : a + b] = 1
                starts, ends = runs(gone == 1)
                kept: list = [None] * len(starts)
                for a, k in zip(s, kept_ids[begin:end]):
                    i = int(np.searchsorted(starts, a, side="right")) - 1
                    if i >= 0 and a < ends[i] and k is not None and (kept[i] is None or k < kept[i]):
                        kept[i] = k
                out.append((starts.tolist(), (ends - starts).tolist(), kept))
                begin = int(end)
            cols = [pa.array(c, pa.list_(k)) for c, k in zip(list(zip(*out)) or [(), (), ()], (pa.int32(), pa.int32(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols], names=["uid", "doc_id", "starts", "words", "kept"])

    return each.mapInArrow(merge, "uid long, doc_id long, starts array<int>, words array<int>, kept array<long>").where(F.size("starts") > 0)


def repeated_passages(docs: DataFrame, paragraph_words: int = PARAGRAPH_WORDS, run_words: int = RUN_WORDS, bands: int = BANDS, band_rows: int = ROWS, threshold: float = THRESHOLD, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """(doc_id, start_word, n_words, kept_doc_id): runs of words that repeat an earlier passage.

    Earlier is by doc_id (nulls last, then the text's hash) and position; the
    earliest passage of each component has no row, and kept_doc_id is the least
    document id that keeps a copy of a part of the run.  All words of a run of at
    least passage_words words that occurs earlier, word for word, are in a row (of
    words that repeat at once, again and again, one period stays).  Rows with equal
    doc_id and text count as one document.  Null, empty and short texts have no
    rows; very long texts are compared whole; an empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    found = _removals(docs, paragraph_words, run_words, bands, band_rows, threshold, passage_words)
    return found.select("doc_id", F.explode(F.arrays_zip("starts", "words", "kept")).alias("r")).select("doc_id", F.col("r.starts").alias("start_word"), F.col("r.words").alias("n_words"), F.col("r.kept").alias("kept_doc_id"))


def cut_words(text: str, starts: list[int], counts: list[int]) -> str:
    """text without runs of words and what stands behind them; a line break among it stays one."""
    raw = text.encode()
    buf = np.frombuffer(raw, dtype=np.uint8)
    begin, _, _ = spans(buf, np.array([0, len(buf)]))
    out, at = [], 0
    for s, n in zip(starts, counts):
        lo = int(begin[s])
        hi = int(begin[s + n]) if s + n < len(begin) else len(raw)
        out.append(raw[at:lo])
        left = b"".join(out)
        if b"\n" in raw[lo:hi] and left and not left.endswith(b"\n") and hi < len(raw):
            left += b"\n"
        out, at = [left], hi
    return b"".join([*out, raw[at:]]).decode()


def remove_repeated(docs: DataFrame, paragraph_words: int = PARAGRAPH_WORDS, run_words: int = RUN_WORDS, bands: int = BANDS, band_rows: int = ROWS, threshold: float = THRESHOLD, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """docs without the passages that repeated_passages names; texts of which no word is left are dropped.

    All columns stay; n_chars, where there is one, is brought up to date.  Null,
    empty and short texts stay as they are; repeated rows (equal doc_id and text)
    stay and are edited alike; very long texts are edited whole; an empty table
    stays empty.
    """
    found = cut(_removals(docs, paragraph_words, run_words, bands, band_rows, threshold, passage_words).select("uid", "starts", "words"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = wrapped(docs, uid=F.xxhash64(F.col("doc_id"), text), text=text)
    same = unwrapped(in_ids(rows, found.select("uid"), "uid", anti=True))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [cut_words(t, s, n) for t, s, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], names=["row", "text"])

    touched = in_ids(rows, found.select("uid"), "uid").join(found, "uid").select("row", "text", "starts", "words")
    edited = touched.mapInArrow(edit, touched.select("row", "text").schema).where(F.col("text").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"))
    cols = [F.col("text").alias(c) if c == "text" else F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return same.unionByName(edited.select(*cols))
