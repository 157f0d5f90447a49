"""Related-document packing.

Every distinct text is a sparse vector: its words, in BUCKETS hash buckets, by count
times inverse document frequency over all texts.  A forest of TABLES sorted tables
proposes neighbours: a table orders texts by weighted minhashes (a text's word that
wins an exponential race by its squared weight, then that of a second and a third
race), so that texts which share weighty words stand near each other, and is cut into
leaves.  Texts of a leaf are compared with each other by their whole vectors, and of
all tables the nearest are kept.
A path starts at the unvisited text of the lowest degree, goes on to the most similar
unvisited neighbour while there is one, and starts again.  Windows are filled along
the paths by running totals, and a text that doesn't fit goes on in the next window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import cut
from papyrine.llm.text import U, lists, mix, slices

BITS = 18
BUCKETS = 1 << BITS
WINDOW_WORDS = 2048
NEIGHBOURS = 8
TABLES = 5
LEAF = 2000
#: Texts of a cell of a table, which one task cuts on into leaves.
CELL = 8000
#: Products of weights that are added up at once.
PAIRS = 250_000
#: Words of more than a DENSEth of a leaf's texts go through the dense product.
DENSE = 32
#: Rows of a matrix of cosines that are summed, mirrored or looked through at once, so that no second matrix is held.
ROWS = 128
#: Bytes of packed gaps that are unpacked at once; a longer row is unpacked whole.
GAP_BYTES = 1 << 17
#: Texts whose paths one task walks (their ids and neighbours only); paths stay within such a part.
WALK = 250_000
RACES = 3
SEED = 77


def packed(values: np.ndarray, firsts: np.ndarray, bits: int) -> pa.Array:
    """Whole numbers from 0 on of each row as binary, in codes of 8 or 12 bits; the greatest code says that the number goes on."""
    most = (1 << bits) - 1
    more = values // most
    ends = np.cumsum(more + 1)
    cuts = np.concatenate([[0], ends])[firsts]
    odd = np.diff(cuts) % 2 if bits == 12 else np.zeros(len(firsts) - 1, np.int64)
    pad = np.concatenate([[0], np.cumsum(odd)])  # codes without a number behind them make rows of 12 bits even
    out = np.full(int(cuts[-1] + pad[-1]), most, dtype=np.uint16)
    out[ends - 1 + np.repeat(pad[:-1], np.diff(firsts))] = values - more * most
    cuts = cuts + pad
    if bits == 8:
        data = out.astype(np.uint8)
    else:
        x, y = out[0::2], out[1::2]
        data = np.stack([x & 255, (x >> 8) | ((y & 15) << 4), y >> 4], axis=1).astype(np.uint8).reshape(-1)
        cuts = cuts // 2 * 3
    return pa.Array.from_buffers(pa.binary(), len(firsts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])


def unpacked(col: pa.Array | pa.ChunkedArray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and where each row's begin."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if not len(col):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    cuts = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    most = (1 << bits) - 1
    if bits == 12:
        a, b, c = data.reshape(-1, 3).T.astype(np.uint16)
        data, cuts = np.empty(len(a) * 2, np.uint16), cuts // 3 * 2
        data[0::2], data[1::2] = a | ((b & 15) << 8), (b >> 4) | (c << 4)
    ends = np.flatnonzero(data < most)
    firsts = np.searchsorted(ends, cuts)
    before = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    have = np.diff(firsts) > 0
    before[firsts[:-1][have]] = cuts[:-1][have]
    return data[ends] + most * (ends - before), firsts


def race_table(tables: int) -> np.ndarray:
    """Minus the logarithm of a random number for each race of each table and each bucket."""
    u = np.random.default_rng(SEED).random((tables * RACES, BUCKETS), dtype=np.float32)
    np.log(np.maximum(u, np.float32(1e-7), out=u), out=u)
    return np.negative(u, out=u)


def order_keys(ids: np.ndarray, bucket: np.ndarray, weight: np.ndarray, firsts: np.ndarray, races: np.ndarray) -> np.ndarray:
    """A place in the order of every table for each row (rows, tables): the winners of its races, then its id."""
    rows, n = np.flatnonzero(np.diff(firsts)), len(firsts) - 1
    tables = len(races) // RACES
    out = np.zeros((n, tables), np.uint64)
    squared = np.maximum(weight * weight, np.float32(1e-12))
    for r, minus_log in enumerate(races):
        time = minus_log[bucket] / squared
        best = np.minimum.reduceat(time, firsts[rows]) if len(rows) else time
        won = np.flatnonzero(time == np.repeat(best, np.diff(firsts)[rows]))
        row = np.searchsorted(firsts, won, side="right") - 1
        won = won[np.append(True, row[1:] != row[:-1])] if len(won) else won
        bits = (20, 16, 12)[r % RACES]
        out[rows, r // RACES] = (out[rows, r // RACES] << U(bits)) | (mix(bucket[won].astype(np.uint64) + U(r * BUCKETS + 1)) >> U(64 - bits))
    return (out << U(16)) | (mix(ids.view(np.uint64))[:, None] >> U(48))


def vectors(rows: DataFrame, idf: np.ndarray | None = None, tables: int | None = None) -> DataFrame:
    """(doc_id, id, n_words, gaps, counts) of rows (doc_id, id, text), also of those without words.

    This is the only pass over the texts.  idf and tables are taken as before and
    not used: frequencies come from these rows, and keys are made after copies are dropped.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                once, count = np.unique((w.row_of().astype(np.uint64) << U(BITS)) | (w.hash >> U(64 - BITS)), return_counts=True)
                bucket = (once & U(BUCKETS - 1)).astype(np.int64)
                firsts = np.searchsorted(once >> U(BITS), np.arange(w.rows + 1, dtype=np.uint64))
                begin = firsts[:-1][np.diff(firsts) > 0]
                gap = np.diff(bucket, prepend=0)
                gap[begin] = bucket[begin]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(w.first)), packed(gap, firsts, 12), packed(count - 1, firsts, 8)], names=["doc_id", "id", "n_words", "gaps", "counts"])

    return rows.mapInArrow(each, "doc_id long, id long, n_words long, gaps binary, counts binary")


def buckets(gaps: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of each row's words, and where each row's begin."""
    gap, firsts = unpacked(gaps, 12)
    total = np.cumsum(gap)
    return total - np.repeat(np.concatenate([[0], total])[firsts[:-1]], np.diff(firsts)), firsts


def portions(gaps: pa.Array) -> Iterator[tuple[int, int]]:
    """First row and number of rows of slices of about GAP_BYTES, so that memory doesn't follow the length of texts."""
    at, lo = np.concatenate([[0], np.cumsum(pc.binary_length(gaps).to_numpy(zero_copy_only=False))]), 0
    while lo < len(gaps):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + GAP_BYTES, side="right")) - 1)
        yield lo, hi - lo
        lo = hi


def frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts words of each hash bucket occur, and the number of texts, for rows as of vectors (or with texts)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for lo, m in portions(batch.column(0)):
                total += np.bincount(buckets(batch.column(0).slice(lo, m))[0], minlength=BUCKETS)
            n += batch.num_rows
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(have, -1)), pa.array(np.append(total[have], n))], names=["bucket", "n"])

    points = rows if "gaps" in rows.columns else vectors(rows)
    found = points.select("gaps").mapInArrow(each, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out[:-1], int(out[-1])


def table_keys(batch: pa.RecordBatch, idf: np.ndarray, races: np.ndarray) -> np.ndarray:
    """order_keys of rows (id, gaps, counts)."""
    out = [np.zeros((0, len(races) // RACES), np.uint64)]
    for lo, m in portions(batch.column(1)):
        ids, gaps, counts = batch.slice(lo, m).columns[:3]
        bucket, firsts = buckets(gaps)
        out.append(order_keys(ids.to_numpy(), bucket, ((unpacked(counts, 8)[0] + 1) * idf[bucket]).astype(np.float32), firsts, races))
    return np.concatenate(out)


def weights(table: pa.Table, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and weights of the unit vectors of a table's rows, and where each row's begin."""
    bucket, firsts = buckets(table.column("gaps"))
    count, _ = unpacked(table.column("counts"), 8)
    w = (count + 1) * idf[bucket]
    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(firsts) - 1))
    return bucket, (w / np.maximum(norm, 1e-9)[row]).astype(np.float32), firsts


def cosines(bucket: np.ndarray, weight: np.ndarray, firsts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines of some rows with each other, exactly: words of many of them by a dense product, the others by their places."""
    n = len(rows)
    count = np.diff(firsts)[rows]
    flat = np.arange(count.sum()) + np.repeat(firsts[rows] - (np.cumsum(count) - count), count)
    b = (bucket[flat] << 32) | np.arange(len(flat))  # sorting numbers is several times as fast as sorting places
    b.sort()
    order = b & 0xFFFFFFFF
    b >>= 32
    r, w = np.repeat(np.arange(n, dtype=np.int32), count).take(order), weight.take(flat.take(order))
    begin = np.flatnonzero(np.append(True, b[1:] != b[:-1])) if len(b) else np.zeros(0, np.int64)
    d = np.diff(np.append(begin, len(b)))
    del order, flat, b
    often = d * DENSE > n
    x = np.zeros((n, int(often.sum())), np.float32)
    mine = np.repeat(often, d)
    x[r[mine], np.repeat((np.cumsum(often) - 1).astype(np.int32), d)[mine]] = w[mine]
    s = x @ x.T
    del x
    place = np.arange(len(r), dtype=np.int32) - np.repeat(begin.astype(np.int32), d)  # every word is paired with those of its bucket before it
    entry = np.flatnonzero(~mine & (place > 0))
    entry = entry[np.argsort(r[entry].astype(np.min_scalar_type(n)), kind="stable")]  # row by row, so that sums stay in cache; 16 bits are sorted by radix
    for block in np.split(entry, np.searchsorted(r[entry], np.arange(ROWS, n, ROWS))):
        total = np.cumsum(place[block])
        for lo in range(0, int(total[-1]) if len(total) else 0, PAIRS):
            some = block[np.searchsorted(total, lo, side="right") : np.searchsorted(total, lo + PAIRS, side="right")]
            if not len(some):
                continue
            each, top, stop = place[some], int(r[some[0]]), int(r[some[-1]]) + 1
            right = np.repeat((some - each) - (np.cumsum(each) - each), each)
            right += np.arange(len(right))
            at = np.repeat((r[some] - top) * np.int64(n), each)
            at += r.take(right)
            product = np.repeat(w[some], each)
            product *= w.take(right)
            s[top:stop] += np.bincount(at, weights=product, minlength=(stop - top) * n).reshape(-1, n)
    for lo in range(0, n, ROWS):  # sums stand below the diagonal
        hi = min(n, lo + ROWS)
        s[lo:hi, hi:] = s[hi:, lo:hi].T
        s[lo:hi, lo:hi] = np.tril(s[lo:hi, lo:hi]) + np.tril(s[lo:hi, lo:hi], -1).T
    return s


def nearest(bucket: np.ndarray, weight: np.ndarray, firsts: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Among some rows the k places in `rows` (fewer in small groups) most similar to each, without itself, and their cosines."""
    s = cosines(bucket, weight, firsts, rows)
    np.fill_diagonal(s, -np.inf)
    k = min(k, len(rows) - 1)
    at = np.empty((len(rows), k), np.int64)
    for lo in range(0, len(rows), ROWS):
        at[lo : lo + ROWS] = np.argpartition(-s[lo : lo + ROWS], k - 1, axis=1)[:, :k]
    return at, np.take_along_axis(s, at, axis=1)


def neighbours(rows: pa.Table, idf: np.ndarray, leaf: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a cell's texts, those of the up to k most similar in the leaf of each, and their cosines; weights of one leaf are held at a time."""
    ids = rows.column("id").to_numpy()
    order = np.lexsort((ids, rows.column("key").to_numpy().view(np.uint64)))
    out_id, out_other, out_sim = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for some in np.array_split(order, -(-len(order) // leaf)):
        if len(some) > 1:
            to, sim = nearest(*weights(rows.select(["gaps", "counts"]).take(pa.array(some)), idf), np.arange(len(some)), k)
            out_id.append(np.repeat(ids[some], to.shape[1]))
            out_other.append(ids[some][to].reshape(-1))
            out_sim.append(sim.reshape(-1))
    return np.concatenate(out_id), np.concatenate(out_other), np.concatenate(out_sim)


def bounds(sample: np.ndarray, cells: int) -> np.ndarray:
    """Where a sorted table's cells begin, but for the first: quantiles of a sample, as for a range partitioning."""
    return np.quantile(np.sort(sample), np.arange(1, cells) / cells, method="lower") if len(sample) else np.zeros(0, np.uint64)


def neighbour_graph(points: DataFrame, n: int, idf: np.ndarray, tables: int = TABLES, k: int = NEIGHBOURS, leaf: int = LEAF, cell: int = CELL, walk_texts: int = WALK) -> DataFrame:
    """(id, part, others): the neighbours of every distinct text, most similar first, for points as of vectors, and the part in which it is walked.

    n is about the number of texts.  The bounds of cells and parts come from a
    sample of keys; keys end in bits of the id, so that equal texts (of other
    ids) are spread as well.
    """
    spark = points.sparkSession
    once = points.groupBy("id").agg(F.first(F.struct("gaps", "counts")).alias("v")).select("id", "v.*")
    cells, parts = max(1, -(-n // cell)), max(1, -(-n // walk_texts))
    if cells > 1:
        share = int(min(1.0, 200 * cells / n) * 1_000_000) + 1
        weigh = spark.sparkContext.broadcast(idf)

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            races = race_table(tables)
            for batch in batches:
                key = table_keys(batch, weigh.value, races)
                yield pa.RecordBatch.from_arrays([lists(key.reshape(-1).view(np.int64), np.arange(len(key) + 1) * tables, pa.int64())], names=["keys"])

        some = points.select("id", "gaps", "counts").where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share)
        some = some.repartition(1 + 200 * cells // 20_000)  # few tasks make a table of races for it
        sample = some.mapInArrow(keys, "keys array<long>").toArrow().column("keys").combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, tables)
    else:
        sample = np.zeros((0, tables), np.uint64)
    shared = spark.sparkContext.broadcast(([bounds(sample[:, t], cells) for t in range(tables)], bounds(sample[:, 0], parts), idf))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        races = race_table(tables)
        for batch in batches:
            key = table_keys(batch, shared.value[2], races)
            part = np.searchsorted(shared.value[1], key[:, 0], side="right")
            for t in range(tables):
                at = np.searchsorted(shared.value[0][t], key[:, t], side="right")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t)), pa.array(at), batch.column(0), pa.array(key[:, t].copy().view(np.int64)), pa.array(part), batch.column(1), batch.column(2)], names=["table", "cell", "id", "key", "part", "gaps", "counts"])

    at = once.mapInArrow(assign, "table long, cell long, id long, key long, part long, gaps binary, counts binary")

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        ids = rows.column("id").to_numpy()
        edge_id, other, sim = neighbours(rows, shared.value[2], leaf, k)
        good = sim > 0
        edge_id, other, sim = edge_id[good], other[good], sim[good]
        none = ids if key[0].as_py() == 0 else ids[:0]  # a row for each text that says where it is walked
        part = rows.column("part").combine_chunks()
        return pa.table(
            {
                "id": np.concatenate([edge_id, none]),
                "other": pa.array(np.concatenate([other, none]), mask=np.arange(len(other) + len(none)) >= len(other)),
                "far": pa.array(np.concatenate([-sim, np.zeros(len(none), np.float32)])),
                "part": pa.concat_arrays([pa.nulls(len(other), pa.int64()), part[: len(none)]]),
            }
        )

    edges = at.groupBy("table", "cell").applyInArrow(search, "id long, other long, far float, part long")
    best = F.slice(F.array_sort(F.collect_set(F.when(F.col("other").isNotNull(), F.struct("far", "other")))), 1, k)
    return edges.groupBy("id").agg(best.alias("b"), F.max("part").alias("part")).select("id", "part", F.col("b.other").alias("others"))


def follow(ids: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of ids along greedy paths; flat[ends[i] : ends[i + 1]] are the neighbours of ids[i], most similar first.

    Neighbours stay in arrays: a list of them would take several times the memory.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    at = np.minimum(np.searchsorted(ids, flat, sorter=order), n - 1)
    place = order[at]
    of = np.repeat(np.arange(n), np.diff(ends))
    good = (ids[place] == flat) & (place != of)
    place, of = place[good], of[good]
    first = memoryview(np.searchsorted(of, np.arange(n + 1)))
    starts = memoryview(np.lexsort((np.arange(n), ids, np.bincount(of, minlength=n) + np.bincount(place, minlength=n))))
    near, seen, path, m = memoryview(place), bytearray(n), np.zeros(n, np.int64), 0
    out = memoryview(path)
    for i in starts:
        while i >= 0 and not seen[i]:
            seen[i] = 1
            out[m] = i
            m += 1
            i = next((p for p in near[first[i] : first[i + 1]] if not seen[p]), -1)
    return path


def walk(ids: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Places of ids along greedy paths; others[i] are the neighbours of ids[i], most similar first."""
    flat = np.concatenate(others) if others else np.zeros(0, np.int64)
    return follow(ids, flat, np.cumsum([0, *map(len, others)]))


def pack(docs: DataFrame, window: int = WINDOW_WORDS, k: int = NEIGHBOURS, tables: int = TABLES, leaf: int = LEAF, cell: int = CELL, walk_texts: int = WALK) -> DataFrame:
    """(cell, window_no, n_words, doc_ids, starts, lengths): windows of `window` words.

    doc_ids, starts and lengths say which words of which documents a window holds,
    in order.  Every word of every text is in exactly one window; all windows of a
    cell (a part of the texts that is walked at once) but its last are full.  Copies
    of a text stand together.  Null and empty texts have no words and are in no
    window; repeated rows are packed each; a null doc_id stays null; neighbours that
    are alike near stand in order of their hashes.  A very long text goes on
    through as many windows as it needs.  An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("id"), text.alias("text"))
    points = cut(vectors(rows))
    df, n = frequencies(points)
    idf = np.log((n + 1) / (df + 1))
    points = points.where("n_words > 0")
    near = neighbour_graph(points, n, idf, tables, k, leaf, cell, walk_texts=walk_texts)

    def paths(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending")])
        ids, others = table.column("id").to_numpy(), table.column("others").combine_chunks()
        flat, ends = others.flatten().to_numpy(), np.concatenate([[0], np.cumsum(others.value_lengths().to_numpy())])
        path = follow(ids, flat, ends)
        return pa.table({"id": ids[path], "cell": pa.array(np.full(len(path), key[0].as_py())), "place": pa.array(np.arange(len(path)))})

    placed = near.groupBy("part").applyInArrow(paths, "id long, cell long, place long")
    line = points.select("doc_id", "id", "n_words").join(placed, "id").select("cell", "place", F.xxhash64("doc_id").alias("h"), "doc_id", "n_words")
    # a text of which there are very many copies is spread over partitions as well
    line = cut(line.repartitionByRange("cell", "place", "h").sortWithinPartitions("cell", "place", "h"))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            cells, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            for c, m in zip(cells.tolist(), np.bincount(at, weights=batch.column(1).to_numpy(), minlength=len(cells)).tolist()):
                seen[c] = seen.get(c, 0) + int(m)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * len(seen), pa.int64()), pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["partition", "cell", "words"])

    before: dict[tuple[int, int], int] = {}
    so_far: dict[int, int] = {}
    for r in sorted(line.select("cell", "n_words").mapInArrow(total, "partition long, cell long, words long").toArrow().to_pylist(), key=lambda r: r["partition"]):  # a row for each partition and cell
        before[r["partition"], r["cell"]] = so_far.get(r["cell"], 0)
        so_far[r["cell"]] = before[r["partition"], r["cell"]] + r["words"]
    shared = spark.sparkContext.broadcast(before)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        at = {c: m for (p, c), m in shared.value.items() if p == here}
        for batch in batches:
            cell_, words_ = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            if not len(cell_):
                continue
            end = np.cumsum(words_)
            edge = np.flatnonzero(np.append(True, cell_[1:] != cell_[:-1]))
            offset = np.array([at[c] for c in cell_[edge].tolist()]) - (end - words_)[edge]
            begin = end - words_ + np.repeat(offset, np.diff(np.append(edge, len(cell_))))
            for c in cell_[edge].tolist():
                at[c] += int(words_[cell_ == c].sum())
            lo, hi = begin // window, (begin + words_ - 1) // window
            many = hi - lo + 1
            row = np.repeat(np.arange(len(cell_)), many)
            no = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            start = np.maximum(begin[row], no * window)
            stop = np.minimum((begin + words_)[row], (no + 1) * window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell_[row]), pa.array(no.astype(np.int32)), pa.array((start - no * window).astype(np.int32)), batch.column(1).take(pa.array(row)), pa.array((start - begin[row]).astype(np.int32)), pa.array((stop - start).astype(np.int32))],
                names=["cell", "window_no", "at", "doc_id", "start", "length"],
            )

    held = line.select("cell", "doc_id", "n_words").mapInArrow(fill, "cell long, window_no int, at int, doc_id long, start int, length int")
    windows = held.groupBy("cell", "window_no").agg(F.sum("length").cast("int").alias("n_words"), F.array_sort(F.collect_list(F.struct("at", "doc_id", "start", "length"))).alias("w"))
    return windows.select("cell", "window_no", "n_words", F.col("w.doc_id").alias("doc_ids"), F.col("w.start").alias("starts"), F.col("w.length").alias("lengths"))
