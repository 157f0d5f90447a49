import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import changed, frame, prose, seeded, words
from pyspark.sql import functions as F

from papyrine.llm import ann, packing, sharding


def brute_interleave(rows, shards, seed):
    """(doc_id, source) -> places, by sorting."""
    keyed = [(hashlib.md5(f"{seed}|{'' if i is None else i}".encode()).hexdigest(), i, s) for i, s in rows]
    none_first = lambda i: (i is not None, i or 0)
    out = []
    for source in {s for _, s in rows}:
        mine = sorted((k for k in keyed if k[2] == source), key=lambda k: (k[0], none_first(k[1])))
        out += [((2 * r + 1) / (2 * len(mine)), source is not None, source or "", k[0], none_first(k[1]), k[1]) for r, k in enumerate(mine)]
    out.sort()
    n = len(out)
    return sorted(((o[5], o[2] if o[1] else None, p * shards // n, p - -(-(p * shards // n) * n // shards)) for p, o in enumerate(out)), key=str)


def test_interleaving_against_brute_force(spark):
    rng = seeded(31)
    rows = [(int(i), f"s{min(int(rng.geometric(0.4)), 4)}") for i in range(300)] + [(None, "s1"), (None, None), (7, None), (7, None), (900, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, rank string")
    want = brute_interleave(rows, 7, 42)
    for bucket in (10**6, 20):  # one bucket, and many
        found = [tuple(r) for r in sharding.interleave(df, 7, 42, bucket).collect()]
        assert sorted(found, key=str) == want
    shares = {}
    for _, s, shard, _ in want:
        shares.setdefault(s, [0] * 7)[shard] += 1
    for s, counts in shares.items():
        assert max(counts) - min(counts) <= 2, s
    assert sharding.interleave(df.where("false")).count() == 0


def test_written_shards(spark, tmp_path):
    docs = frame(spark, [f"t{i}" for i in range(40)])
    sharding.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and sorted(r["count"] for r in back.groupBy("_shard").count().collect()) == [10] * 4 and set(docs.columns) < set(back.columns)


def clustered(rng, n, dim=24, centres=12):
    c = rng.standard_normal((centres, dim)) * 2
    return (c[rng.integers(0, centres, n)] + rng.standard_normal((n, dim))).astype(np.float32)


@pytest.mark.parametrize("shard_rows, numbers", [(10**6, 10**6), (400, 10**6), (400, 0)])
def test_neighbours_recall(spark, shard_rows, numbers):
    x = clustered(seeded(32), 1200)
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "vec_id long, embedding array<float>, shard string")
    found = {}
    for r in ann.neighbours(df, shard_rows=shard_rows, query_rows=500, every=1, broadcast_numbers=numbers).collect():
        found.setdefault(r.vec_id, []).append((r["rank"], r.neighbour_id, r.distance))
    d = np.sqrt(((x[:, None] - x[None]).astype(np.float64) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    hits = 0
    for i in range(len(x)):
        mine = sorted(found[i])
        assert [m[0] for m in mine] == list(range(1, 11)) and len({m[1] for m in mine} | {i}) == 11
        assert all(abs(d[i, m[1]] - m[2]) < 1e-5 for m in mine) and [m[2] for m in mine] == sorted(m[2] for m in mine)
        hits += len({m[1] for m in mine} & set(np.argsort(d[i])[:10].tolist()))
    assert hits >= 0.9 * 10 * len(x)


def test_neighbours_edges(spark):
    rows = [(1, [0.0, 0.0]), (1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0]), (4, [3.0, 4.0]), (5, None), (6, []), (7, [1.0]), (8, [1.0, None]), (9, [float("nan"), 0.0]), (None, [6.0, 8.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = [tuple(r) for r in ann.neighbours(df, k=3, every=1).collect()]
    by = {i: [f[2:] for f in sorted(found, key=lambda f: f[1]) if f[0] == i] for i in (1, 2, 4, 7, None)}
    assert by[1] == [(2, 0.0), (3, 0.0), (4, 5.0)] and by[2] == [(1, 0.0), (3, 0.0), (4, 5.0)] and by[7] == []
    assert by[4] == [(1, 5.0), (2, 5.0), (3, 5.0)] and by[None] == [(4, 5.0), (1, 10.0), (2, 10.0)]
    assert ann.neighbours(df.where("false")).count() == 0 == ann.neighbours(df.where("vec_id = 4"), every=1).count()
    many = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(300)], "vec_id long, embedding array<float>")
    assert ann.neighbours(many, every=1).count() == 3000 and ann.neighbours(many).count() == 30


def test_pruning_is_relaxed():
    x = np.array([[0, 0], [1, 0], [1.05, 0], [0, 1]], np.float32)
    at, d = np.array([[1, 2, 3, -1]]), np.array([[1, 1.1025, 1, np.inf]], np.float32)
    assert sorted(ann.prune(x, at, d, 4, 1.2)[0].tolist()) == [-1, -1, 1, 3]


def test_walk_starts_low_and_follows_the_nearest():
    ids = np.array([10, 11, 12, 13, 14])
    others = [np.array(o, dtype=np.int64) for o in ([11, 12], [12, 10], [11], [], [10])]
    assert [int(ids[i]) for i in packing.walk(ids, others)] == [13, 14, 10, 11, 12]
    assert len(packing.walk(np.array([], dtype=np.int64), [])) == 0


def test_packing_keeps_every_word_once(spark):
    rng = seeded(33)
    base = [prose(rng, 60) for _ in range(20)]
    texts = [changed(rng, b, 3) for b in base for _ in range(3)] + [None, "", "one", prose(rng, 5000), base[0], base[0]]
    ids = list(range(len(texts) - 2)) + [None, None]
    for cell, window in ((8000, 256), (16, 100)):
        found = packing.pack(frame(spark, texts, ids, clashing=True), window=window, cell=cell, leaf=12).collect()
        seen = {}
        for r in found:
            assert len(r.doc_ids) == len(r.starts) == len(r.lengths) and sum(r.lengths) == r.n_words <= window
            for d, s, n in zip(r.doc_ids, r.starts, r.lengths):
                seen.setdefault(d, []).append((s, n))
        for i, t in zip(ids[:-2], texts):
            at = 0
            for s, n in sorted(seen.get(i, [])):
                assert s == at and n > 0
                at += n
            assert at == len(words(t))
        assert sum(n for _, n in seen[None]) == 2 * len(words(base[0]))
        last = {r.cell: max(x.window_no for x in found if x.cell == r.cell) for r in found}
        assert all(r.n_words == window for r in found if r.window_no < last[r.cell])
    order = [d for r in sorted(packing.pack(frame(spark, texts[:60]), window=64).collect(), key=lambda r: r.window_no) for d in dict.fromkeys(r.doc_ids)]
    order = list(dict.fromkeys(order))
    assert sum(a // 3 == b // 3 for a, b in zip(order, order[1:])) >= 30  # copies of a text follow each other
    assert packing.pack(frame(spark, [])).count() == 0 == packing.pack(frame(spark, [None, ""])).count()


def cosine_neighbours(texts):
    """The cosines of all texts by counts and inverse document frequencies of their words, over the whole vocabulary."""
    bags = [{w: t.count(w) for w in set(t)} for t in map(words, texts)]
    df = {}
    for bag in bags:
        for w in bag:
            df[w] = df.get(w, 0) + 1
    at = {w: i for i, w in enumerate(df)}
    x = np.zeros((len(texts), len(df)))
    for i, bag in enumerate(bags):
        for w, n in bag.items():
            x[i, at[w]] = n * np.log((len(texts) + 1) / (df[w] + 1))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -1)
    return s


@pytest.mark.parametrize("cell, leaf, least", [(10**6, 10**6, 0.9), (500, 125, 0.5)])
def test_neighbours_against_the_whole_vocabulary(spark, cell, leaf, least):
    rng = seeded(34)
    texts = [" ".join(f"v{int(x)}" for x in rng.zipf(1.3, 150) % 20000) for _ in range(1000)]
    docs = frame(spark, texts)
    rows = docs.selectExpr("doc_id", "doc_id AS id", "text")
    df, n = packing.frequencies(rows)
    idf = np.log((n + 1) / (df + 1))
    found = packing.neighbour_graph(packing.vectors(rows, idf, packing.TABLES), n, idf, leaf=leaf, cell=cell).collect()
    s = cosine_neighbours(texts)
    assert len(found) == 1000 and {r.part for r in found} == {0}
    hits = [len(set(r.others) & set(np.argsort(-s[r.id])[:8].tolist())) for r in found]
    assert sum(hits) >= least * 8 * 1000


def test_packed_numbers():
    values, firsts = np.array([0, 5, 254, 255, 256, 70000, 65535, 1]), np.array([0, 0, 3, 3, 8])
    for kind in (8, 12):
        back, cuts = packing.unpacked(packing.packed(values, firsts, kind), kind)
        assert back.tolist() == values.tolist() and cuts.tolist() == firsts.tolist()
        back, cuts = packing.unpacked(packing.packed(values, firsts, kind).slice(2), kind)
        assert back.tolist() == values[3:].tolist() and cuts.tolist() == [0, 0, 5]


def brute_windows(lines, window):
    """Windows of (document, first word, words) that hold documents of so many words one after another."""
    out, room = [], 0
    for doc, n in lines:
        at = 0
        while at < n:
            if not room:
                out.append([])
                room = window
            take = min(room, n - at)
            out[-1].append((doc, at, take))
            at, room = at + take, room - take
    return out


def test_pack_against_brute_force(spark):
    rng = seeded(36)
    texts = [prose(rng, int(n), 150) for n in rng.integers(5, 120, 150)]
    found = packing.pack(frame(spark, texts), window=100).orderBy("window_no").collect()
    s, ids = cosine_neighbours(texts), [spark.sql("SELECT xxhash64(:t)", args={"t": t}).first()[0] for t in texts]
    order = sorted(range(len(texts)), key=lambda i: ids[i])
    others = [np.array([ids[j] for j in sorted(range(len(texts)), key=lambda j: (-np.float32(s[i, j]), ids[j]))[:8]]) for i in order]
    want = [order[i] for i in packing.walk(np.array([ids[i] for i in order]), others)]
    got = list(dict.fromkeys(d for r in found for d in r.doc_ids))
    follow = sum((a, b) in set(zip(want, want[1:])) for a, b in zip(got, got[1:]))
    assert follow >= 0.9 * len(texts)  # but for neighbours that are nearly as near
    assert [list(zip(r.doc_ids, r.starts, r.lengths)) for r in found] == brute_windows([(d, len(words(texts[d]))) for d in got], 100)


def test_packing_very_many_copies_and_ties(spark):
    t, u = prose(seeded(37), 30), prose(seeded(38), 30)
    docs = frame(spark, [t] * 500 + [u] * 3 + [" ".join(reversed(t.split()))] * 2)
    found = packing.pack(docs, window=64, walk_texts=2).collect()
    assert sum(r.n_words for r in found) == 505 * 30 and sorted(set(d for r in found for d in r.doc_ids)) == list(range(505))
    for c in {r.cell for r in found}:
        mine = sorted((r for r in found if r.cell == c), key=lambda r: r.window_no)
        assert [r.window_no for r in mine] == list(range(len(mine))) and all(r.n_words == 64 for r in mine[:-1])


def test_answers_search_wider_than_the_graph_was_built_with(spark):
    x = seeded(35).standard_normal((2000, 64)).astype(np.float32)
    found = {}
    for r in ann.neighbours(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>"), degree=10, every=1).collect():
        found.setdefault(r.vec_id, set()).add(r.neighbour_id)
    d = ((x[:300, None] - x[None]) ** 2).sum(-1)
    d[np.arange(300), np.arange(300)] = np.inf
    assert sum(len(found[i] & set(np.argsort(d[i])[:10].tolist())) for i in range(300)) >= 0.91 * 10 * 300


def test_cosines_are_summed_row_by_row(monkeypatch):
    rng, n, sums = seeded(53), 200, []
    x = np.where(rng.random((n, 400)) < 0.03, rng.random((n, 400)), 0).astype(np.float32)
    count = (x > 0).sum(1)
    firsts, exact = np.concatenate([[0], np.cumsum(count)]), np.bincount
    monkeypatch.setattr(packing, "PAIRS", 300)
    monkeypatch.setattr(packing, "DENSE", 20)
    monkeypatch.setattr(np, "bincount", lambda a, **k: sums.append(k["minlength"]) or exact(a, **k))
    s = packing.cosines(np.nonzero(x)[1], x[x > 0], firsts, np.arange(n))
    want = x @ x.T
    np.fill_diagonal(s, 0)
    np.fill_diagonal(want, 0)
    assert np.allclose(s, want, atol=1e-5)
    assert len(sums) > 5 and sum(sums) <= n * (n + 2 * len(sums))  # not a whole matrix each time


def traced(f, *args):
    """What f returns, and the most bytes that it held at once."""
    tracemalloc.start()
    try:
        return f(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_leaf_holds_one_matrix_of_cosines():
    rng, n = seeded(54), 1800
    x = np.where(rng.random((n, 3000)) < np.where(np.arange(3000) < 30, 0.3, 0.01), rng.random((n, 3000)), 0).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    firsts = np.concatenate([[0], np.cumsum((x > 0).sum(1))])
    (to, sim), most = traced(packing.nearest, np.nonzero(x)[1], x[x > 0], firsts, np.arange(n), 8)
    want = x @ x.T
    np.fill_diagonal(want, -1)
    assert np.allclose(np.sort(sim, axis=1), np.sort(want, axis=1)[:, -8:], atol=1e-5)
    assert np.allclose(np.take_along_axis(want, to, axis=1), sim, atol=1e-5)
    assert most < 3 * 4 * n * n  # the matrix, the leaf's words and sums of PAIRS products


def test_walk_holds_neighbours_in_arrays():
    rng, n = seeded(55), 20000
    ids = rng.permutation(n) * 3 - n
    others = [ids[(i + rng.integers(-40, 40, 8)) % n] for i in range(n)]
    others[7], others[8] = others[7][:0], np.append(others[8], 1 - n)  # without neighbours; one that isn't there
    path, most = traced(packing.walk, ids, others)
    at = {int(x): i for i, x in enumerate(ids)}
    near = [[at[x] for x in o.tolist() if x in at and at[x] != i] for i, o in enumerate(others)]
    degree = [len(o) for o in near]
    for p in (p for o in near for p in o):
        degree[p] += 1
    seen, want = set(), []
    for i in sorted(range(n), key=lambda i: (degree[i], ids[i])):
        while i is not None and i not in seen:
            seen.add(i)
            want.append(i)
            i = next((p for p in near[i] if p not in seen), None)
    assert path.tolist() == want
    assert most < 64 * 8 * n


def test_packing_reads_texts_once(spark):
    rng = seeded(56)
    texts = [prose(rng, 40) for _ in range(60)] + [None, "", prose(rng, 40)]
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    docs = frame(spark, texts).withColumn("text", F.udf(seen, "string")("text"))
    found = packing.pack(docs, window=64, cell=20, leaf=10).collect()
    assert sum(r.n_words for r in found) == 61 * 40 and read.value == len(texts)
    rows = frame(spark, texts).selectExpr("doc_id", "doc_id AS id", "text")
    df, n = packing.frequencies(packing.vectors(rows))
    bags = [set(words(t)) for t in texts]
    assert n == len(texts) and df.sum() == sum(map(len, bags)) and df.max() == max(sum(w in b for b in bags) for w in set().union(*bags))


def test_word_counts_are_unpacked_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "GAP_BYTES", 100)
    sizes = [0, 40, 50, 300, 0, 10, 90, 90, 0]
    assert list(packing.portions(pa.array([b"x" * n for n in sizes], pa.binary()))) == [(0, 3), (3, 1), (4, 3), (7, 2)]  # the 300 bytes alone
    assert list(packing.portions(pa.array([], pa.binary()))) == []
