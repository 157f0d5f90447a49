import numpy as np
import pyarrow as pa
import pytest
from llm.helpers import CLASHING, SCHEMA, changed, components, frame, jaccard, prose, seeded, words

from papyrine.llm import common, near_dedup, substring_dedup, text


def shingles(t, k=3):
    w = words(t)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def test_words_are_those_of_the_pattern():
    texts = ["Hello, World! 3x", "", None, "É_à ñ-ß x", " . ", "KK x", "日本 語"]
    w = text.words(pa.array(texts))
    for i, t in enumerate(texts):
        a, b = w.first[i], w.first[i + 1]
        assert [bytes(w.buf[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] == words(t)
    again = text.words(pa.array(["x", "hello hello"]))
    assert again.hash[1] == again.hash[2] == w.hash[0] and len(text.words(pa.array([], pa.string())).hash) == 0


def test_winnowing_marks_every_window():
    rng = seeded(1)
    g = rng.integers(0, 5, 200).astype(np.uint64)
    firsts = np.array([0, 0, 3, 90, 200])
    chosen = set(text.winnow(g, firsts, 6).tolist())
    for a, b in zip(firsts, firsts[1:]):
        for i in range(a, max(b - 5, a + 1) if b > a else a):
            assert chosen & set(range(i, min(i + 6, b)))


def test_components(spark):
    rng = seeded(2)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 60, (45, 2))] + [(i, i + 1) for i in range(100, 130)]
    ids = sorted({x for e in edges for x in e if e[0] != e[1]})
    want = components(140, edges)
    df = spark.createDataFrame(edges, "a long, b long")
    for limit in (10**6, 0):  # on the driver, and by shuffles
        assert {r["id"]: r["label"] for r in common.components(df, limit).collect()} == {i: want[i] for i in ids}
    assert common.components(df.where("false"), 0).count() == 0


def corpus():
    rng = seeded(3)
    base = [prose(rng, int(n)) for n in rng.integers(30, 300, 25)]
    texts = list(base)
    for i, t in enumerate(base[:15]):
        texts += [changed(rng, t, max(1, len(t.split()) // 40)) for _ in range(i % 4 + 1)]
    return texts + [base[0], base[0].upper(), base[20]] + [None, "", " .. ", "a", "a", "b c"]


def test_near_duplicates_against_brute_force(spark):
    texts = corpus()
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if jaccard(sets[i], sets[j]) >= near_dedup.THRESHOLD]
    want = components(len(texts), pairs)
    found = near_dedup.near_duplicates(frame(spark, texts, clashing=True)).collect()
    group = {r.doc_id: r.group_id for r in found}
    in_groups = [i for i in range(len(texts)) if want.count(want[i]) > 1]
    assert all(group[i] == want[i] for i in group)
    assert len(set(group) & set(in_groups)) >= 0.95 * len(in_groups)
    assert {r.doc_id for r in found if r.kept} == set(group.values())
    kept = near_dedup.drop_near_duplicates(frame(spark, texts, clashing=True))
    assert kept.columns == [c.split()[0] for c in CLASHING.split(", ")]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(range(len(texts))) - {r.doc_id for r in found if not r.kept})


def test_near_duplicates_ties_and_nulls(spark):
    t = prose(seeded(4), 40)
    docs = frame(spark, [t, t, t, None, "", t + " more"], ids=[5, 5, None, 1, 1, 7])
    found = near_dedup.near_duplicates(docs).collect()
    assert len(found) == 4 and sum(r.kept for r in found) == 1 and all(r.group_id == 5 for r in found)
    left = near_dedup.drop_near_duplicates(docs).collect()
    assert sorted(str(r.text)[:3] for r in left) == sorted(["Non", "", t[:3]]) and len(left) == 3
    assert near_dedup.near_duplicates(docs.where("false")).count() == 0 == near_dedup.drop_near_duplicates(docs.where("false")).count()


def test_in_ids_both_ways(spark):
    df, ids = spark.range(50), spark.createDataFrame([(3,), (7,), (7,), (99,)], "x long")
    for limit in (100, 1):
        assert sorted(r.id for r in common.in_ids(df, ids, limit=limit).collect()) == [3, 7]
        assert common.in_ids(df, ids, limit=limit, anti=True).count() == 48
    assert common.in_ids(df, ids.where("false")).count() == 0 and common.in_ids(df, ids.where("false"), anti=True).count() == 50


def test_passages_inside_lines_are_found_once(spark):
    rng = seeded(5)
    passage = prose(rng, 80).replace("\n", " ")
    hosts = [prose(rng, 200) for _ in range(6)]
    texts = [h[: h.index(".") + 1] + " " + passage + ". " + h[h.index(".") + 2 :] for h in hosts] + [prose(rng, 100)]
    found = substring_dedup.repeated_passages(frame(spark, texts, clashing=True)).collect()
    assert {r.doc_id for r in found} == {1, 2, 3, 4, 5} and {r.kept_doc_id for r in found} == {0} and all(r.n_words >= 60 for r in found)
    left = {r.doc_id: r.text for r in substring_dedup.remove_repeated(frame(spark, texts, clashing=True)).collect()}
    assert left[0] == texts[0] and left[6] == texts[6]
    want = set(words(passage))
    for i in range(1, 6):
        assert len(words(left[i])) <= len(words(texts[i])) - 60 and words(left[i])[-100:] == words(texts[i])[-100:]
    assert want


def test_passages_without_sentences_are_found(spark):
    rng = seeded(8)
    flat = lambda n: " ".join(words(prose(rng, n, 5000)))
    for n in (55, 70, 200):
        passage = flat(n)
        texts = [f"{flat(40)} {passage} {flat(35)}" for _ in range(4)] + [flat(100)]
        found = substring_dedup.repeated_passages(frame(spark, texts)).collect()
        assert {r.doc_id for r in found} == {1, 2, 3} and all(r.kept_doc_id == 0 and 20 <= r.n_words <= n and r.start_word >= 40 for r in found)


def test_paragraphs_against_brute_force(spark):
    rng = seeded(6)
    lines = [prose(rng, 45).replace("\n", " ") for _ in range(12)]
    texts = []
    for i in range(12):
        near = changed(rng, lines[(i * 5) % 7], 2)
        texts.append("\n".join([prose(rng, 30).replace("\n", " "), near, prose(rng, 8).replace("\n", " ")]))
    paras = [(d, k, words(p)) for d, t in enumerate(texts) for k, p in enumerate(t.split("\n")) if len(words(p)) >= substring_dedup.PARAGRAPH_WORDS]
    bigrams = [set(zip(w, w[1:])) for _, _, w in paras]
    label = components(len(paras), [(i, j) for i in range(len(paras)) for j in range(i) if jaccard(bigrams[i], bigrams[j]) >= substring_dedup.THRESHOLD])
    want = {paras[i][0] for i in range(len(paras)) if label[i] != i}
    found = {r.doc_id for r in substring_dedup.repeated_passages(frame(spark, texts)).collect()}
    assert want <= found and found <= want


def test_passages_edge_cases(spark):
    t = prose(seeded(7), 70)
    docs = frame(spark, [t, t, t, None, "", "short one", "short one"], ids=[1, 1, None, 2, 3, 4, 5])
    found = substring_dedup.repeated_passages(docs).collect()
    assert [(r.doc_id, r.n_words, r.kept_doc_id) for r in found] == [(None, 70, 1)]  # repeated rows are one document
    left = substring_dedup.remove_repeated(docs).collect()
    assert sorted((r.doc_id or 0) for r in left) == [1, 1, 2, 3, 4, 5] and [r.text for r in left if r.doc_id == 2] == [None]
    assert substring_dedup.remove_repeated(docs.where("false")).count() == 0
    assert str(substring_dedup.remove_repeated(docs).schema) == str(spark.createDataFrame([], SCHEMA).schema)


@pytest.mark.parametrize("starts, counts, want", [([0], [2], "c d.\ne f"), ([2], [2], "a b, e f".replace(", ", ",\n", 1)), ([4], [2], "a b, c d.\n"), ([0, 4], [4, 2], "")])
def test_cut_words(starts, counts, want):
    assert substring_dedup.cut_words("a b, c d.\ne f", starts, counts).replace(" \n", "\n") == want


def brute_runs(texts, n):
    """doc_id -> words in a run of n words that occurs earlier."""
    first, gone = set(), {}
    for d, t in enumerate(texts):
        w = words(t)
        for i in range(len(w) - n + 1):
            run = tuple(w[i : i + n])
            if run in first:
                gone.setdefault(d, set()).update(range(i, i + n))
            first.add(run)
    return gone


def found_words(found):
    out = {}
    for r in found:
        out.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    return out


def broken(rng, n, every, end):
    """n words with an end behind every so many (with 0: none)."""
    w = words(prose(rng, n, 5000))
    return " ".join(x + (end if every and i % every == every - 1 else "") for i, x in enumerate(w))


def test_passages_are_found_whole_against_brute_force(spark):
    rng = seeded(9)
    texts = []
    for n in (50, 51, 60, 100, 200):
        for every in (0, 9, 17):
            passage = broken(rng, n, every, ".")
            texts += [f"{broken(rng, 37, 11, '.')} {passage} {broken(rng, 41, 13, '.')}" for _ in range(3)]
    once = broken(rng, 70, 0, "")
    texts += [f"{once} {broken(rng, 30, 7, '.')} {once}", broken(rng, 49, 0, ""), None, ""]
    passage = broken(rng, 90, 0, "").split()  # one text has its beginning, another its end
    texts += [" ".join(p + broken(rng, 30, 0, "").split()) for p in (passage[:60], passage[30:], passage)]
    want = brute_runs(texts, 50)
    found = substring_dedup.repeated_passages(frame(spark, texts)).collect()
    assert found_words(found) == want and len(want) >= 32


@pytest.mark.parametrize("end", [".", "\n"])
def test_passages_of_short_sentences_and_lines_are_found(spark, end):
    rng = seeded(10)
    texts = []
    for n in (51, 60, 100, 200):
        passage = broken(rng, n, 5, end)
        texts += [f"{broken(rng, 37, 4, end)} {passage} {broken(rng, 41, 3, end)}" for _ in range(3)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)  # an anchor's places are in several batches
    try:
        found = substring_dedup.repeated_passages(frame(spark, texts)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_runs(texts, 50)
    assert found_words(found) == want and len(want) == 8


def test_hot_anchors_are_compared_run_by_run(spark):
    rng = seeded(11)
    passage = broken(rng, 90, 9, ".")
    texts = [f"{broken(rng, 20 + i % 7, 11, '.')} {passage if i % 3 else passage[: len(passage) // 2]} {broken(rng, 25, 13, '.')}" for i in range(60)] + [passage, passage, None]
    rows = substring_dedup._rows(frame(spark, texts))
    want = brute_runs(texts, 50)
    for hot in (10**6, 5, 1):
        gone = {}
        for r in substring_dedup.repeated_runs(rows, 50, hot).collect():
            gone.setdefault(r.doc_id, set()).update(range(r.span >> 32, (r.span >> 32) + (r.span & 0xFFFFFFFF)))
            assert r.kept_doc_id < r.doc_id
        assert gone == want


def test_a_sentence_and_a_group_of_very_many(spark):
    rng = seeded(12)
    common = " ".join(words(prose(rng, 30, 5000))) + "."
    texts = spark.range(20000).selectExpr("id AS doc_id", f"concat('{common} ', 'a', id, ' b', id * 7, ' c', id * 3, ' d', id, ' e', id, ' f', id, '.') AS text")
    found = substring_dedup.repeated_sentences(substring_dedup._rows(texts))
    assert found.count() in (19999, 39998, 59997) and found.where("kept_doc_id <> 0").isEmpty()
    copies = spark.range(20000).selectExpr("id AS doc_id", f"'{common} {common}' AS text").union(spark.range(20000, 20300).selectExpr("id", f"concat('{common} {common} x', id)"))
    near = near_dedup.near_duplicates(copies)
    assert near.where("kept").count() == 1 and near.count() == 20300 and near.where("group_id <> 0").isEmpty()


def test_large_buckets_of_near_groups_are_not_paired(spark, monkeypatch):
    rng = seeded(51)
    base = rng.integers(0, 300, (30, 25))
    sets = {i: sorted({int(x) for x in np.where(rng.random(25) < 0.12, rng.integers(0, 300, 25), base[i % 30])}) for i in range(400)}
    keys = [(i, k) for i in sets for k in ([1] if i < 300 else []) + [100 + i // 5]]
    rows, items = spark.createDataFrame(keys, "id long, key long"), spark.createDataFrame(list(sets.items()), "id long, items array<int>")
    pairs, exact = [], common.jaccard
    monkeypatch.setattr(common, "jaccard", lambda p, s, t: pairs.append(p.count()) or exact(p, s, t))
    same = lambda i, j: (i < 300 and j < 300) or i // 5 == j // 5
    label = components(400, [(i, j) for i in sets for j in range(i) if same(i, j) and jaccard(set(sets[i]), set(sets[j])) >= 0.6])
    for limits in ({}, {"part_items": 900}):
        pairs.clear()
        found = {r.id: r.label for r in common.near_groups(lambda ids=None: rows if ids is None else rows.join(ids, "key", "left_semi"), lambda ids: items.join(ids, "id", "left_semi"), 0.6, **limits).collect()}
        assert found == {i: x for i, x in enumerate(label) if label.count(x) > 1}
        assert sum(pairs) <= 4 * len(sets)  # a bucket of 300 ids has 44 850 pairs


def test_runs_of_a_hot_anchor_go_on_through_batches():
    rng, k, n = seeded(52), 3, 500
    hashes = rng.integers(0, 900, (n, k)).astype("<u8")
    rows = pa.RecordBatch.from_arrays(
        [pa.array(np.where(np.arange(n) < 20, 6, np.where(np.arange(n) < 450, 7, 8))), pa.array(np.arange(n)), pa.array(np.arange(n) + 1000), pa.array(np.full(n, 5, np.int32)), pa.array([h.view(np.uint8).reshape(-1, 8)[:, : substring_dedup.HASH_BYTES].tobytes() for h in hashes], pa.binary())],
        names=["key", "uid", "doc_id", "at", "hashes"],
    )
    seen, want = {}, set()
    for i, (key, h) in enumerate(zip(rows.column(0).to_pylist(), hashes.tolist())):
        for j, x in enumerate(h):
            if seen.setdefault((key, x), (i, j)) != (i, j):
                want.add((i, 5 + j, seen[key, x][0] + 1000))
    for size in (1, 7, 64, n):
        got = [r for b in substring_dedup.later_runs((rows.slice(a, size) for a in range(0, n, size)), 10) for r in b.to_pylist()]
        runs = {(r["uid"], (r["span"] >> 32) + j) for r in got for j in range((r["span"] & 0xFFFFFFFF) - 9)}
        assert runs == {(i, w) for i, w, _ in want}
        for r in got:
            mine = [d for i, w, d in want if i == r["uid"] and 0 <= w - (r["span"] >> 32) <= (r["span"] & 0xFFFFFFFF) - 10]
            assert r["kept_doc_id"] == min(mine)
