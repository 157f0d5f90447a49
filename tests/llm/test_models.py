import math
from concurrent.futures import ProcessPoolExecutor
from multiprocessing import get_context

import numpy as np
import pyarrow as pa
from llm.helpers import frame, prose, seeded, words
from pyspark.sql import functions as F

from papyrine.llm import quality, toxicity
from papyrine.llm.text import words as tokenised


def labelled(n, seed, stems=("zug", "krax", "blor")):
    """Documents of which every third has insults, stems with changing ends, in two places."""
    rng = seeded(seed)
    texts, toxic = [], []
    for i in range(n):
        parts = prose(rng, int(rng.integers(20, 250)), 3000).split(" ")
        if i % 3 == 0:
            for _ in range(3):
                parts.insert(int(rng.integers(0, len(parts))), f"{stems[rng.integers(len(stems))]}{'aeiou'[rng.integers(5)]}{'nrst'[rng.integers(4)]}")
        texts.append(" ".join(parts))
        toxic.append(int(i % 3 == 0))
    return texts, toxic


def test_windows_cover_every_word_and_overlap():
    first = np.array([0, 0, 5, 69, 69 + 200, 69 + 264])
    row, start, n = toxicity.windows(first, 64, 48)
    for i, (a, b) in enumerate(zip(first, first[1:])):
        mine = [(s, s + k) for r, s, k in zip(row, start, n) if r == i]
        assert sorted({w for s, e in mine for w in range(s, e)}) == list(range(a, b))
        assert all(e - s2 == 16 for (s, e), (s2, _) in zip(mine, mine[1:]))


def test_gradients():
    w = tokenised(pa.array(["one two three four five", "six seven", "eight"]))
    net = toxicity.Network(np.unique(w.hash), np.zeros(len(np.unique(w.hash)), np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    proj, start, n = net.project(net.inputs(w)[0].astype(np.float64)), w.first[:-1], np.diff(w.first)
    weight = np.array([1.0, -2.0, 0.5])
    _, kept = net.forward(proj, start, n, keep=True)
    grads, dproj = net.backward(proj, kept, weight)

    def slope(a, i):
        old = a[i]
        out = []
        for e in (1e-3, -1e-3):
            a[i] = old + e
            out.append(float(net.forward(proj, start, n) @ weight))
        a[i] = old
        return (out[0] - out[1]) / 2e-3

    for k in ("Uf", "Ub", "att", "att_b", "v", "w", "c"):
        i = tuple(0 for _ in net.p[k].shape)
        assert math.isclose(slope(net.p[k], i), grads[k][i], abs_tol=2e-5)
    for i in ((0, 0), (1, 20), (4, 30), (7, 47)):
        assert math.isclose(slope(proj, i), dproj[i], abs_tol=2e-5)


def test_toxicity_held_out(spark):
    texts, toxic = labelled(360, 21)
    fresh, truth = labelled(120, 22)
    odd = [None, "", "?!"]
    docs = frame(spark, texts + fresh + odd, clashing=True)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == len(texts) + len(fresh) + 3
    guess = [found[360 + i].toxic for i in range(120)]
    hits = sum(g and t for g, t in zip(guess, truth))
    assert hits >= 0.8 * sum(truth) and hits >= 0.8 * sum(guess)
    for i in range(480, 483):
        assert (found[i].score, found[i].n_windows, found[i].worst_word, found[i].toxic) == (0.0, 0, None, False)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, r in found.items() if not r.toxic}


def held_out(seed, n):
    """Recall and precision on fresh documents of a network that n labelled ones trained."""
    texts, toxic = labelled(n, 21)
    fresh, truth = labelled(120, 22)
    net = toxicity.train(pa.array(texts), np.array(toxic), seed)
    guess, truth = toxicity.judge(net, tokenised(pa.array(fresh)))[0] > net.threshold, np.array(truth) > 0
    return (guess & truth).sum() / truth.sum(), (guess & truth).sum() / max(1, guess.sum())


def test_small_label_sets_whatever_the_seed():
    with ProcessPoolExecutor(4, mp_context=get_context("spawn")) as pool:
        for recall, precision in pool.map(held_out, [5, 6, 7, 8, 9], [240] * 5):
            assert recall >= 0.8 and precision >= 0.8


def test_pieces_of_long_texts_score_as_the_whole():
    texts, toxic = labelled(60, 21)
    net = toxicity.train(pa.array(texts), np.array(toxic), n_steps=20)
    every = " ".join(texts).split()
    for n in (1, 63, 64, 65, 112, 113, 160, len(every)):
        batch = pa.RecordBatch.from_arrays([pa.array([" ".join(every[:n]), "", None, "é" * 900])], names=["text"])
        whole = [v for _, v in toxicity.judged(net, batch)]
        for long in (64, 100, 999):
            cut = [v for _, v in toxicity.judged(net, batch, long)]
            for i in range(3):
                assert np.allclose(np.concatenate([v[i] for v in whole]), np.concatenate([v[i] for v in cut]), atol=1e-4)


def test_toxicity_of_repeated_rows_and_null_ids(spark):
    texts, toxic = labelled(90, 21)
    docs = frame(spark, texts + [texts[0], texts[0], texts[0] * 3], ids=[*range(90), 0, None, None])
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    found = toxicity.toxicity(docs, labels).collect()
    assert len(found) == 93 and sum(r.doc_id is None for r in found) == 2
    assert len({(round(r.score, 6), r.n_windows) for r in found if r.doc_id == 0}) == 1


def test_toxicity_without_labels(spark):
    docs = frame(spark, ["a b", None], ids=[None, 1])
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for given in (labels, labels.where("false")):
        assert {(r.doc_id, r.score, r.toxic) for r in toxicity.toxicity(docs, given).collect()} == {(None, 0.0, False), (1, 0.0, False)}
        assert toxicity.drop_toxic(docs, given).count() == 2
    assert toxicity.toxicity(docs.where("false"), labels).count() == 0


def test_scores_dont_depend_on_batches():
    texts, toxic = labelled(90, 23)
    net = toxicity.train(pa.array(texts), np.array(toxic), n_steps=20)
    whole = toxicity.judge(net, tokenised(pa.array(texts)))[0]
    alone = [float(toxicity.judge(net, tokenised(pa.array([t])))[0][0]) for t in texts[:20]]
    assert np.allclose(whole[:20], alone, atol=1e-4)


def brute_posteriors(rows, odds):
    """(host, path) -> (host posterior, path posterior), by loops."""
    p = [(h, s, 1 / (1 + math.exp(-(e + odds)))) for h, s, e in rows]

    def moments(groups):
        n = {g: len(v) for g, v in groups.items()}
        total, all_ = sum(n.values()), sum(map(sum, groups.values()))
        within = max(sum(sum(x * x for x in v) - sum(v) ** 2 / len(v) for v in groups.values()) / max(total - len(groups), 1), 1e-9)
        around = sum(sum(v) ** 2 / len(v) for v in groups.values()) - all_**2 / total
        size = total - sum(k * k for k in n.values()) / total
        between = max((around - (len(groups) - 1) * within) / max(size, 1), 1e-9)
        return all_ / total, min(max(within / between, 1), 1e6)

    hosts, paths = {}, {}
    for h, s, x in p:
        hosts.setdefault(h, []).append(x)
        paths.setdefault((h, s), []).append(x)
    mean, hk = moments(hosts)
    _, pk = moments(paths)
    host = {h: (sum(v) + hk * mean) / (len(v) + hk) for h, v in hosts.items()}
    return {k: (host[k[0]], (sum(v) + pk * host[k[0]]) / (len(v) + pk)) for k, v in paths.items()}


def test_posteriors_against_brute_force(spark):
    rng = seeded(24)
    rows = [(f"h{int(rng.integers(6)) ** 2 % 7}", f"p{rng.integers(3)}", float(rng.normal(1, 2))) for _ in range(200)] + [("lonely", "", -5.0)]
    want = brute_posteriors(rows, 0.7)
    for r in quality.posteriors(spark.createDataFrame(rows, "host string, path string, llr double"), 0.7).collect():
        a, b = want.pop((r.host, r.path))
        assert math.isclose(r.host_good, a, rel_tol=1e-9) and math.isclose(r.path_good, b, rel_tol=1e-9)
    assert not want


def test_quality_held_out_and_edges(spark):
    rng = seeded(25)
    rows, good = [], []
    for i in range(240):
        t = prose(rng, int(rng.integers(30, 150)))
        bad = i % 4 == 0
        rows.append((i, t.upper().replace(" ", "!! ") if bad else t, f"s{i % 3}"))
        good.append(int(not bad))
    rows += [(None, None, None), (500, "", "s9"), (500, "", "s9")]
    docs = spark.createDataFrame([(*r, "en", "x") for r in rows], "doc_id long, text string, source string, lang string, host string")
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good[:160])] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    found = quality.quality(docs, labels).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows) and by[None].host == "" and all(0 < r.good < 1 for r in found)
    assert sum(by[i].kept == bool(good[i]) for i in range(160, 240)) >= 76
    flat = quality.quality(docs, labels.where("false")).collect()
    assert {r.evidence for r in flat} == {0.0} and len({round(r.good, 6) for r in flat}) == 1
    assert quality.quality(docs.where("false"), labels).count() == 0
    by_path = quality.quality(docs, labels, F.col("source"), F.lit("p")).select("path").distinct().collect()
    assert [r.path for r in by_path] == ["p"] and words("x")
