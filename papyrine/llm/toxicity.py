"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Each word enters as a trained word vector (words outside the vocabulary share
one) beside the mean of trained vectors of its character 4-grams.  A gated
recurrent layer reads every window of WINDOW words in both directions, attention
pools its states, and a logistic unit scores the window.  Windows begin every
STRIDE words, so they overlap and cover the whole text; a logistic head over the
worst window, the expected number of toxic windows and their share scores the
document.  Training sees documents' labels only: the worst window of a toxic
document is taken as the toxic one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import in_ids
from papyrine.llm.text import Words, _bytes, pieces, slices, words

WINDOW = 64
STRIDE = 48
HIDDEN = 8
WORD_DIM = 8
CHAR_DIM = 8
CHAR_CODES = 8192
#: The network is fitted on at most so many labelled documents of each class (the least hashes of their ids).
TRAIN_TOXIC = 600
TRAIN_CLEAN = 1200
STEPS = 400
BATCH = 64
RATE = 0.05
#: Words of fewer training documents (or of fewer than one in 200) have no vector of their own; of others this share is
#: hidden in training, so that characters count too.
LEAST_DOCS = 5
HIDDEN_WORDS = 0.6
#: Logits by which held-out scores are blurred when the threshold is chosen.
BLUR = 0.5
#: Share of the steps over whose weights the network is averaged, from the end.
AVERAGED = 0.3
SEED = 5
#: A longer text is read in pieces of a quarter of this.
LONG_BYTES = 1 << 22

_RANK = np.zeros(256, dtype=np.uint32)
_RANK[ord("0") : ord("9") + 1] = np.arange(1, 11)
_RANK[ord("a") : ord("z") + 1] = np.arange(11, 37)
_RANK[128:] = 37 + np.arange(128)


def gram_codes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """A code for the bytes around each byte of each word (one before, two behind, none beyond the word), and where each word's begin."""
    r = _RANK[w.buf]
    before, behind, beyond = (np.zeros_like(r) for _ in range(3))
    before[1:], behind[:-1], beyond[:-2] = r[:-1], r[1:], r[2:]
    before[w.start] = 0  # rows stand next to each other in the buffer
    behind[w.end - 1] = 0
    beyond[behind == 0] = 0
    beyond[w.end - 1] = 0
    beyond[np.maximum(w.end - 2, 0)] = 0
    code = (before * np.uint32(40503) + r * np.uint32(2531) + behind * np.uint32(163) + beyond * np.uint32(7919)) * np.uint32(2654435761) >> np.uint32(32 - CHAR_CODES.bit_length() + 1)
    n = w.end - w.start
    firsts = np.concatenate([[0], np.cumsum(n)])
    return code[np.arange(firsts[-1]) + np.repeat(w.start - firsts[:-1], n)].astype(np.uint16), firsts


def windows(first: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and number of words of every window; a row without words has none."""
    n = np.diff(first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - window) // stride)), 0)
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = first[:-1][row] + k * stride
    return row, start, np.minimum(window, first[1:][row] - start)


def _summed(at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Rows of x summed by their place."""
    return np.stack([np.bincount(at, weights=x[:, j], minlength=n) for j in range(x.shape[1])], axis=1).astype(np.float32)


class Network:
    """The weights, and forward and backward passes over windows."""

    def __init__(self, vocabulary: np.ndarray, prior: np.ndarray, seed: int = SEED, char_prior: np.ndarray | float = 0.0):
        rng = np.random.default_rng(seed)
        f = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        h, d = HIDDEN, WORD_DIM + CHAR_DIM
        self.vocabulary = vocabulary
        word = (rng.standard_normal((len(vocabulary) + 1, WORD_DIM)) * 0.1).astype(np.float32)
        word[0] = 0
        word[1:, 0] = prior
        char = (rng.standard_normal((CHAR_CODES, CHAR_DIM)) * 0.3).astype(np.float32)
        char[:, 0] = char_prior
        self.p = {"word": word, "char": char, "b": np.zeros(6 * h, np.float32), "W": f(d, 6 * h), "att": f(2 * h, h), "att_b": np.zeros(h, np.float32), "v": f(h, 1)[:, 0], "w": f(2 * h, 1)[:, 0], "c": np.full(1, -2, np.float32)}
        for side in "fb":
            self.p["U" + side] = f(h, 3 * h)
        self.head, self.threshold = np.array([0.0, 1, 0, 0]), 0.0

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """1 + place in the vocabulary, 0 for other words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, w: Words) -> tuple[np.ndarray, np.ndarray, tuple]:
        """The input of every word, its word id, and its character grams."""
        ids = self.ids(w.hash)
        code, firsts = gram_codes(w)
        if len(ids):
            chars = np.add.reduceat(self.p["char"][code], firsts[:-1], axis=0) / np.diff(firsts)[:, None].astype(np.float32)
        else:
            chars = np.zeros((0, CHAR_DIM), np.float32)
        return np.concatenate([self.p["word"][ids], chars], axis=1), ids, (code, firsts)

    def forward(self, proj: np.ndarray, start: np.ndarray, n: np.ndarray, keep: bool = False):
        """Logits of windows over projected words; with keep, also what backward needs."""
        p, h, t = self.p, HIDDEN, int(n.max())
        at = np.minimum(start[None, :] + np.arange(t)[:, None], len(proj) - 1)
        mask = (np.arange(t)[:, None] < n[None, :]).astype(np.float32)
        full = bool(mask.all())
        states = np.empty((t, len(start), 2 * h), dtype=np.float32)
        saved: dict = {"f": {}, "b": {}}
        for side, lo, order in (("f", 0, range(t)), ("b", 3 * h, range(t - 1, -1, -1))):
            state = np.zeros((len(start), h), np.float32)
            own, u = np.ascontiguousarray(proj[:, lo : lo + 3 * h]), p["U" + side]
            for i in order:
                x = own[at[i]]
                y = state @ u
                x[:, : 2 * h] += y[:, : 2 * h]
                gate = np.tanh(x[:, : 2 * h] * np.float32(0.5))
                gate += 1
                gate *= np.float32(0.5)
                z, r = gate[:, :h], gate[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * y[:, 2 * h :])
                nxt = new + z * (state - new)
                if not full:
                    nxt = np.where(mask[i][:, None] > 0, nxt, state)
                if keep:
                    saved[side][i] = (state, z, r, new, y[:, 2 * h :])
                state = nxt
                states[i, :, lo // 3 : lo // 3 + h] = state
        hid = np.tanh(states @ p["att"] + p["att_b"])
        e = hid @ p["v"]
        e[mask == 0] = -np.inf
        e -= e.max(axis=0)
        alpha = np.exp(e)
        alpha /= alpha.sum(axis=0)
        pooled = np.einsum("tm,tmh->mh", alpha, states)
        logit = pooled @ p["w"] + p["c"][0]
        return (logit, (at, mask, states, saved, hid, alpha, pooled)) if keep else logit

    def backward(self, proj: np.ndarray, kept: tuple, d: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the upper weights, and of proj, for the gradient d of the logits."""
        p, h = self.p, HIDDEN
        at, mask, states, saved, hid, alpha, pooled = kept
        t = len(at)
        g = {"w": pooled.T @ d, "c": np.array([d.sum()], np.float32)}
        dp = d[:, None] * p["w"]
        ds = alpha[:, :, None] * dp
        da = np.einsum("tmh,mh->tm", states, dp)
        de = alpha * (da - (alpha * da).sum(axis=0))
        g["v"] = np.einsum("tm,tmh->h", de, hid)
        dh = de[:, :, None] * p["v"] * (1 - hid * hid)
        g["att"] = np.einsum("tmi,tmj->ij", states, dh)
        g["att_b"] = dh.sum(axis=(0, 1))
        ds += dh @ p["att"].T
        dproj = np.zeros_like(proj)
        for side, lo, order in (("f", 0, range(t - 1, -1, -1)), ("b", 3 * h, range(t))):
            u = p["U" + side]
            gu = np.zeros_like(u)
            carry = np.zeros((at.shape[1], h), np.float32)
            for i in order:
                state, z, r, new, yn = saved[side][i]
                m = mask[i][:, None]
                dn = carry + ds[i, :, lo // 3 : lo // 3 + h]
                live = dn * m
                dnew = live * (1 - z) * (1 - new * new)
                dz = live * (state - new) * z * (1 - z)
                dr = dnew * yn * r * (1 - r)
                dy = np.concatenate([dz, dr, dnew * r], axis=1)
                gu += state.T @ dy
                on = np.flatnonzero(mask[i])
                dproj[at[i][on], lo : lo + 3 * h] = np.concatenate([dz, dr, dnew], axis=1)[on]
                carry = dy @ u.T + live * z + dn * (1 - m)
            g["U" + side] = gu
        return g, dproj

    def project(self, x: np.ndarray) -> np.ndarray:
        return x @ self.p["W"] + self.p["b"]

    def step(self, ids: np.ndarray, codes: np.ndarray, code_at: np.ndarray, first: np.ndarray, n: np.ndarray, target: np.ndarray, weight: np.ndarray, moments: dict, rate: float) -> None:
        """One Adam step on windows of n words from first on; ids and codes (of word i from code_at[i]) are those of all words."""
        start = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(first - start, n)
        counts = np.diff(code_at)[at]
        ids = ids[at]
        firsts = np.concatenate([[0], np.cumsum(counts)])
        codes = codes[np.arange(firsts[-1]) + np.repeat(code_at[at] - firsts[:-1], counts)]
        chars = np.add.reduceat(self.p["char"][codes], firsts[:-1], axis=0) / counts[:, None].astype(np.float32)
        x = np.concatenate([self.p["word"][ids], chars], axis=1)
        proj = self.project(x)
        logit, kept = self.forward(proj, start, n, keep=True)
        prob = 1 / (1 + np.exp(-logit))
        d = ((prob - target) * weight / weight.sum()).astype(np.float32)
        g, dproj = self.backward(proj, kept, d)
        g["W"], g["b"] = x.T @ dproj, dproj.sum(axis=0)
        dx = dproj @ self.p["W"].T
        g["word"] = _summed(ids, dx[:, :WORD_DIM], len(self.p["word"]))
        g["char"] = _summed(codes, np.repeat(dx[:, WORD_DIM:] / counts[:, None], counts, axis=0), CHAR_CODES)
        moments["t"] = moments.get("t", 0) + 1
        for k, v in g.items():
            m, s = moments.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
            m += 0.1 * (v - m)
            s += 0.001 * (v * v - s)
            if k in ("word", "char"):
                self.p[k] *= 1 - 0.1 * rate
            self.p[k] = (self.p[k] - rate * (m / (1 - 0.9 ** moments["t"])) / (np.sqrt(s / (1 - 0.999 ** moments["t"])) + 1e-7)).astype(np.float32)

    def scores(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, first word and logit of every window of every row."""
        row, start, n = windows(w.first, WINDOW, STRIDE)
        if not len(row):
            return row, start, np.zeros(0, np.float32)
        proj = self.project(self.inputs(w)[0])
        logit = np.empty(len(row), np.float32)
        for part in (np.flatnonzero(n == WINDOW), np.flatnonzero(n < WINDOW)):  # full windows need no masks
            order = part[np.argsort(n[part], kind="stable")]
            for i in range(0, len(order), 2048):
                some = order[i : i + 2048]
                logit[some] = self.forward(proj, start[some], n[some])
        return row, start, logit


def train(text: pa.Array, toxic: np.ndarray, seed: int = SEED, n_steps: int = STEPS) -> Network:
    """Fit on labelled texts, in as many steps of as many windows whatever their number; every fifth is held out to set the threshold."""
    parts = [w for _, w in slices(pa.RecordBatch.from_arrays([text], names=["text"]))]  # slices, so that temporaries stay small
    total = sum(w.rows for w in parts)
    joined = lambda cuts: np.concatenate([[0], np.cumsum(np.concatenate([np.diff(c) for c in cuts]))])
    first, hashes = joined([w.first for w in parts]), np.concatenate([w.hash for w in parts])
    rows = np.arange(total)
    have = np.diff(first) > 0
    held = (rows % 5 == 4) & have
    fit = have & ~held
    doc, inverse = np.repeat(rows, np.diff(first)), np.unique(hashes, return_inverse=True)
    grams_ = [gram_codes(w) for w in parts]
    codes, firsts = np.concatenate([c for c, _ in grams_]), joined([f for _, f in grams_])
    each = np.maximum(1, np.array([(toxic[fit] == c).sum() for c in (0, 1)]))

    def counts(what: np.ndarray, of: np.ndarray, kinds: int) -> np.ndarray:
        """In how many documents of each class that are fitted on each kind occurs."""
        used = np.unique(of[fit[of]] * kinds + what[fit[of]])
        return np.stack([np.bincount((used % kinds)[toxic[used // kinds] == c], minlength=kinds) for c in (0, 1)], axis=1)

    def lean_of(count: np.ndarray) -> np.ndarray:
        """How much more often a kind is in toxic documents, shrunk where it is rare: half the log odds."""
        share = (count + 8 * each / each.sum()) / each
        return np.clip(0.5 * np.log(share[:, 1] / share[:, 0]), -1.5, 1.5).astype(np.float32)

    count = counts(inverse[1], doc, len(inverse[0]))
    common = np.flatnonzero(count.sum(axis=1) >= max(LEAST_DOCS, fit.sum() // 200))
    by_code = counts(codes.astype(np.int64), np.repeat(doc, np.diff(firsts)), CHAR_CODES)
    char_prior = lean_of(by_code)
    word_prior = lean_of(count[common])
    ids = Network(inverse[0][common], word_prior).ids(hashes)
    word_lean = np.append(np.float32(0), word_prior)[ids]
    row, start, n = windows(first, WINDOW, STRIDE)
    by_char = np.add.reduceat(char_prior[codes], firsts[:-1]) / np.diff(firsts) if len(ids) else np.zeros(0)
    lean = np.concatenate([[0], np.cumsum(np.maximum(0, np.maximum(word_lean, by_char)) ** 2)])
    begin = np.searchsorted(row, rows)
    check = np.flatnonzero(held) if held.any() else np.flatnonzero(fit)

    net = Network(inverse[0][common], word_prior, seed, char_prior)
    net.p["char"][by_code.sum(axis=1) == 0] = 0  # what training never sees says nothing
    _steps(net, parts, ids, codes, firsts, row, start, n, rows, begin, lean[start + n] - lean[start], np.flatnonzero(fit & (toxic > 0)), np.flatnonzero(fit & (toxic == 0)), np.random.default_rng(seed), n_steps)
    high = pool(row, np.concatenate([net.scores(w)[2] for w in parts]), total)[0]
    _decide(net, high[check], (toxic[check] > 0).astype(float))
    return net


def _steps(net: Network, parts: list, ids: np.ndarray, codes: np.ndarray, firsts: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray, rows: np.ndarray, begin: np.ndarray, score: np.ndarray, bad: np.ndarray, good: np.ndarray, rng: np.random.Generator, n_steps: int) -> None:
    """Fit the network to windows of toxic (bad) and clean (good) documents; score says at first which windows are worst."""

    def worst(of: np.ndarray) -> np.ndarray:
        return np.array([begin[i] + int(np.argmax(score[begin[i] : np.searchsorted(row, i, side="right")])) for i in of], dtype=np.int64)

    top = worst(bad)
    trust = np.ones(len(bad))
    moments: dict = {}
    mean: dict = {}
    steps, scored, averaged = 0, 0.0, 0
    while steps < n_steps:
        done = steps / n_steps
        if done >= max(0.35, scored + 0.2):
            scored = done
            score = np.concatenate([net.scores(w)[2] for w in parts])
            top = worst(bad)
            trust = np.maximum(0.02, 1 / (1 + np.exp(-2 * score[top])))  # a label that the text doesn't bear out counts little

        def some_of(docs: np.ndarray) -> np.ndarray:
            return begin[docs] + (rng.random(len(docs)) * (np.searchsorted(row, docs, side="right") - begin[docs])).astype(np.int64)

        part = [top, some_of(good), some_of(good)]
        if scored:
            part.append(worst(good))
        n_bad = len(bad)
        if done < 0.35:  # at first any window of a toxic document may be the toxic one
            part.insert(1, some_of(bad))
            n_bad *= 2
        part = np.concatenate(part)
        target = (np.arange(len(part)) < n_bad).astype(np.float32)
        weight = np.ones(len(part))
        weight[: len(bad)] = trust
        weight[:n_bad] *= min(4.0, max(1.0, (len(part) - n_bad) / max(1, weight[:n_bad].sum())))
        order = rng.permutation(len(part))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            steps += 1
            shown = np.where(rng.random(len(ids)) < HIDDEN_WORDS, 0, ids) if i == 0 else shown
            if done > 1 - AVERAGED:
                for k, v in net.p.items():
                    mean[k] = mean.get(k, 0.0) + v
                averaged += 1
            net.step(shown, codes, firsts, start[part[some]], n[part[some]], target[some], weight[some].astype(np.float32), moments, RATE * min(1, steps / 10) * (1 - 0.8 * done))
    if averaged:
        net.p = {k: (v / averaged).astype(np.float32) for k, v in mean.items()}


def _decide(net: Network, x: np.ndarray, y: np.ndarray) -> None:
    """Set the network's head and threshold by held-out documents."""
    each = np.where(y > 0, min(4.0, max(1.0, (y == 0).sum() / max(1, y.sum()))), 1)
    first = net.head.copy()
    for _ in range(2000):  # gradient steps, with a ridge towards the worst window alone
        q = 1 / (1 + np.exp(-np.clip(x @ net.head, -30, 30)))
        net.head = net.head - 0.02 * (x.T @ (each * (q - y)) / each.sum() + 0.01 * (net.head - first))
    z = x @ net.head
    cand = np.unique(z)
    mid = np.concatenate([[cand[0] - 1], np.linspace(cand[0], cand[-1], 201), [cand[-1] + 1]])
    soft = 1 / (1 + np.exp(-np.clip((z[None] - mid[:, None]) / BLUR, -30, 30)))  # blurred, so that a gap is cut in its middle
    f = 2 * (soft * y).sum(axis=1) / (y.sum() + soft.sum(axis=1))
    best = np.flatnonzero(f == f.max())
    net.threshold = float(mid[best[len(best) // 2]])


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN) -> Network | None:
    """The network for these labels, or None where there aren't two classes of labelled texts."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit(SEED))
    sample = known.where("toxic = 1").orderBy(order, "doc_id").limit(toxic).union(known.where("toxic = 0").orderBy(order, "doc_id").limit(clean)).toPandas()
    if sample["toxic"].nunique() < 2:
        return None
    ids = docs.sparkSession.createDataFrame(sample[["doc_id"]])
    rows = in_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), ids, "doc_id").dropDuplicates(["doc_id", "text"]).toArrow().to_pandas()
    rows = rows.merge(sample, on="doc_id").sort_values(["doc_id", "text"])
    rows = rows.iloc[np.random.default_rng(SEED).permutation(len(rows))]
    if rows["toxic"].nunique() < 2:
        return None
    return train(pa.array(rows["text"].tolist(), pa.string()), rows["toxic"].to_numpy(np.int64))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score, worst_word, n_windows, toxic) for every row.

    score is the head's probability, worst_word the word at which the worst window
    begins (counted from 0; the first of equals), toxic whether the score is over the threshold
    that held-out labelled documents set.  Rows without words have score 0, no
    windows and null worst_word, and aren't toxic; without labels of both classes
    no row is.  Repeated rows are scored each; null ids are carried; an empty table
    gives no rows.  A very long text is read in pieces that overlap as windows do,
    so its score covers all of it in bounded memory.  Other columns are ignored,
    whatever their names.
    """
    net = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if net is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(None).cast("int").alias("worst_word"), F.lit(0).alias("n_windows"), F.lit(False).alias("toxic"))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (worst, at, count) in judged(shared.value, batch):
                none = count == 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.where(none, 0.0, 1 / (1 + np.exp(-worst)))), pa.array(at.astype(np.int32), mask=none), pa.array(count.astype(np.int32)), pa.array(~none & (worst > shared.value.threshold))],
                    names=["doc_id", "score", "worst_word", "n_windows", "toxic"],
                )

    return rows.mapInArrow(each, "doc_id long, score double, worst_word int, n_windows int, toxic boolean")


def pool(row: np.ndarray, logit: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """What the head sees of each row: 1, worst logit, log expected toxic windows, their share; and the number of windows."""
    count = np.bincount(row, minlength=rows)
    soft = np.bincount(row, weights=1 / (1 + np.exp(-np.clip(logit, -30, 30))), minlength=rows)
    worst = np.full(rows, -10.0)
    np.maximum.at(worst, row, logit)
    worst = np.clip(worst, -10, 10)
    return np.stack([np.ones(rows), worst, np.log(soft + 0.01), soft / np.maximum(1, count) ** 0.5], axis=1), count


def in_pieces(net: Network, raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and logit of every window of one very long text, of which a piece is tokenised at a time."""
    starts, logits, before, carry, done = [], [], 0, b"", False
    todo = pieces(raw, size)
    piece = next(todo, b"")
    while not done:
        later = next(todo, None)
        done = later is None
        w = words(pa.array([(carry + piece).decode("utf-8", "replace")], pa.string()))
        n, full = len(w.hash), 0
        if not done:  # only windows that are whole; the words of the next begin the next piece
            full = (n - WINDOW) // STRIDE + 1 if n >= WINDOW else 0
            carry = w.buf[w.start[full * STRIDE] if full * STRIDE < n else len(w.buf) :].tobytes()
        if n > WINDOW - STRIDE or not before:  # else the last window before has them
            _, start, logit = net.scores(w)
            keep = slice(0, full) if not done else slice(None)
            starts.append(start[keep] + before)
            logits.append(logit[keep])
        before += full * STRIDE
        piece = later
    return np.concatenate(starts), np.concatenate(logits)


def judged(net: Network, batch: pa.RecordBatch, long: int = LONG_BYTES) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The batch in slices, with what judge says of their rows."""
    for part, w in slices(batch, long=long):
        if w is not None:
            yield part, judge(net, w)
        else:
            raw, _ = _bytes(part.column(part.schema.get_field_index("text")))
            start, logit = in_pieces(net, raw, max(1, long // 4))
            yield part, _verdicts(net, np.zeros(len(start), np.int64), start, logit, np.zeros(1, np.int64))


def judge(net: Network, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The logit, the first word of the worst window and the number of windows of each row."""
    return _verdicts(net, *net.scores(w), w.first[:-1])


def _verdicts(net: Network, row: np.ndarray, start: np.ndarray, logit: np.ndarray, first_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = len(first_word)
    seen, count = pool(row, logit, rows)
    at = np.zeros(rows, np.int64)
    have = np.flatnonzero(count)
    if len(have):
        most = np.maximum.reduceat(logit, (np.cumsum(count) - count)[have])
        hit = np.flatnonzero(logit >= np.repeat(most, count[have]))
        _, first = np.unique(row[hit], return_index=True)
        at[have] = start[hit[first]] - first_word[have]
    return seen @ net.head, at, count


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that toxicity marks; all columns stay.

    Rows without words (null and empty texts among them) stay, and without labels
    of both classes all rows do.  Repeated rows are judged alike; very long texts
    are judged whole, in pieces; an empty table stays empty.
    """
    net = fit(docs, labels)
    if net is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, (worst, _, count) in judged(shared.value, batch):
                yield part.filter(pa.array((count == 0) | (worst <= shared.value.threshold)))

    return docs.mapInArrow(each, docs.schema)
