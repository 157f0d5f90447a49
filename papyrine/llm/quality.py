"""Quality: hierarchical empirical Bayes over sites.

A logistic classifier of text statistics, fitted on labelled documents, gives each
document the log odds of being good.  Averaged over a path (a section of a host)
and shrunk towards the host, and the host towards the whole, these make
posteriors: sparse sites stay near their parent, large ones speak for themselves.
How strongly to shrink is estimated from the grouped variances (method of
moments).  A document's result combines its own evidence with its path's posterior.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.llm.common import cut, in_ids
from papyrine.llm.text import slices

#: The classifier is fitted on at most so many labelled documents of each class (the least hashes of their ids).
TRAIN_EACH = 2000
KEEP = 0.5
SEED = 3
FEATURES = 12

_CLASS = np.zeros(256, dtype=np.uint8)
for _chars, _k in ((b"abcdefghijklmnopqrstuvwxyz", 1), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), (b"0123456789", 3), (b" ", 4), (b"\n", 5), (b".,;:'\"?-()", 6), (b"!", 7)):
    _CLASS[list(_chars)] = _k
_CLASS[128:] = 8  # 0: other signs


def features(part: pa.RecordBatch, w, text: int) -> np.ndarray:
    """Statistics of the text of each row: shares of kinds of characters, lengths, and repetition."""
    from papyrine.llm.text import _bytes

    col = part.column(text)
    raw, at = _bytes(col.fill_null(""))
    n = w.rows
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(at)) * 9 + _CLASS[raw], minlength=9 * n).reshape(n, 9)
    size = np.maximum(1, kinds.sum(axis=1))
    words_ = np.diff(w.first)
    few = np.maximum(1, words_)
    row = w.row_of()
    pairs = np.sort((row.astype(np.uint64) << np.uint64(40)) | (w.hash >> np.uint64(24)))
    distinct = np.bincount((pairs[np.append(True, pairs[1:] != pairs[:-1])] >> np.uint64(40)).astype(np.int64), minlength=n) if len(pairs) else np.zeros(n)
    letters = kinds[:, 1] + kinds[:, 2] + kinds[:, 8]
    x = np.stack(
        [
            np.ones(n),
            np.log1p(words_),
            np.sqrt(kinds[:, 0] / size),
            np.sqrt(kinds[:, 2] / np.maximum(1, letters)),
            np.sqrt(kinds[:, 3] / size),
            np.sqrt(kinds[:, 5] / size),
            np.sqrt(kinds[:, 6] / size),
            np.sqrt(kinds[:, 7] / size),
            size / few / 10,
            distinct / few,
            np.log1p(few / np.maximum(1, kinds[:, 5] + 1)),
            (words_ < 10).astype(float),
        ],
        axis=1,
    )
    return np.clip(x, 0, 20)


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by gradient steps on standardised columns; classes count the same."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    mean[0], scale[0] = 0, 1
    z, w = (x - mean) / scale, np.zeros(x.shape[1])
    each = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    step = np.zeros_like(w)
    for _ in range(1500):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = 0.9 * step + z.T @ (each * (q - y)) + 0.001 * w
        w -= 0.3 * step
    w /= scale
    w[0] -= (w[1:] * mean[1:]).sum()
    return w


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def classifier(docs: DataFrame, labels: DataFrame, each: int = TRAIN_EACH) -> tuple[np.ndarray, float]:
    """Weights for features, and the log odds of a good document among all labels; zeros without labels of both classes."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    n = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    odds = float(np.log((n.get(1, 0) + 1) / (n.get(0, 0) + 1)))
    order = F.xxhash64("doc_id", F.lit(SEED))
    sample = known.where("quality = 1").orderBy(order, "doc_id").limit(each).union(known.where("quality = 0").orderBy(order, "doc_id").limit(each)).toPandas()
    if sample["quality"].nunique() < 2:
        return np.zeros(FEATURES), odds
    t = in_ids(_rows(docs), docs.sparkSession.createDataFrame(sample[["doc_id"]]), "doc_id").toArrow().to_pandas().merge(sample, on="doc_id").sort_values(["doc_id", "text"])
    if t["quality"].nunique() < 2:
        return np.zeros(FEATURES), odds
    batch = pa.RecordBatch.from_arrays([pa.array(t["text"].tolist(), pa.string())], names=["text"])
    x = np.concatenate([features(part, w, 0) for part, w in slices(batch)])
    return _fit(x, t["quality"].to_numpy(float)), odds


def evidence(docs: DataFrame, weights: np.ndarray, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, llr): each document's log likelihood ratio of good to bad, at most 6 either way."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(host.cast("string"), F.lit("")).alias("host"), F.coalesce(path.cast("string"), F.lit("")).alias("path"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, w in slices(batch):
                llr = np.clip(features(part, w, 3) @ weights, -6, 6)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(llr)], names=["doc_id", "host", "path", "llr"])

    return rows.mapInArrow(each, "doc_id long, host string, path string, llr double")


def posteriors(found: DataFrame, odds: float) -> DataFrame:
    """(host, path, n, host_good, path_good): posterior shares of good documents, from rows (host, path, llr).

    A path of n documents with mean m counts n / (n + k) of m and the rest of its
    host's posterior; k is the variance within paths over that between (at least 1,
    at most 10**6), and likewise for hosts under the whole.
    """
    p = 1 / (1 + F.exp(-(F.col("llr") + F.lit(odds))))
    paths = found.select("host", "path", p.alias("p")).groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("ss").alias("hss"))

    def moments(groups: DataFrame, n: str, s: str, ss: str) -> DataFrame:
        mean = F.sum(s) / F.sum(n)
        within = F.greatest(F.sum(F.col(ss) - F.col(s) * F.col(s) / F.col(n)) / F.greatest(F.sum(n) - F.count("*"), F.lit(1)), F.lit(1e-9))
        around = F.sum(F.col(s) * F.col(s) / F.col(n)) - F.sum(s) * F.sum(s) / F.sum(n)
        degrees = F.count("*") - 1
        size = F.sum(n) - F.sum(F.col(n) * F.col(n)) / F.sum(n)
        between = F.greatest((around - degrees * within) / F.greatest(size, F.lit(1)), F.lit(1e-9))
        return groups.agg(mean.alias("mean"), F.least(F.greatest(within / between, F.lit(1.0)), F.lit(1e6)).alias("k"))

    top = moments(hosts, "hn", "hs", "hss").select(F.col("mean").alias("all_mean"), F.col("k").alias("host_k"))
    low = moments(paths, "n", "s", "ss").select(F.col("k").alias("path_k"))
    hosts = hosts.crossJoin(F.broadcast(top)).select("host", ((F.col("hs") + F.col("host_k") * F.col("all_mean")) / (F.col("hn") + F.col("host_k"))).alias("host_good"))
    out = paths.join(hosts, "host").crossJoin(F.broadcast(low))
    return out.select("host", "path", "n", "host_good", ((F.col("s") + F.col("path_k") * F.col("host_good")) / (F.col("n") + F.col("path_k"))).alias("path_good"))


def quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, keep: float = KEEP) -> DataFrame:
    """(doc_id, host, path, evidence, host_good, path_good, good, kept) for every row.

    host is by default the document's source, and path a section of it, its
    language.  good is the posterior probability that the document is good, with
    its path's posterior share as the prior; kept is good >= keep.  Null hosts and
    paths count as the empty string, null texts as empty; repeated rows count each.
    Without labels of both classes the evidence is 0 and everything is as good as the prior.
    """
    weights, odds = classifier(docs, labels)
    found = cut(evidence(docs, weights, F.col("source") if host is None else host, F.col("lang") if path is None else path))
    sites = posteriors(found, odds)
    prior = F.least(F.greatest(F.col("path_good"), F.lit(0.001)), F.lit(0.999))
    good = 1 / (1 + F.exp(-(F.col("llr") + F.log(prior / (1 - prior)))))
    out = found.join(sites, ["host", "path"]).withColumn("good", good)
    return out.select("doc_id", "host", "path", F.col("llr").alias("evidence"), "host_good", "path_good", "good", (F.col("good") >= keep).alias("kept"))
