"""Small corpora and brute-force versions."""

import re

import numpy as np

WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, row string, uid string, label string, kept string, cell string, path string, host string"


def words(text):
    return WORD.findall((text or "").lower())


def prose(rng, n, size=400):
    """n made-up words, with sentences and lines."""
    out = []
    for i, w in enumerate(rng.integers(0, size, n)):
        out.append(f"w{w}x{w * 7 % 91}" + ("." if i % 9 == 8 else "") + ("\n" if i % 50 == 49 else ""))
    return " ".join(out).replace("\n ", "\n")


def changed(rng, text, n):
    """text with n words replaced."""
    parts = text.split(" ")
    for i in rng.choice(len(parts), n, replace=False):
        parts[i] = f"new{rng.integers(10**6)}"
    return " ".join(parts)


def frame(spark, texts, ids=None, clashing=False, source="s0"):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", source, None if t is None else len(t)) for i, t in zip(ids, texts)]
    if clashing:
        return spark.createDataFrame([r + ("x",) * 9 for r in rows], CLASHING)
    return spark.createDataFrame(rows, SCHEMA)


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def components(n, edges):
    label = list(range(n))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def seeded(n=0):
    return np.random.default_rng(n)
