"""Small tables and plain versions of what the operators compute."""

from __future__ import annotations

import collections
import re

import numpy as np
import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
BLANKS = re.compile("[^\x20\x09-\x0d]+")
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def read(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def low(text):
    return (text or "").translate(LOWER)


def documents(spark, texts, extra=()):
    """A ``documents`` table from (doc_id, text) pairs with columns that may clash."""
    names = ("words", "row", "doc", "hash", "n", "score", "copies", "places", *extra)
    rows = [(d, t, "en", None, None if t is None else len(t), *("x" for _ in names)) for d, t in texts]
    return spark.createDataFrame(rows, DOCS + "".join(f", {c} string" for c in names))


def groups(n, pairs):
    """The smallest member reachable from each of ``range(n)``."""
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def close_pairs(values, distance):
    values = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance):
            yield i, i + 1 + int(j)


def removed_words(docs, window=50):
    """Per (doc_id, text): flags of the words that repeated windows cover."""
    first = {}
    words = [(d, BLANKS.findall(t or "")) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            order = (d is None, d or 0)
            first[key] = min(first.get(key, order), order)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d is None, d or 0):
                gone[i : i + window] = [True] * window
        out.append((d, w, gone))
    return out


def collected(df):
    return collections.Counter(tuple(r) for r in df.collect())
