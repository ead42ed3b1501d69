"""Quality classifier: a linear-chain conditional random field over the lines of a text.

Each line is labelled good or bad. Its features are rates of character classes and of
repeated words in it and in the lines before and after; a transition score links
neighbouring labels. Forward-backward gives each line's probability of being good, and
their mean weighted by line length, put through a logistic curve, is the document's score.

Weights are learned on the driver from at most ``SAMPLE`` labelled documents of at most
``SAMPLE_LINES`` lines, half of each label where there are enough, chosen by a hash of
their ids; every line takes its document's label. The logistic curve is fitted to the
label shares of all training labels. Scoring reads every document whole, in tasks.

``labels``, ``lang``, ``source`` and ``doc_id`` are no inputs of a score. Defined cases: a
null or empty text, or one of blanks, has score 0; repeated rows are scored each for
itself; repeated labels of one document count once, the smaller one; without training
labels of both kinds every text with words has the share of label 1 as its score (1 if
there is none); other columns pass through ``keep_good``; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.llm.text import BLANKS, small_batches, split_words, text_pieces

SAMPLE = 3000
SAMPLE_LINES = 400
THRESHOLD = 0.3
STEPS = 150
RATE = 0.2
PENALTY = 1e-3
_PIECE = 1 << 22

_CLASSES = {
    "upper": bytes(range(65, 91)),
    "symbols": b"#*$%&<>^~@=_{}[]\\",
    "exclaims": b"!?",
    "bars": b"|",
    "digits": b"0123456789",
    "stops": b".,;:",
}
_TABLES = []
for _chars in _CLASSES.values():
    _table = np.zeros(256, np.uint8)
    _table[list(_chars)] = 1
    _TABLES.append(_table)
N_LINE = len(_CLASSES) + 4
N_FEATURES = 3 * N_LINE + 1


class Model(NamedTuple):
    weights: np.ndarray  # of a good line's features
    change: np.ndarray  # 2 x 2 scores of neighbouring labels
    slope: float
    offset: float


def line_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every line with words of a piece: its features, length in bytes and document."""
    words = split_words(data, bounds, BLANKS)
    begin = np.unique(np.concatenate([[0], np.flatnonzero(data == 10) + 1, bounds[1:-1]]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    lo, hi = np.searchsorted(words.starts, begin), np.searchsorted(words.starts, end)
    some = hi > lo
    begin, lo, hi = begin[some], lo[some], hi[some]
    if not len(begin):
        return np.zeros((0, N_FEATURES)), np.zeros(0), np.zeros(0, np.int64)
    doc = np.searchsorted(bounds, begin, "right") - 1
    counts = hi - lo
    lengths = np.add.reduceat(words.ends - words.starts, lo).astype(float)
    own = np.empty((len(begin), N_LINE))
    for i, table in enumerate(_TABLES):
        own[:, i] = np.add.reduceat(table[data], begin, dtype=np.int32)
    upper = own[:, 0] / lengths
    own[:, : len(_TABLES)] = np.minimum(own[:, : len(_TABLES)] / counts[:, None], 1)
    hashes = words.hashes()
    again = np.zeros(len(hashes))
    again[1:] = hashes[1:] == hashes[:-1]
    again[lo] = 0
    own[:, -4] = np.add.reduceat(again, lo) / counts
    own[:, -3] = np.minimum(lengths / counts, 30) / 10
    own[:, -2] = np.log1p(counts) / 5
    own[:, -1] = upper
    features = np.zeros((len(begin), N_FEATURES))
    features[:, :N_LINE] = own
    same = doc[1:] == doc[:-1]
    features[1:, N_LINE : 2 * N_LINE] = own[:-1] * same[:, None]
    features[:-1, 2 * N_LINE : 3 * N_LINE] = own[1:] * same[:, None]
    features[:, -1] = 1
    return features, lengths, doc


class _Chains:
    """Lines of many documents laid out step by step, the longest documents first."""

    def __init__(self, doc: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        sizes = np.diff(np.append(first, len(doc)))
        order = np.argsort(-sizes, kind="stable")
        self.first, self.sizes = first[order], sizes[order]
        self.steps = int(self.sizes[0])
        # How many documents have a step t, for all t.
        self.active = np.searchsorted(-self.sizes, -np.arange(1, self.steps + 1), "right")

    def marginals(self, scores: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Each line's probability of good, the expected label pairs, the log normalizer."""
        lines = len(scores)
        shift = np.maximum(scores, 0)
        emit = np.exp(np.stack([-shift, scores - shift], axis=1))
        pair = np.exp(change)
        forward, scale = np.empty((lines, 2)), np.empty(lines)
        for t in range(self.steps):
            n = self.active[t]
            at = self.first[:n] + t
            x = emit[at] if t == 0 else emit[at] * (forward[at - 1] @ pair)
            scale[at] = x.sum(axis=1)
            forward[at] = x / scale[at, None]
        backward, pairs = np.ones((lines, 2)), np.zeros((2, 2))
        for t in range(self.steps - 1, 0, -1):
            n = self.active[t]
            at = self.first[:n] + t
            x = emit[at] * backward[at] / scale[at, None]
            pairs += pair * (forward[at - 1].T @ x)
            backward[at - 1] = x @ pair.T
        good = forward[:, 1] * backward[:, 1]
        return good / (good + forward[:, 0] * backward[:, 0]), pairs, float(np.log(scale).sum() + shift.sum())


def learn(features: np.ndarray, doc: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transition scores of greatest penalized likelihood, by Adam.

    ``label`` and ``weight`` belong to the lines; a document's lines have equal ones.
    """
    chains = _Chains(doc)
    size = features.shape[1]
    x, mean, square = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    seen = np.zeros((2, 2))
    inner = doc[1:] == doc[:-1]
    np.add.at(seen, (label[:-1][inner], label[1:][inner]), 1)
    total = len(doc)
    for step in range(1, STEPS + 1):
        good, pairs, _ = chains.marginals(features @ x[:size], x[size:].reshape(2, 2))
        slope = np.concatenate([features.T @ (weight * (label - good)), (seen - pairs).ravel()])
        slope = slope / total - PENALTY * x
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        x += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return x[:size], x[size:].reshape(2, 2)


def document_means(model: Model, features: np.ndarray, lengths: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents with lines and the length-weighted mean of their lines' marginals."""
    good, _, _ = _Chains(doc).marginals(features @ model.weights, model.change)
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    return doc[first], np.add.reduceat(good * lengths, first) / np.add.reduceat(lengths, first)


def _logistic(model: Model, means: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model.slope * (means - 0.5) + model.offset, -500, 500)))


def _calibrate(means: np.ndarray, labels: np.ndarray, shares: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, each label weighted to its share."""
    weight = len(labels) * shares[labels] / np.bincount(labels, minlength=2)[labels]
    slope, offset = 4.0, 0.0
    for _ in range(50):  # Newton steps, with a small penalty that keeps the slope finite
        p = 1 / (1 + np.exp(-(slope * (means - 0.5) + offset)))
        v = np.stack([means - 0.5, np.ones_like(means)])
        down = v @ (weight * (labels - p)) - 1e-3 * np.array([slope, offset])
        curve = (v * (weight * p * (1 - p))) @ v.T + 1e-3 * np.eye(2)
        slope, offset = np.array([slope, offset]) + np.clip(np.linalg.solve(curve, down), -2, 2)
    return float(slope), float(offset)


def held_out(doc_id):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _sample_lines(most: int):
    """Quality, features and lengths of the first ``most`` lines of each text with lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, bounds in text_pieces(batch.column(1)):
                features, lengths, doc = line_features(data, bounds)
                counts = np.bincount(doc, minlength=last - first)
                for i in np.flatnonzero(counts > 0):
                    own = np.flatnonzero(doc == i)[:most]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first + i, 1),
                            pa.array([features[own].astype(np.float32).ravel()], pa.list_(pa.float32())),
                            pa.array([lengths[own].astype(np.float32)], pa.list_(pa.float32())),
                        ],
                        ["quality", "features", "lengths"],
                    )

    return run


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_lines: int = SAMPLE_LINES) -> Model:
    """Learn from the labelled documents that are not held out.

    At most 2 x ``sample`` documents reach the driver, each with the features of its
    first ``sample_lines`` lines, as Arrow columns of 4-byte numbers.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(~held_out("doc_id") & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality"))
    counts = {r[0]: r[1] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        share = counts.get(1, 0) / sum(counts.values()) if counts else 1.0
        far = 500.0 if share == 1 else -500.0
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, far)
    half = sample // 2
    rooms = {0: max(half, sample - counts[1]), 1: max(half, sample - counts[0])}
    order = (F.xxhash64("doc_id"), "doc_id")
    picked = [known.filter(F.col("quality") == q).orderBy(*order).limit(n) for q, n in rooms.items()]
    ids = picked[0].unionAll(picked[1])  # at most 2 * sample rows
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    # An id that many rows share counts once, like its label.
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    rows = rows.groupBy("doc_id").agg(F.first("quality").alias("quality"), one).select("quality", "text")
    found = rows.mapInArrow(_sample_lines(sample_lines), "quality long, features array<float>, lengths array<float>")
    found = found.toArrow().combine_chunks()
    quality = found.column("quality").to_numpy()
    if len(np.unique(quality)) < 2:
        share = counts[1] / (counts[0] + counts[1])
        return Model(np.zeros(N_FEATURES), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    features, lengths = (found.column(c).combine_chunks() for c in ("features", "lengths"))
    sizes = lengths.value_lengths().to_numpy()
    features = features.flatten().to_numpy().reshape(-1, N_FEATURES)
    lengths = lengths.flatten().to_numpy()
    ends = np.cumsum(sizes)
    spans = [slice(e - n, e) for e, n in zip(ends, sizes)]
    # Whatever order tasks end in.
    order = sorted(range(len(spans)), key=lambda i: (quality[i], lengths[spans[i]].tobytes(), features[spans[i]].tobytes()))
    features = np.concatenate([features[spans[i]] for i in order]).astype(float)
    lengths = np.concatenate([lengths[spans[i]] for i in order]).astype(float)
    quality, sizes = quality[order], sizes[order]
    doc = np.repeat(np.arange(len(order)), sizes)
    weights, change = learn(features, doc, quality[doc], np.ones(len(doc)))
    model = Model(weights, change, 1.0, 0.0)
    _, means = document_means(model, features, lengths, doc)
    shares = np.array([counts[0], counts[1]]) / (counts[0] + counts[1])
    slope, offset = _calibrate(means, quality, shares)
    return Model(weights, change, slope, offset)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Every row as ``row`` with its ``score``."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            texts = batch.column(0).field("text")
            for first, _, data, bounds in text_pieces(texts, _PIECE):
                features, lengths, doc = line_features(data, bounds)
                if len(doc):
                    which, means = document_means(model, features, lengths, doc)
                    scores[first + which] = _logistic(model, means)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["row", "score"])

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns."""
    return score(docs, fit(docs, labels)).filter(F.col("score") >= threshold).select("row.*")
