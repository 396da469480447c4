"""Quality classifier: a generalised additive model with pairwise interactions.

Every text is described by a few ratios over its whole length. Cyclic boosting visits the features
in turn, many times, each time adding a small step of a shallow tree over that feature's bins to the
feature's lookup table; then the pairs of features that explain most of what is left get tables of
their own in the same way. A score is the logistic of the sum of one entry from each table, so
scoring is a few vectorised additions for a batch of texts.

The tables are learnt from the first ``TRAINING_ROWS`` labels in the order of a hash of their ids (a
stated bound; all of them, if there are fewer): a text of each, then, while there is room, further
texts of ids that have several. Every text is scored, whole.

Defined cases: a null text is scored as an empty one; rows with a null id are scored and count as
held out, as do labels of null or other than 0 and 1 for training; repeated rows are each scored,
but learnt from once, like repeated labels; other columns are not read. Without labels of both kinds the score
is the smoothed share of label 1. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import picked, values
from tidemark.session import materialize

FEATURES = (
    "log_words", "word_length", "capitals", "symbols", "shouts", "digits", "bars", "distinct_words", "repeated_words",
    "repeated_lines", "compressed", "stops", "short_words", "beyond_ascii", "longest_word", "words_per_line",
)
TRAINING_ROWS = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.1, 1.0
THRESHOLD = 0.3
FOLDS = 5
#: Bytes compressed at a time, so that a long text needs no second copy.
BLOCK = 1 << 20


def _class(members: bytes) -> np.ndarray:
    table = np.zeros(256)
    table[list(members)] = 1
    return table


UPPER, LOWER = _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))
CLASSES = np.stack([
    UPPER, UPPER + LOWER, _class(b"#*$%&|<>@^~_=+\\{}[]"), _class(b"!?"), _class(b"0123456789"), _class(b"|"),
    _class(b".,;:"), _class(bytes(range(0xC0, 256))),
]).T


def features(text: str | None) -> list[float]:
    """One number for each of ``FEATURES``; ratios are 0 for an empty text."""
    data = (text or "").encode()
    words = data.split()
    n = max(1, len(words))
    upper, letters, symbols, shouts, digits, bars, stops, beyond = np.bincount(
        np.frombuffer(data, np.uint8), minlength=256
    ) @ CLASSES
    chars = max(1.0, float(sum(map(len, words))))
    lines = [line for line in data.split(b"\n") if line.strip()]
    squeezed, squeeze = 0, zlib.compressobj(1)
    for at in range(0, len(data), BLOCK):
        squeezed += len(squeeze.compress(data[at : at + BLOCK]))
    squeezed += len(squeeze.flush())
    repeats = sum(map(bytes.__eq__, words[1:], words))
    return [
        np.log1p(len(words)), chars / n, upper / max(1.0, letters), symbols / n, shouts / n, digits / chars, bars / n,
        len(set(words)) / n**0.8, repeats / n, 1 - len(set(lines)) / max(1, len(lines)), squeezed / max(1, len(data)),
        stops / n, sum(len(w) <= 3 for w in words) / n, beyond / chars, np.log1p(max(map(len, words), default=0)),
        np.log1p(len(words) / max(1, len(lines))),
    ]


def _shallow(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The step of a tree of up to three leaves over ordered bins with gradient and curvature sums."""

    def split(a: int, b: int):
        left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
        if not len(left_g):
            return 0.0, None
        all_g, all_h = g[a:b].sum(), h[a:b].sum()
        gain = (
            left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
        )
        at = int(np.argmax(gain))
        return float(gain[at]), a + at + 1

    edges = [0, len(g)]
    for _ in range(2):
        gain, at = max((split(a, b) for a, b in zip(edges, edges[1:])), key=lambda x: x[0])
        if at is None or gain <= 0:
            break
        edges = sorted([*edges, at])
    out = np.empty(len(g))
    for a, b in zip(edges, edges[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _shallow_pair(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The step of a tree that cuts one axis, then each side along the other; and what it gains."""
    best, step = -1.0, np.zeros_like(g)
    for swap in (False, True):
        gg, hh = (g.T, h.T) if swap else (g, h)
        left = np.cumsum(gg, 0)[:-1], np.cumsum(hh, 0)[:-1]
        for cut in range(len(gg) - 1):
            sides, gain, out = ((left[0][cut], left[1][cut]), (gg.sum(0) - left[0][cut], hh.sum(0) - left[1][cut])), 0.0, np.empty_like(gg)
            for rows, (a, b) in zip((slice(0, cut + 1), slice(cut + 1, None)), sides):
                ca, cb = np.cumsum(a), np.cumsum(b)
                gains = ca**2 / (cb + RIDGE) + (ca[-1] - ca) ** 2 / (cb[-1] - cb + RIDGE)
                at = int(np.argmax(gains))
                gain += gains[at]
                out[rows, : at + 1] = ca[at] / (cb[at] + RIDGE)
                out[rows, at + 1 :] = (ca[-1] - ca[at]) / (cb[-1] - cb[at] + RIDGE)
            if gain > best:
                best, step = gain, out.T if swap else out
    return step, best - g.sum() ** 2 / (h.sum() + RIDGE)


class Model:
    """Bin edges, a table for each feature and for each of a few pairs, and a constant."""

    def __init__(self, constant: float, edges: list[np.ndarray], tables: list[np.ndarray], pairs: dict):
        self.constant, self.edges, self.tables, self.pairs = constant, edges, tables, pairs

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.constant)
        if self.tables:
            bins = self.bins(x)
            for f, table in enumerate(self.tables):
                total += table[bins[:, f]]
            coarse = bins * PAIR_BINS // (BINS + 1)
            for (a, b), table in self.pairs.items():
                total += table[coarse[:, a], coarse[:, b]]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boosts the tables on features ``x`` and labels ``y`` (0 or 1)."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    constant = float(np.log(share / (1 - share)))
    if not 0 < y.sum() < len(y):
        return Model(constant, [], [], {})
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    tables = [np.zeros(BINS + 1) for _ in edges]
    model = Model(constant, edges, tables, {})
    bins = model.bins(x)
    total = np.full(len(x), constant)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(tables):
            g, h = slopes()
            used = len(edges[f]) + 1
            step = RATE * _shallow(np.bincount(bins[:, f], g, used), np.bincount(bins[:, f], h, used))
            table[:used] += step
            total += step[bins[:, f]]
    coarse = bins * PAIR_BINS // (BINS + 1)

    def pair_sums(a, b):
        at, (g, h) = coarse[:, a] * PAIR_BINS + coarse[:, b], slopes()
        square = (PAIR_BINS, PAIR_BINS)
        return np.bincount(at, g, PAIR_BINS**2).reshape(square), np.bincount(at, h, PAIR_BINS**2).reshape(square)

    every = [(a, b) for a in range(len(edges)) for b in range(a)]
    gains = {p: _shallow_pair(*pair_sums(*p))[1] for p in every}
    chosen = sorted(every, key=lambda p: -gains[p])[:PAIRS]
    model.pairs = {p: np.zeros((PAIR_BINS, PAIR_BINS)) for p in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            step = RATE * _shallow_pair(*pair_sums(a, b))[0]
            model.pairs[a, b] += step
            total += step[coarse[:, a], coarse[:, b]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: the checksum of the id as text is divisible by ``FOLDS``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [[float(v) for v in features(t)] for t in values(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "label", "features"]
        )


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """The model from up to ``rows`` labelled documents outside the held-out fold.

    A class cannot push the other out: the labels are limited by the hash of their ids, and a text
    of each comes before further texts of any. What the driver sees is ``rows`` rows at most.
    """
    chosen = (
        picked(labels, "doc_id", "quality").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    )
    sample = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    described = sample.select("doc_id", "label", "text").mapInArrow(_described, "doc_id long, label int, features array<double>")
    described = materialize(described.distinct(), "described")
    least = described.groupBy("doc_id", "label").agg(F.min("features").alias("least"))
    found = (
        described.join(F.broadcast(least), ["doc_id", "label"])
        .orderBy(F.col("features") != F.col("least"), F.xxhash64("doc_id", "features"), "doc_id", "label", "features")  # a rerun adds up alike
        .limit(rows).select("label", "features").toPandas()
    )
    x = np.array(found["features"].tolist(), float).reshape(len(found), len(FEATURES))
    return fit(x, found["label"].to_numpy(float))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = np.array([features(t) for t in values(batch.column("text"))], float).reshape(-1, len(FEATURES))
        kept = [batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(model.scores(x))], [*batch.schema.names, "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1; the texts pass through a task once."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(lambda b: _scored(b, shared.value), f"{schema}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text)."""
    model = learn(docs, labels, rows)
    texts = picked(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(texts, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
