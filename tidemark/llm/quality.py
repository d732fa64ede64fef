"""Text quality: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins and has a lookup table of log-odds;
chosen pairs of features have small two-way tables.  Tables are learned by
cyclic boosting: feature by feature, a tree of at most three leaves (four for a
pair) is fitted to the logistic gradient and added to the table at a low rate.
A score is one addition per table, done for a batch of texts at a time.

The model is fitted on a bounded sample of labelled documents; features and
scores are computed for every whole text where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import unused
from tidemark.llm.common import written

SAMPLE = 20_000
FEATURES = ["log_words", "word_length", "upper", "digits", "punctuation", "exclaims", "bars", "symbols", "high_bytes",
            "byte_entropy", "distinct_words", "distinct_pairs", "adjacent_repeats", "distinct_lines", "words_per_line",
            "stops", "commas", "lower_starts", "one_letter", "long_words"]
_SYMBOLS = np.frombuffer(b"*$%#&@~^_=<>+\\{}[]", np.uint8)


def text_features(text: bytes) -> list[float]:
    """The features of one text, in the order of ``FEATURES``; shares are of its
    bytes or words, and all but the first are 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size = len(text)
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    share = counts[counts > 0] / size
    lines = text.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, n)
    punctuation = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    same = sum(map(bytes.__eq__, words, words[1:])) / n
    return [float(np.log(n)), float(lengths.mean()), float(counts[65:91].sum() / max(1, letters)),
            float(counts[48:58].sum() / size), float(punctuation / size), float(counts[33] / n), float(counts[124] / n),
            float(counts[_SYMBOLS].sum() / n), float(counts[128:].sum() / size), float(-(share * np.log2(share)).sum()),
            len(set(words)) / n, pairs, same, len(set(lines)) / len(lines), n / len(lines), float(counts[46] / n),
            float(counts[44] / n), sum(w[:1].islower() for w in words) / n, float((lengths == 1).mean()),
            float((lengths > 12).mean())]


def feature_matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([text_features(t or b"") for t in texts], np.float64).reshape(len(texts), len(FEATURES))


@dataclass
class AdditiveModel:
    """Lookup tables over binned features.  ``edges[j]`` cuts feature j into
    ``len(edges[j]) + 1`` bins; ``coarse[j]`` does so for the pairs."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.coarse)] if self.pairs else []
        for (i, j), table in zip(self.pairs, self.pair_tables):
            total += table[bins[i], bins[j]]
        return _chance(total)


def _chance(log_odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Quantile cuts between values that occur."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _best_cut(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, int]:
    """Gain and place (bins before it go left) of the best cut of a run of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    if not len(gl):
        return 0.0, 0
    gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - g.sum() ** 2 / (h.sum() + l2)
    gain[(hl < least) | (hr < least)] = 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _three_leaves(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> np.ndarray:
    """The step of every bin: a tree of up to two cuts, each the best at its turn."""
    parts = [(0, len(g))]
    for _ in range(2):
        gain, at, k = max((*_best_cut(g[a:b], h[a:b], l2, least), k) for k, (a, b) in enumerate(parts))
        if gain <= 0:
            break
        a, b = parts[k]
        parts[k:k + 1] = [(a, a + at), (a + at, b)]
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return step


def _four_leaves(g: np.ndarray, h: np.ndarray, l2: float, least: float) -> tuple[float, np.ndarray]:
    """Gain and steps: one cut along an axis, then one along the other on each side."""
    best = (-1.0, np.zeros_like(g))
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        _, at = _best_cut(a.sum(axis=1), b.sum(axis=1), l2, 0)
        step, gain = np.zeros_like(a), 0.0
        for rows in (slice(0, at), slice(at, None)):
            ga, ha = a[rows].sum(axis=0), b[rows].sum(axis=0)
            _, cut = _best_cut(ga, ha, l2, least)
            for cols in (slice(0, cut), slice(cut, None)):
                leaf = ga[cols].sum() / (ha[cols].sum() + l2)
                gain += ga[cols].sum() * leaf
                step[rows, cols] = leaf
        if gain > best[0]:
            best = (gain, step.T if flip else step)
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, n_pairs: int = 8, bins: int = 48,
        coarse_bins: int = 10, rate: float = 0.15, l2: float = 1.0, least: float = 1.0) -> AdditiveModel:
    """Fit to features ``x`` and 0/1 labels ``y``.  With no rows the score is
    0.5 everywhere; with labels of one kind it is nearly that label."""
    n, m = x.shape
    odds = (y.sum() + 0.5) / (n - y.sum() + 0.5)
    model = AdditiveModel(float(np.log(odds)), [np.zeros(0)] * m, [np.zeros(1)] * m, [np.zeros(0)] * m, [], [])
    if not 0 < y.sum() < n:
        return model
    model.edges = [_cuts(x[:, j], bins) for j in range(m)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.coarse = [_cuts(x[:, j], coarse_bins) for j in range(m)]
    cell = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    total = np.full(n, model.base)
    for _ in range(rounds):
        for j in range(m):
            p = _chance(total)
            size = len(model.tables[j])
            step = rate * _three_leaves(np.bincount(cell[j], y - p, size), np.bincount(cell[j], p * (1 - p), size), l2, least)
            model.tables[j] += step
            total += step[cell[j]]
    small = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        at = small[i] * shape[1] + small[j]
        p = _chance(total)
        return (np.bincount(at, y - p, shape[0] * shape[1]).reshape(shape),
                np.bincount(at, p * (1 - p), shape[0] * shape[1]).reshape(shape), at)

    gains = sorted(((_four_leaves(*sums(i, j)[:2], l2, least)[0], i, j) for i, j in combinations(range(m), 2)),
                   key=lambda r: (-r[0], r[1], r[2]))
    model.pairs = [(i, j) for _, i, j in gains[:n_pairs]]
    model.pair_tables = [np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h, at = sums(i, j)
            step = rate * _four_leaves(g, h, l2, least)[1]
            model.pair_tables[k] += step
            total += step.ravel()[at]
    return model


def _arrow_features(batch: pa.RecordBatch) -> np.ndarray:
    return feature_matrix(batch.column("text").cast(pa.binary()).to_pylist())


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> AdditiveModel:
    """Fit on the ``sample`` labelled documents of lowest id hash.

    ``labels`` has an id and a 0/1 label; ids labelled both ways take no part,
    and of documents that share an id the smallest text counts.
    """
    agreed = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).cast("long").alias("doc_id"))
              .agg(F.min(label_col).cast("int").alias("label"), F.max(label_col).cast("int").alias("most"))
              .filter("label = most").select("doc_id", "label"))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = agreed.join(slim.select("doc_id").distinct(), "doc_id", "left_semi")
    picked = written(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample), "quality-sample")
    texts = (slim.join(F.broadcast(picked), "doc_id")  # at most `sample` rows of two numbers
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(list(_arrow_features(batch)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), rows], ["doc_id", "label", "x"])

    rows = texts.mapInArrow(run, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    x = np.array(rows["x"].to_pylist(), np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, rows["label"].to_numpy().astype(np.float64))


def scored(docs: DataFrame, model: AdditiveModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name``: the model's chance (0 to 1) that a text is good.

    A null text scores as an empty one.  A column of ``docs`` called ``name`` is
    replaced.
    """
    columns = [c for c in docs.columns if c.lower() != name.lower()]
    text = unused([*docs.columns, name], "text_to_score")[0]
    kept = docs.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = feature_matrix(part.column(text).cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(model.score(x))],
                                                 [*columns, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns)
    return kept.mapInArrow(run, f"{schema}, `{name}` double")


def train_fold(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The labels to learn from: ids whose CRC-32 as text is not 1 modulo 3."""
    return labels.filter(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1)
