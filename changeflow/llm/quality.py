"""Quality scores by positive-unlabelled learning.

Trusted positives, unlabelled web text and an estimated class prior pi; a small network is fitted by the non-negative unbiased risk

    pi * R_p(+1) + max(0, R_u(-1) - pi * R_p(-1))

with the logistic loss, in numpy on a bounded sample of rows. The prior comes from the sample: a first classifier of positives against
unlabelled rows ranks held-back rows, and pi is the smallest ratio of the shares of unlabelled and positive rows above a score. The inputs are numbers of the whole text: repetition of words, of word pairs and of lines, character classes and their neighbourhoods,
lengths. Nothing else of a row is an input.

Null texts count as empty; empty texts have all inputs 0 and get the score 0. Null ids and repeated rows are scored row by row. Without
any positive all scores are 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm.common import find_words, slices, span_hashes, text_bytes

POSITIVES, UNLABELLED = 4000, 8000  # rows of the sample at most
HIDDEN, STEPS, BATCH, RATE = 16, 800, 256, 0.01

# Classes of bytes: lower case, upper case, digit, blank, line end, sentence marks, other marks, bytes of non-ASCII letters.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[128:] = 0, 1, 2, 3, 4, 7
_CLASS[[ord(c) for c in ".,;:!?'-\"()"]] = 5
_CLASSES = 8
_SUMMARY = 13
FEATURES = _SUMMARY + _CLASSES + _CLASSES * _CLASSES


def _distinct_share(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct keys / keys, and the share of the most frequent key; zeros without keys."""
    count = np.bincount(rows, minlength=n)
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    key = (rows.astype(np.uint64) << np.uint64(44)) | (keys >> np.uint64(20))
    key.sort()
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    own = (key[edge] >> np.uint64(44)).astype(np.int64)
    times = np.diff(np.append(edge, len(key)))
    most = np.zeros(n)
    np.maximum.at(most, own, times)
    return np.bincount(own, minlength=n) / np.maximum(count, 1), most / np.maximum(count, 1)


def text_features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Inputs of the classifier for every text of a column: FEATURES numbers per row."""
    n, size = len(offsets) - 1, np.diff(offsets)
    rows = np.repeat(np.arange(n), size)
    kind = _CLASS[raw].astype(np.int64)
    share = np.bincount(rows * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES) / np.maximum(size, 1)[:, None]
    inner = rows[1:] == rows[:-1]
    pairs = np.bincount((rows[1:] * _CLASSES * _CLASSES + kind[:-1] * _CLASSES + kind[1:])[inner], minlength=n * _CLASSES * _CLASSES)
    pairs = pairs.reshape(n, _CLASSES * _CLASSES) / np.maximum(size - 1, 1)[:, None]
    s, e, doc = find_words(raw, offsets)
    words = span_hashes(raw, s, e)
    count = np.bincount(doc, minlength=n)
    distinct, most = _distinct_share(words, doc, n)
    same = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    repeats = np.bincount(doc[1:][same], minlength=n) / np.maximum(count, 1)
    two = (words[:-1] * np.uint64(3) + words[1:])[doc[1:] == doc[:-1]] if len(words) > 1 else words[:0]
    pair_distinct, pair_most = _distinct_share(two, doc[1:][doc[1:] == doc[:-1]] if len(words) > 1 else doc[:0], n)
    # lines: spans between line ends
    ends = np.flatnonzero(raw == 10)
    begins = np.union1d(offsets[:-1][size > 0], ends + 1)
    begins = begins[begins < len(raw)]
    stops = np.append(begins[1:], len(raw)) if len(begins) else begins
    line_doc = np.searchsorted(offsets, begins, "right") - 1
    lines = np.bincount(line_doc, minlength=n) if len(begins) else np.zeros(n)
    line_distinct, line_most = _distinct_share(span_hashes(raw, begins, stops), line_doc, n) if len(begins) else (np.zeros(n), np.zeros(n))
    log_count = np.log1p(count)
    summary = np.stack([
        log_count, distinct, most, distinct * log_count, repeats, pair_distinct, pair_most, np.log1p(lines), line_distinct, line_most,
        size / np.maximum(count, 1) / 10, np.minimum(line_distinct, 1) * np.log1p(lines), (count > 0).astype(float),
    ], axis=1)
    return np.concatenate([summary, share, pairs], axis=1)


@dataclass
class QualityModel:
    centre: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.centre) / self.spread, -8, 8)
        a, b, c, d = self.weights
        return 1 / (1 + np.exp(-np.clip(np.tanh(x @ a + b) @ c + d, -30, 30)[:, 0]))


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int) -> list[np.ndarray]:
    """Weights by Adam. With a prior: the non-negative unbiased risk; without: positives against unlabelled rows."""
    rng = np.random.default_rng(seed)
    w = [rng.normal(0, 1 / np.sqrt(positive.shape[1]), (positive.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)), np.zeros(1)]
    first, second = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    for step in range(1, STEPS + 1):
        p, u = positive[rng.integers(0, len(positive), BATCH)], unlabelled[rng.integers(0, len(unlabelled), BATCH)]
        x = np.concatenate([p, u])
        hidden = np.tanh(x @ w[0] + w[1])
        f = (hidden @ w[2] + w[3])[:, 0]
        sig = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        g = np.zeros(2 * BATCH)
        if prior is None:
            g[:BATCH], g[BATCH:] = -(1 - sig[:BATCH]) / BATCH, sig[BATCH:] / BATCH
        else:
            minus = np.logaddexp(0, f)  # loss of the label -1
            negative_risk = minus[BATCH:].mean() - prior * minus[:BATCH].mean()
            if negative_risk >= 0:
                g[:BATCH] = prior * (-(1 - sig[:BATCH]) - sig[:BATCH]) / BATCH
                g[BATCH:] = sig[BATCH:] / BATCH
            else:  # step back from the overfitted negative part
                g[:BATCH] = prior * sig[:BATCH] / BATCH
                g[BATCH:] = -sig[BATCH:] / BATCH
        dh = (g[:, None] @ w[2].T) * (1 - hidden**2)
        grads = [x.T @ dh + 1e-4 * w[0], dh.sum(0), hidden.T @ g[:, None] + 1e-4 * w[2], np.array([g.sum()])]
        speed = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, d in enumerate(grads):
            first[k] += 0.1 * (d - first[k])
            second[k] += 0.001 * (d * d - second[k])
            w[k] = w[k] - speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among unlabelled rows, from their scores by a classifier that has seen neither."""
    best = 1.0
    for cut in np.quantile(positive, np.linspace(0.0, 0.5, 51)):  # half of the positives at least, so that the shares are well measured
        p, u = (positive >= cut).mean(), (unlabelled >= cut).mean()
        best = min(best, u / p)
    return float(np.clip(best, 0.02, 0.98))


def fit_quality(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, seed: int = 11) -> QualityModel | None:
    """Fit the classifier to feature rows; None without rows."""
    if not len(positive) or not len(unlabelled):
        return None
    both = np.concatenate([positive, unlabelled])
    centre, spread = both.mean(0), both.std(0) + 1e-3
    p, u = (np.clip((x - centre) / spread, -8, 8) for x in (positive, unlabelled))
    if prior is None:
        half = (len(p) + 1) // 2, (len(u) + 1) // 2
        draft = QualityModel(centre, spread, _fit(p[: half[0]], u[: half[1]], None, seed), 0.5)
        prior = estimate_prior(draft.scores(positive[half[0] :] if len(p) > 1 else positive), draft.scores(unlabelled[half[1] :] if len(u) > 1 else unlabelled))
    return QualityModel(centre, spread, _fit(p, u, prior, seed), prior)


def _features(docs: DataFrame) -> np.ndarray:
    """Feature rows of a bounded set of texts, on the driver, in the order of the ids."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            f = text_features(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(f), pa.list_(pa.float64()))], names=["id", "f"])

    rows = docs.mapInArrow(compute, "id string, f array<double>").collect()
    rows.sort(key=lambda r: (r["id"], r["f"]))
    order = np.random.default_rng(5).permutation(len(rows))
    return np.array([r["f"] for r in rows], float).reshape(-1, FEATURES)[order]


def learn(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None) -> QualityModel | None:
    """Fit on rows that ``learn_from`` (a condition on the column ``id``, the id as text) allows.

    The sample takes the rows of the smallest hashes: at most ``positives`` ids labelled 1 and ``unlabelled`` ids of any row, and one text of an
    id that stands repeatedly, so both lists are of bounded size however large the tables are. Labels 0 are not used.
    """
    draw = lambda df, n, seed: df.select(F.col(id_col).cast("string").alias("id")).where(F.col("id").isNotNull() & learn_from).distinct().orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n)
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    one = lambda ids: texts.join(F.broadcast(ids), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    good, web = one(draw(labels.where(F.col(label_col) == 1), positives, 1)), one(draw(docs, unlabelled, 2))
    return fit_quality(_features(good), _features(web), prior)


def score(docs: DataFrame, model: QualityModel | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the score, which replaces a column of its name. One pass, no shuffle."""
    shared, columns = docs.sparkSession.sparkContext.broadcast(model), docs.columns  # some kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text"):
            raw, offsets = text_bytes(batch.column("__text"))
            s = np.full(batch.num_rows, 0.5)
            if shared.value is not None:
                s = np.where(np.diff(offsets) > 0, shared.value.scores(text_features(raw, offsets)), 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), pa.array(s, pa.float64())], names=[*(f"c{i}" for i in range(len(columns))), "s"])

    renamed = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    renamed = renamed.withColumn("__text", F.coalesce(F.col(f"c{columns.index(text_col)}"), F.lit("")))
    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)), "s double"])
    kept = [i for i, c in enumerate(columns) if c.lower() != score_col.lower()]
    return renamed.mapInArrow(run, schema).select(*(f"c{i}" for i in kept), "s").toDF(*(columns[i] for i in kept), score_col)
