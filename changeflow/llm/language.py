"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in windows of ``WINDOW`` bytes, from both ends, gives every byte a distribution over the languages, and the
document's probabilities are the mean over all its bytes. It is trained here, in numpy, by backpropagation through time on a bounded
sample of labelled texts; the gates and the candidate use x / (1 + |x|) as squashing function, which needs no exponentials.

Null texts and texts without a letter get ``und`` with score 0. Rows without a language are never learned from. Without any labelled row
every text is ``und``. Repeated rows and null ids are scored row by row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from changeflow.llm.common import sample_share, slices, text_bytes

UNKNOWN = "und"
WINDOW = 192  # bytes read at once when scoring
PAD = 256
HIDDEN = 8
BLOCK = 2048  # windows scored together
SAMPLE_ROWS = 1500  # labelled texts per language that are learned from, about
SAMPLE_CHARS = 96  # characters of each window of the sample
SAMPLE_WINDOWS = 2  # windows per sampled text
STEPS, BATCH, RATE = 400, 128, 0.02


@dataclass
class ByteNetwork:
    """Weights: per direction the byte table (3H x 257) and the state matrix (3H x H); the output over both directions."""

    labels: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def hidden(self) -> int:
        return self.weights["uf"].shape[1]

    def probabilities(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean distribution over the languages of every text (rows); a text without bytes gets zeros."""
        sizes = np.diff(offsets)
        pieces = -(-sizes // WINDOW)
        doc = np.repeat(np.arange(len(sizes)), pieces)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = offsets[:-1][doc] + number * WINDOW
        length = np.minimum(WINDOW, offsets[1:][doc] - start)
        total = np.zeros((len(sizes), len(self.labels)))
        padded = np.concatenate([raw, np.zeros(WINDOW, np.uint8)])
        order = np.argsort(-length, kind="stable")  # full windows first, so that few blocks hold padding
        for a in range(0, len(order), BLOCK):
            part = order[a : a + BLOCK]
            steps = int(length[part].max())
            where = np.arange(steps)[:, None]
            ids = padded[start[part][None, :] + where].astype(np.intp)
            inside = where < length[part][None, :]
            ids[~inside] = PAD
            sums = self.position_probabilities(ids, inside)
            for k in range(len(self.labels)):
                total[:, k] += np.bincount(doc[part], weights=sums[k], minlength=len(sizes))
        return total / np.maximum(sizes, 1)[:, None]

    def position_probabilities(self, ids: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Sum over the positions of each window (columns) of the distribution at every position."""
        w, full = self.weights, bool(inside.all())
        steps, n = ids.shape
        ahead = np.empty((steps, len(self.labels), n), np.float32)
        live = None if full else inside
        for t, h in _run(w["ef"], w["uf"], ids, range(steps), live):
            np.matmul(w["vf"], h, out=ahead[t])
        sums = np.zeros((len(self.labels), n), np.float32)
        for t, h in _run(w["eb"], w["ub"], ids, range(steps - 1, -1, -1), live):
            p = ahead[t]
            p += w["vb"] @ h
            p += w["c"]
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            if not full:
                p *= inside[t]
            sums += p
        return sums


def _squash(x: np.ndarray, room: np.ndarray) -> None:
    """x / (1 + |x|) in place."""
    np.abs(x, out=room)
    room += 1
    x /= room


def _run(table: np.ndarray, state: np.ndarray, ids: np.ndarray, steps, live: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """The hidden state (H x n) at every step; the array is reused. Positions that are not ``live`` leave it at zero, so padding says nothing."""
    size, n = state.shape[1], ids.shape[1]
    h, x, g = np.zeros((size, n), np.float32), np.empty((3 * size, n), np.float32), np.empty((3 * size, n), np.float32)
    room, z, r = np.empty((2 * size, n), np.float32), x[:size], x[size : 2 * size]
    gates, new = x[: 2 * size], x[2 * size :]
    for t in steps:
        np.take(table, ids[t], axis=1, out=x, mode="clip")
        np.matmul(state, h, out=g)
        gates += g[: 2 * size]
        _squash(gates, room)
        gates *= 0.5
        gates += 0.5
        g[2 * size :] *= r
        new += g[2 * size :]
        _squash(new, room[:size])
        h -= new
        h *= z
        h += new
        if live is not None:
            h *= live[t]
        yield t, h


def train(texts: list[bytes], targets: np.ndarray, labels: list[str], seed: int = 7, hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, window: int = 64) -> ByteNetwork:
    """Fit the network on short byte strings with one label each; every position is trained to give the label."""
    rng = np.random.default_rng(seed)
    kinds = len(labels)
    draw = lambda *shape, by: rng.normal(0, by, shape).astype(np.float32)
    w = {
        "ef": draw(3 * hidden, 257, by=0.3), "eb": draw(3 * hidden, 257, by=0.3), "uf": draw(3 * hidden, hidden, by=0.3), "ub": draw(3 * hidden, hidden, by=0.3),
        "vf": draw(kinds, hidden, by=0.5), "vb": draw(kinds, hidden, by=0.5), "c": np.zeros((kinds, 1), np.float32),
    }
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    usable = [i for i, t in enumerate(texts) if t]
    by_label = [np.array([i for i in usable if targets[i] == k]) for k in range(kinds)]
    present = [k for k in range(kinds) if len(by_label[k])]
    for step in range(1, steps + 1):
        wanted = rng.choice(present, batch)
        chosen = [int(rng.choice(by_label[k])) for k in wanted]
        ids = np.full((window, batch), PAD, np.intp)
        for j, i in enumerate(chosen):
            t = texts[i]
            at = int(rng.integers(0, max(1, len(t) - window + 1)))
            piece = np.frombuffer(t[at : at + window], np.uint8)
            ids[: len(piece), j] = piece
        grads = _gradients(w, ids, np.asarray(wanted))
        speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        for k, g in grads.items():
            g = g * min(1.0, 1 / (norm + 1e-9))
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            w[k] -= (speed * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return ByteNetwork(labels, w)


def _forward(table, state, ids, steps):
    size, n = state.shape[1], ids.shape[1]
    h, kept = np.zeros((size, n), np.float32), {}
    for t in steps:
        x, g = table[:, ids[t]], state @ h
        gates = x[: 2 * size] + g[: 2 * size]
        gates = 0.5 + 0.5 * gates / (1 + np.abs(gates))
        z, r = gates[:size], gates[size:]
        new = x[2 * size :] + r * g[2 * size :]
        new = new / (1 + np.abs(new))
        after = (new + z * (h - new)) * (ids[t] != PAD)
        kept[t] = (h, z, r, new, g[2 * size :], after)
        h = after
    return kept


def _backward(table, state, ids, kept, out_grads, steps):
    """Gradients of the byte table and the state matrix, through time."""
    size = state.shape[1]
    d_table, d_state, carry = np.zeros((257, 3 * size), np.float32), np.zeros_like(state), 0
    for t in steps:
        h, z, r, new, un, _ = kept[t]
        dh = (out_grads[t] + carry) * (ids[t] != PAD)
        d_new = dh * (1 - z) * (1 - np.abs(new)) ** 2
        d_z = dh * (h - new) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_r = d_new * un * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_g = np.concatenate([d_z, d_r, d_new * r])
        d_state += d_g @ h.T
        carry = dh * z + state.T @ d_g
        np.add.at(d_table, ids[t], np.concatenate([d_z, d_r, d_new]).T)
    return d_table.T, d_state


def _gradients(w: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy over all positions inside the texts."""
    steps = ids.shape[0]
    order, reverse = range(steps), range(steps - 1, -1, -1)
    ahead, back = _forward(w["ef"], w["uf"], ids, order), _forward(w["eb"], w["ub"], ids, reverse)
    inside = ids != PAD
    n = max(1, int(inside.sum()))
    out_f, out_b, g = {}, {}, {k: np.zeros_like(w[k]) for k in ("vf", "vb", "c")}
    for t in order:
        hf, hb = ahead[t][-1], back[t][-1]
        p = w["vf"] @ hf + w["vb"] @ hb + w["c"]
        p = np.exp(p - p.max(axis=0))
        p /= p.sum(axis=0)
        p[targets, np.arange(len(targets))] -= 1
        p *= inside[t] / n
        p = p.astype(np.float32)
        g["vf"] += p @ hf.T
        g["vb"] += p @ hb.T
        g["c"] += p.sum(axis=1, keepdims=True)
        out_f[t], out_b[t] = w["vf"].T @ p, w["vb"].T @ p
    g["ef"], g["uf"] = _backward(w["ef"], w["uf"], ids, ahead, out_f, reverse)
    g["eb"], g["ub"] = _backward(w["eb"], w["ub"], ids, back, out_b, order)
    return g


def learn(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", rows: int = SAMPLE_ROWS, seed: int = 7) -> ByteNetwork | None:
    """Train on about ``rows`` texts per language out of those that ``learn_from`` marks; None if there are none.

    The sample is drawn by a hash of the id with one rate per language, so no rows are shuffled; what comes to the driver one count per
    language and at most 3/2 x rows x languages x SAMPLE_WINDOWS windows of SAMPLE_CHARS characters.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label")).where(learn_from & F.col("label").isNotNull())
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    labels = sorted(counts)
    rates = F.create_map(*[x for k in labels for x in (F.lit(k), F.lit(min(1.0, rows / counts[k])))])
    share = sample_share(F.col("id").cast("string"), seed=seed)
    room = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    windows = [F.substring("text", (1 + F.floor(room * sample_share(F.col("id").cast("string"), seed=seed + 1 + k))).cast("int"), F.lit(SAMPLE_CHARS)) for k in range(SAMPLE_WINDOWS)]
    drawn = known.where((share < rates[F.col("label")]) & F.col("text").rlike(r"\p{L}")).select("label", F.explode(F.array(*windows)).alias("piece"))
    got = drawn.orderBy(F.xxhash64("piece"), "piece", "label").limit(rows * len(labels) * SAMPLE_WINDOWS * 3 // 2).collect()
    got.sort(key=lambda r: (r["label"], r["piece"]))
    if not got:
        return None
    place = {k: i for i, k in enumerate(labels)}
    return train([r["piece"].encode() for r in got], np.array([place[r["label"]] for r in got]), labels, seed=seed)


def identify(docs: DataFrame, model: ByteNetwork | None, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language and its pooled probability, which replace columns of their names. One pass, no shuffle."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(model)  # a few hundred kB, whatever the corpus
    columns = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in slices(batches, "__text", 4 << 20):
            letters = batch.column("__letters").to_numpy(zero_copy_only=False)
            names, best = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            if net is not None and letters.any():
                p = net.probabilities(*text_bytes(batch.column("__text")))
                top = p.argmax(axis=1)
                best = np.where(letters, np.clip(p[np.arange(len(p)), top], 0, 1), 0.0)
                names = [net.labels[k] if ok else UNKNOWN for k, ok in zip(top, letters, strict=True)]
            keep = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(names, pa.string()), pa.array(best, pa.float64())], names=[*(f"c{i}" for i in range(len(columns))), "p", "s"])

    renamed = docs.toDF(*(f"c{i}" for i in range(len(columns))))
    text = F.col(f"c{columns.index(text_col)}")
    renamed = renamed.withColumn("__text", F.coalesce(text, F.lit(""))).withColumn("__letters", F.coalesce(text.rlike(r"\p{L}"), F.lit(False)))
    schema = ", ".join([*(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)), "p string", "s double"])
    kept = [i for i, c in enumerate(columns) if c.lower() not in (pred_col.lower(), score_col.lower())]
    return renamed.mapInArrow(score, schema).select(*(f"c{i}" for i in kept), "p", "s").toDF(*(columns[i] for i in kept), pred_col, score_col)
