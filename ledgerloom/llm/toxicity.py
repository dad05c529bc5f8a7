"""Toxicity: a bidirectional GRU with attention pooling over word and character inputs.

A word's input is an embedding of the word (hashed) next to the mean embedding of its hashed
character 4-grams; the first 4-gram of a word is told from inner ones. Windows of WINDOW words,
half a window apart, run through a GRU in both directions; attention pools the states into a
logit. A text's logit is that of its most toxic window.

Only texts are labelled, not windows: training takes the windows of a toxic text that are the
most toxic so far as positive, and all windows of a clean text as negative. Everything is
numpy. The training sample is bounded by TRAIN_TEXTS texts of each label, each of at most
TRAIN_CHARS characters (longer ones are not drawn); scoring covers every window of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import LOWER, Block, drawn_texts, mix, restored, span_hashes, text_blocks, word_bounds

WINDOW, STEP = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
WORD_SLOTS, CHAR_SLOTS = 1 << 17, 1 << 16
TRAIN_TEXTS, TRAIN_CHARS = 800, 20_000
EPOCHS, BATCH = 8, 256
#: A word or 4-gram is learned if it is in so many training texts; one training text in SPARE
#: calibrates.
FREQUENT, SPARE = 4, 5
THRESHOLD = 0.7
#: Windows scored at a time.
CHUNK = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _words(block: Block):
    """Distinct words of a block: (index of each word, word slots, 4-gram slots, their offsets);
    and the words per piece."""
    starts, ends, per = word_bounds(block)
    of, first = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(starts):
        hashes = span_hashes(block.buf, starts, ends)
        of, distinct = pd.factorize(hashes)
        first = np.full(len(distinct), len(hashes))
        first[of[::-1]] = np.arange(len(hashes))[::-1]
        slots = (distinct % WORD_SLOTS).astype(np.int64)
    else:
        slots = np.zeros(0, np.int64)
    s, e = starts[first], ends[first]
    grams = np.maximum(e - s - 3, 1)
    offsets = np.concatenate([[0], np.cumsum(grams)])
    at = np.repeat(s - offsets[:-1], grams) + np.arange(offsets[-1])
    stop = np.repeat(e, grams)
    code = (at == np.repeat(s, grams)).astype(np.uint64) << np.uint64(40)
    for k in range(4):
        inside = at + k < stop
        code |= np.where(inside, LOWER[block.buf[np.minimum(at + k, len(block.buf) - 1)]], 0).astype(np.uint64) << np.uint64(9 * k)
    return of, slots, (mix(code) % np.uint64(CHAR_SLOTS)).astype(np.int64), offsets, per


def _frequent(of, slots, grams, offsets, per, rows) -> tuple[np.ndarray, np.ndarray]:
    """Which word slots and 4-gram slots are in at least FREQUENT texts."""
    text = np.repeat(rows, np.diff(per))
    pairs = np.unique(np.stack([text, slots[of]]), axis=1)
    words = np.bincount(pairs[1], minlength=WORD_SLOTS)
    n = np.diff(offsets)[of]
    at = np.repeat(offsets[:-1][of] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    pairs = np.unique(np.repeat(text, n).astype(np.int64) * CHAR_SLOTS + grams[at])
    chars = np.bincount(pairs % CHAR_SLOTS, minlength=CHAR_SLOTS)
    return (words >= FREQUENT).astype(np.float32), (chars >= FREQUENT).astype(np.float32)


def _windows(n: int) -> np.ndarray:
    """Starts of the overlapping windows over n words; the last one ends with the text."""
    starts = np.arange(0, max(n - WINDOW, 0) + 1, STEP)
    return np.append(starts, n - WINDOW) if n > WINDOW and starts[-1] + WINDOW < n else starts


class Model:
    """Weights, scoring and training. Gate order: reset, update, new."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN
        normal = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
        # unseen words and 4-grams stay at zero and so say nothing
        self.word = np.zeros((WORD_SLOTS, WORD_DIM), np.float32)
        self.char = np.zeros((CHAR_SLOTS, CHAR_DIM), np.float32)
        self.w = [normal(d, 3 * h) for _ in range(2)]
        self.u = [normal(h, 3 * h) for _ in range(2)]
        self.b = [np.zeros(3 * h, np.float32) for _ in range(2)]
        self.att = np.zeros(2 * h, np.float32)
        self.out = normal(2 * h, 1)[:, 0]
        self.bias = np.zeros(1, np.float32)
        self.scale = (1.0, 0.0)

    def inputs(self, slots, grams, offsets) -> np.ndarray:
        """A row per distinct word."""
        chars = self.char[grams]
        mean = np.add.reduceat(chars, offsets[:-1], axis=0) / np.diff(offsets)[:, None] if len(slots) else chars[:0]
        return np.concatenate([self.word[slots], mean.astype(np.float32)], axis=1)

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        """What each word adds to the gates of each direction; a last row for padding, which
        keeps the state as it is."""
        pad = np.zeros((1, 3 * HIDDEN), np.float32)
        pad[:, HIDDEN : 2 * HIDDEN] = 30
        return [np.concatenate([x @ self.w[k] + self.b[k], pad]) for k in range(2)]

    def forward(self, gates, index, real, keep: bool = False):
        """Logits of windows ``index`` (windows x words, rows of gates); real: not padding."""
        n, t_max = index.shape
        h2, columns = 2 * HIDDEN, np.ascontiguousarray(index.T)
        states = np.zeros((t_max, n, h2), np.float32)
        kept = []
        for k in range(2):
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(t_max) if k == 0 else range(t_max - 1, -1, -1):
                g = gates[k][columns[t]]
                rec = h @ self.u[k]
                rz = _sigmoid(g[:, :h2] + rec[:, :h2])
                r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
                new = np.tanh(g[:, h2:] + r * rec[:, h2:])
                before, h = h, new + z * (h - new)
                states[t, :, k * HIDDEN : (k + 1) * HIDDEN] = h
                if keep:
                    kept.append((k, t, before, r, z, new, rec[:, h2:]))
        weight = np.exp(np.clip(states @ self.att, -20, 20)) * real.T
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnd->nd", weight, states)
        logits = pooled @ self.out + self.bias[0]
        return (logits, states, weight, pooled, kept) if keep else logits

    def backward(self, d_logit, index, cache, n_rows):
        """Gradients of all weights but the embeddings, and by gate row and direction."""
        _, states, weight, pooled, kept = cache
        grads = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * self.out
        inner = np.einsum("nd,tnd->tn", d_pooled, states)
        d_score = weight * (inner - (weight * inner).sum(axis=0))
        grads["att"] = np.einsum("tn,tnd->d", d_score, states)
        d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.att
        d_gate = [np.zeros((n_rows, 3 * HIDDEN), np.float32) for _ in range(2)]
        d_u = [np.zeros_like(u) for u in self.u]
        d_h, last = None, None
        flat = [[], []]
        for k, t, before, r, z, new, rec in reversed(kept):
            if k != last:
                d_h, last = np.zeros_like(before), k
            d = d_h + d_states[t, :, k * HIDDEN : (k + 1) * HIDDEN]
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * rec * r * (1 - r)
            d_rec = np.concatenate([d_r, d_z, d_new * r], axis=1)
            d_u[k] += before.T @ d_rec
            d_h = d * z + d_rec @ self.u[k].T
            flat[k].append((t, np.concatenate([d_r, d_z, d_new], axis=1)))
        for k in range(2):
            rows = np.concatenate([index[:, t] for t, _ in flat[k]])
            values = np.concatenate([v for _, v in flat[k]])
            for c in range(3 * HIDDEN):
                d_gate[k][:, c] = np.bincount(rows, values[:, c], n_rows)
        grads["u"] = d_u
        return grads, d_gate

    def train(self, texts: list[str], labels: np.ndarray, prior: float | None = None, seed: int = 11) -> None:
        """``prior``: the share of label 1 among all labelled texts, if the sample's differs."""
        rng = np.random.default_rng(seed)
        blocks = []
        for block in text_blocks(pa.array(texts, pa.string()), 1 << 40):
            blocks.append((block, _words(block)))
        (block, (of, slots, grams, offsets, per)), pad = blocks[0], len(blocks[0][1][1])
        index, real, owner = _index(of, per, pad)
        if not len(index):
            return
        owner = block.rows[owner]
        positive = labels[owner] == 1
        spare = np.arange(len(labels)) % SPARE == 0  # kept for the calibration
        keeps_word, keeps_char = _frequent(of, slots, grams, offsets, per, block.rows)
        share = np.bincount(owner, minlength=len(labels))
        target = positive.astype(np.float32)
        weight = np.where(positive, 1.0 / np.sqrt(share[owner]), 1.0).astype(np.float32)
        moments: dict[str, list[np.ndarray]] = {}
        seen_word, seen_char = np.zeros(WORD_SLOTS, np.float32), np.zeros(CHAR_SLOTS, np.float32)
        step = 0
        for epoch in range(EPOCHS):
            active = np.flatnonzero(~spare[owner])
            if epoch:
                x = self.inputs(slots, grams, offsets)
                logits = self._logits(self.gates(x), index, real)
                best = np.full(len(labels), -np.inf, np.float32)
                np.maximum.at(best, owner, logits)
                # of a toxic text, the windows about as toxic as its most toxic one
                active = np.flatnonzero(~spare[owner] & (~positive | (logits >= best[owner] - 1.0)))
                weight = np.ones(len(index), np.float32)
                # clean windows that are already told apart count little
                easy = ~positive & (logits < -4)
                active = active[~easy[active] | (rng.random(len(active)) < 0.25)]
            balance = weight[active]
            total_pos = balance[target[active] == 1].sum()
            total_neg = balance[target[active] == 0].sum()
            gain = float(np.clip(total_neg / max(total_pos, 1e-6), 1, 20)) ** 0.5
            order = rng.permutation(active)
            for lo in range(0, len(order), BATCH):
                rows = order[lo : lo + BATCH]
                step += 1
                words, local = np.unique(np.append(index[rows].ravel(), pad), return_inverse=True)
                words = words[:-1]  # pad is the largest
                local = local[:-1].reshape(len(rows), -1)
                n_gram = np.diff(offsets)[words]
                starts = np.concatenate([[0], np.cumsum(n_gram)])
                gram_at = np.repeat(offsets[words] - starts[:-1], n_gram) + np.arange(starts[-1])
                some, chars = slots[words], grams[gram_at]
                x = self.inputs(some, chars, starts)
                cache = self.forward(self.gates(x), local, real[rows], keep=True)
                w = weight[rows] * np.where(target[rows] == 1, gain, 1)
                d_logit = ((_sigmoid(cache[0]) - target[rows]) * w / len(rows)).astype(np.float32)
                grads, d_gate = self.backward(d_logit, local, cache, len(words) + 1)
                d_gate = [g[:-1] for g in d_gate]
                grads["w"] = [x.T @ g for g in d_gate]
                grads["b"] = [g.sum(axis=0) for g in d_gate]
                d_x = sum(g @ w.T for g, w in zip(d_gate, self.w, strict=True))
                self._adam(grads, moments, step)
                self._adagrad(self.word, seen_word, some, d_x[:, :WORD_DIM] * keeps_word[some][:, None])
                per_gram = np.repeat(d_x[:, WORD_DIM:] / n_gram[:, None], n_gram, axis=0)
                self._adagrad(self.char, seen_char, chars, per_gram * keeps_char[chars][:, None])
        x = self.inputs(slots, grams, offsets)
        best = np.full(len(labels), -np.inf, np.float32)
        np.maximum.at(best, owner, self._logits(self.gates(x), index, real))
        self._calibrate(best[spare], labels[spare])
        if prior is not None and 0 < prior < 1 and 0 < (drawn := labels.mean()) < 1:
            a, b = self.scale
            self.scale = a, b + float(np.log(prior / (1 - prior)) - np.log(drawn / (1 - drawn)))

    def _adam(self, grads, moments, step, rate=0.01):
        for name, grad in grads.items():
            for k, g in enumerate(grad if isinstance(grad, list) else [grad]):
                value = getattr(self, name)
                value = value[k] if isinstance(grad, list) else value
                m = moments.setdefault(f"{name}{k}", [np.zeros_like(value), np.zeros_like(value)])
                m[0] += 0.1 * (g - m[0])
                m[1] += 0.001 * (g * g - m[1])
                value -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)

    @staticmethod
    def _adagrad(table, seen, slots, grad, rate=0.2):
        rows, of = np.unique(slots, return_inverse=True)
        summed = np.stack([np.bincount(of, grad[:, c], len(rows)) for c in range(grad.shape[1])], axis=1)
        seen[rows] += (summed * summed).mean(axis=1)
        table[rows] -= rate * summed / (np.sqrt(seen[rows]) + 1e-6)[:, None]

    def _calibrate(self, best: np.ndarray, labels: np.ndarray) -> None:
        """Scale and shift of the logits by logistic regression over texts not trained on, drawn
        towards leaving them as they are, so that a separable or tiny set does no harm."""
        ok = np.isfinite(best)
        x, y = best[ok].astype(float), labels[ok].astype(float)
        a, b = 1.0, 0.0
        for _ in range(200):
            p = _sigmoid(a * x + b)
            g = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + b])
            s = p * (1 - p)
            hess = np.array([[(s * x * x).sum() + 1, (s * x).sum()], [(s * x).sum(), s.sum() + 1]])
            move = np.clip(np.linalg.solve(hess, g), -0.5, 0.5)
            a, b = a - move[0], b - move[1]
            if np.abs(move).max() < 1e-6:
                break
        self.scale = (float(max(a, 0.05)), float(b))

    def _logits(self, gates, index, real) -> np.ndarray:
        parts = [self.forward(gates, index[i : i + CHUNK], real[i : i + CHUNK]) for i in range(0, len(index), CHUNK)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def score(self, column: pa.Array) -> np.ndarray:
        """Scores 0..1 of the texts; 0 for texts without a word."""
        best = np.full(len(column), -np.inf, np.float32)
        for block in text_blocks(column, overlap=WINDOW - 1):
            of, slots, grams, offsets, per = _words(block)
            index, real, piece = _index(of, per, len(slots))
            if len(index):
                gates = self.gates(self.inputs(slots, grams, offsets))
                np.maximum.at(best, block.rows[piece], self._logits(gates, index, real))
        a, b = self.scale
        return np.where(np.isfinite(best), _sigmoid(a * np.where(np.isfinite(best), best, 0).astype(float) + b), 0.0)


def _index(of: np.ndarray, per: np.ndarray, pad: int):
    """(windows x WINDOW words, which are no padding, each window's piece)."""
    counts = np.diff(per)
    starts = [_windows(int(n)) + a for a, n in zip(per[:-1], counts, strict=True) if n]
    piece = np.repeat(np.flatnonzero(counts), [len(s) for s in starts])
    if not len(piece):
        return np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.float32), piece
    at = np.concatenate(starts)[:, None] + np.arange(WINDOW)
    real = at < per[piece + 1][:, None]
    padded = np.append(of, pad)
    return padded[np.where(real, at, len(of))], real.astype(np.float32), piece


def held_out(fold: int = 1, folds: int = 3):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold


def fit(docs: DataFrame, labels: DataFrame, texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> Model | float:
    """A model from labelled texts outside the held-out fold, drawn by a hash of doc_id. With
    one label only, a constant: that label (0 without any). A doc_id with several labels counts
    as toxic if one says so, one with several texts gives one of them; null ids, labels and texts
    are left out."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    rows = drawn_texts(docs, known.withColumnRenamed("toxic", "label"), (0, 1), texts, chars)
    rows = [{"toxic": r["label"], "text": r["text"]} for r in rows]
    if len({r["toxic"] for r in rows}) < 2:
        return float(rows[0]["toxic"]) if rows else 0.0
    prior = known.agg(F.avg("toxic")).first()[0]
    model = Model()
    model.train([r["text"] for r in rows], np.array([r["toxic"] for r in rows]), prior)
    return model


def _sent(docs: DataFrame, model: Model | float):
    """The model to all executors: about 6 MB."""
    return docs.sparkSession.sparkContext.broadcast({"constant": model} if isinstance(model, float) else vars(model))


def _scores(sent: dict, text: pa.Array) -> np.ndarray:
    return np.full(len(text), sent["constant"]) if "constant" in sent else restored(Model, sent).score(text)


def score(docs: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs(doc_id, text, ...)``.

    Every window of the whole text is scored. Null, empty and wordless texts score 0 (the
    constant, if the model is one). A null doc_id is not held out. Repeated rows give repeated
    rows, other columns are ignored, no row gives no row.
    """
    sent = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = _scores(sent.value, b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(scores.astype(float)), pa.array((scores >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold."""
    sent = _sent(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = _scores(sent.value, b.column(b.schema.get_field_index("text")))
            yield b.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
