"""Quality: ordinal cumulative-link regression on graded ratings over hashed text.

P(grade <= k) = sigmoid(threshold_k - score) with one score for all grades and thresholds in
order. The score sums hashed weights over a text's words (as means): of the word, of its last
three bytes and of its shape. The expected grade and the tail probabilities follow.

The classifier is fitted in numpy on at most TRAIN_TEXTS rated texts of each grade (of at most
TRAIN_CHARS characters; longer ones are not drawn); scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Block, drawn_texts, mix, restored, span_hashes, text_blocks, word_bounds

SLOTS = 1 << 18
TRAIN_TEXTS, TRAIN_CHARS = 500, 20_000
EPOCHS, RATE, DECAY = 60, 0.5, 1e-4
#: A feature is learned if it is in so many training texts.
FREQUENT = 3
KINDS = 3

#: Classes of bytes for a word's shape: small letters, capitals, digits, beyond ASCII, and each
#: other byte itself.
_SHAPE = np.arange(256, dtype=np.uint64)
for _k, _bytes in enumerate((range(97, 123), range(65, 91), range(48, 58), range(128, 256))):
    _SHAPE[list(_bytes)] = 256 + _k


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(slots of KINDS features for each word, words before each piece)."""
    starts, ends, per = word_bounds(block)
    if not len(starts):
        return np.zeros((0, KINDS), np.int64), per
    word = span_hashes(block.buf, starts, ends)
    tail = span_hashes(block.buf, np.maximum(starts, ends - 3), ends) ^ np.uint64(0x5555)
    cls, last = _SHAPE[block.buf], ends - 1
    shape = np.full(len(starts), 0xAAAA, np.uint64)
    for at in (starts, np.minimum(starts + 1, last), np.maximum(last - 1, starts), last):
        shape = shape * np.uint64(1031) + cls[at]
    shape = shape * np.uint64(7) + np.minimum(ends - starts, 3).astype(np.uint64)
    return np.stack([(mix(x) % np.uint64(SLOTS)).astype(np.int64) for x in (word, tail, shape)], axis=1), per


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """Weights by slot and ordered thresholds, one fewer than grades."""

    def __init__(self, grades: int):
        self.weights = np.zeros(SLOTS, np.float32)
        self.first, self.steps = 0.0, np.zeros(max(grades - 2, 0))

    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate([[0.0], np.cumsum(np.exp(self.steps))])

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return _sigmoid(score[:, None] - self.thresholds())

    def train(self, texts: list[str], grades: np.ndarray) -> None:
        (block,) = text_blocks(pa.array(texts, pa.string()), 1 << 40)
        slots, per = features(block)
        words = np.diff(per)
        text = np.repeat(np.repeat(np.arange(len(texts), dtype=np.int32), words), KINDS)
        flat = slots.ravel()
        pairs = np.unique(text.astype(np.int64) * SLOTS + flat)
        keep = np.bincount(pairs % SLOTS, minlength=SLOTS) >= FREQUENT
        used, flat = np.unique(flat, return_inverse=True)
        flat = flat.astype(np.int32)
        value = 1.0 / np.maximum(words, 1)[text]
        top = len(self.thresholds())
        # the same total weight for each grade
        share = np.bincount(grades, minlength=top + 1)
        weight = (len(grades) / (np.count_nonzero(share) * np.maximum(share, 1)))[grades]
        w, m, v = np.zeros(len(used)), np.zeros(len(used) + top), np.zeros(len(used) + top)
        spread = np.quantile(grades, 0.5)
        self.first = -float(spread > 0)
        gain = 20.0  # means of hashed words are small numbers
        for step in range(1, EPOCHS + 1):
            score = np.bincount(text, w[flat] * value, len(texts)) * gain
            theta = self.thresholds()
            upper = np.where(grades < top, _sigmoid(np.append(theta, 0)[np.minimum(grades, top)] - score), 1.0)
            lower = np.where(grades > 0, _sigmoid(theta[np.maximum(grades - 1, 0)] - score), 0.0)
            p = np.maximum(upper - lower, 1e-9)
            d_up, d_low = upper * (1 - upper) / p * weight, lower * (1 - lower) / p * weight
            d_score = (d_up - d_low) / len(texts)  # of the negative log-likelihood
            g_w = np.bincount(flat, d_score[text] * value, len(used)) * gain + DECAY * w
            g_w *= keep[used]
            g_theta = np.array([(-d_up[grades == k].sum() + d_low[grades == k + 1].sum()) for k in range(top)]) / len(texts)
            g = np.concatenate([g_w, [g_theta.sum()], [g_theta[k + 1 :].sum() * np.exp(s) for k, s in enumerate(self.steps)]])
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w -= move[: len(used)] * 0.1
            self.first -= move[len(used)] * 0.1
            self.steps = self.steps - move[len(used) + 1 :] * 0.1
        self.weights[used] = w * gain

    def score(self, column: pa.Array) -> np.ndarray:
        """Scores of whole texts; 0 without a word."""
        total, words = np.zeros(len(column)), np.zeros(len(column))
        for block in text_blocks(column):
            slots, per = features(block)
            sums = np.concatenate([[0.0], np.cumsum(self.weights[slots].sum(axis=1, dtype=np.float64))])
            np.add.at(total, block.rows, sums[per[1:]] - sums[per[:-1]])
            np.add.at(words, block.rows, np.diff(per))
        return total / np.maximum(words, 1)


def rating() -> Column:
    """Grades from the labels: 0 of low quality, 1 of good quality but toxic, 2 of good quality
    (a missing toxic mark counts as not toxic)."""
    quality, toxic = F.col("quality").cast("int"), F.coalesce(F.col("toxic").cast("int"), F.lit(0))
    return F.when(quality == 0, 0).when(quality == 1, 2 - toxic)


def fit(docs: DataFrame, rated: DataFrame, grades: int = 3, texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> Model:
    """A model from ``rated(doc_id, grade)`` (0 .. grades - 1; others, nulls and ids without a
    text are left out; of several grades the lowest holds, of several texts one), drawn by a hash
    of doc_id. Without any rating all weights are 0."""
    known = rated.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1))
    known = known.groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    rows = drawn_texts(docs, known.withColumnRenamed("grade", "label"), range(grades), texts, chars)
    model = Model(grades)
    if rows:
        model.train([r["text"] for r in rows], np.array([r["label"] for r in rows]))
    return model


def classify(docs: DataFrame, model: Model, least: int = 1, share: float = 0.5) -> DataFrame:
    """``(doc_id, expected_grade, tails, selected)`` of each row of ``docs(doc_id, text, ...)``.

    ``tails[k]`` is P(grade > k); selected: P(grade >= least) >= share. Null, empty and wordless
    texts have score 0. A null doc_id is kept, repeated rows give repeated rows, other columns
    are ignored, no row gives no row.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = restored(Model, sent.value)
        for b in batches:
            tails = model.tails(model.score(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64())), pa.array(tails[:, least - 1] >= share)],
                ["doc_id", "expected_grade", "tails", "selected"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tails array<double>, selected boolean")
