"""Language identification as a mixture of languages, fitted to each text.

Learning: over all labelled texts outside the held-out fold, Spark counts hashed byte 4-grams of
lower-cased letters by language.

Inference: a text is cut into segments of SEGMENT bytes; the segment's 4-grams give its
likelihood in each language. Expectation-maximisation estimates the proportions of the
languages in the text. The set of languages grows from the best single one: the language that
raises the likelihood most is added while the gain exceeds a penalty of PENALTY times the log
of the number of segments (plus one), as in a Bayesian information criterion. All texts of a
block are fitted at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Block, mix, restored, text_blocks

SLOTS = 1 << 15
GRAM = 4
SEGMENT = 64
SMOOTHING = 0.5
#: A 4-gram's log-likelihood is held within so much of a uniform guess, as repeated or odd
#: strings say little about a language.
CLIP = 6.0
#: Neighbouring 4-grams share their bytes; a segment counts as this share of independent ones.
TEMPER = 0.25
PENALTY = 2.0
STEPS = 12
MOST_LANGUAGES = 512

#: Digits, punctuation and control characters are one class, so that only letters matter.
_LETTERS = np.zeros(256, np.uint64)
_LETTERS[[*range(97, 123), *range(128, 256)]] = np.arange(1, 26 + 128 + 1)
_LETTERS[65:91] = _LETTERS[97:123]


def _grams(block: Block) -> np.ndarray:
    """The slot of the 4-gram that begins at each byte, padded with gaps at the end; -1 where
    it begins with two gaps."""
    x = np.append(_LETTERS[block.buf], np.zeros(GRAM - 1, np.uint64))
    code = np.zeros(len(block.buf), np.uint64)
    for k in range(GRAM):
        code |= x[k : k + len(code)] << np.uint64(8 * k)
    slots = (mix(code) & np.uint64(SLOTS - 1)).astype(np.int64)
    slots[(x[: len(code)] == 0) & (x[1 : len(code) + 1] == 0)] = -1
    return slots


def _padded():
    """The text in small letters, in gaps, so that its 4-grams do not reach into the next text."""
    return F.concat(F.lit(" "), F.lower(F.coalesce("text", F.lit(""))), F.lit("  "))


def counts(docs: DataFrame) -> DataFrame:
    """``(lang, slot, n)`` over all of ``docs(lang, text)`` with both given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for block in text_blocks(b.column(1)):
                slots = _grams(block)
                piece = np.repeat(langs[block.rows], np.diff(block.offsets)) if len(set(langs[block.rows])) > 1 else None
                for lang in set(langs[block.rows]):
                    own = slots if piece is None else slots[piece == lang]
                    seen.setdefault(lang, np.zeros(SLOTS, np.int64))
                    seen[lang] += np.bincount(own[own >= 0], minlength=SLOTS)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "slot", "n"])

    rows = docs.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), _padded().alias("text"))
    return rows.mapInArrow(run, "lang string, slot long, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


class Model:
    """Languages, and the log-likelihood of each 4-gram slot in each, against a uniform guess."""

    def __init__(self, rows: list):
        self.langs = sorted({r["lang"] for r in rows})
        if len(self.langs) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        n = np.zeros((SLOTS, max(len(self.langs), 1)))
        at = {lang: k for k, lang in enumerate(self.langs)}
        for r in rows:
            n[r["slot"], at[r["lang"]]] = r["n"]
        p = (n + SMOOTHING) / (n.sum(axis=0) + SMOOTHING * SLOTS)
        logs = np.clip(np.log(p * SLOTS), -CLIP, CLIP) * TEMPER
        self.logs = np.concatenate([logs, np.zeros((1, logs.shape[1]))]).astype(np.float32)  # the last row is slot -1

    def segments(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(segments x languages log-likelihoods, each segment's piece)."""
        size = np.diff(block.offsets)
        per = -(-size // SEGMENT)
        piece = np.repeat(np.arange(len(size)), per)
        k = np.arange(len(piece)) - np.repeat(np.cumsum(per) - per, per)
        starts = block.offsets[:-1][piece] + k * SEGMENT
        if not len(starts):
            return np.zeros((0, self.logs.shape[1]), np.float32), piece
        return np.add.reduceat(self.logs[_grams(block)], starts, axis=0), piece


def _em(like: np.ndarray, edges: np.ndarray, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log-likelihood) by text. like: scaled likelihoods by segment; languages
    that start at 0 stay at 0."""
    share = start
    n = np.diff(np.append(edges, len(text)))[:, None]
    for _ in range(STEPS):
        resp = like * share[text]
        resp /= np.maximum(resp.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(resp, edges, axis=0) / n
    total = np.log(np.maximum((like * share[text]).sum(axis=1), 1e-30))
    return share, np.add.reduceat(total, edges)


def infer(logs: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Proportions (texts x languages; all 0 without a segment). Segments are in order of text."""
    k = logs.shape[1]
    out = np.zeros((n_texts, k))
    if not len(text):
        return out
    top = logs.max(axis=1, keepdims=True)
    like, base = np.exp(logs - top).astype(np.float64), top[:, 0].astype(np.float64)
    found, edges = np.unique(text, return_index=True)
    local = np.repeat(np.arange(len(found)), np.diff(np.append(edges, len(text))))
    whole = np.add.reduceat(logs.astype(np.float64), edges, axis=0)
    best = whole.argmax(axis=1)
    share = np.zeros((len(found), k))
    share[np.arange(len(found)), best] = 1
    fit = whole[np.arange(len(found)), best] - np.add.reduceat(base, edges)
    penalty = PENALTY * np.log1p(np.diff(np.append(edges, len(text))))
    going = np.arange(len(found))
    for size in range(1, k):
        keep = np.isin(local, going)
        sub_like, sub_local = like[keep], local[keep]
        sub_found, sub_edges = np.unique(sub_local, return_index=True)
        pos = np.searchsorted(sub_found, sub_local)
        gain, chosen = np.full(len(sub_found), -np.inf), share[sub_found].copy()
        for lang in range(k):
            inside = share[sub_found, lang] > 0
            start = share[sub_found] * (1 - 0.5 / size)
            start[:, lang] += 0.5 / size
            new, value = _em(sub_like, sub_edges, pos, start)
            better = ~inside & (value - fit[sub_found] > gain)
            gain[better] = (value - fit[sub_found])[better]
            chosen[better] = new[better]
        more = gain > penalty[sub_found]
        going = sub_found[more]
        if not len(going):
            break
        share[going] = chosen[more]
        fit[going] += gain[more]
    out[found] = share
    return out


def held_out(fold: int = 2, folds: int = 4):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold


def fit(docs: DataFrame) -> Model:
    """The model of all texts with a language outside the held-out fold (a null doc_id is in
    no fold and left out). The counts that reach the driver are SLOTS per language at most."""
    return Model(counts(docs.where(~held_out())).collect())


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, proportions)`` for each row of ``docs(doc_id, text)``.

    ``lang_pred`` is the language of the largest proportion (ties: the first by code point) and
    score that proportion; ``und`` with score 0 if the text is null or has no letter, or if
    nothing was learned. ``proportions`` maps the selected languages to theirs. A null doc_id is
    not held out. Repeated rows give repeated rows; other columns are ignored; no row gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # SLOTS floats per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = restored(Model, sent.value)
        for b in batches:
            share = np.zeros((b.num_rows, model.logs.shape[1]))
            pending: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0

            def settle():
                if pending:
                    logs, rows = (np.concatenate(x) for x in zip(*pending, strict=True))
                    some, local = np.unique(rows, return_inverse=True)
                    share[some] = infer(logs, local, len(some))
                    pending.clear()

            before = -1
            for block in text_blocks(b.column(2)):
                if held > 1 << 16 and block.rows[0] != before:
                    settle()
                    held = 0
                before = block.rows[-1]
                logs, piece = model.segments(block)
                pending.append((logs, block.rows[piece]))
                held += len(piece)
            settle()
            best = share.argmax(axis=1)
            top = share[np.arange(len(best)), best]
            letters = b.column(3).to_numpy(zero_copy_only=False).astype(bool)
            ok = letters & (top > 0) & bool(model.langs)
            names = [model.langs[k] if good else "und" for k, good in zip(best, ok, strict=True)]
            maps = [[(model.langs[k], float(row[k])) for k in np.flatnonzero(row > 0.005)] if good else [] for row, good in zip(share, ok, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(np.where(ok, np.minimum(top, 1.0), 0.0)), pa.array(maps, pa.map_(pa.string(), pa.float64()))],
                ["doc_id", "held_out", "lang_pred", "score", "proportions"],
            )

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letter")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        _padded().alias("text"), letter,
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, proportions map<string,double>")
