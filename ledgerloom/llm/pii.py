"""Personal data: fixed base kinds, and identifiers found by bootstrapped context patterns.

One pass over the texts finds the base kinds and every other identifier-like token (with a
digit, ``@`` or ``_``), each with the lexical patterns of its left context: the word before it
with the punctuation between them, and the two words before it.

Base entities and secrets of unmistakable shape are seeds. Tokens that have a base kind's shape and
fail its test are decoys: they are no identifiers, and count against their patterns. Seeds, decoys
and all other tokens form a bipartite graph with their patterns. Spark scores it in rounds:

* a pattern's confidence is the sum of its distinct instances' confidences over their number
  plus one, so that a pattern seen once or twice is never sure;
* an unseen instance's confidence is that at least one of its patterns is right,
  1 - prod(1 - confidence).

Instances that reach the threshold are identifiers wherever they occur. A hot pattern or
instance costs one aggregated row and a join that adaptive execution splits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import materialise, text_hash

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 4
SURE = 0.8
#: Characters of the shortest token that counts as an identifier.
SHORTEST = 6
#: Characters that a context pattern may reach back.
REACH = 64

# --- fixed values ---
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRETS = (re.compile(r"AKIA[0-9A-Z]{16}"), re.compile(r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,}"))
# --- end of fixed values ---

#: Shapes of the base kinds, of tokens that base_spans has not taken.
_DECOYS = (re.compile(r"[0-9](?:-?[0-9]){12,}"), re.compile(r"[0-9]+(?:\.[0-9]+){3,}"), re.compile(r"\+[0-9][().0-9-]*[0-9]"))
_NOT_DIGIT = re.compile(r"[^0-9]")
_HINT = re.compile(r"[0-9@_]")
_TOKEN = re.compile(r"""[^\s"'=:,;()<>\[\]{}|]+""")
_TOKEN_BACK = re.compile(r"""[\s"'=:,;()<>\[\]{}|]""")
_CUE = re.compile(r"(?:([^\W\d_]{1,24})[^\w\n]{1,4})?([^\W\d_]{1,24})([^\w\n]{0,4})\Z")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Anchored at each ``@``: its local part is the run of allowed characters before it, since
    that run cannot hold another ``@``. Linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, start)
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """A maximal run of numbers joined by dots is cut into fours from its start."""
    for run in NUMBERS.finditer(text):
        if run[0].count(".") >= 3:
            at, parts = run.start(), run[0].split(".")
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = at + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                    yield at, end
                at = end + 1


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All base entities, by kind as in KINDS, then start; offsets in code points."""
    out: list[Span] = [("email", *x) for x in _emails(text)]
    out += [("ip", *x) for x in _ips(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def _tokens(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens outside the sorted spans ``taken``."""
    k, at = 0, 0
    while hint := _HINT.search(text, at):
        here = hint.start()
        while k < len(taken) and taken[k][1] <= here:
            k += 1
        if k < len(taken) and taken[k][0] <= here:
            at = taken[k][1]
            continue
        low = max(at, taken[k - 1][1] if k else 0)
        start = here
        while start > low and not _TOKEN_BACK.match(text, start - 1):
            start -= 1
        m = _TOKEN.match(text, here)
        end = min(m.end() if m else here + 1, taken[k][0] if k < len(taken) else len(text))
        at = max(end, here + 1)
        while end > start and text[end - 1] in ".!?":
            end -= 1
        if end - start >= SHORTEST:
            yield start, end


def cues(text: str, start: int) -> list[str]:
    """The lexical patterns of what stands before ``start``; none without a word there."""
    m = _CUE.search(text[max(0, start - REACH) : start])
    if not m:
        return []
    word = f"{m[2].lower()}{m[3].strip(' \"')}"
    return [word, f"{m[1].lower()} {word}"] if m[1] else [word]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(text: str) -> tuple[list[Span], list[Span], list[tuple[int, int, int, bool, bool, list[str]]]]:
    """Base spans, secrets, and all occurrences (start, end, value, seed, decoy, patterns)."""
    if not _HINT.search(text):
        return [], [], []
    base = base_spans(text)
    secrets, seen = [], []
    for kind, s, e in base:
        seen.append((s, e, True, False))
    for s, e in _tokens(text, sorted((s, e) for _, s, e in base)):
        secret = any(p.fullmatch(text, s, e) for p in SECRETS)
        if secret:
            secrets.append(("secret", s, e))
        seen.append((s, e, secret, any(p.fullmatch(text, s, e) for p in _DECOYS)))
    value = lambda s, e: xxhash.xxh64_intdigest(text[s:e].lower().encode()) - (1 << 63)
    return base, secrets, [(s, e, value(s, e), seed, decoy, cues(text, s)) for s, e, seed, decoy in seen]


_SEEN = "array<struct<start:int,end:int,value:bigint,seed:boolean,decoy:boolean,patterns:array<string>>>"
_SCANNED = f"doc_id long, text_hash long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, seen {_SEEN}"


def scanned(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen_type = pa.list_(
            pa.struct([("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64()), ("seed", pa.bool_()), ("decoy", pa.bool_()), ("patterns", pa.list_(pa.string()))])
        )
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):  # what is held as Python strings stays small
                b = whole.slice(lo, 256)
                counts, shas, spans, seen = [], [], [], []
                for text in b.column(2):
                    base, secrets, found = scan(text.as_py() or "")
                    counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS])
                    shas.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    spans.append(_joined(base + secrets))
                    seen.append([dict(zip(("start", "end", "value", "seed", "decoy", "patterns"), x, strict=True)) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(4)), pa.array(shas, pa.string()), pa.array(spans, pa.string()), pa.array(seen, seen_type)],
                    ["doc_id", "text_hash", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "seen"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(run, _SCANNED)


def score(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """``(pattern, confidence)`` and, for instances that are no seeds, ``(value, confidence)``,
    of distinct ``edges(pattern, value, seed)``. Values with a true ``decoy``, if there is such a column,
    have no confidence: they only count among their patterns' instances."""
    counts = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.sum(F.col("seed").cast("double")).alias("sure"))
    unseen = edges.where("not seed and not decoy" if "decoy" in edges.columns else "not seed").select("pattern", "value")
    counts, unseen = materialise(counts, "patterns"), materialise(unseen, "unseen")
    values = None
    for k in range(rounds):
        sure = F.col("sure")
        patterns = counts
        if values is not None:
            gained = unseen.join(values, "value").groupBy("pattern").agg(F.sum("confidence").alias("gained"))
            patterns = counts.join(gained, "pattern", "left")
            sure = sure + F.coalesce("gained", F.lit(0.0))
        patterns = patterns.select("pattern", (sure / (F.col("n") + 1)).alias("confidence")).where("confidence > 0")
        doubt = F.sum(F.log1p(-F.col("confidence")))
        values = unseen.join(patterns, "pattern").groupBy("value").agg((1 - F.exp(doubt)).alias("confidence"))
        if k < rounds - 1:
            values = materialise(values, "values")
    return patterns, values


def find(docs: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> DataFrame:
    """A row per row of ``docs(doc_id, text, ...)``: ``doc_id, text_hash, n_email, n_ip, n_card,
    n_phone, base_sha256, spans``.

    ``spans`` lists kind:start:end, the base kinds first, then ``secret`` (shapes in SECRETS)
    and ``context`` (found by patterns), each by start. Added spans never touch base spans;
    base spans of different kinds may overlap. A null text counts as empty, a null doc_id is
    kept, repeated rows give repeated rows, other columns are ignored, no row gives no row.
    """
    rows = materialise(scanned(docs), "pii")
    seen = rows.select("doc_id", "text_hash", F.explode("seen").alias("s")).select("doc_id", "text_hash", "s.*")
    edges = seen.select("value", "seed", "decoy", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(
        F.max("seed").alias("seed"), F.max("decoy").alias("decoy")
    )
    _, values = score(edges, rounds)
    known = values.where(F.col("confidence") >= sure).select("value")
    found = seen.where("not seed and not decoy").join(known, "value").groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("more")
    )
    found = found.select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"),
        F.array_join(F.transform("more", lambda x: F.concat_ws(":", F.lit("context"), x["start"], x["end"])), ",").alias("more"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    spans = F.concat_ws(",", F.when(F.col("spans") != "", F.col("spans")), "more")
    return rows.drop("seen").join(found, same, "left").withColumn("spans", spans).drop("_id", "_hash", "more")


def masked(text: str, spans: str) -> str:
    """The text with each span (overlapping ones merged) replaced by its kind in brackets."""
    out, at = [], 0
    for s, e, kind in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(","))):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> DataFrame:
    """``docs`` with every span masked and ``n_chars``, where there is one, brought up to date.
    Rows and columns stay; a null text stays null."""
    spans = find(docs, rounds, sure).where("spans <> ''").groupBy("doc_id", "text_hash").agg(F.first("spans").alias("_spans"))
    spans = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text_hash"), "_spans")

    @F.pandas_udf("string")
    def mask(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([masked(t, s) if t and s else t for t, s in zip(text, spans, strict=True)], dtype=object)

    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text_hash"))
    out = docs.withColumn("_hash", text_hash()).join(spans, same, "left").withColumn("text", mask("text", "_spans"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
