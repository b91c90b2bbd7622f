"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (0) or abstain (-1) on each document. Their accuracies are unknown; expectation-
maximisation estimates them, and the class balance, from how often each pattern of votes occurs over all documents (at
most 3 ** labellers patterns, so counts alone reach the driver). Posterior labels then train a hashed linear scorer.

The scorer is fitted on at most SAMPLE_ROWS documents (smallest hashes of doc_id), and scores every document. A document
is kept unless both the scorer and the posterior find it bad.

Nulls: a null text is empty: all labellers but the length one abstain. A null doc_id is scored as well. Repeated rows
get equal scores. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .hashing import lean
from .textstats import text_stats

SAMPLE_ROWS = 6_000
FEATURES_LOG2 = 16
EPOCHS, RATE, RIDGE = 6, 0.5, 1e-6
LABELLERS = ("length", "repeats", "lines", "symbols", "digits", "word_length", "variety", "sentences")


def votes(text: str | None) -> tuple[int, ...]:
    """One vote for each of LABELLERS."""
    n, chars, symbols, dup, repeated, distinct, digits, lines, ends = text_stats(text)
    if not n:
        return (0,) + (-1,) * (len(LABELLERS) - 1)
    three = lambda x, good, bad: 1 if x <= good else 0 if x >= bad else -1
    return (
        three(-n, -50, -10),
        three(repeated / n, 0.05, 0.2) if n >= 10 else -1,
        three(dup / max(lines, 1), 0.1, 0.3) if lines >= 3 else -1,
        three(symbols / max(chars, 1), 0.01, 0.1),
        three(digits / max(chars, 1), 0.05, 0.2),
        1 if 3 <= chars / n <= 9 else 0 if chars / n < 2 or chars / n > 15 else -1,
        three(-distinct / n, -0.35, -0.15) if n >= 50 else -1,
        three(-ends / max(lines, 1), -0.5, -0.05) if lines >= 2 else -1,
    )


def pattern(v: tuple[int, ...]) -> int:
    return sum((x + 1) * 3**k for k, x in enumerate(v))


def unpack(code: int) -> list[int]:
    return [code // 3**k % 3 - 1 for k in range(len(LABELLERS))]


def expectation_maximisation(codes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """Accuracies (labeller, class), share of good documents and the posterior of each pattern. An accuracy is the chance
    of the right vote given that the labeller votes; a slight prior keeps labellers better than chance."""
    v = np.array([unpack(int(c)) for c in codes], np.int64).reshape(-1, len(LABELLERS))
    said = [(v == y).astype(float) for y in (0, 1)]
    right, share = np.full((len(LABELLERS), 2), 0.75), 0.8
    post = np.zeros(len(codes))
    for _ in range(rounds):
        good = np.log(share) + said[1] @ np.log(right[:, 1]) + said[0] @ np.log(1 - right[:, 1])
        bad = np.log(1 - share) + said[0] @ np.log(right[:, 0]) + said[1] @ np.log(1 - right[:, 0])
        new = 1 / (1 + np.exp(np.clip(bad - good, -50, 50)))
        for y, p in ((1, new), (0, 1 - new)):
            w = counts * p
            right[:, y] = ((w @ said[y]) + 8) / (w @ (said[0] + said[1]) + 10)
        right = right.clip(0.51, 0.995)
        share = float(np.clip((counts @ new + 8) / (counts.sum() + 10), 0.05, 0.99))
        done = len(new) == 0 or np.abs(new - post).max() < 1e-7
        post = new
        if done:
            break
    return right, share, post


def buckets(text: str | None) -> np.ndarray:
    """Hashed features: words, shapes of the counts' orders of magnitude, and character classes of words."""
    mask = (1 << FEATURES_LOG2) - 1
    words = (text or "").lower().split()
    found = {zlib.crc32(w.encode("utf-8", "replace")) & mask for w in set(words)}
    stats = text_stats(text)
    n = max(stats[0], 1)
    found |= {zlib.crc32(f"{k}:{int(20 * x / n)}".encode()) & mask for k, x in enumerate(stats)}
    found.add(zlib.crc32(f"n:{stats[0].bit_length()}".encode()) & mask)
    return np.fromiter(found, np.int64, len(found))


def train(texts: list[str | None], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by averaged stochastic gradient steps, in a fixed order."""
    rows = [buckets(t) for t in texts]
    w, bias, total, shift = np.zeros(1 << FEATURES_LOG2), 0.0, np.zeros(1 << FEATURES_LOG2), 0.0
    rng = np.random.default_rng(0)
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            x = rows[k]
            scale = 1 / np.sqrt(len(x))
            p = 1 / (1 + np.exp(-np.clip(bias + w[x].sum() * scale, -30, 30)))
            g = RATE / (1 + epoch) * (p - labels[k])
            w[x] -= g * scale + RIDGE * w[x]
            bias -= 0.1 * g
        total += w
        shift += bias
    return (total / EPOCHS).astype(np.float32), shift / EPOCHS


def weak_label_scores(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, posterior (of good, by votes), score (of good, by the scorer), kept."""
    spark = docs.sparkSession

    @lean
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pattern(votes(x.as_py())) for x in batch.column(0)], pa.int32())], ["pattern"])

    counted = docs.select("text").mapInArrow(vote, "pattern int").groupBy("pattern").count().collect()
    codes, counts = np.array([r.pattern for r in counted], np.int64), np.array([r["count"] for r in counted], float)
    right, share, post = expectation_maximisation(codes, counts)
    posterior = dict(zip(codes.tolist(), post.tolist(), strict=True))
    fitted = docs.where("doc_id is not null").select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(sample_rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(fitted.select("doc_id").distinct()), "doc_id", "left_semi")
    got = materialize(chosen, "weak-sample").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample_rows).toArrow()
    texts = got.column("text").to_pylist()
    weights, bias = train(texts, np.array([posterior.get(pattern(votes(t)), share) for t in texts]))
    shared = spark.sparkContext.broadcast((weights, bias, posterior, share))

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, posterior, share = shared.value
        for batch in batches:
            p, s = [], []
            for text in batch.column(1):
                text = text.as_py()
                p.append(posterior.get(pattern(votes(text)), share))
                x = buckets(text)
                s.append(float(1 / (1 + np.exp(-np.clip(bias + weights[x].sum() / np.sqrt(len(x)), -30, 30)))))
            kept = [a >= 0.5 or b >= 0.5 for a, b in zip(p, s, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array(s, pa.float64()), pa.array(kept, pa.bool_())], ["doc_id", "posterior", "score", "kept"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, posterior double, score double, kept boolean")
