"""Toxicity by maximum-scoring segments.

* Token scores: log-odds of toxic against clean labelled documents under an informative Dirichlet prior (the pooled
  counts), for a word and for its first letters, where they are significant and large; all other tokens score a small negative drift.
* Segments: a linear scan finds all maximal-scoring segments of a text.
* Calibration: Karlin-Altschul extreme values. lambda solves E[exp(lambda s)] = 1 over the tokens of clean documents, K
  fits how often their best segment exceeds a level. A segment's normalised score is lambda S - ln(K n); the positive
  ones of a document are summed, and a logistic curve fitted on documents held apart turns the sum into a score.

Features are hashed to 2**FEATURES_LOG2 buckets, so the model has the same size for any corpus. It is fitted on a sample
of at most SAMPLE_ROWS labelled rows (smallest hashes of doc_id; near copies with equal labels count once), never on rows
whose crc32(doc_id as text) mod 5 is 0.

Nulls: a null text is empty and gets the score of a text without segments; a null doc_id or label is not learned from
and is scored like any other row (held_out as for the empty text). Repeated rows are scored alike. Without labels of
both kinds, as in an empty table, no token scores, and every score is the prior. Extra columns are ignored by
score_documents and kept by clean_documents. Very long texts are scanned whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import lean
from .neardup import PART, WHOLE, shingle_set

FEATURES_LOG2 = 20
SAMPLE_ROWS = 40_000
PREFIX = 4
PRIOR, MARGIN, DRIFT, CEILING = 5.0, 1.0, -0.25, 8.0
BIN, BINS = 0.5, 80
#: Distinct words a worker remembers, and the longest one.
MEMO_WORDS, MEMO_CHARS = 100_000, 64
#: Least log-odds ratio of a token that scores. A large sample makes any slight difference significant, such as that of
#: lengths; this keeps what counts alike at every size.
EFFECT = 1.0
#: Buckets whose scores the driver works out at once.
SLICE = 1 << 16
STRIP = ".,;:!?|()[]\"'"


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def features(word: str) -> tuple[int, int]:
    """Buckets of the word and of its first letters."""
    mask = (1 << FEATURES_LOG2) - 1
    return zlib.crc32(b"w" + word.encode("utf-8", "replace")) & mask, zlib.crc32(b"p" + word[:PREFIX].encode("utf-8", "replace")) & mask


def tokens(text: str | None) -> list[str]:
    return text.lower().split() if text else []


@dataclass
class Model:
    scores: np.ndarray  # by bucket, float32; 0: not significant
    rate: float = 1.0  # lambda
    scale: float = 1.0  # K
    a: float = -4.0
    b: float = 0.0


class Scorer:
    def __init__(self, model: Model):
        self.model, self.memo = model, {}

    def word(self, word: str) -> float:
        bare = word.strip(STRIP)
        best = max((float(self.model.scores[x]) for x in features(bare)), default=0.0) if bare else 0.0
        return best if best > 0 else DRIFT

    def segments(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal segments (first word, end, score), and the number of words."""
        words = tokens(text)
        memo = self.memo
        missing = {w for w in words if w not in memo}
        if missing:
            if len(memo) + len(missing) > MEMO_WORDS:
                memo.clear()
                missing = set(words)
            for w in missing:
                if len(w) <= MEMO_CHARS:
                    memo[w] = self.word(w)
        scores = np.fromiter((memo[w] if w in memo else self.word(w) for w in words) if any(len(w) > MEMO_CHARS for w in missing) else map(memo.__getitem__, words), np.float64, len(words))
        return maximal_segments(scores), len(words)

    def statistic(self, text: str | None) -> float:
        found, n = self.segments(text)
        least = math.log(max(self.model.scale * n, 1e-9)) if n else 0.0
        return sum(x for x in (self.model.rate * s - least for _, _, s in found) if x > 0)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments in linear time: each candidate keeps the sums before and after it, and merges with
    the nearest earlier one that starts lower while ending lower."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    stack: list[list] = []  # first, end, sum before, sum after
    for at in np.flatnonzero(scores > 0).tolist():
        k = [at, at + 1, float(total[at]), float(total[at + 1])]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= k[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= k[3]:
                stack.append([*k, j])
                break
            k = [stack[j][0], k[1], stack[j][2], k[3]]
            del stack[j:]
    return [(a, b, after - before) for a, b, before, after, _ in stack]


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """text, toxic and fold of a bounded sample of labelled rows. The sampled ids are broadcast: there are at most rows."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
    known = known.withColumn("_fold", fold(F.col("_id"))).where("_fold <> 0").orderBy(F.xxhash64("_id"), "_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("doc_id", "text", F.col("_toxic").alias("toxic"), F.col("_fold").alias("fold"))

    @lean
    def family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [min(shingle_set(x.as_py()).view(np.int64).tolist(), default=0) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], [*batch.schema.names, "family"])

    # Near copies say the same thing many times: of those with a label and their least shingle in common, one row stays.
    rows = found.mapInArrow(family, "doc_id long, text string, toxic int, fold long, family long")
    return rows.groupBy("family", "toxic").applyInPandas(without_near_copies, "text string, toxic int, fold long")


def without_near_copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows whose shingle set has a similarity under 0.8 to each one that stays, by doc_id. Sets that similar share one of
    their rarest fifth of shingles and one more, so only kept sets that do are compared."""
    rows = rows.sort_values(["doc_id", "text"], kind="stable")
    sets = [np.sort(shingle_set(text)) for text in rows["text"]]
    known, counts = np.unique(np.concatenate(sets), return_counts=True)
    holders, stay, empty = {}, [], False
    for k, found in enumerate(sets):
        n = len(found)
        rare = found[np.lexsort((found, counts[np.searchsorted(known, found)]))][: n - -(-PART * n // WHOLE) + 1].tolist() if n else []
        others = {j for h in rare for j in holders.get(h, ())}
        copy = any(similar(found, sets[j]) for j in others) if n else empty
        empty |= not n
        stay.append(not copy)
        if not copy:
            for h in rare:
                holders.setdefault(h, []).append(k)
    return rows.loc[stay, ["text", "toxic", "fold"]]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if WHOLE * min(len(a), len(b)) < PART * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return WHOLE * both >= PART * (len(a) + len(b) - both)


def count_features(rows: DataFrame) -> DataFrame:
    """bucket, toxic, n: documents of the sample with the bucket; -1 - toxic: documents. Summed in each task first."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros((2, 1 << FEATURES_LOG2), np.int64), [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = {w.strip(STRIP) for w in tokens(text.as_py())} - {""}
                counts[toxic, list({x for w in words for x in features(w)})] += 1
                n[toxic] += 1
        for toxic in (0, 1):
            at = np.flatnonzero(counts[toxic])
            bucket = np.concatenate([at, [-1]])
            got = np.concatenate([counts[toxic][at], [n[toxic]]])
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(np.full(len(bucket), toxic)), pa.array(got)], ["bucket", "toxic", "n"])

    return rows.select("text", "toxic").mapInArrow(run, "bucket long, toxic long, n long")


def log_odds(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Each bucket's log-odds ratio under a Dirichlet prior in proportion to the pooled counts, where it is significant.

    Significant: the signed root of the deviance from equal rates is above what the largest of as many chance buckets
    would reach, and the ratio above EFFECT; 0 elsewhere.
    """
    found = np.zeros(len(toxic), np.float32)
    if not n_toxic or not n_clean:
        return found
    odds = lambda y, n, prior: np.log((y + prior) / (n + PRIOR - y - prior).clip(0.5))
    part = lambda y, e: np.where(y > 0, y * np.log(np.maximum(y, 1) / np.maximum(e, 1e-9)), 0.0)
    least = math.sqrt(2 * math.log(max(2, int((toxic > 0).sum())))) + MARGIN
    for a in range(0, len(toxic), SLICE):  # a slice at a time, as each step makes arrays of that length
        t, c = toxic[a : a + SLICE], clean[a : a + SLICE]
        both = t + c
        prior = PRIOR * (both + 0.5) / (n_toxic + n_clean)
        expected = np.maximum(both * (n_toxic / (n_toxic + n_clean)), 1e-9)
        deviance = 2 * (part(t, expected) + part(c, both - expected))
        score = odds(t, n_toxic, prior) - odds(c, n_clean, prior)
        found[a : a + SLICE] = np.where((t > expected) & (deviance > least**2) & (score > EFFECT), np.minimum(score, CEILING), 0)
    return found


def solve_rate(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(weights * exp(rate * scores)) = sum(weights)."""
    if not len(scores) or scores.max() <= 0 or scores @ weights >= 0:
        return 1.0
    low, high, total = 0.0, 1.0, weights.sum()
    excess = lambda r: weights @ np.exp(np.minimum(r * scores, 600)) - total
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic fit of y on x with a slight ridge. Newton steps are halved until the loss falls: where the
    kinds are separable, full steps overshoot and need not come back."""
    at = np.array([-3.0, 0.5])

    def loss(v: np.ndarray) -> float:
        z = v[0] + v[1] * x
        return float(weight @ (np.logaddexp(0, z) - y * z) + 0.005 * v @ v)

    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(at[0] + at[1] * x, -40, 40)))
        w, g = weight * p * (1 - p) + 1e-9, weight * (p - y)
        h = np.array([[w.sum() + 0.01, w @ x], [w @ x, w @ (x * x) + 0.01]])
        step = np.linalg.solve(h, [g.sum() + 0.01 * at[0], g @ x + 0.01 * at[1]])
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return float(at[0]), max(float(at[1]), 0.0)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    from .common import materialize

    spark = docs.sparkSession
    known = materialize(sample(docs, labels, rows), "toxicity-sample")
    size = 1 << FEATURES_LOG2
    # at most two rows for each bucket reach the driver
    got = count_features(known.where("fold <> 4")).groupBy("bucket", "toxic").agg(F.sum("n").alias("n"))
    got = got.select(F.col("bucket").cast("int"), F.col("toxic").cast("byte"), "n").toArrow()
    counts = np.zeros((2, size + 1), np.int64)
    for batch in got.to_batches():
        bucket, toxic, n = (batch.column(i).to_numpy() for i in range(3))
        counts[toxic, bucket] = n  # -1: the last one
    del got
    model = Model(log_odds(counts[1, :-1], counts[0, :-1], int(counts[1, -1]), int(counts[0, -1])))
    # word tokens of clean documents by score: significant buckets against the rest
    hits = counts[0, :-1][model.scores > 0]
    rest = int(counts[0, :-1].sum() - hits.sum())
    model.rate = solve_rate(np.concatenate([model.scores[model.scores > 0].astype(float), [DRIFT]]), np.concatenate([hits + 0.1, [rest + 1.0]]))
    shared = spark.sparkContext.broadcast(model)

    @lean
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.segments(x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([max((s for *_, s in f), default=0.0) for f, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())], ["toxic", "best", "words"])

    apart = known.where("fold = 4").select("text", "toxic").mapInArrow(best, "toxic int, best double, words long")
    level = 1.0
    x = apart.where("toxic = 0").agg(F.sum((F.col("best") >= level).cast("long")).alias("over"), F.sum("words").alias("words")).first()
    if x.words:
        model.scale = float(((x.over or 0) + 0.5) / (x.words * math.exp(-model.rate * level)))
    shared = spark.sparkContext.broadcast(model)

    @lean
    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            got = [min(BINS - 1, int(scorer.statistic(x.as_py()) / BIN)) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(got, pa.int64())], ["toxic", "step"])

    steps = known.where("fold = 4").select("text", "toxic").mapInArrow(statistics, "toxic int, step long").groupBy("toxic", "step").count().collect()
    if steps:
        model.a, model.b = logistic(np.array([r.step * BIN for r in steps]), np.array([float(r.toxic) for r in steps]), np.array([float(r["count"]) for r in steps]))
    return model


def score_documents(docs: DataFrame, model: Model, keep: list[str], segments: bool = False) -> DataFrame:
    """The columns of keep with score, predicted, n_segments and, with segments, the significant passages (first word, end, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, "text")
    fields = rows.select(*keep).schema

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        m = scorer.model
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(len(keep)):
                found, n = scorer.segments(text.as_py())
                least = math.log(max(m.scale * n, 1e-9)) if n else 0.0
                passages.append([s for s in found if m.rate * s[2] > least])
                z = m.a + m.b * min(BIN * BINS, sum(m.rate * s - least for _, _, s in passages[-1]))
                scores.append(1 / (1 + math.exp(-z)))
            columns = [*batch.columns[: len(keep)], pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([len(p) for p in passages], pa.int32())]
            if segments:
                kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
                columns.append(pa.array([[{"first": a, "end": b, "score": float(s)} for a, b, s in p] for p in passages], kind))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "score", "predicted", "n_segments", *["segments"] * segments])

    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double", "predicted int", "n_segments int", *["segments array<struct<first:long,end:long,score:double>>"] * segments])
    return rows.mapInArrow(run, ddl)


def clean_documents(docs: DataFrame, model: Model) -> DataFrame:
    """The rows not predicted toxic, with all their columns: a filter within the scan, without a shuffle. Only texts go to
    the workers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        m = scorer.model
        for batch in texts:
            yield pa.array([m.a + m.b * min(BIN * BINS, scorer.statistic(x.as_py())) < 0 for x in batch], pa.bool_())

    return docs.where(clean(docs["text"]))
