"""Toxic passages as maximum-scoring segments of word scores.

Words and their beginnings (lower case, hashed to ``BUCKETS``) are scored by log-odds of toxic against clean documents under a Dirichlet
prior in proportion to their frequency in the whole corpus; scores that aren't significant become zero, a word has the largest score of
itself and its beginnings, so that inflected forms count together, and costs ``DRIFT``. A linear scan finds all
maximal-scoring segments of a text (Ruzzo and Tompa). Lambda solves the equation of Karlin and Altschul for clean words, K is the maximum
likelihood estimate over clean documents; they turn a segment's score into an expected number of such segments by chance. A document's
score is a logistic regression on its strongest segment and the sum over its significant ones, both in those units.

Labels are learnt from a bounded sample, ``SAMPLE`` labelled documents by hash of their id, none of them held out. Corpus counts cover all documents.
The model has at most BUCKETS words. Ids serve only to find the label and whether a document is held out; they, lang and source are
no inputs of a score. Null texts count as empty; they and empty ones get the score of a text without segments. A null doc_id isn't held out.
Labels without id or value are ignored, of several for one id the largest counts. Without toxic or clean labels every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from adspark.llm.common import PIECE, keep, map_arrow, pieces, table
from adspark.llm.words import Words

BUCKETS, SAMPLE, PRIOR, SIGNIFICANT, DRIFT, THRESHOLD, E_VALUE = 1 << 20, 50_000, 2_000.0, 4.0, 0.5, 0.3, 0.05
#: Bytes of a word's beginnings.
STEMS = (4, 5, 6, 7)
SEGMENTS = "array<struct<start:int,end:int,score:double>>"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _buckets(column: pa.Array) -> tuple[Words, np.ndarray]:
    """The words of a column and, a row each for words and beginnings, their buckets."""
    w = Words(column, "alnum")
    if not len(w):
        return w, np.zeros((1 + len(STEMS), 0), np.int64)
    return w, np.stack([(h & np.uint64(BUCKETS - 1)).astype(np.int64) for h in w.parts(STEMS)])


def _sample(labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ids and labels of the training sample: at most SAMPLE rows."""
    rows = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id")).limit(SAMPLE).collect())
    ids = np.array([r.doc_id for r in rows], np.int64)
    order = np.argsort(ids)
    return ids[order], np.array([r.toxic > 0 for r in rows], bool)[order]


def _labels_of(ids: np.ndarray, toxic: np.ndarray, column: pa.Array) -> np.ndarray:
    """1, 0, or -1 for documents that aren't in the sample."""
    out = np.full(len(column), -1)
    if len(ids):
        got = np.array([-1 if x is None else x for x in column.to_pylist()], np.int64)
        at = np.minimum(np.searchsorted(ids, got), len(ids) - 1)
        known = (ids[at] == got) & np.array([x is not None for x in column.to_pylist()], bool)
        out[known] = toxic[at[known]]
    return out


def _counts(docs: DataFrame, ids: np.ndarray, toxic: np.ndarray) -> DataFrame:
    """By bucket, how often it occurs in all documents, and the toxic and the clean documents of the sample that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, BUCKETS), np.int64)
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                w, buckets = _buckets(part.column("text"))
                total[0] += np.bincount(buckets.ravel(), minlength=BUCKETS)
                label = _labels_of(ids, toxic, part.column("doc_id"))
                row = np.repeat(np.arange(len(part)), w.count)
                known = label[row] >= 0
                pair = np.unique((row[known] * BUCKETS + buckets[:, known]).ravel())
                of = label[pair // BUCKETS]
                for k in (0, 1):
                    total[2 - k] += np.bincount(pair[of == k] % BUCKETS, minlength=BUCKETS)
        seen = np.flatnonzero(total[0])
        for k in range(0, len(seen), 50_000):
            b = seen[k:k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (b, *total[:, b])], ["bucket", "n", "toxic", "clean"])

    return (map_arrow(docs, run, "bucket long, n long, toxic long, clean long")
            .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "clean")]))


def _weights(counts: DataFrame) -> tuple[np.ndarray, float]:
    """The score of each bucket, drift included, and lambda."""
    counts = keep(counts)
    sums = counts.agg(*[F.sum(c).cast("double").alias(c) for c in ("n", "toxic", "clean")]).first()
    weight = np.full(BUCKETS, -DRIFT)
    if not sums["toxic"] or not sums["clean"]:
        return weight, 1.0
    prior = F.col("n") / F.lit(sums["n"]) * PRIOR
    odds = lambda c: F.log((F.col(c) + F.col("prior")) / (F.lit(sums[c] + PRIOR) - F.col(c) - F.col("prior")))
    scored = (counts.withColumn("prior", prior).withColumn("delta", odds("toxic") - odds("clean"))
              .withColumn("z", F.col("delta") / F.sqrt(1 / (F.col("toxic") + F.col("prior")) + 1 / (F.col("clean") + F.col("prior")))))
    rows = scored.where(F.abs("z") >= SIGNIFICANT).select(
        "bucket", "delta", ((F.col("clean") + F.col("prior")) / (sums["clean"] + PRIOR)).alias("p")).collect()  # at most BUCKETS rows
    b, delta, p = (np.array([r[i] for r in rows], float) for i in range(3))
    weight[b.astype(np.int64)] = delta - DRIFT
    rest = max(1e-9, 1 - p.sum())
    value = lambda x: math.log((p * np.exp(np.minimum(x * (delta - DRIFT), 600))).sum() + rest * math.exp(-x * DRIFT))
    low, high = 1e-3, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return weight, high


def segments(s: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments [start, end) of a row of scores, in one scan over its runs of one sign."""
    positive = s > 0
    if not positive.any():
        return []
    edge = np.flatnonzero(np.diff(positive.astype(np.int8), prepend=0, append=0))
    total = np.concatenate([[0.0], np.cumsum(s)])
    found: list[list] = []  # start, end, total before, total after, the nearest entry with a smaller total before
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        now = [a, b, float(total[a]), float(total[b]), -1]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= now[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= now[3]:
                now[4] = j
                found.append(now)
                break
            now[0], now[2] = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


def _segments(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    """n_words and segments, and the columns of ``docs`` but the text."""
    also = [c for c in docs.columns if c != "text"]
    shared = docs.sparkSession.sparkContext.broadcast(weight)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for part in pieces(batch, "text", PIECE):
                w, buckets = _buckets(part.column("text"))
                s = weights[buckets].max(axis=0)
                again = np.flatnonzero(np.diff(buckets[0], prepend=-1) == 0)  # a word that repeats the one before adds nothing
                s[again] = np.minimum(s[again], -DRIFT)
                hot = np.unique(np.searchsorted(w.first, np.flatnonzero(s > 0), side="right") - 1)
                found: list[list[dict]] = [[] for _ in range(len(part))]
                for r in hot.tolist():
                    found[r] = [{"start": a, "end": b, "score": x} for a, b, x in segments(s[w.first[r]:w.first[r + 1]])]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*map(part.column, also), pa.array(w.count), pa.array(found, kind)], [*also, "n_words", "segments"])

    added = StructType.fromDDL(f"n_words long, segments {SEGMENTS}")
    return map_arrow(docs, run, StructType([docs.schema[c] for c in also] + added.fields))


def _features(found: DataFrame, scale: float, k: float) -> DataFrame:
    """Evidence of the strongest segment, of all significant ones together, and their number."""
    size = F.log(F.lit(k) * F.greatest(F.col("n_words"), F.lit(1)))
    above = F.transform("segments", lambda x: x["score"] * scale - size)  # minus the log of the expected number
    passages = F.filter("segments", lambda x: x["score"] * scale - size >= -math.log(E_VALUE))
    return (found.withColumn("strongest", F.coalesce(F.array_max(above), -size)).withColumn("passages", passages)
            .withColumn("evidence", F.aggregate(above, F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0))))
            .withColumn("best", F.coalesce(F.array_max(F.transform("segments", lambda x: x["score"] * scale)), F.lit(0.0))))


def _inputs() -> list[Column]:
    return [F.greatest(F.least(F.col("strongest"), F.lit(20.0)), F.lit(-10.0)), F.log1p(F.col("evidence")),
            F.least(F.col("best"), F.lit(20.0)), F.log1p(F.size("segments"))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Intercept and coefficients by Newton's method with a ridge penalty."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


@dataclass
class Model:
    """What is learnt: the score of each bucket, lambda, K, and the regression (None without labels of both kinds)."""

    weight: np.ndarray
    scale: float
    k: float
    beta: np.ndarray | None


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``docs`` (doc_id, text). Of rows that share a labelled doc_id, the one with the smallest hash of its text trains."""
    ids, toxic = _sample(labels)
    if not toxic.any() or toxic.all():
        return Model(np.full(BUCKETS, -DRIFT), 1.0, 1.0, None)
    weight, scale = _weights(_counts(docs, ids, toxic))
    known = docs.sparkSession.createDataFrame(list(zip(ids.tolist(), toxic.astype(int).tolist())), "doc_id long, toxic int")
    labelled = docs.withColumn("hash", F.xxhash64("text")).join(F.broadcast(known), "doc_id")  # at most SAMPLE rows of two numbers
    first = F.min(F.struct("hash", "toxic", "n_words", "segments")).alias("first")
    found = keep(_segments(labelled, weight).groupBy("doc_id").agg(first).select("first.*"))
    best = F.coalesce(F.array_max(F.transform("segments", lambda x: x["score"])), F.lit(0.0))
    counts = found.where("toxic = 0 and n_words > 0").withColumn("best", best).agg(
        F.sum((F.col("best") > 0).cast("double")), F.sum(F.col("n_words") * F.exp(-F.col("best") * scale))).first()
    k = max(counts[0] or 0.0, 0.5) / max(counts[1] or 1.0, 1.0)
    rows = np.array(sorted(_features(found, scale, k).select("toxic", *_inputs()).collect()), float)  # at most SAMPLE rows
    both = len(rows) and 0 < rows[:, 0].sum() < len(rows)
    return Model(weight, scale, k, logistic(rows[:, 1:], rows[:, 0]) if both else None)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """score, n_words and passages (significant segments) of each row of ``docs``, with its columns but the text."""
    found = _features(_segments(docs, model.weight), model.scale, model.k)
    if model.beta is None:
        return found.withColumn("score", F.lit(0.0))
    line = F.lit(float(model.beta[0]))
    for b, x in zip(model.beta[1:].tolist(), _inputs()):
        line = line + x * b
    return found.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(line, F.lit(30.0)), F.lit(-30.0)))))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_words and passages (significant segments) for each row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_words", "passages")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go, each row by its own text: rows pass through the scan of their text, so that nothing is joined or shuffled."""
    model = fit(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), table(spark, sf_dir, "labels"))
    own = [f"own_{k}" for k in range(len(docs.columns))]  # no name of theirs clashes with one of ours
    found = score(docs.toDF(*own).withColumn("text", F.col(own[[c.lower() for c in docs.columns].index("text")])), model)
    return found.where(F.col("score") < THRESHOLD).select(*own).toDF(*docs.columns)
