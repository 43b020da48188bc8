"""Toxicity scores by non-negative positive-unlabelled learning.

Learned from confirmed toxic texts (positives) and a sample of unlabelled texts, in which a
share ``prior`` is toxic. The risk of a linear model f on sparse features is

    prior * mean_P loss(f) + max(0, mean_U loss(-f) - prior * mean_P loss(-f))

with the logistic loss: the second term estimates the risk on clean texts and is kept from
going below zero (Kiryo et al. 2017). Features say which words, and which beginnings of words
of 3 to 6 bytes, occur in a text; those whose counts in the two samples differ beyond chance
(log-likelihood ratio) are kept, with their exact 64-bit hashes.

Fitting reads samples bounded by ``POSITIVES`` and ``UNLABELLED`` texts and its model by
``FEATURES``; scoring reads every whole text within its scan, without a shuffle, against the
broadcast model (at most 16 bytes a feature).

Edge cases: null and empty texts get the score of a text without features; texts that repeat
count once in the samples; rows without label, or with a null one, are never positives;
without positives the score is the prior; columns of the documents pass through, except that
the outputs replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlink.llm import bytewords as B
from satlink.llm import common as C

POSITIVES, UNLABELLED, FEATURES = 3000, 9000, 2048
#: Least log-likelihood ratio, and count among positives, of a feature.
EVIDENCE, LEAST = 28.0, 6
STARTS = (3, 4, 5, 6)
THRESHOLD = 0.3
_WORDS = B.Words(B.alnum_bytes())


def text_features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature): distinct features of each text of a batch, with their hash."""
    data, offsets = C.utf8(batch.column("text"))
    words, start, end, first = _WORDS(data, offsets)
    text = np.repeat(np.arange(batch.num_rows), np.diff(first))
    sums = B.prefix(_WORDS.values[data])
    texts, features = [text], [words]
    for n in STARTS:
        at = np.flatnonzero(end - start >= n)
        features.append(B.mix(B.hash_range(sums, start[at], start[at] + n) + np.uint64(n << 32)))
        texts.append(text[at])
    return np.concatenate(texts), np.concatenate(features)


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` of the rows, by the hash of the text, so that copies count alike; never over twice as many."""
    n = rows.count()
    share = F.pmod(F.xxhash64("text", F.lit(7)), F.lit(1 << 20)) < int(min(1.0, most / max(n, 1)) * (1 << 20))
    return rows.where(share).select("text").dropDuplicates(["text"]).limit(2 * most)


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def present(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature number) of the model's features in each text, each once."""
        text, feature = text_features(batch)
        if not len(self.features):
            return text[:0], text[:0]
        seen = np.zeros(1 << 18, bool)
        seen[(self.features >> np.uint64(46)).astype(np.int64)] = True
        at = np.flatnonzero(seen[(feature >> np.uint64(46)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.features, feature[at]), len(self.features) - 1)
        ok = self.features[place] == feature[at]
        pairs = np.unique(text[at[ok]] * len(self.features) + place[ok])
        return pairs // len(self.features), pairs % len(self.features)

    def logits(self, batch: pa.RecordBatch) -> np.ndarray:
        text, place = self.present(batch)
        return self.bias + np.bincount(text, self.weights[place], batch.num_rows)


def nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """(weights, bias) of a linear model by Adam on the non-negative PU risk."""
    k = positive.shape[1]
    w = np.zeros(k + 1)
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    P = np.hstack([positive, np.ones((len(positive), 1), np.float32)])
    U = np.hstack([unlabelled, np.ones((len(unlabelled), 1), np.float32)])
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        p, u = sigmoid(P @ w.astype(np.float32)), sigmoid(U @ w.astype(np.float32))
        # Logistic loss: loss(f) = -log s(f) has slope s - 1, loss(-f) = -log s(-f) has slope s.
        clean = np.mean(-np.log1p(-np.minimum(u, 1 - 1e-7))) - prior * np.mean(-np.log1p(-np.minimum(p, 1 - 1e-7)))
        clean_slope = U.T @ (u / len(U)).astype(np.float32) - prior * (P.T @ (p / len(P)).astype(np.float32))
        slope = prior * (P.T @ ((p - 1) / len(P)).astype(np.float32)) + clean_slope if clean >= 0 else -clean_slope
        slope = slope + decay * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, prior: float | None = None) -> Model:
    """Learn from rows of ``docs`` where ``learn`` (on doc_id) holds; ``prior`` defaults to the labels' toxic share."""
    C.python_tasks(docs.sparkSession)
    toxic = labels.where(F.col("toxic").isNotNull() & learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.where(learn & F.col("text").isNotNull()).select("doc_id", "text")
    if prior is None:
        counts = toxic.agg(F.avg(F.col("toxic").cast("double")).alias("share")).first()
        prior = min(0.9, max(1e-3, counts["share"] or 1e-3))
    confirmed = texts.join(toxic.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    sample = _sampled(confirmed, POSITIVES).withColumn("positive", F.lit(True)).unionByName(_sampled(texts, UNLABELLED).withColumn("positive", F.lit(False)))
    sample = C.written(sample.repartition(8, F.xxhash64("text")), "toxicity-sample")
    n = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    if not n.get(True) or not n.get(False):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            text, feature = text_features(batch)
            order = np.lexsort((feature, text))
            text, feature = text[order], feature[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (feature[1:] != feature[:-1])
            text, feature = text[new], feature[new]
            positive = batch.column("positive").to_numpy(zero_copy_only=False)[text]
            known, number = np.unique(feature, return_inverse=True)
            p = np.bincount(number, positive, len(known)).astype(np.int64)
            u = np.bincount(number, ~positive, len(known)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(p), pa.array(u)], names=["feature", "p", "u"])

    counts = sample.mapInArrow(C.task("toxicity", count), "feature long, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    share = F.lit(n[True] / (n[True] + n[False]))
    expected = share * (F.col("p") + F.col("u"))
    evidence = 2 * (F.col("p") * F.log(F.col("p") / expected) + F.when(F.col("u") > 0, F.col("u") * F.log(F.col("u") / (F.col("p") + F.col("u") - expected))).otherwise(0.0))
    chosen = counts.where((F.col("p") >= LEAST) & (F.col("p") > 2 * expected) & (evidence >= EVIDENCE)).orderBy(evidence.desc(), "feature").limit(FEATURES).collect()
    model = Model(np.sort(np.array([r["feature"] for r in chosen], np.int64).view(np.uint64)), np.zeros(len(chosen)), 0.0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            text, place = model.present(batch)
            lists = np.split(place, np.searchsorted(text, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(lists, pa.list_(pa.int64()))], names=["positive", "places"])

    found = sample.mapInArrow(C.task("toxicity", rows), "positive boolean, places array<long>").orderBy("positive", F.to_json("places")).collect()
    matrix = {True: np.zeros((n[True], len(chosen)), np.float32), False: np.zeros((n[False], len(chosen)), np.float32)}
    at = {True: 0, False: 0}
    for r in found:
        matrix[r["positive"]][at[r["positive"]], r["places"]] = 1
        at[r["positive"]] += 1
    model.weights, model.bias = nnpu(matrix[True], matrix[False], prior)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but score and predicted), score and predicted of every document."""
    spark = docs.sparkSession
    C.python_tasks(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]
    known = spark.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            s = 1 / (1 + np.exp(-np.clip(known.value.logits(batch), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(C.task("toxicity", run), schema)
