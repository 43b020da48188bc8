"""Language identification by a byte convolutional network, trained and applied in numpy.

The network sees windows of ``WINDOW`` bytes: a byte embedding, filters of several widths
(as one matrix; a narrower filter has zeros in the outer places), max pooling over the window,
ReLU, a dense layer and softmax, trained by Adam on windows of a bounded sample of labelled
texts (``DOCS_PER_LANGUAGE`` documents of each language, ``WINDOWS_PER_DOC`` windows of each).

Scoring takes all windows of every whole text, in batches of windows, inside the scan, with
the broadcast network (a few ten kB); the class shares of a text's windows, weighted by their
letters, are averaged.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; rows without
language, and texts that repeat, are not or once in the sample; without any labelled text
every text is ``und``; other columns pass through, the outputs replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from satlink.llm import common as C

WINDOW = 160
WIDTHS = (2, 3, 4, 5)
FILTERS = 8  # of each width
EMBEDDING = 6
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 600, 4
UNKNOWN = "und"
_BATCH = 256


def letter_bytes() -> np.ndarray:
    """Bytes that may belong to a letter: weights windows of letters over those of digits and marks."""
    out = np.zeros(256, bool)
    out[65:91] = out[97:123] = out[128:] = True
    return out


@dataclass
class Network:
    languages: list[str]
    embed: np.ndarray  # 256 x E
    filters: np.ndarray  # (widest * E) x filters
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Embedded bytes around each position: (windows, positions, widest * E)."""
        n, size = windows.shape
        wide = max(WIDTHS)
        e = np.zeros((n, size + wide - 1, self.embed.shape[1]), np.float32)
        e[:, :size] = self.embed[windows]
        view = np.lib.stride_tricks.as_strided(e, (n, size, wide * e.shape[2]), (e.strides[0], e.strides[1], e.strides[2]))
        return np.ascontiguousarray(view)

    def shares(self, windows: np.ndarray) -> np.ndarray:
        """Class probabilities of each window."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), _BATCH):
            c = self.columns(windows[at : at + _BATCH])
            pooled = (c.reshape(-1, c.shape[2]) @ self.filters).reshape(c.shape[0], c.shape[1], -1).max(1)
            out[at : at + _BATCH] = softmax(np.maximum(pooled + self.bias, 0) @ self.dense + self.dense_bias)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(windows: np.ndarray, target: np.ndarray, languages: list[str], epochs: int = 6, rate: float = 4e-3, seed: int = 5) -> Network:
    """Adam on cross entropy; the gradient passes max pooling at the places of the maxima only."""
    rng = np.random.default_rng(seed)
    wide, f = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide, EMBEDDING, f), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(-1, f)
    net = Network(
        languages, rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(f, np.float32),
        rng.normal(0, 0.3, (f, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32),
    )
    names = ("embed", "filters", "bias", "dense", "dense_bias")
    m = {k: np.zeros_like(getattr(net, k)) for k in names}
    v = {k: np.zeros_like(getattr(net, k)) for k in names}
    step, size = 0, 64
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), size):
            pick = order[at : at + size]
            x, n = windows[pick].copy(), len(pick)
            # A third of the windows is shortened at random, since texts may be short.
            keep = np.where(rng.random(n) < 1 / 3, rng.integers(8, x.shape[1], n), x.shape[1])
            x[np.arange(x.shape[1]) >= keep[:, None]] = 0
            c = net.columns(x)
            z = (c.reshape(-1, c.shape[2]) @ net.filters).reshape(n, c.shape[1], f)
            place = z.argmax(1)
            pooled = np.take_along_axis(z, place[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(pooled, 0)
            p = softmax(hidden @ net.dense + net.dense_bias)
            p[np.arange(n), target[pick]] -= 1
            p /= n
            back = (p @ net.dense.T) * (pooled > 0)
            seen = c[np.arange(n)[:, None], place]  # (n, f, wide * E) at the maxima
            slope = {"dense": hidden.T @ p, "dense_bias": p.sum(0), "bias": back.sum(0), "filters": np.einsum("nf,nfk->kf", back, seen) * mask}
            to_embed = np.einsum("nf,kf->nfk", back, net.filters).reshape(n, f, wide, EMBEDDING)
            padded = np.zeros((n, x.shape[1] + wide - 1), np.int64)
            padded[:, : x.shape[1]] = x
            at_bytes = padded[np.arange(n)[:, None, None], place[:, :, None] + np.arange(wide)]
            inside = (place[:, :, None] + np.arange(wide)) < x.shape[1]
            g = np.zeros_like(net.embed)
            np.add.at(g, at_bytes[inside], to_embed[inside])
            slope["embed"] = g
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * slope[k]
                v[k] = 0.999 * v[k] + 0.001 * slope[k] ** 2
                setattr(net, k, (getattr(net, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32))
    return net


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows, text): all windows of each text one after the other; the last is filled with zero bytes."""
    lengths = np.diff(offsets)
    per_text = -(-lengths // WINDOW)
    text = np.repeat(np.arange(len(lengths)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = offsets[:-1][text] + number * WINDOW
    place = start[:, None] + np.arange(WINDOW)
    inside = place < offsets[1:][text][:, None]
    padded = np.append(data, np.uint8(0))
    return np.where(inside, padded[np.minimum(place, len(data))], 0).astype(np.uint8), text


def fit(docs: DataFrame, learn: Column) -> Network | None:
    """Learn from text and non-null lang of the rows of ``docs`` where ``learn`` holds."""
    C.python_tasks(docs.sparkSession)
    rows = docs.where(learn & F.col("lang").isNotNull() & (F.length("text") > 0)).select("lang", "text")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    wanted = F.lit(0)
    for lang, n in counts.items():
        wanted = F.when(F.col("lang") == lang, int(min(1.0, DOCS_PER_LANGUAGE / n) * (1 << 20))).otherwise(wanted)
    sample = rows.where(F.pmod(F.xxhash64("text", F.lit(3)), F.lit(1 << 20)) < wanted)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.merged(batches):
            langs, out_lang, out = batch.column("lang").to_pylist(), [], []
            windows, text = cut_windows(*C.utf8(batch.column("text")))
            for i, lang in enumerate(langs):
                mine = np.flatnonzero(text == i)
                for j in mine[np.unique(np.linspace(0, len(mine) - 1, WINDOWS_PER_DOC).astype(int))]:
                    out_lang.append(lang), out.append(windows[j].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_lang, pa.string()), pa.array(out, pa.binary())], names=["lang", "bytes"])

    # At most about DOCS_PER_LANGUAGE * WINDOWS_PER_DOC windows a language; copies of a text count once.
    found = sample.mapInArrow(C.task("language", spread), "lang string, bytes binary").distinct().limit(2 * len(counts) * DOCS_PER_LANGUAGE * WINDOWS_PER_DOC).collect()
    found = sorted((r["lang"], bytes(r["bytes"])) for r in found)
    languages = sorted(counts)
    windows = np.frombuffer(b"".join(b for _, b in found), np.uint8).reshape(-1, WINDOW)
    return train(windows, np.array([languages.index(lang) for lang, _ in found]), languages)


def predict(docs: DataFrame, network: Network | None, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all but the outputs), lang_pred and score of every document."""
    spark = docs.sparkSession
    C.python_tasks(spark)
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    known = spark.sparkContext.broadcast(network)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, letters = known.value, letter_bytes()
        for batch in C.merged(batches):
            texts = batch.column("text").to_pylist()
            lettered = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if net is not None and lettered.any():
                windows, text = cut_windows(*C.utf8(batch.column("text")))
                weight = letters[windows].sum(1) + 1e-6
                shares = net.shares(windows) * weight[:, None]
                total = np.stack([np.bincount(text, shares[:, k], len(texts)) for k in range(len(net.languages))], 1)
                total /= np.maximum(total.sum(1, keepdims=True), 1e-30)
                best = total.argmax(1)
                for i in np.flatnonzero(lettered):
                    lang[i] = net.languages[best[i]]
                score[lettered] = np.clip(total[lettered, best[lettered]], 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(lang, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(C.task("language", run), schema)
