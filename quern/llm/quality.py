"""Quality classifier: a factorisation machine (operator 1).

Features of a text: its hashed words (L2-normalised counts), structure statistics, and
their metadata (lengths). The score is logistic in

    w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i (v_if x_i)^2],

so all pairwise interactions cost one pass over the features.

The machine is fitted with numpy on a bounded sample of labelled rows: the ``SAMPLE``
rows with the smallest id hash. Scoring reads every whole text.

Defined results: a null text is the empty text and is scored by its statistics. Labels
that are null or have no doc_id are not used; several labels of a doc_id count as the
largest. Without any usable label every score is 0.5, and ``keep_good`` keeps every row, as
nothing is known against any. Repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import crc32_of_id, prepare, table, unused

SAMPLE = 4000                  # labelled rows that the fit uses at most
BUCKETS = 1 << 14
FACTORS = 8
EPOCHS = 6
THRESHOLD = 0.7
LETTERS, UPPER = np.zeros(256, bool), np.zeros(256, bool)
UPPER[ord("A"):ord("Z") + 1] = True
LETTERS[ord("a"):ord("z") + 1] = True
LETTERS |= UPPER
LETTERS[128:] = True
DIGITS = np.zeros(256, bool)
DIGITS[ord("0"):ord("9") + 1] = True
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
MARKED = re.compile(r"\W\W$")
STATS = 20


def statistics(text: str, words: list[str], counts: Counter) -> np.ndarray:
    """Structure statistics of a text, about 0 to 1 each."""
    raw = np.frombuffer(text.encode(), np.uint8)
    h = np.bincount(raw, minlength=256)
    n, nw = max(1, len(raw)), max(1, len(words))
    letters = max(1, h[LETTERS].sum())
    lines = [x for x in text.split("\n") if x]
    distinct = counts.keys()
    marked = sum(c for w, c in counts.items() if not w[-1].isalnum() and w[-1] not in ".,;:")
    doubled = sum(c for w, c in counts.items() if MARKED.search(w))
    caps = sum(c for w, c in counts.items() if w.isupper() and len(w) > 1)
    single = sum(c for w, c in counts.items() if len(w) == 1)
    numeric = sum(c for w, c in counts.items() if w[0].isdigit())
    same = sum(map(str.__eq__, words, words[1:]))
    return np.array([
        np.log1p(n) / 12, np.log1p(len(words)) / 10, min(2.0, n / nw / 10), h[UPPER].sum() / letters,
        h[DIGITS].sum() / n, 1 - (h[LETTERS].sum() + h[DIGITS].sum() + h[SPACE].sum()) / n, h[SPACE].sum() / n,
        h[10] / nw, len(distinct) / nw, max(counts.values(), default=0) / nw, caps / nw, marked / nw, doubled / nw,
        single / nw, numeric / nw, same / nw, 1 - len(set(lines)) / max(1, len(lines)), h[ord("|")] / nw,
        (h[33:48].max(initial=0) + h[58:65].max(initial=0)) / n, 1.0 if not words else 0.0], np.float32)


_BUCKET: dict[str, int] = {}


def bucket(word: str) -> int:
    b = _BUCKET.get(word)
    if b is None:
        if len(_BUCKET) >= 300_000:
            _BUCKET.clear()
        b = _BUCKET[word] = zlib.crc32(word.encode()) % BUCKETS
    return b


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: hashed words below ``BUCKETS``, statistics from there on."""
    text = text or ""
    words = text.split()
    counts = Counter(words)
    idx = np.fromiter(map(bucket, counts), np.int32, len(counts))
    val = np.fromiter(counts.values(), np.float32, len(counts))
    if len(val):
        val /= np.sqrt((val * val).sum())
    return (np.concatenate([idx, np.arange(BUCKETS, BUCKETS + STATS, dtype=np.int32)]),
            np.concatenate([val, statistics(text, words, counts)]))


class FactorisationMachine:
    """Second-order machine over sparse rows given as (indices, values, row starts)."""

    def __init__(self, size: int, factors: int = FACTORS, seed: int = 7):
        self.w0 = np.float32(0)
        self.w = np.zeros(size, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (size, factors)).astype(np.float32)
        self.shift, self.scale = np.zeros(STATS, np.float32), np.ones(STATS, np.float32)
        self.fitted = False

    def margin(self, idx, val, starts):
        vx = self.v[idx] * val[:, None]
        s = np.add.reduceat(vx, starts)
        q = np.add.reduceat(vx * vx, starts)
        return self.w0 + np.add.reduceat(self.w[idx] * val, starts) + 0.5 * (s * s - q).sum(axis=1), vx, s

    def scaled(self, idx, val):
        """Statistics in units of the sample's spread."""
        val = val.copy()
        at = idx >= BUCKETS
        k = idx[at] - BUCKETS
        val[at] = np.clip((val[at] - self.shift[k]) / self.scale[k], -4, 4)
        return val

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, epochs: int = EPOCHS,
            batch: int = 64, rate: float = 0.05, decay: float = 1e-5, seed: int = 7) -> None:
        if not len(y):
            return
        self.fitted = True
        stats = np.stack([v[-STATS:] for _, v in rows])
        self.shift, self.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-3
        rows = [(i, self.scaled(i, v)) for i, v in rows]
        share = np.clip(y.mean(), 0.01, 0.99)
        self.w0 = np.float32(np.log(share / (1 - share)))
        g0, gw, gv = 1e-6, np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for k in range(0, len(y), batch):
                take = order[k:k + batch]
                idx = np.concatenate([rows[i][0] for i in take])
                val = np.concatenate([rows[i][1] for i in take])
                lens = np.array([len(rows[i][0]) for i in take])
                m, vx, s = self.margin(idx, val, np.cumsum(lens) - lens)
                g = (1 / (1 + np.exp(-m)) - y[take]).astype(np.float32) / len(take)
                each = np.repeat(g, lens) * val
                used, back = np.unique(idx, return_inverse=True)
                dw = np.bincount(back, each).astype(np.float32) + decay * self.w[used]
                dv = np.zeros((len(used), self.v.shape[1]), np.float32)
                np.add.at(dv, back, each[:, None] * (np.repeat(s, lens, axis=0) - vx))
                dv += decay * self.v[used]
                gw[used] += dw * dw
                gv[used] += dv * dv
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                self.v[used] -= rate * dv / np.sqrt(gv[used])
                g0 += g.sum() ** 2
                self.w0 -= np.float32(rate * g.sum() / np.sqrt(g0))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for k in range(0, len(texts), 64):
            rows = [features(t) for t in texts[k:k + 64]]
            idx = np.concatenate([i for i, _ in rows])
            lens = np.array([len(i) for i, _ in rows])
            val = self.scaled(idx, np.concatenate([v for _, v in rows]))
            m = self.margin(idx, val, np.cumsum(lens) - lens)[0]
            out[k:k + 64] = 1 / (1 + np.exp(-np.clip(m.astype(np.float64), -30, 30)))
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, used: Column, rows: int = SAMPLE) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` labelled ids, those with the smallest hash."""
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & used) \
        .groupBy("doc_id").agg(F.max(label).alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(chosen), "doc_id")                 # ``rows`` ids and labels at most
    one = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    return texts.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")


def fit_quality(docs: DataFrame, labels: DataFrame, used: Column, rows: int = SAMPLE) -> FactorisationMachine:
    """A machine fitted on the sample; only feature numbers and values reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            fs = [features(t) for t in rb.column("text").to_pylist()]
            yield pa.record_batch([rb.column("doc_id"), rb.column("label"),
                                   pa.array([i.tobytes() for i, _ in fs], pa.binary()),
                                   pa.array([v.tobytes() for _, v in fs], pa.binary())],
                                  names=["doc_id", "label", "idx", "val"])

    got = labelled_sample(docs, labels, "quality", used, rows) \
        .select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("label").cast("int").alias("label")) \
        .mapInArrow(run, "doc_id string, label int, idx binary, val binary").collect()
    got.sort(key=lambda r: r["doc_id"])
    fm = FactorisationMachine(BUCKETS + STATS)
    fm.fit([(np.frombuffer(r["idx"], np.int32), np.frombuffer(r["val"], np.float32)) for r in got],
           np.array([r["label"] for r in got], np.float32))
    return fm


def add_scores(docs: DataFrame, model, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` plus the model's score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # of fixed size
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            s = shared.value.scores(rb.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(s, pa.float64())], names=[*rb.schema.names, score])

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, score)`` with the machine fitted on the rows that are not held out."""
    fm = fit_quality(docs, labels, crc32_of_id("doc_id") % 4 != 2)
    return add_scores(docs.select("doc_id", "text"), fm)


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    prepare(spark)
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (crc32_of_id("doc_id") % 4 == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject (without any usable label: all); all their columns."""
    prepare(docs.sparkSession)
    fm = fit_quality(docs, labels, crc32_of_id("doc_id") % 4 != 2)
    if not fm.fitted:
        return docs
    score = unused(docs, "_score")
    return add_scores(docs, fm, score=score).where(F.col(score) >= threshold).drop(score)
