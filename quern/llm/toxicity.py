"""Toxicity by non-negative positive-unlabelled learning (operator 5).

Positives are confirmed toxic texts, the rest is unlabelled text. With class prior
``pi`` the risk of a classifier g under loss l is

    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)]):

the negative part is estimated from unlabelled text less the positives in it, and is
kept from falling below zero (where the step undoes the over-fit instead); l is the
sigmoid loss. The
classifier is linear over the distinct words of a text and their first letters, hashed.
Every feature that positives hold more often than unlabelled texts do takes part, its weight
shrunk by its evidence: the posterior of a true difference (likelihood ratio of the two rates
against prior odds of 1 to ``ODDS``) times the part of its positives that is above the rate of
negatives, which the prior corrects: (rate_u - pi rate_p) / (1 - pi). At full weight, chance
differences of common words add up in long texts. The rates are counts over all confirmed
positives and all texts that may be used (one per row), so a rare kind gains evidence as the
data grow.

The steps draw from bounded samples (``POSITIVES``, ``UNLABELLED``: smallest id hash). Labels of
held-out rows are never read, nor are held-out texts in the unlabelled sample. The prior
is the share of toxic among the labels that may be used.

Defined results: a null text is the empty text, scored by the bias. Without a positive
example every score is 0. Repeated rows score alike.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import crc32_of_id, prepare, table
from quern.llm.quality import THRESHOLD, add_scores, labelled_sample
from quern.operators.joins import BROADCAST_BYTES, value_bytes

POSITIVES = 20_000             # confirmed toxic rows that the steps draw from at most
UNLABELLED = 6000              # unlabelled rows that the steps draw from at most
BUCKETS = 1 << 18
ID_BITS = 1 << 26              # bitmap of confirmed ids, where they are too many to broadcast: 16 MB
STEPS, BATCH, RATE, L1 = 1000, 256, 0.3, 1e-5
ODDS = 1000.0                  # chance differences to a true one, before the rates are seen
EDGES = re.compile(r"^\W+|\W+$")
_WORDS: dict[str, tuple[int, ...]] = {}


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its first four, five and six letters."""
    got = _WORDS.get(word)
    if got is None:
        if len(_WORDS) >= 300_000:
            _WORDS.clear()
        w = EDGES.sub("", word.lower())
        parts = {"=" + w} | {f"{k}{w[:k]}" for k in (4, 5, 6) if len(w) > k} if w else set()
        got = _WORDS[word] = tuple(zlib.crc32(p.encode()) % BUCKETS for p in sorted(parts))
    return got


def features(text: str | None) -> np.ndarray:
    """Distinct feature numbers of a whole text."""
    found: set[int] = set()
    for f in map(word_features, set((text or "").split())):
        found.update(f)
    return np.fromiter(found, np.int32, len(found))


def feature_counts(rows: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """How many rows hold each feature, and how many rows there are."""
    held = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return np.bincount(held, minlength=BUCKETS), len(rows)


def evidence(in_p: tuple[np.ndarray, int], in_u: tuple[np.ndarray, int], prior: float, odds: float = ODDS) -> np.ndarray:
    """Share of its weight that each feature keeps, 0 to 1; ``in_p`` and ``in_u`` are feature counts."""
    def loglik(k: np.ndarray, n: int, rate: np.ndarray) -> np.ndarray:
        return k * np.log(np.maximum(rate, 1e-300)) + (n - k) * np.log(np.maximum(1 - rate, 1e-300))

    (kp, n_p), (ku, n_u) = in_p, in_u
    p, u, both = kp / n_p, ku / n_u, (kp + ku) / (n_p + n_u)
    ratio = loglik(kp, n_p, p) + loglik(ku, n_u, u) - loglik(kp, n_p, both) - loglik(ku, n_u, both)
    negative = np.clip((u - prior * p) / (1 - prior), 0, 1)
    above = np.clip(p - negative, 0, 1) / np.maximum(p, 1e-300)
    return np.where(p > u, above / (1 + odds * np.exp(-np.clip(ratio, 0, 60))), 0)


class PuClassifier:
    """Linear classifier fitted on the non-negative positive-unlabelled risk."""

    def __init__(self, weights=None, bias: float = -30.0):
        self.w = np.zeros(BUCKETS, np.float32) if weights is None else weights
        self.bias = bias

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        lens = np.array([len(r) for r in rows])
        out = np.full(len(rows), self.bias)
        some = lens > 0
        if some.any():
            starts = (np.cumsum(lens) - lens)[some]
            out[some] += np.add.reduceat(self.w[np.concatenate([r for r in rows if len(r)])].astype(np.float64), starts)
        return out

    def fit(self, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, counts: tuple | None = None,
            steps: int = STEPS, batch: int = BATCH, rate: float = RATE, l1: float = L1, seed: int = 11) -> None:
        """``counts``: feature counts of the positives and of the unlabelled; without them, those of the rows."""
        if not positive or not unlabelled:
            return
        rng = np.random.default_rng(seed)
        self.bias = float(np.log(prior / (1 - prior)))
        share = evidence(*(counts or map(feature_counts, (positive, unlabelled))), prior)
        kept = np.flatnonzero(share)
        number = np.full(BUCKETS, -1, np.int32)
        number[kept] = np.arange(len(kept))
        share, w, total = share[kept], np.zeros(len(kept)), np.full(len(kept), 1e-8)
        positive, unlabelled = ([x[x >= 0] for x in (number[r] for r in rows)] for rows in (positive, unlabelled))
        gb = 1e-8
        for _ in range(steps):
            rows = [positive[i] for i in rng.integers(0, len(positive), batch)] + \
                [unlabelled[i] for i in rng.integers(0, len(unlabelled), 2 * batch)]
            idx, of = np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            m = self.bias + np.bincount(of, w[idx], minlength=len(rows))
            score = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
            sp, su = score[:batch], score[batch:]
            # Sigmoid loss l(g) = sigmoid(-g), bounded, so a few sure positives in u weigh little.
            dp, du = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
            if su.mean() - prior * sp.mean() >= 0:
                gp, gu = -2 * prior * dp, du
            else:
                gp, gu = prior * dp, -du
            g = np.concatenate([gp, gu])
            d = np.bincount(idx, g[of], minlength=len(kept))
            total += d * d
            step = rate / np.sqrt(total) * share
            moved = w - step * d
            w = np.where(d != 0, np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0), w)
            gb += g.sum() ** 2
            self.bias -= rate * g.sum() / np.sqrt(gb)
        self.w[kept] = w

    def scores(self, texts: list[str | None]) -> np.ndarray:
        m = np.concatenate([self.margins([features(t) for t in texts[k:k + 64]]) for k in range(0, len(texts), 64)]) \
            if texts else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


def _features_of(rows: DataFrame) -> list[np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            yield pa.record_batch([rb.column("doc_id"), pa.array([np.sort(features(t)).tobytes() for t in rb.column("text").to_pylist()], pa.binary())],
                                  names=["doc_id", "idx"])

    got = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id string, idx binary").collect()
    return [np.frombuffer(r["idx"], np.int32) for r in sorted(got, key=lambda r: r["doc_id"])]


def _counts_by(rows: DataFrame, flag: Column) -> tuple[tuple[np.ndarray, int], tuple[np.ndarray, int]]:
    """``feature_counts`` of all rows and of the flagged ones in one pass, added up by Spark;
    the driver gets two numbers a feature at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, BUCKETS + 1), np.int64)
        for rb in batches:
            for text, flagged in zip(rb.column("text").to_pylist(), rb.column("flag").to_pylist()):
                idx = features(text)
                for h in held[:2 if flagged else 1]:
                    h[idx] += 1
                    h[BUCKETS] += 1
        some = np.flatnonzero(held[0])
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(held[0, some]), pa.array(held[1, some])],
                              names=["f", "n", "flagged"])

    got = rows.select("text", flag.alias("flag")).mapInArrow(run, "f long, n long, flagged long") \
        .groupBy("f").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged")).toArrow()
    held = np.zeros((2, BUCKETS + 1), np.int64)
    for h, c in zip(held, ("n", "flagged")):
        h[got["f"].to_numpy()] = got[c].to_numpy()
    return (held[0, :BUCKETS], int(held[0, BUCKETS])), (held[1, :BUCKETS], int(held[1, BUCKETS]))


def _counts_of(rows: DataFrame) -> tuple[np.ndarray, int]:
    """``feature_counts`` of all rows."""
    return _counts_by(rows, F.lit(False))[0]


def rows_with_ids(texts: DataFrame, ids: DataFrame, bits: int = ID_BITS) -> DataFrame:
    """Rows of ``texts`` whose doc_id is in ``ids``; only rows that pass a bitmap of the ids' hashes are shuffled.

    The bitmap is broadcast: ``bits / 64`` rows at most, whatever the number of ids. Its false
    hits go out in the exact join behind it.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    word, bit = F.floor(place / 64), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))
    bitmap = ids.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_set"))
    some = texts.join(F.broadcast(bitmap), (word == F.col("_word")) & (F.col("_set").bitwiseAND(bit) != 0)).drop("_word", "_set")
    return some.join(ids.select("doc_id").distinct().hint("shuffle_merge"), "doc_id", "left_semi")


def group_counts(texts: DataFrame, ids: DataFrame, small: bool) -> tuple[tuple[np.ndarray, int], tuple[np.ndarray, int]]:
    """Feature counts of the texts whose doc_id is in ``ids``, and of all; no text outside ``ids`` is shuffled."""
    if not small:
        return _counts_of(rows_with_ids(texts, ids)), _counts_of(texts)
    marked = ids.select("doc_id").distinct().withColumn("flag", F.lit(True))
    every, of_ids = _counts_by(texts.select("doc_id", "text").join(F.broadcast(marked), "doc_id", "left"), F.coalesce("flag", F.lit(False)))
    return of_ids, every


def fit_toxicity(docs: DataFrame, labels: DataFrame, used: Column, positives: int = POSITIVES,
                 unlabelled: int = UNLABELLED) -> PuClassifier:
    """Classifier from confirmed toxic rows and unlabelled text; only feature numbers and counts reach the driver."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & used)
    ids = known.where("toxic = 1").select("doc_id")
    n, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("long"))).first()
    model = PuClassifier()
    if not toxic:
        return model
    prior = float(np.clip(toxic / n, 0.001, 0.5))
    confirmed = labels.where("toxic = 1")
    p = _features_of(labelled_sample(docs, confirmed, "toxic", used, positives))
    # Unlabelled: any text, labels unread. Ids stand in for the labels table.
    texts = docs.where(F.col("doc_id").isNotNull() & used)
    every = texts.select("doc_id", F.lit(0).alias("toxic"))
    u = _features_of(labelled_sample(docs, every, "toxic", F.lit(True), unlabelled))
    if p and u:
        size = ids.agg(F.sum(value_bytes(ids))).first()[0]
        model.fit(p, u, prior, group_counts(texts, ids, size <= BROADCAST_BYTES))
    return model


def op5_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    prepare(spark)
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, crc32_of_id("doc_id") % 3 != 1)
    return add_scores(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc32_of_id("doc_id") % 3 == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
