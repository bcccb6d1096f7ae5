"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts with unknown label (U) of the training
fold train an ensemble of linear numpy classifiers on the presence of words and
of short runs of letters in words.  With the
class prior pi the risk is

    pi * E_P[l(z)] + max(0, E_U[l(-z)] - pi * E_P[l(-z)])

(logistic l): the part of U that is toxic is taken out with the help of P, and
where that estimate of the non-toxic risk turns negative (the classifier is
overfitting) it counts as 0 and gives no step.  pi is the share of
toxic rows among the labelled rows of the training fold.

Each member learns from a bounded sample (``MAX_POSITIVE``, ``MAX_UNLABELLED``
rows, by hash of the id) in a Spark task of its own; the model is at most
``MEMBERS * MAX_FEATURES`` features.  Every document is scored whole.

Labels of ids with crc32 mod 5 = 0 are never read.  Only the text enters a
score.  Words: runs of 0-9, a-z and any non-ASCII byte of the text with A-Z
lower-cased.

Defined cases: null and empty texts get the score of no words; without a
positive training row every score is 0; null labels are unlabelled; repeated
label rows count once, toxic if any says so; repeated documents give repeated
rows; an empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import fold, fold_column, map_batches, pick, table, texts

FOLDS = 5
MEMBERS = 3
MAX_POSITIVE = 2000
MAX_UNLABELLED = 6000
MAX_FEATURES = 3000
MIN_DOCS = 3
GRAM = 5
#: Words remembered per Python worker while scoring.
REMEMBERED = 200_000
MIN_Z = 4.0
STEPS = 300
RATE = 0.05
DECAY = 1e-4
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes | None) -> set[bytes]:
    return set(WORD.findall(text.lower())) if text else set()


def parts_of(word: bytes) -> list[int]:
    """Features of a word, as crc32 codes: itself, and its runs of GRAM bytes with the start marked."""
    marked = b"^" + word
    return [zlib.crc32(b"=" + word), *(zlib.crc32(marked[k:k + GRAM]) for k in range(len(marked) - GRAM + 1))]


class Parts(dict):
    """Word -> its features (those that ``known`` has, if given); remembers at most ``REMEMBERED`` words."""

    def __init__(self, known: set[int] | None = None):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= (REMEMBERED if self.known is not None else REMEMBERED // 6):  # all features take more room
            self.clear()
        found = tuple(x for x in parts_of(word) if self.known is None or x in self.known)
        self[word] = found
        return found

    def of(self, text: bytes | None) -> set[int]:
        return set().union(*filter(None, map(self.__getitem__, words_of(text))))


# --- one classifier (numpy) ------------------------------------------------------

def choose(positive: list[np.ndarray], unlabelled: list[np.ndarray], most: int = MAX_FEATURES) -> np.ndarray:
    """Features whose share of texts differs most between P and U, in standard errors; sorted."""
    n, m = len(positive), len(unlabelled)
    in_p, n_p = np.unique(np.concatenate(positive), return_counts=True)
    in_u, n_u = np.unique(np.concatenate(unlabelled), return_counts=True)
    often = in_u[n_u >= MIN_DOCS]
    every = np.union1d(in_p, often)  # other features of U alone are below MIN_DOCS
    a, b = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
    a[np.searchsorted(every, in_p)] = n_p
    both = np.isin(in_u, every, assume_unique=True)
    b[np.searchsorted(every, in_u[both])] = n_u[both]
    mean = (a + b + 1) / (n + m + 2)
    z = np.abs(a / n - b / m) / np.sqrt(mean * (1 - mean) * (1 / n + 1 / m))
    z[a + b < MIN_DOCS] = 0
    best = np.argsort(-z, kind="stable")[:most]
    return np.sort(every[best[z[best] >= MIN_Z]])


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def nn_pu_step(z_p: np.ndarray, z_u: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk and its derivatives by the scores of P and U."""
    loss = lambda z: np.logaddexp(0, -z)
    pos, neg = prior * loss(z_p).mean(), loss(-z_u).mean() - prior * loss(-z_p).mean()
    d_u, d_p = sigmoid(z_u) / len(z_u), prior * sigmoid(z_p) / len(z_p)
    d_pos = -prior * sigmoid(-z_p) / len(z_p)
    if neg >= 0:
        return pos + neg, d_pos - d_p, d_u
    return pos, d_pos, np.zeros_like(z_u)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = STEPS) -> tuple[float, np.ndarray, np.ndarray]:
    """Intercept, features and their weights; texts are arrays of distinct feature codes."""
    chosen = choose(positive, unlabelled)
    n, texts_ = len(positive), [*positive, *unlabelled]
    places = []
    for x in texts_:  # only the chosen features of each text are kept
        at = np.searchsorted(chosen, x)
        at = at[at < len(chosen)] if len(chosen) else at[:0]
        places.append(at[chosen[at] == x[:len(at)]] if len(chosen) else at)
    row = np.repeat(np.arange(len(texts_)), [len(x) for x in places])
    col = np.concatenate(places)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        z = np.bincount(row, theta[col], len(texts_)) + theta[-1]
        _, d_p, d_u = nn_pu_step(z[:n], z[n:], prior)
        d = np.concatenate([d_p, d_u])
        grad = np.append(np.bincount(col, d[row], len(chosen)), d.sum())
        grad[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return float(theta[-1]), chosen, theta[:-1]


# --- Spark -----------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, members: int = MEMBERS) -> tuple[DataFrame, float]:
    """(member, positive, text) of the bounded samples, and the class prior."""
    known = pick(labels, "doc_id", "toxic").filter(F.col("doc_id").isNotNull() & (fold_column("doc_id", FOLDS) != 0))
    known = known.groupBy("doc_id").agg(F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    total = known.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("p")).first()
    prior = (total["p"] or 0) / total["n"] if total["n"] else 0.0
    known = known.withColumn("member", F.explode(F.sequence(F.lit(0), F.lit(members - 1))))
    known = known.withColumn("o", F.xxhash64("doc_id", "member"))  # each member draws its own sample
    # row_number below a constant is cut in each map task before the shuffle
    top = lambda df, n: df.withColumn("k", F.row_number().over(Window.partitionBy("member").orderBy("o", "doc_id"))).filter(F.col("k") <= n)
    sample = (top(known.filter("toxic = 1"), MAX_POSITIVE).withColumn("positive", F.lit(True))
              .union(top(known, MAX_UNLABELLED).withColumn("positive", F.lit(False)))
              .select(F.col("doc_id").alias("s_id"), "member", "positive"))
    # at most MEMBERS * (MAX_POSITIVE + MAX_UNLABELLED) rows of 13 bytes
    text = pick(docs, "doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("s_id"))
    # one text per sampled id, also where a document's row is repeated
    return text.groupBy("member", "positive", "doc_id").agg(F.min("text").alias("text")), prior


Model = tuple[float, dict[int, float]]


def fit(docs: DataFrame, labels: DataFrame, members: int = MEMBERS) -> list[Model]:
    """The trained members (intercept, weight by feature); none without positive rows."""
    rows, prior = training_rows(docs, labels, members)
    if not 0 < prior:
        return []

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts()
        for b in batches:
            codes = [np.array(sorted(parts.of(t)), np.uint32).tobytes() for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("member"), b.column("positive"), b.column("doc_id"), pa.array(codes, pa.binary())],
                                             ["member", "positive", "doc_id", "codes"])

    def member(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        arrays = lambda flag: [np.frombuffer(x, np.uint32) for x in rows.codes[rows.positive == flag]]
        p, u = arrays(True), arrays(False)
        if not p or not u:
            return pd.DataFrame({"member": [], "intercept": [], "codes": [], "weights": []})
        b, codes, weights = train(p, u, prior)
        return pd.DataFrame({"member": [rows.member.iloc[0]], "intercept": [b], "codes": [codes.astype(np.int64)], "weights": [weights]})

    sparse = map_batches(rows, features, "member int, positive boolean, doc_id long, codes binary")
    trained = sparse.groupBy("member").applyInPandas(member, "member int, intercept double, codes array<long>, weights array<double>")
    # at most members * MAX_FEATURES numbers reach the driver
    return [(r["intercept"], dict(zip(r["codes"], r["weights"]))) for r in sorted(trained.collect(), key=lambda r: r["member"])]


class Scorer:
    """Mean probability of the members."""

    def __init__(self, models: list[Model]):
        self.models = models
        self.parts = Parts(set().union(*(w for _, w in models)))

    def __call__(self, text: bytes | None) -> float:
        if not self.models:
            return 0.0
        found = sorted(self.parts.of(text))
        return float(np.mean([sigmoid(b + sum(w.get(x, 0.0) for x in found)) for b, w in self.models]))


def score(docs: DataFrame, models: list[Model]) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) with held_out, score and predicted."""
    def run(batches):
        score_text = Scorer(models)
        for b in batches:
            s = [score_text(t) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([fold(d, FOLDS) == 0 for d in b.column("doc_id").to_pylist()], pa.bool_()),
                 pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])

    return map_batches(pick(docs, "doc_id", "text"), run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, models: list[Model]) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    def run(batches):
        score_text = Scorer(models)
        for b in batches:
            yield b.filter(pa.array([score_text(t) < 0.5 for t in texts(b.column("text"))], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def q_op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
