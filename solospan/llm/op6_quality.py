"""Quality classifier: regularised quadratic discriminant over document statistics.

Every whole text becomes a fixed vector of transformed statistics (log sizes,
log odds of character classes, repetition).  Counts, means and covariances of
the two classes are sums over all labelled training rows, gathered on the
executors and added up by Spark; a class's covariance is shrunk towards the
pooled one and its diagonal.  The Cholesky factors are computed once and go to
the tasks with the model; a score is the logistic of the difference of the log
densities (Mahalanobis distances and determinants) and log priors, divided by
the number of statistics.  The division leaves the decision at 0.5 as it is.

Defined results: a null or empty text has the statistics of an empty text and
is scored like any other; labels that are null, or of no document, are left
out; repeated rows and labels count each; if a class has no training rows all
scores are the smoothed share of label 1; an empty table gives no rows; a row
with a null id is held out; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import as_bytes, checkpointed, held_out, map_batches

#: Bytes of the character classes.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",;:", b"!?", b"|", b"#$%&*", b"+-=/\\<>@^_`~(){}[]", b"\"'")
N_STATISTICS = 7 + len(CLASSES)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a UTF-8 text."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, solid = len(words), int(sum(map(len, words)))

    def odds(part: float, of: float) -> float:
        return float(np.log((part + 0.5) / (of - part + 0.5)))

    repeats = sum(map(eq, words, words[1:]))
    shares = [float(np.log((counts[list(c)].sum() + 0.5) / (n + 1.0))) for c in CLASSES]
    return [
        float(np.log1p(n)),
        float(np.log((solid + 1.0) / (n + 1.0))),
        float(np.log1p(max(map(len, words), default=0))),
        float(np.log1p(len(set(words))) - 0.85 * np.log1p(n)),  # distinct words, with the usual growth taken out
        odds(repeats, n + 1.0),
        odds(len(lines) - len(set(lines)), len(lines) + 1.0),
        float(np.log((n + 1.0) / (len(lines) + 1.0))),
        *shares,
    ]


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors, log determinants and priors; ``constant`` if a class has no rows."""

    means: np.ndarray
    whiteners: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logs = []
        for mean, whiten, log_det, log_prior in zip(self.means, self.whiteners, self.log_dets, self.log_priors, strict=True):
            z = (x - mean) @ whiten.T
            logs.append(log_prior - 0.5 * (log_det + (z * z).sum(axis=1)))
        t = np.clip((logs[1] - logs[0]) / x.shape[1], -500, 500)
        return 1 / (1 + np.exp(-t))


def discriminant(n: np.ndarray, sums: np.ndarray, products: np.ndarray, shrinkage: float = 0.2, ridge: float = 0.05) -> Discriminant:
    """From the classes' counts, sums and sums of outer products."""
    d = sums.shape[1]
    if (n < 2).any():
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), np.zeros(2), float((n[1] + 1) / (n.sum() + 2)))
    means = sums / n[:, None]
    covs = products / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.tensordot(n / n.sum(), covs, axes=1)
    whiteners, log_dets = [], []
    for cov in covs:
        shrunk = (1 - shrinkage) * cov + shrinkage * pooled
        shrunk = (1 - ridge) * shrunk + ridge * np.diag(np.diag(shrunk)) + 1e-3 * np.eye(d)
        factor = np.linalg.cholesky(shrunk)
        whiteners.append(np.linalg.inv(factor))
        log_dets.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(whiteners), np.array(log_dets), np.log(n / n.sum()))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics ``x``."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [statistics(t) for t in as_bytes(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return map_batches(docs.select("doc_id", "text"), f, "doc_id long, x array<double>")


def fit(stats: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int) -> Discriminant:
    """The model of all labelled rows whose crc32(doc_id) mod ``modulus`` isn't ``remainder``."""
    d = N_STATISTICS
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1) and _id is not null")
    rows = stats.where(~held_out("doc_id", modulus, remainder)).join(known, F.col("doc_id") == F.col("_id")).select("y", "x")

    def moments(batch: pa.RecordBatch) -> pa.RecordBatch:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        parts = [x[y == k] for k in (0, 1)]
        m = [np.r_[len(p), p.sum(axis=0), (p.T @ p).ravel()] for p in parts]
        return pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([v.tolist() for v in m], pa.list_(pa.float64()))], ["y", "m"])

    sums = map_batches(rows, moments, "y int, m array<double>").select("y", F.posexplode("m").alias("i", "v"))
    total = np.zeros((2, 1 + d + d * d))
    for y, i, v in sums.groupBy("y", "i").agg(F.sum("v")).collect():  # 2 x (1 + d + d * d) numbers, whatever the input
        total[y, i] = v
    return discriminant(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


def quality_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    stats = checkpointed(with_statistics(docs))
    model = fit(stats, labels, "quality", modulus, remainder)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    scored = map_batches(stats, score, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be of label 1.

    All columns come back as they are; null and empty texts are judged as empty
    texts, each repeat of a row alike; an empty table stays empty.
    """
    model = fit(with_statistics(docs), labels, "quality", modulus, remainder)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        texts = as_bytes(batch.column(batch.schema.get_field_index("text")))
        return batch.filter(pa.array(model.scores(np.array([statistics(t) for t in texts])) >= 0.5))

    return map_batches(docs, keep, docs.schema)
