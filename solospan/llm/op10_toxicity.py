"""Toxicity: a classifier with a counterfactual penalty on identity terms.

A logistic model over the presence of words.  It is fitted on at most
``sample_rows`` labelled training rows (those with the smallest seeded hash of
the id); the words that differ most between the classes there, and all
identity terms, are its features.  For each training text that names a group,
every identity term is swapped for each other term of its set, and the squared
change of the logit is penalised: naming one group rather than another must
not move the score, so a group that is often insulted does not become a sign
of an insult by itself.  Every whole text is scored.

Defined results: a null or empty text has no words and is scored by the
intercept; labels that are null, or of no document, are left out; repeated
rows count each; without training rows of both classes all scores are the
smoothed share of label 1; an empty table gives no rows; a row with a null id
is held out; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import as_bytes, checkpointed, held_out, map_batches

#: Sets of identity terms that may stand for one another.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("immigrants", "natives", "refugees"),
    ("disabled", "blind", "deaf"),
    ("old", "young", "elderly"),
)
SWAPS = {t.encode(): tuple(o.encode() for o in group if o != t) for group in IDENTITY_TERMS for t in group}
#: Everything but ASCII letters, digits and bytes of other characters becomes a blank.
FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> set[bytes]:
    return set(text.lower().translate(FOLD).split())


def word_table(sample: DataFrame) -> DataFrame:
    """(word, n, toxic): in how many texts of the sample a word is, and in how many of label 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[bytes] = Counter()
        toxic: Counter[bytes] = Counter()
        for batch in batches:
            for text, y, n in zip(as_bytes(batch.column(0)), *(c.to_pylist() for c in batch.columns[1:]), strict=True):
                every.update(found := dict.fromkeys(words_of(text), n))
                if y:
                    toxic.update(found)
        if every:
            columns = [pa.array(list(every), pa.binary()), pa.array(list(every.values()), pa.int64()), pa.array([toxic[w] for w in every], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "toxic"])

    return sample.select("text", "y", "n").mapInArrow(count, "word binary, n long, toxic long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def fit_weights(rows: list[list[int]], y: np.ndarray, swaps: dict[int, tuple[int, ...]], n_words: int, penalty: float, l2: float = 1e-3, steps: int = 400, rate: float = 0.3, times: np.ndarray | None = None) -> np.ndarray:
    """Intercept and word weights minimising mean log loss + penalty * mean squared counterfactual change + l2 * squares.

    ``rows`` are the words of each text, which counts ``times``; ``swaps`` the words that an identity word may be swapped for.
    """
    word = np.concatenate([np.array(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    # a swap takes one word out of a text and puts another in, unless the text has it already
    pairs = [(a, b, i) for i, r in enumerate(rows) for a in r if a in swaps for b in swaps[a] if b not in r]
    out, into, swapped = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1, 2))
    times = np.ones(len(rows)) if times is None else times
    total, positive = times.sum(), (times * y).sum()
    w, bias = np.zeros(n_words), float(np.log((positive + 1) / (total - positive + 1)))
    squares, bias_squares = np.full(n_words, 1e-8), 1e-8
    for _ in range(steps):
        margin = bias + np.bincount(row, w[word], len(rows))
        error = times * (1 / (1 + np.exp(-margin)) - y)
        grad = np.bincount(word, error[row], n_words) / total + 2 * l2 * w / max(1, total**0.5)
        if len(out):
            change = 2 * penalty * (w[out] - w[into]) * times[swapped] / total
            grad += np.bincount(out, change, n_words) - np.bincount(into, change, n_words)
        bias_grad = error.sum() / total
        squares += grad * grad
        bias_squares += bias_grad * bias_grad
        w -= rate * grad / np.sqrt(squares)
        bias -= rate * bias_grad / np.sqrt(bias_squares)
    return np.r_[bias, w]


def training_sample(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, sample_rows: int) -> DataFrame:
    """text, y and n: at most ``sample_rows`` distinct labelled texts of documents, and how often each is there."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("y")).where("y in (0, 1) and _id is not null")
    known = known.where(~held_out("_id", modulus, remainder)).groupBy("_id", "y").agg(F.count("*").alias("_labels"))
    texts = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("text").alias("_t"))
    there = texts.groupBy("doc_id", "_t").agg(F.count("*").alias("_texts"))
    there = there.select(F.col("doc_id").alias("_id"), F.col("_t").alias("_same"), "_texts").join(known, "_id")
    chosen = there.withColumn("_h", F.xxhash64(F.lit(10), "_id")).orderBy("_h", "_id", "y", "_same").limit(sample_rows)
    chosen = chosen.select("_id", "_same", "y", (F.col("_labels") * F.col("_texts")).alias("n"))
    # at most sample_rows rows are broadcast; the checkpoint keeps that many texts
    rows = texts.join(F.broadcast(chosen), (F.col("doc_id") == F.col("_id")) & (F.col("_t") == F.col("_same")))
    return checkpointed(rows.groupBy("_id", "_same", "y", "n").agg(F.max("text").alias("text")).select("text", "y", "n"))


def fit(docs: DataFrame, labels: DataFrame, modulus: int, remainder: int, sample_rows: int, max_words: int, penalty: float) -> tuple[float, dict[bytes, float]]:
    """Intercept and weights by word."""
    sample = training_sample(docs, labels, modulus, remainder, sample_rows)
    n, positive = sample.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("y")), F.lit(0))).first()
    if not 0 < positive < n:
        return float(np.log((positive + 1) / (n - positive + 1))), {}
    p = positive / n
    z = (F.col("toxic") - F.col("n") * p) / F.sqrt(F.col("n") * p * (1 - p))
    telling = word_table(sample).where("n >= 5").withColumn("z", F.abs(z)).where("z >= 3.5").orderBy(F.col("z").desc(), "word").limit(max_words).collect()
    terms = [bytes(r.word) for r in telling]
    terms += sorted(set(SWAPS).difference(terms))
    index = {w: i for i, w in enumerate(terms)}

    def hits(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(index[w] for w in words_of(t) if w in index) for t in as_bytes(batch.column(0))]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)], ["w", "y", "n"])

    rows = map_batches(sample, hits, "w array<int>, y int, n long").collect()  # at most sample_rows rows of known words
    swaps = {index[a]: tuple(index[b] for b in others) for a, others in SWAPS.items()}
    y, times = (np.array([r[i] for r in rows], float) for i in (1, 2))
    weights = fit_weights([r.w for r in rows], y, swaps, len(terms), penalty, times=times)
    return float(weights[0]), dict(zip(terms, weights[1:].tolist(), strict=True))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, sample_rows: int = 20_000, max_words: int = 2000, penalty: float = 10.0
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    docs = docs.select("doc_id", "text")
    bias, weights = fit(docs, labels, modulus, remainder, sample_rows, max_words, penalty)
    terms = weights.keys()

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        margins = np.array([bias + sum(weights[w] for w in sorted(terms & words_of(t))) for t in as_bytes(batch.column(1))])
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(margins, -500, 500))))], ["doc_id", "score"])

    scored = map_batches(docs, score, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id", modulus, remainder).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
