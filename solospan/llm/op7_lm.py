"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Token counts are taken over all training documents, added up in tasks before
the shuffle.  A token's probability has two factors, both log-bilinear and both
normalised exactly; together they cover every counted token, however many the
corpus has.

*Class given context.*  The ``n_words`` most frequent tokens are classes of
their own; the other common tokens fall into classes by frequency, two for each
power of two, and all others into a last one.  The score of a class after two
others is a product of the class's vector and a sum of the context's vectors,
each weighted by position.  It is trained in numpy with noise-contrastive
estimation on the counted class trigrams of all training documents.  The
trigrams are dealt to tasks of about ``task_trigrams``; in each round every
task makes a pass over its own, and the tasks' parameters are averaged by their
numbers of tokens.  The normaliser depends on the context alone.  Contexts are
pairs of classes, so batched matrix products give a whole table of normalisers,
a Spark row for each first token.

*Token given class and context.*  Every token of a shared class has a vector of
its own.  Contexts are told apart by the groups (weighted k-means) of their two
tokens' trained vectors, and the group centres give the context's side of the
product.  The noise is the tokens' frequency, whatever the context; with the
context's side fixed, the noise-contrastive loss is a sum over tokens, so each
token's vector is fitted, in the partition that holds its counts by group, to
the loss's minimum with a normal prior.  The normalisers, one for each class
and group, are sums over all those rows.  The last class keeps one place for
unseen tokens, so all probabilities of a context add up to one.

Counts and vectors of the ``n_common`` most frequent tokens go to the tasks (a
fixed bound); those of all others reach the documents by a join on the token.

Defined results: a null or empty text is its end token alone; repeated rows
are scored (and counted) each for itself; a row with a null id is held out;
without training documents all counts are zero and base and model give
probability one to each token; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import as_bytes, checkpointed, held_out

END = b"\n"  # no word has a blank
COUNTED_AT_ONCE = 400_000
KEYS_AT_ONCE = 3_000_000
BATCH_DOCS = 512
NEAR_GROUPS, FAR_GROUPS = 16, 4
TOKEN_DIMENSIONS = 8
TOKEN_NOISE = 8
TOKEN_PRIOR = 2.0


def tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()
    words.append(END)
    return words


def token_counts(train: DataFrame) -> DataFrame:
    """(token, c) over all texts of ``train``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()), pa.array(list(counter.values()), pa.int64())], ["token", "c"])
            counter.clear()
            return out

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                counter.update(tokens(text))
                if len(counter) > COUNTED_AT_ONCE:
                    yield flush()
        if counter:
            yield flush()

    return train.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The tokens of the highest counts: as many whole steps of a logarithmic scale as have ``most`` tokens or fewer."""
    step = F.floor(F.log2("c") * 64)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()  # 64 rows for each power of two
    least, n = float("inf"), 0
    for r in sorted(sizes, reverse=True):
        n += r.n
        if n > most:
            break
        least = r.step
    return counts.where(step >= F.lit(float(least)))


@dataclass
class LogBilinear:
    """Classes 0 to ``words``, the last for all tokens that are not common; a context may also be the place before a text (``words`` + 1)."""

    words: int
    context: np.ndarray  # (words + 2) x d
    position: np.ndarray  # 2 x d
    target: np.ndarray  # (words + 1) x d
    bias: np.ndarray  # words + 1

    @classmethod
    def start(cls, share: np.ndarray, d: int, seed: int) -> LogBilinear:
        rng = np.random.default_rng(seed)
        words = len(share) - 1
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        return cls(words, small(words + 2, d), np.ones((2, d), np.float32), small(words + 1, d), np.log(share).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.position, self.target, self.bias]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all targets by the token before (with the bias) and by the one before that."""
        near = (self.context * self.position[0]) @ self.target.T + self.bias
        return near, (self.context * self.position[1]) @ self.target.T

    def normalisers(self, before: int) -> np.ndarray:
        """log Z of all contexts whose token before the last is ``before``."""
        near, far = self.tables()
        scores = near + far[before]
        top = scores.max(axis=1)
        return top + np.log(np.exp(scores - top[:, None]).sum(axis=1))


class NceTrainer:
    """Adagrad on the noise-contrastive loss; the noise, drawn by frequency, is shared by a batch."""

    def __init__(self, model: LogBilinear, share: np.ndarray, seed: int, noise: int = 128, rate: float = 0.1, batch: int = 2048):
        self.m, self.rate, self.batch, self.k = model, rate, batch, noise
        self.log_noise = np.log(noise * share).astype(np.float32)
        self.cumulative = np.cumsum(share)
        self.rng = np.random.default_rng(seed)
        self.squares = [np.full(p.shape, 0.01, np.float32) for p in model.parts()]

    def state(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (*self.m.parts(), *self.squares)]).astype(np.float64)

    def restore(self, state: np.ndarray) -> NceTrainer:
        at = 0
        for p in (*self.m.parts(), *self.squares):
            p[...] = state[at : at + p.size].reshape(p.shape)
            at += p.size
        return self

    def _scatter(self, ids: np.ndarray, grad: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(ids, grad[:, j], n) for j in range(grad.shape[1])], axis=1).astype(np.float32)

    def _apply(self, i: int, grad: np.ndarray) -> None:
        self.squares[i] += grad * grad
        self.m.parts()[i][...] += self.rate * grad / np.sqrt(self.squares[i])

    def step(self, far: np.ndarray, near: np.ndarray, target: np.ndarray, times: np.ndarray) -> None:
        m = self.m
        drawn = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.k) * self.cumulative[-1]), m.words)
        a, b, t, q = (x.take(i, axis=0) for x, i in ((m.context, near), (m.context, far), (m.target, target), (m.target, drawn)))
        h = a * m.position[0] + b * m.position[1]
        # logistic(s) = (1 + tanh(s / 2)) / 2
        right = 0.5 - 0.5 * np.tanh(0.5 * (np.einsum("ij,ij->i", h, t) + m.bias.take(target) - self.log_noise.take(target)))
        wrong = h @ q.T
        wrong += m.bias[drawn] - self.log_noise[drawn]
        wrong *= 0.5
        np.tanh(wrong, out=wrong)
        wrong *= -0.5
        wrong -= 0.5
        scale = np.float32(1.0 / np.sqrt(times.sum()))
        right *= times * scale
        wrong *= (times * scale)[:, None]
        weighted = right[:, None]
        dh = weighted * t + wrong @ q
        d_target = self._scatter(target, weighted * h, m.words + 1)
        np.add.at(d_target, drawn, wrong.T @ h)
        d_bias = np.bincount(target, right, m.words + 1).astype(np.float32)
        np.add.at(d_bias, drawn, wrong.sum(axis=0))
        d_context = self._scatter(near, dh * m.position[0], m.words + 2) + self._scatter(far, dh * m.position[1], m.words + 2)
        d_position = np.stack([np.einsum("ij,ij->j", dh, a), np.einsum("ij,ij->j", dh, b)]) * scale
        for i, grad in enumerate((d_context, d_position, d_target, d_bias)):
            self._apply(i, grad)

    def fit(self, far: np.ndarray, near: np.ndarray, target: np.ndarray, times: np.ndarray) -> None:
        """A pass over counted trigrams in random order; the most frequent ones are spread over several batches."""
        parts = np.ceil(times / max(1.0, times.sum() / 1000)).astype(np.int64)
        order = self.rng.permutation(np.repeat(np.arange(len(times)), parts))
        weight = (times / parts).astype(np.float32)
        for at in range(0, len(order), self.batch):
            i = order[at : at + self.batch]
            self.step(far[i], near[i], target[i], weight[i])


@dataclass
class Classes:
    """The common tokens' places and the classes of all tokens."""

    index: dict[bytes, int]
    counts: np.ndarray  # of each place
    words: int  # so many first places are classes of their own
    of: np.ndarray  # class of each place; the last entry, place -1, is the class of all other tokens

    @classmethod
    def by_frequency(cls, common: list[tuple[bytes, int]], n_words: int) -> Classes:
        counts = np.array([c for _, c in common], np.int64)
        words = min(n_words, len(common))
        _, kind = np.unique(-np.floor(2 * np.log2(counts[words:])), return_inverse=True)
        of = np.r_[np.arange(words), words + kind]
        return cls({w: i for i, (w, _) in enumerate(common)}, counts, words, np.r_[of, of.max(initial=-1) + 1].astype(np.int64))

    @property
    def last(self) -> int:
        return int(self.of[-1])

    def share(self, n_all: int) -> np.ndarray:
        """Share of all training tokens of each class; an empty class counts as one token."""
        size = np.bincount(self.of[:-1], self.counts, self.last + 1)
        size[-1] = max(n_all - self.counts.sum(), 1)
        return size / size.sum()

    def places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Of all texts end to end: each token's place (-1: none), where each text starts, the tokens."""
        each = [tokens(t) for t in texts]
        flat = [w for words in each for w in words]
        places = np.fromiter((self.index.get(w, -1) for w in flat), np.int64, len(flat))
        return places, np.cumsum([0, *map(len, each)])[:-1], flat

    def trigrams(self, places: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of the token two before, of the one before, and of the token itself."""
        target, outside = self.of[places], self.last + 1
        near, far = np.r_[outside, target[:-1]], np.r_[outside, outside, target[:-2]][: len(target)]
        near[starts], far[starts] = outside, outside
        second = starts + 1
        second = second[(second < len(target)) & ~np.isin(second, starts)]
        far[second] = outside
        return far, near, target


def class_trigrams(training: DataFrame, classes: Classes) -> DataFrame:
    """(key, n): the counted class trigrams of all texts; a key holds the three classes in base ``last`` + 2."""
    base = classes.last + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], ["key", "n"])

        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCS):
                places, starts, _ = classes.places(as_bytes(whole.column(0).slice(at, BATCH_DOCS)))
                far, near, target = classes.trigrams(places, starts)
                held.append((far * base + near) * base + target)
                if sum(map(len, held)) > KEYS_AT_ONCE:
                    yield flush()
        if held:
            yield flush()

    return training.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def train(trigrams: DataFrame, model: LogBilinear, share: np.ndarray, rounds: int, task_trigrams: int) -> LogBilinear:
    """The model after ``rounds`` passes over the counted trigrams."""
    trigrams = checkpointed(trigrams)
    tasks = max(1, -(-trigrams.count() // task_trigrams))
    dealt = checkpointed(trigrams.repartition(tasks, "key"))
    base = model.words + 2
    schema = "n double, p array<double>"

    def one_round(state: np.ndarray, seed: int) -> np.ndarray:
        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if rows := [b for b in batches if b.num_rows]:
                key, n = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in rows]) for i in (0, 1))
                trainer = NceTrainer(model, share, seed).restore(state)
                trainer.fit(key // base // base, key // base % base, key % base, n)
                weight = float(n.sum())
                yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(trainer.state() * weight).tolist()])], ["n", "p"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, p = 0.0, 0.0
            for batch in batches:
                for i in range(batch.num_rows):
                    n += batch.column(0)[i].as_py()
                    p = p + batch.column(1)[i].values.to_numpy()
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([p.tolist()])], ["n", "p"])

        # at most sixteen sums of the model's size come to the driver, however many tasks there are
        sums = dealt.mapInArrow(fit, schema).repartition(16).mapInArrow(add, schema).collect()
        return np.sum([r.p for r in sums], axis=0) / sum(r.n for r in sums) if sums else state

    state = NceTrainer(model, share, 0).state()
    for seed in range(rounds):
        state = one_round(state, seed)
    return NceTrainer(model, share, 0).restore(state).m


def log_normalisers(docs: DataFrame, model: LogBilinear) -> np.ndarray:
    """Table of log Z by (token two before, token before)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [model.normalisers(i).astype(np.float32) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in z], pa.binary())], ["id", "z"])

    got = docs.sparkSession.range(0, model.words + 2, 1, 12).mapInArrow(rows, "id long, z binary").collect()
    return np.stack([np.frombuffer(r.z, np.float32) for r in sorted(got)])


def grouped(x: np.ndarray, weight: np.ndarray, groups: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Weighted k-means: the group of each row of ``x``, the groups' centres."""
    rng = np.random.default_rng(seed)
    groups = min(groups, len(x))
    centres = x[rng.choice(len(x), groups, replace=False, p=weight / weight.sum())].astype(np.float64)
    label = np.zeros(len(x), np.int64)
    for _ in range(20):
        label = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        mass = np.bincount(label, weight, groups)
        sums = np.stack([np.bincount(label, weight * column, groups) for column in x.T], axis=1)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centres)
    return label, centres


@dataclass
class Contexts:
    """Groups of contexts, by the class before and the one before that, and the context's side of the product."""

    near: np.ndarray  # group of each class
    far: np.ndarray
    centres: np.ndarray  # groups x d
    sides: np.ndarray | None = None  # groups x (1 + TOKEN_DIMENSIONS)

    @classmethod
    def of_model(cls, model: LogBilinear, share: np.ndarray) -> Contexts:
        weight = np.r_[share, share.min()]
        near, a = grouped(model.context * model.position[0], weight, NEAR_GROUPS)
        far, b = grouped(model.context * model.position[1], weight, FAR_GROUPS)
        return cls(near, far, (a[:, None] + b).reshape(-1, a.shape[1]))

    def groups(self, far: np.ndarray, near: np.ndarray) -> np.ndarray:
        return self.near[near] * (self.far.max() + 1) + self.far[far]

    def whiten(self, share: np.ndarray) -> None:
        """The sides: a one, then the centres' main axes, uncorrelated and of unit variance over the training contexts."""
        x = self.centres - share @ self.centres
        variance, axes = np.linalg.eigh((x * share[:, None]).T @ x)
        order = np.argsort(-variance)[:TOKEN_DIMENSIONS]
        scale = np.sqrt(np.maximum(variance[order], 1e-3 * variance.max() + 1e-30))
        side = np.zeros((len(x), 1 + TOKEN_DIMENSIONS))
        side[:, 0], side[:, 1 : 1 + len(order)] = 1, x @ axes[:, order] / scale
        self.sides = side


def grouped_counts(training: DataFrame, classes: Classes, contexts: Contexts) -> DataFrame:
    """(token, g, n): how often each token of a shared class stands in each group of contexts; a token's rows lie together."""

    groups, names = len(contexts.centres), ["token", "g", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[tuple[bytes, int]] = Counter()
        common = np.zeros(len(classes.counts) * groups, np.uint32)  # by place and group; a task's texts have fewer than 2^32 words

        def flush() -> pa.RecordBatch:
            token, g = zip(*counter, strict=True)
            out = pa.RecordBatch.from_arrays([pa.array(token, pa.binary()), pa.array(g, pa.int32()), pa.array(list(counter.values()), pa.int64())], names)
            counter.clear()
            return out

        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCS):
                places, starts, flat = classes.places(as_bytes(whole.column(0).slice(at, BATCH_DOCS)))
                far, near, _ = classes.trigrams(places, starts)
                group = contexts.groups(far, near)
                shared, rest = places >= classes.words, np.flatnonzero(places < 0)
                np.add.at(common, places[shared] * groups + group[shared], 1)
                counter.update(zip([flat[i] for i in rest.tolist()], group[rest].tolist(), strict=True))
                if len(counter) > COUNTED_AT_ONCE:
                    yield flush()
        if counter:
            yield flush()
        if len(cells := np.flatnonzero(common)):
            place, g = np.divmod(cells, groups)
            token = pa.array(list(classes.index), pa.binary()).take(pa.array(place))
            yield pa.RecordBatch.from_arrays([token, pa.array(g.astype(np.int32)), pa.array(common[cells].astype(np.int64))], names)

    rows = training.select("text").mapInArrow(count, "token binary, g int, n long")
    return rows.repartition("token").groupBy("token", "g").agg(F.sum("n").alias("n"))


def fit_tokens(n: np.ndarray, share: np.ndarray, sides: np.ndarray, steps: int = 12) -> np.ndarray:
    """The vectors of tokens that stand ``n`` (tokens x groups) times after each group of contexts.

    The noise has each token after a group as often as its own count and the
    group's share say, ``TOKEN_NOISE`` times over.  Each step goes to the
    minimum of a quadratic bound of the loss, so no step makes it larger.
    """
    n, share, sides = n.astype(np.float32), share.astype(np.float32), sides.astype(np.float32)
    noise = TOKEN_NOISE * n.sum(axis=1, keepdims=True) * share
    bound = 0.25 * (n + noise) @ (sides * sides).sum(axis=1)
    vectors = np.zeros((len(n), sides.shape[1]), np.float32)
    least_curved = (bound + TOKEN_PRIOR)[:, None]
    offset = np.float32(np.log(TOKEN_NOISE))
    for _ in range(steps):
        wrong = 0.5 + 0.5 * np.tanh(0.5 * (offset - vectors @ sides.T))  # probability that the pair is noise
        vectors += ((n * wrong - noise * (1 - wrong)) @ sides - TOKEN_PRIOR * vectors) / least_curved
    return vectors


def token_vectors(counts: DataFrame, classes: Classes, contexts: Contexts) -> DataFrame:
    """(token, place, class, c, v) of every token of a shared class; gives ``contexts`` its sides."""
    counts = checkpointed(counts)
    groups = len(contexts.centres)
    share = np.full(groups, 1e-9)
    for r in counts.groupBy("g").agg(F.sum("n").alias("n")).collect():  # a row for each group
        share[r.g] += r.n
    share /= share.sum()
    contexts.whiten(share)
    sides = contexts.sides

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                batch = whole.slice(at, 8192)
                lists = batch.column(1)
                row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
                g, times = np.divmod(lists.flatten().to_numpy(), 1 << 50)
                n = np.zeros((batch.num_rows, groups))
                n[row, g] = times
                v = fit_tokens(n, share, sides)
                place = np.array([classes.index.get(t, -1) for t in batch.column(0).to_pylist()], np.int64)
                vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32()), pa.array(v.ravel()))
                columns = [batch.column(0), pa.array(place), pa.array(classes.of[place]), pa.array(n.sum(axis=1).astype(np.int64)), vectors]
                yield pa.RecordBatch.from_arrays(columns, ["token", "place", "class", "c", "v"])

    # at most ``groups`` numbers a token, group and count in one
    lists = counts.groupBy("token").agg(F.collect_list(F.col("g") * F.lit(1 << 50) + F.col("n")).alias("gn"))
    return checkpointed(lists.mapInArrow(fit, "token binary, place long, class long, c long, v array<float>"))


def token_normalisers(vectors: DataFrame, classes: Classes, sides: np.ndarray) -> np.ndarray:
    """log Z by shared class and group of contexts; the last class has a place for unseen tokens."""
    shared, groups = classes.last + 1 - classes.words, len(sides)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = np.zeros((shared, groups))
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                batch = whole.slice(at, 8192)
                v = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
                s = np.exp(v @ sides.T) * (batch.column(1).to_numpy()[:, None] + 1.0)
                kind = batch.column(0).to_numpy() - classes.words
                for k in np.unique(kind):
                    z[k] += s[kind == k].sum(axis=0)
        k, g = np.nonzero(z)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(g), pa.array(z[k, g])], ["k", "g", "z"])

    z = np.zeros((shared, groups))
    z[-1] = 1.0
    sums = vectors.select("class", "c", "v").mapInArrow(add, "k long, g long, z double").groupBy("k", "g").agg(F.sum("z").alias("z"))
    for r in sums.collect():  # classes times groups
        z[r.k, r.g] += r.z
    return np.log(np.maximum(z, 1e-300))


def lm_scores(
    docs: DataFrame,
    modulus: int = 7,
    remainder: int = 2,
    n_words: int = 1023,
    n_common: int = 200_000,
    dimensions: int = 16,
    rounds: int = 4,
    task_trigrams: int = 1_000_000,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = docs.select("doc_id", "text")
    training = docs.where(~held_out("doc_id", modulus, remainder))
    counts = checkpointed(token_counts(training))
    n_all, v_all = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = most_frequent(counts, n_common).collect()  # n_common rows at most
    common = sorted(((bytes(r.token), r.c) for r in top), key=lambda x: (x[0] != END, -x[1], x[0]))
    classes = Classes.by_frequency(common, n_words)
    words = classes.words
    log_counts = np.append(np.log10(classes.counts + 1.0), 0.0)  # place -1: not common
    share = classes.share(n_all)

    model = train(class_trigrams(training, classes), LogBilinear.start(share, dimensions, seed=1), share, rounds, task_trigrams)
    near, far = model.tables()
    log_z = log_normalisers(docs, model)
    contexts = Contexts.of_model(model, share)
    vectors = token_vectors(grouped_counts(training, classes, contexts), classes, contexts)
    sides = contexts.sides
    log_z_token = token_normalisers(vectors, classes, sides)
    known = vectors.where("place >= 0").select("place", "v").toArrow()  # n_common rows at most
    v = np.zeros((len(common) + 1, sides.shape[1]), np.float32)  # place -1: not common
    if known.num_rows:
        v[known["place"].to_numpy()] = known["v"].combine_chunks().flatten().to_numpy().reshape(known.num_rows, -1)
    ln10 = np.log(10.0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_DOCS):
                batch = whole.slice(at, BATCH_DOCS)
                places, starts, flat = classes.places(as_bytes(batch.column(1)))
                two, one, target = classes.trigrams(places, starts)
                log_p = (near[one, target] + far[two, target] - log_z[two, one]) / ln10
                log_c = log_counts[places]
                group = contexts.groups(two, one)
                shared = np.flatnonzero(target >= words)
                in_class = np.einsum("ij,ij->i", v[places[shared]], sides[group[shared]]) - log_z_token[target[shared] - words, group[shared]]
                log_p[shared] += in_class / ln10 + log_c[shared]
                each = lambda v: np.add.reduceat(v, starts)  # noqa: B023, E731  a text has a token at least
                rest = np.flatnonzero(places < 0)
                doc = np.searchsorted(starts, rest, "right") - 1
                odd = Counter((d, flat[i], g) for d, i, g in zip(doc.tolist(), rest.tolist(), group[rest].tolist(), strict=True))
                n, m = batch.num_rows, len(odd)
                zero, none = np.zeros(m), np.zeros(m, np.int64)
                rows = row + np.arange(n)
                columns = [
                    np.r_[rows, row + np.fromiter((d for d, _, _ in odd), np.int64, m)],
                    pa.array([b"\n%d" % r for r in rows.tolist()] + [w for _, w, _ in odd], pa.binary()),
                    np.r_[np.zeros(n, np.int64), np.fromiter((g for _, _, g in odd), np.int64, m)],
                    np.r_[np.zeros(n, np.int64), np.fromiter(odd.values(), np.int64, m)],
                    pa.concat_arrays([batch.column(0).cast(pa.int64()), pa.nulls(m, pa.int64())]),
                    np.r_[each(np.ones(len(places), np.int64)), none],
                    np.r_[each((places >= 0).astype(np.int64)), none],
                    np.r_[each(log_c), zero],
                    np.r_[each(log_p), zero],
                ]
                row += n
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns], names)

    schema = "row long, token binary, g long, tf long, doc_id long, n_tokens long, n_common long, log_c double, log_p double"
    names = [x.split()[0] for x in schema.split(", ")]
    # a document's own row goes under a key that no token has, so that it needs no join of its own
    rows = docs.mapInArrow(score, schema).join(vectors.where("place < 0").select("token", "c", "v"), "token", "left")
    c = F.coalesce("c", F.lit(0))
    odd = F.col("tf") * F.log10(c + 1)
    side = [F.get(F.array(*(F.lit(float(x)) for x in column)), F.col("g").cast("int")) for column in sides.T]
    product = reduce(operator.add, (F.get("v", F.lit(j)) * x for j, x in enumerate(side)))
    in_class = F.col("tf") * F.coalesce(product, F.lit(0.0)) / float(ln10)
    by_row = rows.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_common") + F.sum(F.when(c > 0, F.col("tf")).otherwise(0))).alias("n_known"),
        (F.sum("log_c") + F.sum(odd)).alias("log_c"),
        (F.sum("log_p") + F.sum(odd + in_class)).alias("score"),
    )
    return by_row.select(
        "doc_id",
        held_out("doc_id", modulus, remainder).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("log_c") - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        "score",
    )
