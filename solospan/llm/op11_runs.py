"""Periodic runs of words by multi-scale minimizers, and the texts with them collapsed.

A run is a maximal stretch of words with smallest period ``q`` that is at
least ``max(6, 4 q)`` words long.  Periods up to 8 are found by direct scans at
each lag.  For longer ones there is a scale for each range of periods ``(L/2,
L]``, ``L`` a power of two: every window of ``L/2`` positions has a minimizer,
the position of its smallest hash of ``L`` words.  Inside a run the words of a
window come again one period later, so the minimizers repeat at the distance
of the period, and since ``L`` words within a run differ at every shorter
distance, the next position with an equal minimizer lies just one period on.
Each pair of consecutive equal minimizers whose distance belongs to the scale
is a seed; seeds are extended to both sides by comparing words.  Hashes only
propose: what is returned was compared word by word.

Texts are whole words' numbers in one array for each group of texts, with a
number of its own between two texts; a group is bounded by its words, a text
longer than that is a group by itself.

Defined results: a null or empty text has no words, no runs and an empty
collapsed text; repeated rows count each for itself; a null id is carried
along; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import WORD, as_bytes, crc_of_id, map_batches

SHORT_PERIODS = 8
LEAST_LENGTH, LEAST_PERIODS = 6, 4
GROUP_WORDS = 200_000
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

Run = tuple[int, int, int]  # start, end, period


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doubled(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of twice ``width`` words from those of ``width``; past the end a constant follows."""
    after = np.zeros_like(h)
    after[: len(h) - width] = h[width:]
    return mixed(h * np.uint64(0x9E3779B97F4A7C15) + mixed(after + np.uint64(1)))


def sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over all windows of ``width``, a power of two."""
    step = 1
    while step < width:
        x = pick(x[:-step], x[step:])
        step *= 2
    return x


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the smallest value of a window of ``width`` positions."""
    least = np.pad(sliding(h, width, np.minimum), width - 1)
    return np.flatnonzero(h == sliding(least, width, np.maximum))


def reach(a: np.ndarray, b: np.ndarray) -> int:
    """How many first words of ``a`` and ``b`` are equal."""
    at, size, most = 0, 64, min(len(a), len(b))
    while at < most:
        differ = np.flatnonzero(a[at : min(at + size, most)] != b[at : min(at + size, most)])
        if len(differ):
            return at + int(differ[0])
        at += size
        size *= 2
    return most


def long_enough(matches: int, period: int) -> bool:
    return matches + period >= max(LEAST_LENGTH, LEAST_PERIODS * period)


def lag_scan(words: np.ndarray, period: int) -> list[Run]:
    """Runs of ``period`` or of a divisor of it."""
    equal = np.flatnonzero(words[:-period] == words[period:])
    if not len(equal):
        return []
    cuts = np.flatnonzero(np.diff(equal) != 1)
    first, last = equal[np.r_[0, cuts + 1]], equal[np.r_[cuts, len(equal) - 1]]
    wide = last - first + 1 + period >= max(LEAST_LENGTH, LEAST_PERIODS * period)
    return [(a, b + 1 + period, period) for a, b in zip(first[wide].tolist(), last[wide].tolist(), strict=True)]


def seeded(words: np.ndarray, h: np.ndarray, scale: int) -> list[Run]:
    """Runs with a period over ``scale / 2`` and up to ``scale``; ``h`` hashes ``scale`` words."""
    at = minimizers(h, scale // 2)
    at = at[np.argsort(h[at], kind="stable")]
    gap = np.diff(at)
    near = np.flatnonzero((h[at[1:]] == h[at[:-1]]) & (gap > scale // 2) & (gap <= scale))
    runs: list[Run] = []
    period = end = -1
    for d, i in sorted(zip(gap[near].tolist(), at[near].tolist(), strict=True)):
        if d == period and i < end:
            continue  # inside the stretch that the seed before it was extended to
        after = i + reach(words[i : len(words) - d], words[i + d :])
        before = i - reach(words[:i][::-1], words[d : i + d][::-1])
        period, end = d, after
        if long_enough(after - before, d):
            runs.append((before, after + d, d))
    return runs


def find_runs(words: np.ndarray, borders: np.ndarray) -> list[Run]:
    """All runs of texts that lie one after the other; ``borders`` are the positions of the numbers between them."""
    runs = [r for q in range(1, min(SHORT_PERIODS, len(words) - 1) + 1) for r in lag_scan(words, q)]
    sizes = np.diff(borders, prepend=-1)  # with the border
    place = np.arange(len(words))
    h, width, scale = mixed(words.astype(np.uint64)), 1, 2 * SHORT_PERIODS
    while len(sizes):
        fits = sizes > LEAST_PERIODS * (scale // 2 + 1)  # texts that may hold so long a period
        if not fits.all():
            stays = np.repeat(fits, sizes)
            words, place, h, sizes = words[stays], place[stays], h[stays], sizes[fits]
        if not len(sizes):
            break
        while width < scale:
            h, width = doubled(h, width), 2 * width
        runs += [(int(place[a]), int(place[b - 1]) + 1, q) for a, b, q in seeded(words, h, scale)]
        scale *= 2
    shortest: dict[tuple[int, int], int] = {}
    for a, b, q in runs:  # a multiple of the smallest period gives the same stretch
        shortest[a, b] = min(q, shortest.get((a, b), q))
    return sorted((a, b, q) for (a, b), q in shortest.items())


def runs_of(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of every text's words, by start and period."""
    number: dict[bytes, int] = {}
    flat: list[int] = []
    borders = []
    for i, words in enumerate(texts):
        flat += [number.setdefault(w, len(number)) for w in words]
        borders.append(len(flat))
        flat.append(-1 - i)
    out: list[list[Run]] = [[] for _ in texts]
    found = find_runs(np.array(flat, np.int64), np.array(borders))
    for (a, b, q), i in zip(found, np.searchsorted(borders, [r[0] for r in found]).tolist(), strict=True):
        start = borders[i - 1] + 1 if i else 0
        out[i].append((a - start, b - start, q))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for a, b, q in runs:
            gone[a + q] += 1
            gone[b] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, its ``runs`` (start, length, period; by start, then period) and its text ``collapsed``."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs: list[list[Run]] = []
        texts: list[bytes] = []
        group: list[list[bytes]] = []
        held = 0
        for raw in [*as_bytes(batch.column(1)), None]:
            if raw is not None:
                group.append(raw.split())  # at the six ASCII blanks
                held += len(group[-1])
            if group and (raw is None or held >= GROUP_WORDS):
                found = runs_of(group)
                texts += [collapsed(w, r) for w, r in zip(group, found, strict=True)]
                runs += found
                group, held = [], 0
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        listed = [[{"start": a, "length": b - a, "period": q} for a, b, q in r] for r in runs]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, kind), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])

    return map_batches(docs.select("doc_id", text), f, f"doc_id long, runs {RUNS}, collapsed string")


def with_planted_period(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text; if crc32 of the id is divisible by 10, with its tail replaced by a repetition.

    With h = crc32, g = floor(h / 10) and n words, each word i >= a = g % n
    becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).  A row
    without an id stays as it is.
    """
    h = crc_of_id(doc_id)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def planted(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        at = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(at, lambda i: F.get(w, i.cast("int"))), " ")

    once = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, F.get(once, F.lit(0))).otherwise(F.col(text))


def run_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length / period and the digests of all runs and of the collapsed text.

    ``docs`` has the columns of :func:`periodic_runs`; equal exponents go to
    the smallest start, then period.  No run: four nulls.
    """
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")

    def greater(best: Column, r: Column) -> Column:
        more = r["length"] * best["period"] > best["length"] * r["period"]
        return F.when(best.isNull() | more, r).otherwise(best)

    best = F.aggregate("runs", none, greater)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    found = docs.select("doc_id", "runs", "collapsed", best.alias("best"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_run_digests(docs: DataFrame) -> DataFrame:
    """:func:`run_digests` of the documents' words with the planted periods."""
    return run_digests(periodic_runs(docs.select("doc_id", with_planted_period().alias("text"))))
