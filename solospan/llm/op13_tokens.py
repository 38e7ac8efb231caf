"""Token counts by rank-synchronous merging over ragged arrays.

A text is cut into pre-tokens that no merge can cross: a run of word marks
(the blanks of the text) with the signs behind it, up to the next blank or to
a sign that is in no longer piece.  The new distinct pre-tokens of a batch are
held as one ragged numpy array of symbols.  In each round every sequence finds
its lowest-rank pair and all sequences merge theirs at once; the symbols that
survive are the tokens, a sign outside the vocabulary counts its UTF-8 bytes.

The vocabulary ranks pieces, not pairs, so a merge may create a pair of a
*better* rank.  A sequence therefore merges several places of its lowest rank
in one round only up to the first that creates a pair of the same or a better
rank, which keeps the one-by-one order (best rank, then leftmost) exactly.
Pieces of equal rank (runs of word marks) are settled from left to right with
a stack when nothing else is left to merge.

Counts of pre-tokens are kept in the worker process in a bounded table.

Defined results: a null or empty text has no bytes and no tokens; special
strings in a text are ordinary text; whole texts of any length are counted;
repeated rows count each for itself; a null id is carried along; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import kept_in_worker, map_batches

MODEL = "piece_bpe_32k.model"
MARK = "▁"  # stands for a blank; one more is put before the text
NONE = np.int32(2**31 - 1)  # the rank of a pair that is no piece
CACHED, LONGEST_CACHED = 400_000, 64
SLICE_CHARACTERS = 4_000_000  # texts of a batch that are cut at a time


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Merges:
    """The pairs of symbols that form a piece, with their ranks (0 is merged first)."""

    def __init__(self, scores: dict[str, float]):
        pieces = sorted(scores, key=lambda p: -scores[p])
        self.id = {p: i for i, p in enumerate(pieces)}
        steps = np.array([scores[p] for p in pieces])
        ranks = np.searchsorted(np.unique(-steps), -steps)  # pieces of one score share a rank
        self.n = len(pieces)
        pairs = []
        for piece, whole in self.id.items():
            for cut in range(1, len(piece)):
                if (a := self.id.get(piece[:cut])) is not None and (b := self.id.get(piece[cut:])) is not None:
                    pairs.append((a * self.n + b, whole))
        pairs.sort()
        self.keys = np.array([k for k, _ in pairs] + [2**62], np.int64)
        self.whole = np.array([w for _, w in pairs] + [0], np.int32)
        self.rank = np.r_[ranks[self.whole[:-1]], NONE].astype(np.int32)
        self.of_sign = np.full(0x110000, -1, np.int32)
        for piece, i in self.id.items():
            if len(piece) == 1:
                self.of_sign[ord(piece)] = i
        # ranks that several pieces share, if their pieces form no part of any other piece
        shared = np.bincount(ranks, minlength=self.n) > 1
        parts = [(x, w) for k, w in zip(self.keys[:-1].tolist(), self.whole.tolist(), strict=False) for x in divmod(k, self.n)]
        open_ranks = {int(ranks[x]) for x, w in parts if shared[ranks[x]] and ranks[w] != ranks[x]}
        self.settled = shared.copy()
        self.settled[list(open_ranks)] = False
        longer = set("".join(p for p in pieces if len(p) > 1))
        self.alone = "".join(c for c in "\n\t" if c not in longer)  # no merge goes across these

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair."""
        key = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.n + right)
        at = np.searchsorted(self.keys, key)
        found = self.keys[at] == key
        return np.where(found, self.rank[at], NONE), self.whole[at]

    def settle(self, symbols: list[int]) -> int:
        """Symbols left where only pairs of one shared rank can merge, leftmost first."""
        pair = {}

        def whole(a: int, b: int) -> int:
            if (a, b) not in pair:
                rank, merged = self.look(np.array([a]), np.array([b]))
                pair[a, b] = int(merged[0]) if rank[0] != NONE else -1
            return pair[a, b]

        stack: list[int] = []
        for s in symbols:
            stack.append(s)
            while len(stack) > 1 and (w := whole(stack[-2], stack[-1])) >= 0:
                stack[-2:] = [w]
        return len(stack)

    def survivors(self, sequences: list[str]) -> np.ndarray:
        """Number of tokens of every sequence (none is empty)."""
        signs = np.frombuffer("".join(sequences).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(s) for s in sequences])
        row = np.repeat(np.arange(len(sequences)), sizes)
        sym = self.of_sign[signs]
        spelled = 1 + (signs > 0x7F).astype(np.int64) + (signs > 0x7FF) + (signs > 0xFFFF)
        out = np.bincount(row, np.where(sym < 0, spelled - 1, 0), len(sequences)).astype(np.int64)

        def ranks_at(at: np.ndarray) -> np.ndarray:
            inside = at + 1 < len(sym)
            inside[inside] = row[at[inside]] == row[at[inside] + 1]
            ranks = np.full(len(at), NONE, np.int32)
            ranks[inside] = self.look(sym[at[inside]], sym[at[inside] + 1])[0]
            return ranks

        rank = ranks_at(np.arange(len(sym)))
        while len(sym):
            first = np.r_[0, np.flatnonzero(row[1:] != row[:-1]) + 1]
            size = np.diff(first, append=len(sym))
            least = np.minimum.reduceat(rank, first)
            live = least != NONE
            out[row[first[~live]]] += size[~live]
            live_at = np.flatnonzero(live)
            for i in live_at[self.settled[least[live_at]]]:
                out[row[first[i]]] += self.settle(sym[first[i] : first[i] + size[i]].tolist())
                live[i] = False
            if not live.all():
                stays = np.repeat(live, size)
                sym, row, rank, least, size = sym[stays], row[stays], rank[stays], least[live], size[live]
                if not len(sym):
                    break
            take = np.flatnonzero(rank == np.repeat(least, size))
            n = np.arange(len(take))
            chain = np.maximum.accumulate(np.where(np.r_[True, take[1:] != take[:-1] + 1], n, 0))
            take = take[(n - chain) % 2 == 0]  # of overlapping places every second one, from the left
            r, merged = self.look(sym[take], sym[take + 1])

            # pairs that a merge creates, with its left neighbour merged and its right one not yet
            created = np.full(len(take), NONE, np.int32)
            right = take + 2 < len(sym)
            right[right] = row[take[right]] == row[take[right] + 2]
            created[right] = self.look(merged[right], sym[take[right] + 2])[0]
            left = take > 0
            left[left] = row[take[left]] == row[take[left] - 1]
            beside = np.where(np.r_[False, take[1:] == take[:-1] + 2], np.r_[0, merged[:-1]], sym[take - 1])
            created[left] = np.minimum(created[left], self.look(beside[left], merged[left])[0])
            if (better := created <= r).any():
                before = np.cumsum(better) - better
                own = row[take]
                start = np.maximum.accumulate(np.where(np.r_[True, own[1:] != own[:-1]], np.arange(len(take)), 0))
                keep = before == before[start]
                take, merged = take[keep], merged[keep]

            sym[take] = merged
            gone = np.zeros(len(sym), bool)
            gone[take + 1] = True
            sym, row, rank = sym[~gone], row[~gone], rank[~gone]
            at = take - np.arange(len(take))
            beside_merged = np.zeros(len(sym), bool)
            beside_merged[at] = beside_merged[np.maximum(at - 1, 0)] = True
            touched = np.flatnonzero(beside_merged)
            rank[touched] = ranks_at(touched)
        return out


class TokenCounter:
    """Token counts of texts, with a bounded table of the counts of pre-tokens."""

    def __init__(self, path: str, cached: int = CACHED):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.vocab_size())
        plain = [i for i in ids if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
        self.merges = Merges({model.id_to_piece(i): model.get_score(i) for i in plain})
        alone = re.escape(self.merges.alone)
        self.cut: Callable[[str], list[str]] = re.compile(rf"{MARK}+[^{MARK}{alone}]*|[{alone}]|[^{MARK}{alone}]+" if alone else f"{MARK}+[^{MARK}]*").findall
        self.counts: dict[str, int] = {}
        self.cached = cached

    def count(self, texts: list[str]) -> list[int]:
        cut = [self.cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.counts))
        if len(self.counts) + len(new) > self.cached:
            self.counts.clear()
            new = list(set().union(*cut))
        if new:
            self.counts.update(zip(new, self.merges.survivors(new).tolist(), strict=True))
        totals = [sum(map(self.counts.__getitem__, pieces)) for pieces in cut]
        for piece in new:
            if len(piece) > LONGEST_CACHED:
                del self.counts[piece]
        return totals


def token_counts(docs: DataFrame, limit: int = 4096, path: str | None = None, cached: int = CACHED) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every document (doc_id, text)."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = path or model_path()
        counter = kept_in_worker(("op13", model, cached), lambda: TokenCounter(model, cached))
        texts = batch.column(1)
        parts = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False)) // SLICE_CHARACTERS
        at = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), batch.num_rows]
        n: list[int] = []
        for a, b in zip(at, at[1:], strict=False):
            n += counter.count(texts.slice(a, b - a).to_pylist())
        sizes = pc.cast(pc.binary_length(texts), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(texts, count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
