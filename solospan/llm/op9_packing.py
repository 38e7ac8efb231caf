"""Best-two-fit packing of tokenised documents into sequences.

Documents are tokenised batch by batch; ids of a word do not depend on the
words around it (the tokenizer's splits never cross white space), so a worker
process encodes each distinct word once, keeps it for its later tasks as far as
the caches reach, and joins the words' ids.  Pieces are dealt at
random to shards of about ``shard_pieces``, and each shard is packed by itself,
which costs at most about one part-filled sequence a shard.  In a shard a
sequence is filled greedily, largest piece first and then always the largest
that fits.  Then its smallest piece is put back as long as two unpacked pieces
fit the gap so expanded more tightly.

Defined results: a null or empty text is the closing id alone (one token);
only documents of more than ``capacity`` tokens are cut; repeated rows are
packed each for itself; a null id is carried along; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import as_bytes, checkpointed, kept_in_worker

TOKENIZER = "word_bpe_49k.json"
CACHED_WORDS, CACHED_PARTS = 700_000, 1_200_000
LONGEST_CACHED = 64
TOGETHER = 2000  # parts that are encoded as one text
#: No token of the pre-tokenizer holds a letter and then another ASCII sign, so a word may be cut there.
CUT = re.compile(r"(?<=[A-Za-z])(?=[!-/:-@\[-`{-~])")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts as little-endian 32-bit bytes, word by word with bounded caches of words and their parts."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS, cached_parts: int = CACHED_PARTS):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.most_words, self.most_parts = cached_words, cached_parts
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end what the tokenizer's splits leave whole
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    def _cut(words: list[bytes]) -> list[list[str]]:
        """Each word's parts that are tokenised by themselves; ASCII words in lower case, as the tokenizer folds them anyway."""
        special = {i for i, w in enumerate(words) if b"<|" in w}  # may hold a special token: stays whole
        folded = [w.lower() if w.isascii() and i not in special else w for i, w in enumerate(words)]
        joined = b"\n".join(folded).decode("utf-8", "replace")
        cut = [c.split(" ") for c in CUT.sub(" ", joined).split("\n")]  # no word has a blank
        for i in special:
            cut[i] = [words[i].decode("utf-8", "replace")]
        return cut

    def _encode_parts(self, parts: list[str]) -> dict[str, bytes]:
        """Parts of letters only are encoded many at a time: each ends with a token that ends a word."""
        out: dict[str, bytes] = {}
        letters = [p for p in parts if p.isalpha()]
        others = [p for p in parts if not p.isalpha()]
        groups = [letters[i : i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4")
            at = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(at) != len(group):  # a sign that is no letter for the tokenizer
                others += group
                continue
            raw = ids.tobytes()
            out.update(zip(group, [raw[m:n] for m, n in zip([0, *at], at, strict=False)], strict=True))
        encoded = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
        out.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(others, encoded, strict=True))
        return out

    def _encode(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        cut = self._cut(words)
        new = list(set().union(*cut).difference(self.parts))
        here = self._encode_parts(new)
        if len(self.parts) > self.most_parts:
            here.update((p, self.parts[p]) for parts in cut for p in parts if p in self.parts)
            self.parts.clear()
        self.parts.update(here)
        known = self.parts
        out = [known[parts[0]] if len(parts) == 1 else b"".join([known[p] for p in parts]) for parts in cut]
        for p in [p for p in new if len(p) > LONGEST_CACHED]:
            del self.parts[p]
        return out

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        if len(self.words) > self.most_words:
            self.words.clear()
        split = [t.split() for t in texts]  # at the six ASCII blanks
        new = list(set().union(*split).difference(self.words))
        here = dict(zip(new, self._encode(new), strict=True))
        self.words.update(here)
        known = self.words
        for words in split:
            yield b"".join([known[w] for w in words])
        for w in [w for w in new if len(w) > LONGEST_CACHED]:
            del self.words[w]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame, capacity: int = 2048, path: str | None = None, batch_rows: int = 500, cached: tuple[int, int] = (CACHED_WORDS, CACHED_PARTS), kept: bool = True
) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of the pieces of every document (doc_id, text)."""

    def of_batch(batch: pa.RecordBatch, encoder: WordEncoder) -> pa.RecordBatch:
        out: list[tuple] = []
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(as_bytes(batch.column(1))), strict=True):
            ids += b"\0\0\0\0"
            for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[start : start + 4 * capacity]
                out.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = path or tokenizer_path()
        make = lambda: WordEncoder(model, *cached)
        encoder = kept_in_worker(("op9", model, cached), make) if kept else make()
        gc.disable()  # nothing here makes cycles, and the caches are long to look through
        try:
            for whole in batches:
                for at in range(0, whole.num_rows, batch_rows):
                    yield of_batch(whole.slice(at, batch_rows), encoder)
        finally:
            gc.enable()

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def best_two(unpacked: int, room: int, least: int, rows: list[list[int]]) -> tuple[int, int] | None:
    """Two unpacked lengths of the largest sum over ``least`` and at most ``room``; ``unpacked`` has a bit for each length.

    ``rows`` are the pieces of each length; one is returned twice only if it has two.
    """
    best, found = least, None
    a = (unpacked & ((1 << room) - 1)).bit_length() - 1
    while a > 0 and 2 * a > best:
        b = (unpacked & ((1 << (min(a - (len(rows[a]) < 2), room - a) + 1)) - 1)).bit_length() - 1
        if b > 0 and a + b > best:
            best, found = a + b, (a, b)
            if best == room:
                break
        a = (unpacked & ((1 << a) - 1)).bit_length() - 1
    return found


def pack(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of row numbers; every length is from 1 to ``capacity``."""
    rows: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, n in enumerate(lengths):
        rows[n].append(i)
    unpacked = sum(1 << n for n in range(1, capacity + 1) if rows[n])

    def out(n: int) -> int:
        nonlocal unpacked
        i = rows[n].pop()
        if not rows[n]:
            unpacked ^= 1 << n
        return i

    def back(n: int, i: int) -> None:
        nonlocal unpacked
        rows[n].append(i)
        unpacked |= 1 << n

    bins = []
    while unpacked:
        first = unpacked.bit_length() - 1
        inside, room = [(first, out(first))], capacity - first
        while n := (unpacked & ((1 << (room + 1)) - 1)).bit_length() - 1 if unpacked & ((1 << (room + 1)) - 1) else 0:
            inside.append((n, out(n)))
            room -= n
        while room and len(inside) > 1:
            least, i = inside[-1]  # greedy filling ends with the smallest
            pair = best_two(unpacked, room + least, least, rows)
            if not pair:
                break
            inside[-1:] = [(n, out(n)) for n in pair]
            back(least, i)
            room += least - sum(pair)
            inside.sort(reverse=True)
        bins.append([i for _, i in inside])
    return bins


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    path: str | None = None,
    shard_pieces: int = 16384,
    cached: tuple[int, int] = (CACHED_WORDS, CACHED_PARTS),
    kept: bool = True,
) -> DataFrame:
    """The pieces of ``docs`` with their sequence_id and offset.

    ``cached`` words and parts trade a worker's memory for time; ``kept`` keeps
    them in the worker for its later tasks, also those of other jobs.
    """
    cut = checkpointed(pieces(docs, capacity, path, cached=cached, kept=kept))
    shards = max(1, -(-cut.count() // shard_pieces))

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        lengths = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k, inside in enumerate(pack(lengths.tolist(), capacity)):
            sequence[inside] = (int(rows["shard"].iloc[0]) << 32) + k
            offset[inside] = np.cumsum(lengths[inside]) - lengths[inside]
        return rows.drop(columns="shard").assign(sequence_id=sequence, offset=offset)

    # the checkpoint fixes the rows' numbers; they only spread the pieces
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(pack_shard, PIECES + ", sequence_id long, offset long")
