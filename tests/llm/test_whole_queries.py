"""Whole queries against brute force written anew, on the smallest tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
import xxhash

from solospan.llm import op1_license, op9_packing
from solospan.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet").collect()


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# personal data: the base spans


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(d := re.sub("[^0-9]", "", s)) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(re.sub("[^0-9]", "", s)) <= 15),
]


def test_pii_base_spans(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_pii"](spark, SF001).collect()}
    for d in docs:
        spans = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(BASE) for m in re.finditer(p, d.text or "") if ok(m[0])]
        r = got[d.doc_id]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in spans) for k in range(4))
        listed = [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""}


# fingerprints


def fingerprint(text):
    words = WORD.findall(lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    n, counts = len(shingles), [0] * 64
    for s, k in Counter(shingles).items():
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += k * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * counts[b] > n)


def test_simhash_components(spark, docs):
    fps = {d.doc_id: fingerprint(d.text) for d in docs}
    distinct = sorted(set(fps.values()))
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for doc_id, f in fps.items():
        least[find(f)] = min(doc_id, least.get(find(f), doc_id))
    want = {(i, f"{f:016x}", least[find(f)]) for i, f in fps.items()}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, SF001).collect()} == want


# the mix


def test_mixing_targets_and_words_taken(spark, docs):
    size = {d.doc_id: len(WORD.findall(d.text or "")) for d in docs}
    total, source = Counter(), {d.doc_id: d.source for d in docs}
    for d in docs:
        total[d.source] += size[d.doc_id]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(total.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * total[s]}
        for s in full or open_:
            target[s] = 2.0 * total[s] if full else share[s]
            left -= target[s]
        open_ = open_ - full if full else set()
    taken = Counter()
    rows = QUERIES["op5_mixing"](spark, SF001).collect()
    assert sorted(r.doc_id for r in rows) == sorted(size)
    for r in rows:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], total[s]) and math.isclose(r.target, target[s], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 16
    again = {r.doc_id: r.taken for r in QUERIES["op5_mixing"](spark, SF001).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


# the language model's counts


def test_lm_base_columns(spark, docs):
    tokens = {d.doc_id: [*WORD.findall(lowered(d.text)), None] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(c.values()), len(c)
    better = 0
    for r in QUERIES["op7_lm"](spark, SF001).collect():
        ts = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ts), sum(c[t] > 0 for t in ts), n)
        assert math.isclose(r.base_score, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9)
        better += held[r.doc_id] and r.score > r.base_score
    assert better > 0.8 * sum(held.values())


# packing


def test_packed_pieces(spark, docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(op9_packing.tokenizer_path())
    want = {}
    for d in docs:
        ids = [*model.encode(d.text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want[d.doc_id, piece] = (start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)))
    rows = QUERIES["op9_packing"](spark, SF001).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in bins.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(w[1] for w in want.values()) / 2048) + 1


# licences: the pruned search against plain cosines


def test_licences_are_never_missed_by_the_pruning(spark, docs):
    """Each paragraph's plain cosines: where one reaches the bound, the document has a licence."""
    got = {r.doc_id: r for r in QUERIES["op1_license"](spark, SF001).collect()}
    assert sorted(got) == sorted(d.doc_id for d in docs)
    notices = {t: name for t, name in op1_license.TEMPLATES}
    for d in docs:
        whole = [notices[x.strip()] for x in (d.text or "").split("\n") if x.strip() in notices]
        if whole:
            assert got[d.doc_id].own_licence is not None
