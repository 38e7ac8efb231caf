"""Periodic runs, conversation repair and token counts against brute force, on the tables and on odd inputs."""

import functools
import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from solospan.llm import op11_runs, op12_repair, op13_tokens
from solospan.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, runs string, collapsed string, n_tokens string, best string"


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns, ids with a planted period (crc32 divisible by 10)."""
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:12]
    rows = [(1000, None), (1001, ""), (1001, ""), (None, "x y " * 9), (None, None), (1002, "\x1c  a\x0bb"), (1003, "word " * 30_000), (1004, "a b c a b c a b c a b c a")]
    rows += [(i, None if i % 4 == 0 else " ".join(f"w{(i * j * j) % 97}" for j in range(i % 60))) for i in planted]
    rows += [(1005, "é" * 3000 + "▁x <s> </s>\n\n\t\r\n  y" + " " * 700)]
    return spark.createDataFrame([(*r, "c", "c", "c", "c", "c") for r in rows], ODD)


# runs


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def run_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w) if n < 5000 else [(0, n, 1)]
    best = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    shape = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shape, sha(lines), sha(kept))


def test_runs_of_random_words():
    rnd = random.Random(11)
    for _ in range(60):
        texts = []
        for _ in range(rnd.randint(1, 6)):
            k, w = rnd.choice([1, 2, 3, 60]), []
            for _ in range(rnd.randint(0, 5)):
                base = [b"%d" % rnd.randrange(k) for _ in range(rnd.randint(1, rnd.choice([3, 20, 90])))]
                w += (base * 7)[: rnd.randint(1, 400)]
            texts.append(w)
        assert op11_runs.runs_of(texts) == [brute_runs(w) for w in texts]


@pytest.mark.parametrize("q", [1, 2, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 127, 300])
def test_every_period_at_its_least_length(q):
    rnd = random.Random(q)
    noise = lambda n: [b"n%d" % rnd.randrange(10**9) for _ in range(n)]
    base = [b"x"] * (q - 1) + [b"y"]  # the smallest period is q though shorter ones nearly hold
    for n, found in ((max(6, 4 * q) - 1, 0), (max(6, 4 * q), 1)):
        words = [*noise(50), *(base * 6)[:n], *noise(50)]
        runs = [r for r in op11_runs.runs_of([noise(5), words, words])[1] if r[2] == q]
        assert runs == [(50, 50 + n, q)] * found


def test_run_query_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op11_runs"](spark, SF001).collect()))
    assert got == sorted(run_row(*d) for d in docs)
    assert sum(r[1] for r in got) > 0


def test_runs_of_odd_tables(spark):
    d = odd_documents(spark)
    got = sorted(map(tuple, op11_runs.planted_run_digests(d).collect()), key=repr)
    assert got == sorted((run_row(r.doc_id, r.text) for r in d.collect()), key=repr)
    assert op11_runs.planted_run_digests(d.limit(0)).count() == 0
    row = op11_runs.periodic_runs(d.where("doc_id = 1004")).first()
    assert [tuple(r) for r in row.runs] == [(0, 13, 3)] and row.collapsed == "a b c"


# conversations


def repair_brute(rows):
    """(cost, audit, repaired rows) of the cheapest edits, least audit first, by plain recursion over prefixes."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @functools.cache
    def best(i, state, put):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            role, text, must, late = rows[i]
            c, a, r = best(i + 1, state, 0)
            options.append((c + 3, "D" + a, r))
            if not must:
                initial = role[:1]
                if (initial == "s" and state == "") or initial == after[state]:
                    c, a, r = best(i + 1, initial, 0)
                    options.append((c + late, "K" + a, ((role, text), *r)))
                c, a, r = best(i + 1, after[state], 0)
                options.append((c + 2 + late, "R" + a, ((name[after[state]], text), *r)))
        if put < 3:
            c, a, r = best(i, after[state], put + 1)
            options.append((c + 2, "I" + a, ((name[after[state]], ""), *r)))
        return min(options, key=lambda o: o[:2], default=(10**9, "", ()))

    return best(0, "", 0)


def conversation_row(conv_id, rows):
    space = lambda v: " " if v is None else v
    out = []
    for turn, role, text in rows:
        role, text = space(role), space(text)
        kind = zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64]))
    seen, faults, steps = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
    for _, role, text in out:
        solid = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        steps.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
    turns = [t for t, _, _ in out if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(out, out[1:]))
    cost, audit, repaired = repair_brute(tuple(steps))
    return (conv_id, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())


def by_conversation(rows):
    groups = {}
    for conv_id, turn, role, text in rows:
        groups.setdefault(conv_id, []).append((turn, role, text))
    return sorted((conversation_row(c, g) for c, g in groups.items()), key=repr)


def test_repair_query_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, QUERIES["op12_repair"](spark, SF001).collect()), key=repr)
    assert got == by_conversation(rows)


def test_repair_of_odd_conversations(spark):
    rnd = random.Random(12)
    roles, texts = ["system", "user", "assistant", "tool", "", "s", "USER", None], ["Hi.", "so", "Yes! \n", " \x0b", "", None, "?", "é…", "x" * 70 + "a.", "x" * 70 + "b."]
    rows = [(c if c else None, rnd.choice([None, *range(12)]), rnd.choice(roles), rnd.choice(texts)) for c in range(60) for _ in range(rnd.randint(1, 14))]
    rows = list({(r[0], r[1], r[2] or " ", (r[3] or " ")[:64]): r for r in rows}.values())  # no ties that the order leaves open
    rows += rows[::9]  # repeated rows
    rows += [(100 + i, i, "user", "Gone.") for i in range(200)]  # single rows, some of them dropped
    table = spark.createDataFrame([(*r, "c", 1) for r in rows], "conv_id long, turn long, role string, text string, code string, phase long").repartition(5)
    got = sorted(map(tuple, op12_repair.repair_digests(op12_repair.damaged(table)).collect()), key=repr)
    assert got == by_conversation(rows)
    assert any(r[7] == "" for r in got)
    assert op12_repair.repair_digests(op12_repair.damaged(table.limit(0))).count() == 0


def test_repair_of_a_long_conversation(spark):
    rnd = random.Random(13)
    rows = [(7, i, rnd.choice(["user", "assistant", "assistant", "system"]), rnd.choice([f"No. {i}.", f"cut {i}", "Again.", ""])) for i in range(700)]
    rows += [(8, 0, "user", "Hi.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(map(tuple, op12_repair.repair_digests(op12_repair.damaged(table)).collect()), key=repr)
    assert got == by_conversation(rows)
    edits = op12_repair.repaired_rows(op12_repair.damaged(table)).where("conv_id = 7").collect()
    assert [e.place for e in edits] == list(range(len(edits))) and "".join(e.edit for e in edits) == got[0][7]
    kept = "".join(e.role[0] for e in edits if e.role)
    assert re.fullmatch("(s?(ua)+)?", kept)


# tokens


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=op13_tokens.model_path())


def test_tokens_equal_the_library():
    model, rnd = library(), random.Random(14)
    pieces = [model.id_to_piece(i).replace("▁", " ") for i in range(259, model.vocab_size())]
    texts = ["", " ", "  a  b ", "<s> x </s><unk>", "x▁y", "\x00a", " " * 900, "w" * 3000, "ab" * 2000, "</s>" * 400, "\r" * 300 + "\n" * 90, "é" * 777, " \r" * 200]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 12))) for _ in range(2000)]
    texts += ["".join(chr(rnd.choice([rnd.randint(1, 300), rnd.randint(1, 0xD7FF), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(20)) for _ in range(1500)]
    texts += ["".join(rnd.choice("ab. \n▁()/*;'\r") for _ in range(rnd.randint(1, 200))) for _ in range(1500)]
    counter = op13_tokens.TokenCounter(op13_tokens.model_path(), cached=2000)
    got = [n for i in range(0, len(texts), 500) for n in counter.count(texts[i : i + 500])]
    assert got == [len(x) for x in model.encode(texts, num_threads=1)]


def test_several_places_merge_only_as_far_as_one_by_one():
    """Pieces whose ranks do not rise along the merges, against merging one pair at a time."""
    rnd = random.Random(15)
    for _ in range(150):
        pieces = {c: -float(i) for i, c in enumerate("abc")}
        grown = list(pieces)
        for _ in range(rnd.randint(2, 14)):
            grown.append(rnd.choice(grown) + rnd.choice(grown))
        scores = {p: -float(s) for p, s in zip(dict.fromkeys(grown), rnd.sample(range(100), len(dict.fromkeys(grown))))}
        if rnd.random() < 0.3:
            scores = {p: -1.0 if p.strip("a") == "" and len(p) > 1 else s for p, s in scores.items()}
        merges = op13_tokens.Merges(scores)
        texts = ["".join(rnd.choice("aaabcd") for _ in range(rnd.randint(1, 40))) for _ in range(20)]

        def one_by_one(text):
            s = list(text)
            while pairs := [(-scores[a + b], i) for i, (a, b) in enumerate(zip(s, s[1:])) if a + b in scores]:
                i = min(pairs)[1]
                s[i : i + 2] = [s[i] + s[i + 1]]
            return len(s)

        assert merges.survivors(texts).tolist() == [one_by_one(t) for t in texts]


def test_token_query_and_odd_tables(spark):
    model = library()
    want = lambda rows: sorted(((r.doc_id, len((r.text or "").encode()), n := len(model.encode(r.text or "")), n > 4096) for r in rows), key=repr)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert sorted(map(tuple, QUERIES["op13_tokens"](spark, SF001).collect()), key=repr) == want(docs.collect())
    d = odd_documents(spark)
    got = op13_tokens.token_counts(d)
    assert sorted(map(tuple, got.collect()), key=repr) == want(d.collect()) and any(r.over_limit for r in got.collect())
    assert op13_tokens.token_counts(d.limit(0)).count() == 0
