"""The training-data operators against brute force, on odd and small inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from solospan.llm import op1_license, op2_pii, op3_topk, op4_simhash, op5_mixing, op6_quality, op7_lm, op8_ann, op9_packing, op10_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _fp string, size string"
SF001 = "/root/testdata/sf0.001"


def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns that clash with the operators' own."""
    rows = [(1, "a b c d", "en", "s", 7), (1, "a b c d", "en", "s", 7), (2, None, None, None, None), (3, "", "en", None, 0), (None, "x y", "en", "s", 3)]
    rows += [(4, "word " * 30_000, "en", "t", 150_000), (5, "mail a@b.co or 10.1.2.3.", "en", "", 24), (6, "\x1c  ", "en", "t", 3), (7, "a b c d", "en", "s", 7)]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


QUERIES = {
    "op1": lambda s, d, l: op1_license.scan_licences(op1_license.document_paths(d)),
    "op2": lambda s, d, l: op2_pii.find_pii(d),
    "op4": lambda s, d, l: op4_simhash.simhash_components(d),
    "op5": lambda s, d, l: op5_mixing.mix_sources(d),
    "op6": lambda s, d, l: op6_quality.quality_scores(d, l),
    "op7": lambda s, d, l: op7_lm.lm_scores(d, rounds=1),
    "op9": lambda s, d, l: op9_packing.pack_documents(d),
    "op10": lambda s, d, l: op10_toxicity.toxicity_scores(d, l),
}


@pytest.mark.parametrize("name", QUERIES)
def test_odd_and_empty_tables(spark, name):
    d = odd_documents(spark)
    l = labels(spark, [(1, 1, 0), (2, None, None), (4, 0, 1), (None, 1, 1), (99, 0, 0)])
    out = QUERIES[name](spark, d, l).collect()
    ids = sorted((r.doc_id for r in out if name != "op9" or r.piece == 0), key=str)
    assert ids == sorted([1, 1, 2, 3, None, 4, 5, 6, 7], key=str)
    assert QUERIES[name](spark, d.limit(0), l.limit(0)).count() == 0


def test_stage_forms_on_odd_tables(spark):
    """Columns of any name come back with their own values."""
    odd = ["_fp", "size", "root", "component_id", "_cands", "_null", "_base", "_all", "_rest", "_m0", "_p1", "_chosen", "_src", "_hash", "row", "c0", "c2", "taken"]
    d = odd_documents(spark).drop("_fp", "size")
    d = d.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in odd])

    def whole(df):
        rows = df.collect()
        assert df.columns == d.columns
        assert all(r[c] == f"{c}:{'none' if r.doc_id is None else r.doc_id}" for r in rows for c in odd)
        return rows

    kept = whole(op4_simhash.drop_near_duplicates(d))
    assert sorted((r.doc_id for r in kept), key=str) == [1, 2, 4, 5, 6, None]  # 3 is empty like 2, 7 and a repeat equal 1
    redacted = {r.doc_id: r for r in whole(op2_pii.redact(d))}
    assert redacted[5].text == "mail [EMAIL] or [IP]." and redacted[5].n_chars == 21 and redacted[2].text is None
    assert len(whole(op6_quality.keep_quality(d, labels(spark, [])))) == d.count()
    assert all(r.text for r in whole(op5_mixing.mixed_documents(d)))
    for stage in (op4_simhash.drop_near_duplicates, op2_pii.redact, op5_mixing.mixed_documents):
        assert stage(d.limit(0)).count() == 0 and stage(d.limit(0)).columns == d.columns


def test_simhash_links_by_brute_force(spark):
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = {f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for f in base for _ in range(30)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = op4_simhash.fingerprint_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, block_rows=16)
    roots = {r.node: r.root for r in op4_simhash.components(links).collect()}
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in signed:
        for b in signed:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {f: roots.get(f, f) for f in signed} == {f: find(f) for f in signed}


@pytest.mark.parametrize("text", ["", "One", "one TWO", "ÄÖ b\tC d\n\x0bb c d" * 50, "a b c " * 70_000])
def test_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles[:1000] if len(shingles) <= 1000] or [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0
    assert op4_simhash.fingerprint(text.encode()) == want


def test_pii_spans(spark):
    text = "x a.b@c.de._f@g.hi! 1.2.3.256 1.2.3.4.5 4539 1488 0343 6467, 4539148803436468 +1 (234) 555-0000 name [at] host [dot] org " + "9" * 30_000 + " " + "w" * 60_000
    row = op2_pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    at = lambda s, skip=0: (text.index(s, skip), text.index(s, skip) + len(s))
    spans = [(*at("a.b@c.de."[:-1]), "email"), (*at("._f@g.hi"), "email"), (*at("1.2.3.4"), "ip"), (*at("+1 (234) 555-0000"), "phone")]
    base = [s for s in row.spans.split(",") if "name" not in s]
    for a, b, kind in spans:
        assert f"{kind}:{a}:{b}" in base
    assert (row.n_email, row.n_ip, row.n_phone) == (2, 1, 1)
    listed = [s for s in base if not s.endswith(str(at("name [at] host [dot] org")[1]))]
    assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()


def test_bare_telephone_numbers(spark):
    texts = [f"ring +1 ({i:03}) 555-{i:04} now" for i in range(60)]  # matches inside base spans, wrong by the strict check
    texts += [f"ring (212) 555-{i:04} now" for i in range(12)] + [f"ring (112) 555-{i:04} now" for i in range(30)]
    rows = [(i, t) for i, t in enumerate(texts)]
    out = {r.doc_id: r for r in op2_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].spans.split(":")[0] for i in range(60)] == ["phone"] * 60 and out[0].n_phone == 1
    assert [out[i].spans for i in range(60, 72)] == ["phone:5:19"] * 12
    assert [out[i].spans for i in range(72, 102)] == [""] * 30


def test_short_addresses_and_unbracketed_mail(spark):
    right = {"2001:db8::1": "ip", "fe80::1": "ip", "::1": "ip", "fe80::": "ip", "2001:db8:0:0:1:0:0:1": "ip", "name at host dot org": "email", "a.b AT mail dot host DOT com": "email"}
    wrong = ["std::dec", "dead::beef", "add::", "a :: b", "12:30:45:10", "look at the dot on top"]
    rows = [(i, f", {t}, and so on") for i, t in enumerate([*right, *wrong])]
    out = {r.doc_id: r.spans for r in op2_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i] for i in range(len(right))] == [f"{k}:2:{2 + len(t)}" for t, k in right.items()]
    assert [out[len(right) + i] for i in range(len(wrong))] == [""] * len(wrong)


def test_sainte_lague(spark):
    rnd = random.Random(6)
    for _ in range(4):
        weights = [rnd.choice([0, 1, 7, rnd.random() * 50]) for _ in range(rnd.randint(1, 12))]
        seats = rnd.randint(0, 60)
        won = [0] * len(weights)
        if sum(weights):
            for _ in range(seats):
                best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
                won[best] += 1
        df = spark.createDataFrame([("g", i, float(w), seats) for i, w in enumerate(weights)], "g string, k long, w double, s long")
        got = {r.k: r.won for r in op5_mixing.sainte_lague(df, "w", "s", "k", ["g"]).collect()}
        assert [got[i] for i in range(len(weights))] == won


def test_packing_is_gapless_and_tight():
    rnd = random.Random(9)
    lengths = [rnd.randint(1, 2048) if rnd.random() < 0.2 else rnd.randint(1, 600) for _ in range(3000)]
    bins = op9_packing.pack(lengths, 2048)
    assert sorted(i for b in bins for i in b) == list(range(3000))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in bins)
    assert len(bins) <= -(-sum(lengths) // 2048) + 2


def test_best_two_goes_on_past_a_single_piece():
    rows = [[] for _ in range(11)]
    rows[5], rows[4], rows[3] = [0], [1], [2]
    assert op9_packing.best_two(1 << 5 | 1 << 4 | 1 << 3, 10, 6, rows) == (5, 4)
    assert op9_packing.best_two(1 << 5 | 1 << 4 | 1 << 3, 10, 6, [*rows[:5], [0, 3], *rows[6:]]) == (5, 5)
    rnd = random.Random(9)
    for _ in range(200):
        bins = op9_packing.pack(lengths := [rnd.randint(1, 20) for _ in range(30)], 20)
        assert sorted(i for b in bins for i in b) == list(range(30)) and all(sum(lengths[i] for i in b) <= 20 for b in bins)


def test_word_encoder_equals_the_tokenizer():
    rnd = random.Random(3)
    alphabet = "abzÀéß'’–,.!?<|>019AŹ̸ \t\n\x0b\x1c\xa0İΣς🙂_-="
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["x<|endoftext|>y, <|ENDOFTEXT|>z", "H̱ don't! a'b's,'re", "w" * 300]
    encoder = op9_packing.WordEncoder(op9_packing.tokenizer_path())
    got = [list(np.frombuffer(b, "<u4")) for b in encoder.encode([t.encode() for t in texts])]
    assert got == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_top_k_and_neighbours_by_brute_force(spark):
    rng = np.random.default_rng(1)
    x = np.floor(rng.standard_normal((600, 8)) * 20) / 16
    x[100:300] = x[100]  # many equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [1.0, None] + [0.0] * 6), (1002, [float("nan")] * 8), (1003, [1.0]), (700, [0.0] * 8)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    scaled = np.floor(1024 * x)
    ids = np.arange(600)
    got = {}
    for r in op3_topk.exact_top_k(table, k=10, query_modulus=50, block_rows=128, group_rows=4).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    all_ids, all_x = np.r_[ids, 700], np.r_[scaled, np.zeros((1, 8))]
    for q in range(0, 600, 50):
        s = all_x @ scaled[q]
        order = [i for i in np.lexsort((all_ids, -s)) if all_ids[i] != q][:10]
        assert [got[q][n + 1] for n in range(10)] == [(all_ids[i], s[i]) for i in order]
    found = op8_ann.nearest(table, k=20, query_modulus=20, parts=4, block_rows=100).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 600, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(by[q] & set(np.lexsort((ids, -s))[:20].tolist()))
    assert hits / (20 * 30) >= 0.9 and max(r.rank for r in found) == 20
    for f in (op3_topk.exact_top_k, op8_ann.nearest):
        assert f(table.limit(0)).count() == 0
        assert f(table.where("vec_id = 0")).count() == 0  # no candidate but the query itself


def test_top_k_keeps_large_components(spark):
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((300, 8)) * 2.0 ** rng.integers(0, 13, (300, 1)) * 1024) / 1024
    x[40:60] = np.round(rng.standard_normal((20, 8)) * 2e5) + 0.25  # scores beyond 2^53
    x[60:70] = x[50]
    x[60:70, 0] += np.arange(10) / 1024  # that differ less than doubles show
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    scaled = [[int(c) for c in np.floor(1024 * v)] for v in x]
    got = {}
    for r in op3_topk.exact_top_k(table, k=10, query_modulus=10, block_rows=64, group_rows=4, cells=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 300, 10):
        best = sorted((-sum(a * b for a, b in zip(scaled[q], v, strict=True)), i) for i, v in enumerate(scaled) if i != q)[:10]
        assert sorted(got[q]) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert max(s for rows in got.values() for _, _, s in rows) > 2**53
    a, b = [2.0**62, -3.0, 1.0], [[1.0, 1.0, 1.0], [4.0, 0.0, 0.0], [-(2.0**62), 5.0, 1.0], [1.5, 1.0, 0.0]]
    assert op3_topk.integer_scores(np.array(a), np.array(b[:3])).tolist() == [2**62 - 2, op3_topk.BIGGEST, -op3_topk.BIGGEST]
    huge = spark.createDataFrame([(0, [2.0**30]), (1, [2.0**30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit BIGINT"):  # 2^80
        op3_topk.exact_top_k(huge).collect()


def test_classifiers_on_held_out_rows(spark):
    docs, known = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r for r in known.collect()}
    for scores, label, modulus, remainder in ((op6_quality.quality_scores, "quality", 3, 1), (op10_toxicity.toxicity_scores, "toxic", 5, 0)):
        rows = scores(docs, known).collect()
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == remainder) and 0 <= r.score <= 1 for r in rows)
        tested = [r for r in rows if r.doc_id in truth and r.held_out]
        assert sum(r.predicted == truth[r.doc_id][label] for r in tested) / len(tested) >= 0.85


def test_counterfactual_penalty_evens_out_identity_terms():
    # word 0 is an insult; groups 1 and 2 are named in neutral texts, but insults mostly name group 1
    rows = [[0, 1]] * 40 + [[0]] * 10 + [[1]] * 10 + [[2]] * 40 + [[]] * 20
    y = np.array([1.0] * 50 + [0.0] * 70)
    gap = lambda penalty: abs(np.diff(op10_toxicity.fit_weights(rows, y, {1: (2,), 2: (1,)}, 3, penalty)[2:4])[0])
    assert gap(10.0) < 0.2 * gap(0.0)


def test_language_model_sums_to_one_and_beats_the_base(spark):
    rnd = random.Random(2)
    docs = [(i, " ".join(f"{'xy'[i % 2]}{rnd.randint(0, 30)}" for _ in range(60))) for i in range(400)]
    rows = op7_lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string"), n_words=20).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    share = np.full(21, 1 / 21)
    model = op7_lm.LogBilinear.start(share, 4, 1)
    near, far = model.tables()
    for before in (0, 21):
        z = model.normalisers(before)
        assert np.allclose(np.exp(near + far[before] - z[:, None]).sum(axis=1), 1, atol=1e-5)


def test_language_model_scores_by_brute_force(spark):
    """Untrained classes, fitted tokens: every text's score from plain loops; the probabilities of a context add up to one."""
    rnd = random.Random(7)
    docs = [(i, " ".join(f"{'xy'[i % 2]}{int(rnd.paretovariate(0.7))}" for _ in range(1 + i % 40))) for i in range(300)]
    got = op7_lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string"), n_words=8, n_common=60, rounds=0).collect()
    texts = {i: op7_lm.tokens(t.encode()) for i, t in docs}
    training = [texts[i] for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in training for w in t)
    step = {w: math.floor(math.log2(c) * 64) for w, c in counts.items()}
    least = min(s for s in set(step.values()) if sum(x >= s for x in step.values()) <= 60)
    common = sorted(((w, c) for w, c in counts.items() if step[w] >= least), key=lambda x: (x[0] != op7_lm.END, -x[1], x[0]))
    classes = op7_lm.Classes.by_frequency(common, 8)
    assert 8 < len(common) < len(counts) and classes.last > 9
    share = classes.share(sum(counts.values()))
    model = op7_lm.LogBilinear.start(share, 16, seed=1)
    contexts = op7_lm.Contexts.of_model(model, share)
    of = lambda w: int(classes.of[classes.index.get(w, -1)])
    groups = len(contexts.centres)

    def places(text):
        cls = [classes.last + 1] * 2 + [of(w) for w in text]
        return [(w, cls[i], cls[i + 1], cls[i + 2], int(contexts.groups(np.array(cls[i]), np.array(cls[i + 1])))) for i, w in enumerate(text)]

    n = {w: np.zeros(groups) for w in counts if of(w) >= 8}
    for t in training:
        for w, _, _, c, g in places(t):
            if c >= 8:
                n[w][g] += 1
    total = sum(n.values()) + 1e-9
    contexts.whiten(total / total.sum())
    mass = {w: (counts[w] + 1) * np.exp(op7_lm.fit_tokens(n[w][None], total / total.sum(), contexts.sides)[0].astype(float) @ contexts.sides.T) for w in n}
    z = {c: sum((m for w, m in mass.items() if of(w) == c), np.full(groups, float(c == classes.last))) for c in range(8, classes.last + 1)}

    def probability(w, two, one, c, g):
        near, far = model.tables()
        scores = near[one] + far[two]
        p = math.exp(scores[c]) / np.exp(scores).sum()
        return p if c < 8 else p * mass.get(w, np.ones(groups))[g] / z[c][g]

    _, two, one, _, g = places(training[5])[-1]
    assert math.isclose(sum(probability(w, two, one, of(w), g) for w in [*counts, b"unseen token"]), 1, rel_tol=1e-5)
    for r in got[::5]:
        want = sum(math.log10(probability(*x)) for x in places(texts[r.doc_id]))
        assert math.isclose(r.score, want, rel_tol=1e-4, abs_tol=1e-4)


def test_licences_and_inheritance(spark):
    mit = "Released under the MIT License."
    files = [(1, "a/LICENSE", mit), (2, "a/b/x.txt", "one two three"), (3, "a/b/y.txt", f"one\n{mit}\ntwo " + "filler " * 50), (4, "c/z.txt", "none here"), (5, None, "none")]
    files += [(6, "a/b/d/NOTICE", "All rights reserved."), (7, "a/b/d/e/f.txt", "four five"), (8, "top.txt", "six")]
    out = {r.doc_id: r for r in op1_license.scan_licences(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert (out[2].licence, out[2].inherited_from) == ("MIT", "a")
    assert (out[3].own_licence, out[3].is_file) == ("MIT", False)
    assert (out[7].licence, out[7].inherited_from) == ("Proprietary", "a/b/d")
    assert out[4].licence is None and out[5].licence is None and out[8].licence is None


def test_licence_notices_inside_lines_and_before_code(spark):
    rnd = random.Random(5)
    filler = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    notices = {text: name for name, text in op1_license.TEMPLATES}
    files = [(i, f"d{i}/x.txt", f"{filler(60)} {text} {filler(60)}") for i, text in enumerate(notices)]
    wrapped = [t for t, name in notices.items() if name in ("AGPL-3.0", "LGPL-3.0")]
    for i, text in enumerate(wrapped):
        words = text.split()
        lines = ["# " + " ".join(words[n : n + 9]) for n in range(0, len(words), 9)] + [f"x{n} = f{n}(y, {n})" for n in range(12)]
        files.append((100 + i, f"c{i}/x.py", "\n".join(lines)))
    files += [(200 + i, f"e{i}/x.txt", filler(300)) for i in range(60)]
    out = {r.doc_id: r.own_licence for r in op1_license.scan_licences(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert [out[i] for i in range(len(notices))] == list(notices.values())
    assert [out[100 + i] for i in range(len(wrapped))] == [notices[t] for t in wrapped]
    assert not any(out[200 + i] for i in range(60))
