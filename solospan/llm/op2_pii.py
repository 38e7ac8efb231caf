"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

High-recall generators (patterns) propose spans in every whole text.  The four
base kinds are those of the contract: a match that passes its check is always a
span.  Further generators propose spans that the base patterns cannot see:
e-mail addresses in words ("name [at] host [dot] org", also without brackets),
telephone numbers without a country code, and IPv6 addresses (also compressed
ones such as "::1" and "fe80::").

Each candidate of these has a vector of small integer features: its format
(digits, separators, checksum, octets, first and last characters, area code
and exchange, colons) and its context (the characters on either side, telling
words before it).  There are no labelled spans to learn from, so a candidate's
label is whether it passes its generator's strict check, which sees the whole
match.  Candidates that overlap a base span can never be added and are not
learned from.  The others with equal features and label are counted together
by Spark over all documents; each generator has trees of its own, boosted on
its counts, whose number is bounded by the feature bins, and the lowest
threshold at which the share of right ones among the selected is at least
``PRECISION``.  Selected candidates that overlap no base span and no better
candidate are added.

All work on texts is DataFrame expressions; the trees become CASE expressions.
Patterns are written so that matching is linear in the text: runs are
possessive, and a run is only tried from its start.

Defined results: a null text counts as empty; an empty text has no spans and
the hash of the empty string; repeated rows are treated each for itself; null
ids are carried along; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import checkpointed, plain_names

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
_FULL_IP6 = rf"^(?:{_HEX}:){{7}}{_HEX}$"
#: With fewer than three runs of colons it needs a digit: "add::" and "dead::beef" may be code.
_SHORT_IP6 = r"^(?=.*[0-9]|(?:[^:]*:+){3})[0-9A-Fa-f:]*::[0-9A-Fa-f:]*$"
_DETERMINED = r"(?i)\x20at\x20(?:an?|the|this|that|each|every|one|any|no|some|my|your|his|her|its|our|their)\x20dot\x20"
#: (kind, pattern, strict check of a match as a pattern or None); the first four are the base kinds.
GENERATORS = (
    ("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++", None),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", None),
    (
        "email",
        rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20?[\[({{]\x20?(?i:at)\x20?[\])}}]\x20?[A-Za-z0-9-]++(?:\x20?[\[({{]\x20?(?i:dot)\x20?[\])}}]\x20?[A-Za-z0-9-]++)++"
        rf"|(?<![{_LOCAL}])[{_LOCAL}]++\x20(?i:at)\x20[A-Za-z0-9-]++(?:\x20(?i:dot)\x20[A-Za-z0-9-]++)++",
        rf"^(?!.*{_DETERMINED}).*[A-Za-z]{{2,}}$",
    ),
    ("phone", r"(?<![0-9A-Za-z+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])", r"^\(?[2-9]"),
    (
        "ip",
        rf"(?<![0-9A-Fa-f:])(?:{_HEX}::?){{3,7}}{_HEX}(?![0-9A-Fa-f:])"
        rf"|(?<![\w:])(?=[0-9A-Fa-f]|::[0-9A-Fa-f])(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?(?![\w:])",
        f"{_FULL_IP6}|{_SHORT_IP6}",
    ),
)
BASE = 4
#: What a text must hold for a generator to match; spares the scan.
NEEDS = (("@",), (".",), (), ("+",), (), (), (":",))
CONTEXT = r"(?i)(?:e-?mail|mail|contact|phone|tel|call|fax|mobile|card|visa|account|pay|ip|host|server|addr)\W{0,3}(?:is|no|number)?\W{0,3}$"
BEFORE = 24
TREES, RATE, PRECISION = 20, 0.4, 0.9


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _bin(n: Column, *edges: int) -> Column:
    """The number of edges that are at most n."""
    return reduce(add, ((n >= e).cast("int") for e in edges))


def _char_class(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}\p{N}]"), 2).otherwise(3)


def _check(g: int, match: Column) -> Column:
    """Whether the whole match passes the generator's strict check."""
    kind, _, pattern = GENERATORS[g]
    if pattern:
        return match.rlike(pattern)
    digits = _digits(match)
    if kind == "card":
        return F.char_length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


#: Bins of each feature, the generator first.
BINS = (len(GENERATORS), 6, 2, 2, 4, 4, 3, 2, 4, 4, 3)


def _form(g: int, match: Column) -> Column:
    """What the strict check looks at: area code and exchange of a telephone number, colons of an address, "at the dot"."""
    if GENERATORS[g][0] == "phone":
        return F.when(~match.rlike(r"^\(?[2-9]"), 0).when(~match.rlike(r"^\(?[0-9]{3}[\x20).-]{1,2}[2-9]"), 1).otherwise(2)
    if GENERATORS[g][0] == "ip":
        return F.when(match.rlike(_SHORT_IP6), 1).when(match.rlike(_FULL_IP6), 2).otherwise(0)
    return F.when(match.rlike(_DETERMINED), 0).otherwise(1)


def _features(g: int, match: Column, before: Column, after: Column) -> Column:
    digits = _digits(match)
    n = F.char_length(digits)
    first = F.substring(match, 1, 1)
    return F.array(
        F.lit(g),
        _bin(n, 1, 9, 12, 16, 20),
        F.call_function("luhn_check", digits).cast("int"),
        match.rlike(GENERATORS[1][2]).cast("int"),
        _bin(F.char_length(F.regexp_replace(match, "[A-Za-z0-9]", "")), 1, 3, 5),
        F.when(first == "+", 0).when(first == "(", 1).when(first.rlike("[0-9]"), 2).otherwise(3),
        _bin(F.char_length(F.regexp_extract(match, "[A-Za-z]*$", 0)), 2, 5),
        before.rlike(CONTEXT).cast("int"),
        _char_class(F.right(before, F.lit(1))),
        _char_class(F.substring(after, 1, 1)),
        _form(g, match),
    )


def with_candidates(df: DataFrame) -> DataFrame:
    """``df`` (text, not null) and ``_cands``: an array of (start, g, end, ok, f) of all candidates."""
    for g, (_, pattern, _) in enumerate(GENERATORS):
        found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if NEEDS[g]:
            found = F.when(reduce(Column.__or__, (F.contains("text", F.lit(x)) for x in NEEDS[g])), found)
        df = df.withColumn(f"_m{g}", found)
    names = [f"_m{g}" for g in range(len(GENERATORS))]
    split = {f"_p{g}": F.when(F.size(f"_m{g}") > 0, F.split("text", GENERATORS[g][1], -1)) for g in range(len(GENERATORS))}
    df = df.withColumns(split)
    kind = "array<struct<start:int,g:int,end:int,ok:boolean,f:array<int>>>"

    def spans_of(g: int) -> Column:
        matches, rest = F.col(f"_m{g}"), F.col(f"_p{g}")
        steps = F.arrays_zip(matches.alias("m"), F.slice(rest, F.lit(1), F.size(matches)).alias("b"), F.slice(rest, F.lit(2), F.size(matches)).alias("a"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.char_length(x["b"])
            end = start + F.char_length(x["m"])
            one = F.struct(
                start.alias("start"),
                F.lit(g).alias("g"),
                end.alias("end"),
                _check(g, x["m"]).alias("ok"),
                (_features(g, x["m"], F.right(x["b"], F.lit(BEFORE)), x["a"]) if g >= BASE else F.array().cast("array<int>")).alias("f"),
            )
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
        return F.when(F.size(matches) > 0, F.aggregate(steps, zero, step)["out"]).otherwise(F.array().cast(kind))

    return df.withColumn("_cands", F.concat(*map(spans_of, range(len(GENERATORS))))).drop(*names, *split)


class BoostedTrees:
    """Trees of depth two on binned features, boosted for logistic loss with Newton steps on counted rows."""

    def __init__(self, x: np.ndarray, right: np.ndarray, wrong: np.ndarray):
        self.trees: list[tuple] = []
        n = right + wrong
        self.base = float(np.log((right.sum() + 1) / (wrong.sum() + 1)))
        margin = np.full(len(x), self.base)
        for _ in range(TREES if len(x) else 0):
            p = 1 / (1 + np.exp(-margin))
            gradient, weight = right - n * p, n * p * (1 - p)
            tree = self._grow(x, gradient, weight, np.ones(len(x), bool), 2)
            self.trees.append(tree)
            margin += self._value(tree, x)

    @staticmethod
    def _grow(x: np.ndarray, gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, depth: int) -> tuple:
        def leaf(r: np.ndarray) -> float:
            return gradient[r].sum() ** 2 / (weight[r].sum() + 1)

        best, found = 1e-9, None
        for j in range(x.shape[1]) if depth else ():
            for cut in range(1, BINS[j]):
                right = rows & (x[:, j] >= cut)
                left = rows & ~right
                if right.any() and left.any() and (gain := leaf(left) + leaf(right) - leaf(rows)) > best:
                    best, found = gain, (j, cut, left, right)
        if not found:
            return (float(RATE * gradient[rows].sum() / (weight[rows].sum() + 1)),)
        j, cut, left, right = found
        return (j, cut, BoostedTrees._grow(x, gradient, weight, left, depth - 1), BoostedTrees._grow(x, gradient, weight, right, depth - 1))

    @staticmethod
    def _value(tree: tuple, x: np.ndarray) -> np.ndarray:
        if len(tree) == 1:
            return np.full(len(x), tree[0])
        j, cut, low, high = tree
        return np.where(x[:, j] >= cut, BoostedTrees._value(high, x), BoostedTrees._value(low, x))

    def margins(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((self._value(t, x) for t in self.trees), np.zeros(len(x)))

    def column(self, f: Column) -> Column:
        """The margin as an expression of a feature array."""

        def value(tree: tuple) -> Column:
            if len(tree) == 1:
                return F.lit(tree[0])
            j, cut, low, high = tree
            return F.when(f[j] >= cut, value(high)).otherwise(value(low))

        return reduce(add, map(value, self.trees), F.lit(self.base))


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def fit(candidates: DataFrame) -> tuple[dict[int, BoostedTrees], list[float]]:
    """Each further generator's trees and all thresholds on the margin, from the ``_cands`` of all documents that could be added."""
    free = F.filter("_cands", lambda c: (c["g"] >= BASE) & ~F.exists("_cands", lambda b: (b["g"] < BASE) & b["ok"] & _overlap(b, c)))
    one = candidates.select(F.explode(free).alias("c")).groupBy("c.f").agg(F.sum(F.col("c.ok").cast("long")), F.sum((~F.col("c.ok")).cast("long")))
    counted = one.collect()  # a row for each combination of bins at most, whatever the input
    x = np.array([r[0] for r in counted], np.int64).reshape(-1, len(BINS))
    right, wrong = (np.array([r[i] for r in counted], float) for i in (1, 2))
    trees, thresholds = {}, [0.0] * BASE
    for g in range(BASE, len(GENERATORS)):
        mine = np.flatnonzero(x[:, 0] == g)
        trees[g] = BoostedTrees(x[mine], right[mine], wrong[mine])
        margins = trees[g].margins(x[mine])
        threshold = float("inf") if len(mine) else 0.0
        for m in np.unique(margins)[::-1]:
            chosen = mine[margins >= m]
            if right[chosen].sum() >= PRECISION * (right[chosen] + wrong[chosen]).sum():
                threshold = float(m) - 1e-9
        thresholds.append(threshold)
    return trees, thresholds


def _spans(trees: dict[int, BoostedTrees], thresholds: list[float]) -> dict[str, Column]:
    """``_base`` and ``_all``: sorted arrays of (start, kind number, end), from ``_cands``."""
    kind = F.array(*(F.lit(KINDS.index(k)) for k, _, _ in GENERATORS))

    def plain(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), kind[c["g"]].alias("kind"), c["end"].alias("end"))

    base = F.array_sort(F.transform(F.filter("_cands", lambda c: (c["g"] < BASE) & c["ok"]), plain))
    limit = F.array(*(F.lit(t) for t in thresholds))
    further = F.filter("_cands", lambda c: (c["g"] >= BASE))
    score = lambda c: F.coalesce(*(F.when(c["g"] == g, t.column(c["f"])) for g, t in trees.items()))
    scored = F.transform(further, lambda c: F.struct(score(c).alias("score"), c.alias("c")))
    chosen = F.filter(scored, lambda s: (s["score"] >= limit[s["c"]["g"]]) & ~F.exists("_base", lambda b: _overlap(b, s["c"])))

    def better(s: Column, o: Column) -> Column:
        rank = lambda v: F.struct(v["score"], v["c"]["end"] - v["c"]["start"], -v["c"]["start"], -v["c"]["g"])
        return _overlap(o["c"], s["c"]) & (rank(o) > rank(s))

    added = F.transform(F.filter("_chosen", lambda s: ~F.exists("_chosen", lambda o: better(s, o))), lambda s: plain(s["c"]))
    return {"_base": base, "_chosen": chosen, "_all": F.array_sort(F.concat("_base", added))}


def with_spans(df: DataFrame, trees: dict[int, BoostedTrees], thresholds: list[float]) -> DataFrame:
    for name, column in _spans(trees, thresholds).items():
        df = df.withColumn(name, column)
    return df.drop("_chosen", "_cands")


def _joined(spans: str) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256 and spans (see the module's contract)."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    candidates = checkpointed(with_candidates(texts).drop("text"))
    spans = with_spans(candidates, *fit(candidates))

    def count(k: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return spans.select("doc_id", *map(count, range(len(KINDS))), F.sha2(_joined("_base").cast("binary"), 256).alias("base_sha256"), _joined("_all").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets; overlapping spans become one, of the first's kind.

    Null texts stay null, empty ones empty; ``n_chars`` follows a changed text;
    repeated rows are changed alike.  All other columns come back as they are,
    whatever their names; an empty table stays empty.
    """
    plain = plain_names(docs, "text", "n_chars")
    known = plain.withColumn("_null", F.col("text").isNull()).withColumn("text", F.coalesce("text", F.lit("")))
    trees, thresholds = fit(with_candidates(known.select("text")))
    spans = with_spans(with_candidates(known), trees, thresholds)
    kinds = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        more = F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]), kinds[s["kind"]]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, more).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate("_all", zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.char_length("text"))))
    text = F.when(~F.col("_null"), F.when(F.size("_all") > 0, done).otherwise(F.col("text")))
    n_chars = F.when(F.size("_all") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    out = spans.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", n_chars)  # of the changed text
    return out.select(*plain.columns).toDF(*docs.columns)
