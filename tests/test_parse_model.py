"""Randomised check of the text parser against a plain Python model of the
acceptance rule (split that drops trailing empty fields, trim of characters
<= U+0020, signed decimal octets 0..255, overflow rejected)."""

import random

from solospan.sources.text import parse_range_lines

LONG_MAX = 2**63 - 1


def split_dropping_trailing(s: str, sep: str) -> list[str]:
    if sep not in s:
        return [s]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def trim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 0x20:
        i += 1
    while j > i and ord(s[j - 1]) <= 0x20:
        j -= 1
    return s[i:j]


def parse_long(s: str):
    body = s[1:] if s[:1] in "+-" else s
    if not body or not all("0" <= c <= "9" for c in body):
        return None
    v = int(s)
    return v if -LONG_MAX - 1 <= v <= LONG_MAX else None


def address(s: str):
    octets = split_dropping_trailing(trim(s), ".")
    if len(octets) != 4:
        return None
    vals = [parse_long(o) for o in octets]
    if any(v is None or not 0 <= v <= 255 for v in vals):
        return None
    return vals[0] * 16777216 + vals[1] * 65536 + vals[2] * 256 + vals[3]


def model(line: str):
    fields = split_dropping_trailing(line, ",")
    if len(fields) != 2:
        return (None, None, "malformed")
    b, e = address(fields[0]), address(fields[1])
    if b is None or e is None:
        return (None, None, "malformed")
    return (b, e, "reversed" if b > e else None)


def random_octet(rnd):
    return rnd.choice(
        [str(rnd.randint(0, 255)), str(rnd.randint(0, 300)), "0" + str(rnd.randint(0, 99)), "+" + str(rnd.randint(0, 255)),
         "-0", "-" + str(rnd.randint(1, 9)), "", " 1", "9" * rnd.randint(18, 21), "x", "1 "]
        + [str(rnd.randint(0, 255))] * 80
    )


def random_address(rnd):
    n = rnd.choice([4] * 30 + [3, 5])
    a = ".".join(random_octet(rnd) for _ in range(n))
    return rnd.choice(["", " ", "\t", "\r"]) + a + rnd.choice(["", ".", "..", " ", "\t", " ."])


def random_line(rnd):
    parts = [random_address(rnd) for _ in range(rnd.choice([2] * 12 + [1, 3]))]
    line = rnd.choice([",", ", ", " ,"]).join(parts)
    return rnd.choice(["", ",", ",,"]) and line + rnd.choice(["", ",", ",,", ", "]) or line


def test_parser_matches_model_on_random_lines(spark):
    rnd = random.Random(1234)
    lines = [random_line(rnd) for _ in range(4000)] + ["", ",", ",,", "1.2.3.4", ".", "1.2.3.4,", ",1.2.3.4"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = {r.i: (r.begin, r.end, r.reason) for r in parse_range_lines(df).collect()}
    bad = [(lines[i], got[i], model(lines[i])) for i in range(len(lines)) if got[i] != model(lines[i])]
    assert not bad, bad[:10]
    kinds = {model(l)[2] for l in lines}
    assert kinds == {None, "malformed", "reversed"}
