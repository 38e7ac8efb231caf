"""Per-point brute force models used as test oracles."""

from __future__ import annotations

import random
from collections import defaultdict


def exclusive_brute(ranges):
    """ranges: list of (set_id, begin, end) -> sorted list of exclusive parts.

    For every point, the ranges containing it; a point contained by exactly
    one range belongs to that range's exclusive part; consecutive points of
    the same range form one part."""
    by_set = defaultdict(list)
    for i, (s, b, e) in enumerate(ranges):
        by_set[s].append((i, b, e))
    out = []
    for s, rs in by_set.items():
        owner = {}
        cover = defaultdict(int)
        for i, b, e in rs:
            for p in range(b, e + 1):
                cover[p] += 1
                owner[p] = i
        pts = sorted(p for p, c in cover.items() if c == 1)
        start = prev = None
        for p in pts:
            if start is not None and p == prev + 1 and owner[p] == owner[prev]:
                prev = p
                continue
            if start is not None:
                out.append((s, start, prev))
            start = prev = p
        if start is not None:
            out.append((s, start, prev))
    return sorted(out)


def merge_brute(parts):
    out = []
    for s, b, e in sorted(parts):
        if out and out[-1][0] == s and out[-1][2] + 1 == b:
            out[-1] = (s, out[-1][1], e)
        else:
            out.append((s, b, e))
    return out


def depth_brute(ranges):
    """(set_id, point) -> number of ranges containing the point."""
    d = defaultdict(int)
    for s, b, e in ranges:
        for p in range(b, e + 1):
            d[(s, p)] += 1
    return d


def tiny_sets(seed: int, n_sets: int = 300, domain: int = 40, max_ranges: int = 7):
    """Many small sets on a tiny domain: duplicates, single points, touching."""
    rnd = random.Random(seed)
    rows = []
    for s in range(n_sets):
        for _ in range(rnd.randint(0, max_ranges)):
            b = rnd.randint(0, domain)
            kind = rnd.random()
            if kind < 0.25:
                e = b
            else:
                e = min(domain, b + rnd.randint(0, 12))
            rows.append((s, b, e))
            if rnd.random() < 0.1:
                rows.append((s, b, e))  # exact duplicate
    return rows


def big_sets(seed: int):
    """A few large sets (to force buckets), one of them clustered so that a
    level-1 cell is dense, plus small sets."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(400):  # set 1000: spread
        b = rnd.randint(0, 3000)
        rows.append((1000, b, b + rnd.randint(0, 15)))
    for _ in range(500):  # set 1001: clustered near 0, two far ranges
        b = rnd.randint(0, 120)
        rows.append((1001, b, b + rnd.randint(0, 6)))
    rows += [(1001, 100000, 100004), (1001, 100003, 100010), (1001, 100011, 100011)]
    rows += tiny_sets(seed + 1, n_sets=40)
    return rows
