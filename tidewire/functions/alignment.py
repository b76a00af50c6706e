"""How two lists of paragraphs differ, by a longest common subsequence of equal paragraphs."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of an excerpt, its mark included, if lines had to be left out.
EXCERPT = 1200


def matches(old: list[str], new: list[str]) -> list[tuple[int, int]]:
    """Pairs of places of a longest common subsequence, found over the places where equal paragraphs meet.

    Each meeting is put where the shortest of the best ends so far allows it (patience order), so the cost follows the number of
    meetings; equal beginnings and ends are taken off first.
    """
    n = 0
    while n < min(len(old), len(new)) and old[n] == new[n]:
        n += 1
    m = 0
    while m < min(len(old), len(new)) - n and old[-1 - m] == new[-1 - m]:
        m += 1
    places: dict[str, list[int]] = {}
    for j in range(len(new) - m - 1, n - 1, -1):  # from the last on, so that one old paragraph is used once
        places.setdefault(new[j], []).append(j)
    ends: list[int] = []
    tails: list[tuple] = []
    for i in range(n, len(old) - m):
        for j in places.get(old[i], ()):
            k = bisect_left(ends, j)
            link = (i, j, tails[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                tails.append(link)
            elif j < ends[k]:
                ends[k], tails[k] = j, link
    middle, link = [], tails[-1] if tails else None
    while link:
        middle.append(link[:2])
        link = link[2]
    return [(k, k) for k in range(n)] + middle[::-1] + [(len(old) - k, len(new) - k) for k in range(m, 0, -1)]


def gaps(old: list[str], new: list[str]) -> list[tuple[int, int, int, int]]:
    """The stretches between matches, old from a to b against new from c to d, one of them at least not empty."""
    out, a, c = [], 0, 0
    for i, j in [*matches(old, new), (len(old), len(new))]:
        if i > a or j > c:
            out.append((a, i, c, j))
        a, c = i + 1, j + 1
    return out


def _row(old, new) -> tuple:
    old, new = list(old), list(new)
    found, lines = gaps(old, new), []
    for a, b, c, d in found:
        if a:
            lines.append("  " + old[a - 1])
        lines += ["- " + p for p in old[a:b]] + ["+ " + p for p in new[c:d]]
        if b < len(old):
            lines.append("  " + old[b])
    text = "\n".join(lines)
    if cut := len(text) > EXCERPT:
        mark = f"[truncated at {EXCERPT} characters]"
        room = EXCERPT - len(mark) - 1
        whole = text.rfind("\n", 0, room + 1)
        text = text[: whole if whole > 0 else room] + "\n" + mark
    return sum(max(b - a, d - c) for a, b, c, d in found), sum(d - c for *_, c, d in found), sum(b - a for a, b, *_ in found), text, cut


def paragraph_diff(old: Column, new: Column) -> Column:
    """Paragraphs changed, added and removed, and an excerpt of at most EXCERPT characters, cut at a line's end."""

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_row(x, y) for x, y in zip(a, b, strict=True)], columns=["changed", "added", "removed", "excerpt", "truncated"])

    return F.pandas_udf(run, "struct<changed:int,added:int,removed:int,excerpt:string,truncated:boolean>")(old, new)
