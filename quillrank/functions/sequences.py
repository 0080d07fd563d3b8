"""Arrow functions for what only sequence alignment can answer."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Hashable, Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import small


def steps(ref: list[str], hyp: list[str], order: str = "MSDI") -> list[tuple[str, str | None, str | None]]:
    """Cheapest edit steps from ref to hyp, read back from the end in the preference of `order`.

    Rows of the table are filled with vector operations: an insertion run is a running minimum.
    """
    n, m = len(ref), len(hyp)
    ids: dict[str, int] = {}
    h = np.array([ids.setdefault(w, len(ids)) for w in hyp], np.int64)
    j = np.arange(m + 1)
    table = np.zeros((n + 1, m + 1), np.int32)
    table[0] = j
    for i, w in enumerate(ref, 1):
        row = np.empty(m + 1, np.int64)
        row[0] = i
        row[1:] = np.minimum(table[i - 1, 1:] + 1, table[i - 1, :-1] + (h != ids.get(w, -1)))
        table[i] = np.minimum.accumulate(row - j) + j
    out, i, j = [], n, m
    while i or j:
        d = table[i, j]
        for op in order:
            if op == "M" and i and j and ref[i - 1] == hyp[j - 1] and table[i - 1, j - 1] == d:
                out.append(("H", ref[i - 1], hyp[j - 1]))
                i, j = i - 1, j - 1
                break
            if op == "S" and i and j and ref[i - 1] != hyp[j - 1] and table[i - 1, j - 1] + 1 == d:
                out.append(("S", ref[i - 1], hyp[j - 1]))
                i, j = i - 1, j - 1
                break
            if op == "D" and i and table[i - 1, j] + 1 == d:
                out.append(("D", ref[i - 1], None))
                i -= 1
                break
            if op == "I" and j and table[i, j - 1] + 1 == d:
                out.append(("I", None, hyp[j - 1]))
                j -= 1
                break
    return out[::-1]


STEPS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("op", "ref", "hyp")]))


@small
@F.pandas_udf(STEPS)
def edit_steps(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([[{"op": o, "ref": r, "hyp": h} for o, r, h in steps(list(x), list(y))] if x is not None and y is not None else None for x, y in zip(a, b)])


def ratio(junk: bool, words: bool):
    """SequenceMatcher ratio of words or characters: 1 for two empty texts, 0 for one."""

    @small
    @F.pandas_udf(T.DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        cut = str.split if words else list
        out = []
        for x, y in zip(a, b):
            x, y = cut(x or ""), cut(y or "")
            out.append(1.0 if not x and not y else 0.0 if not x or not y else SequenceMatcher(None, x, y, autojunk=junk).ratio())
        return pd.Series(out, dtype="float64")

    return run


def char_ratio(a: str, b: str, deep: int = 32, most: int = 1 << 24) -> float:
    """SequenceMatcher(None, a, b, autojunk=False).ratio(), the same number in about a tenth of the time.

    ends[k] has, by position of a, a bit for each position of b at which k equal characters in a row end; a block looks
    its longest match up there, first in a, then in b. A match of `deep` characters and more, of which a text can have
    few, and pairs over `most` cells are left to SequenceMatcher.
    """
    n, m = len(a), len(b)
    if a == b:
        return 1.0
    if not n or not m:
        return 0.0
    if n * m > most:
        return SequenceMatcher(None, a, b, autojunk=False).ratio()
    marks: dict[str, int] = {}
    for j, ch in enumerate(b):
        marks[ch] = marks.get(ch, 0) | 1 << j
    own = [marks.get(ch, 0) for ch in a]
    ends = [{}, {i: x for i, x in enumerate(own) if x}]
    while ends[-1] and len(ends) <= deep:
        ends.append({i + 1: y for i, x in ends[-1].items() if i + 1 < n and (y := own[i + 1] & x << 1)})
    rows = [list(e) for e in ends]
    slow = None
    total, todo = 0, [(0, n, 0, m, deep)]
    while todo:
        alo, ahi, blo, bhi, k = todo.pop()
        mask = (1 << bhi) - 1
        k = min(k, ahi - alo, bhi - blo, len(ends) - 1)
        while k:
            low, e, r = blo + k - 1, ends[k], rows[k]
            for at in range(bisect_left(r, alo + k - 1), bisect_left(r, ahi)):
                x = (e[r[at]] & mask) >> low
                if x:
                    break
            else:
                k -= 1
                continue
            i, j, size = r[at] - k + 1, blo + (x & -x).bit_length() - 1, k
            if k == deep:
                slow = slow or SequenceMatcher(None, a, b, autojunk=False)
                i, j, size = slow.find_longest_match(alo, ahi, blo, bhi)
            total += size
            if alo < i and blo < j:
                todo.append((alo, i, blo, j, k))
            if i + size < ahi and j + size < bhi:
                todo.append((i + size, ahi, j + size, bhi, k))
            break
    return 2.0 * total / (n + m)


@small
@F.pandas_udf(T.DoubleType())
def word_agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matched words over those of the longer text; 0 if both are empty."""
    out = []
    for x, y in zip(a, b):
        x, y = (x or "").split(), (y or "").split()
        most = max(len(x), len(y))
        out.append(sum(m.size for m in SequenceMatcher(None, x, y).get_matching_blocks()) / most if most else 0.0)
    return pd.Series(out, dtype="float64")


def _script(ch: str) -> str:
    name = unicodedata.name(ch, "")
    return name.split()[0] if name else "UNKNOWN"


@small
@F.pandas_udf(T.StructType([T.StructField("script", T.StringType()), T.StructField("ratio", T.DoubleType())]))
def dominant_script(s: pd.Series) -> pd.DataFrame:
    """Commonest first word of the characters' names without white space, first seen first; and its share."""
    rows = []
    for t in s:
        counts: dict[str, int] = {}
        for ch in t or "":
            if not ch.isspace():
                k = _script(ch)
                counts[k] = counts.get(k, 0) + 1
        top = max(counts, key=counts.get) if counts else None
        rows.append((top, counts[top] / sum(counts.values()) if counts else 0.0))
    return pd.DataFrame(rows, columns=["script", "ratio"])


@small
@F.pandas_udf(T.BooleanType())
def script_mix(s: pd.Series) -> pd.Series:
    """Whether letters of two scripts stand together that never do."""
    pairs = [{"ARABIC", "CYRILLIC"}, {"ARABIC", "HEBREW"}, {"LATIN", "CYRILLIC"}, {"LATIN", "HEBREW"}]
    found = ({_script(c) for c in set(t or "") if c.isalpha()} for t in s)
    return pd.Series([any(p <= x for p in pairs) for x in found], dtype="bool")


def let(value: Column, use) -> Column:
    """use(value) with the value computed once, also where use names it inside a function over elements."""
    return F.transform(F.array(value), use)[0]


def distance(a: Sequence[Hashable], b: Sequence[Hashable], kept: int = 1 << 28) -> int:
    """Edit distance of two sequences: a step for each element of the shorter one, with a bit for each of the longer one.

    Row by row, `up` and `down` have the places where the distance grows or falls by one. Bits of an element are kept if
    all of them are few (`kept`), else made when it is met, so memory is linear however many distinct elements there are.
    """
    if len(a) < len(b):
        a, b = b, a
    start, m, n = 0, len(a), len(b)
    while start < n and a[start] == b[start]:
        start += 1
    while n > start and a[m - 1] == b[n - 1]:
        m, n = m - 1, n - 1
    a, b = a[start:m], b[start:n]
    m, n = len(a), len(b)
    if not n:
        return m
    where: dict[Hashable, list[int]] = {x: [] for x in b}
    for i, x in enumerate(a):
        if x in where:
            where[x].append(i)

    def bits(places: list[int]) -> int:
        held = bytearray(m // 8 + 1)
        for i in places:
            held[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(held, "little")

    marks = {x: bits(places) for x, places in where.items()} if len(where) * m <= kept else None
    full = (1 << m) - 1
    up, down = full, 0
    for x in b:
        own = marks[x] if marks else bits(where[x])
        same = (((own & up) + up) ^ up | own | down) & full
        more, less = down | full ^ (same | up), same & up
        more, less = (more << 1 | 1) & full, less << 1 & full
        up, down = less | full ^ (same | more), more & same
    return n + up.bit_count() - down.bit_count()


def word_ratio(a: list[str], b: list[str]) -> float:
    """SequenceMatcher(None, a, b).ratio(): its rule for frequent elements needs 200 of them, and one that is frequent."""
    if len(b) >= 200 and max(Counter(b).values()) > len(b) // 100 + 1:
        return SequenceMatcher(None, a, b).ratio()
    return char_ratio(a, b)


@small
@F.pandas_udf(T.IntegerType())
def word_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance of two texts in words."""
    return pd.Series([None if x is None or y is None else distance(x.split(), y.split()) for x, y in zip(a, b)], dtype="Int32")


@small
@F.pandas_udf(T.IntegerType())
def char_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit distance of two texts in characters."""
    return pd.Series([None if x is None or y is None else distance(x, y) for x, y in zip(a, b)], dtype="Int32")
