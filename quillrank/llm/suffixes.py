"""Suffix arrays by induced sorting, permuted common prefixes, and exact byte-string dedup with them."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from . import common
from . import superkmers as sk


LARGEST_BLOCK = 1 << 16


def _scan(t: np.ndarray, wanted: np.ndarray, sa: np.ndarray, free: np.ndarray, step: int) -> None:
    """One scan of induced sorting over sa, to the right (step 1) or left (-1), in blocks.

    Each entry p places p-1 at the next free place of its symbol if wanted[p-1]. A block ends before the first place
    that one of its own entries fills, so every entry that is read is final; blocks grow while they can.
    """
    n, at, size = len(t), 0, 256
    view, places, first = sa[::step], np.arange(LARGEST_BLOCK), np.ones(LARGEST_BLOCK, bool)
    while at < n:
        pred = view[at : at + size] - 1
        width = len(pred)
        where = ((pred >= 0) & wanted[pred]).nonzero()[0]
        if count := len(where):
            pred = pred[where]
            c = t[pred]
            by = c.argsort(kind="stable")
            s = c[by]
            new = first[:count]
            np.not_equal(s[1:], s[:-1], out=new[1:])
            target = np.empty(count, np.int64)
            rank = places[:count] - new.nonzero()[0][new.cumsum() - 1]
            target[by] = free[s] + rank if step > 0 else free[s] - rank
            low = int(target.min()) if step > 0 else n - 1 - int(target.max())
            if low < at + width:
                width = low - at
                cut = int(where.searchsorted(width))
                pred, target, c, size = pred[:cut], target[:cut], c[:cut], min(max(32, 2 * width), LARGEST_BLOCK)
            else:
                size = min(size * 2, LARGEST_BLOCK)
            sa[target] = pred
            free[c] = target + step  # of equal symbols the last one counts
        else:
            size = min(size * 2, LARGEST_BLOCK)
        at += width


def _induce(t: np.ndarray, is_s: np.ndarray, counts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the leftmost-smaller ones in the given order."""
    ends = np.cumsum(counts)
    sa = np.full(len(t), -1, np.int64)
    c = t[lms]
    by = np.argsort(c, kind="stable")
    c = c[by]
    last = np.searchsorted(c, c, side="right") - 1
    sa[ends[c] - 1 - (last - np.arange(len(c)))] = lms[by]
    _scan(t, ~is_s, sa, ends - counts, 1)
    larger = np.flatnonzero(sa >= 0)
    sa[larger[is_s[sa[larger]]]] = -1
    sa[0] = len(t) - 1
    _scan(t, is_s, sa, ends - 1, -1)
    return sa


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array by induced sorting of t, whose last value is 0 and whose others are from 1 to symbols - 1."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    # classify: smaller than the next suffix, or larger; equal neighbours take the type of what follows
    differ = np.append(t[:-1] != t[1:], True)
    after = np.flatnonzero(differ)[np.cumsum(differ) - differ]
    is_s = np.append(t[:-1] < t[1:], True)[after]
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    counts = np.bincount(t, minlength=symbols)
    if not len(lms):
        return _induce(t, is_s, counts, lms)
    # sort the substrings between leftmost-smaller places, and name them
    sa = _induce(t, is_s, counts, lms)
    mark = np.zeros(n, bool)
    mark[lms] = True
    ordered = sa[mark[sa]]
    size = np.zeros(n, np.int64)
    size[lms] = np.diff(np.append(lms, n - 1)) + 1
    a, b = ordered[:-1], ordered[1:]
    same = (size[a] == size[b]) & (b != n - 1) & (a != n - 1)
    live, k = np.flatnonzero(same), 0
    while len(live):
        ok = t[a[live] + k] == t[b[live] + k]
        same[live[~ok]] = False
        k += 1
        live = live[ok]
        live = live[size[a[live]] > k]
    name = np.zeros(n, np.int64)
    name[ordered] = np.cumsum(np.append(False, ~same))
    names = int(name[ordered[-1]]) + 1
    if names < len(lms):
        ordered = lms[suffix_array(name[lms], names)]
    return _induce(t, is_s, counts, ordered)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray, cap: int) -> np.ndarray:
    """For each place of t, the common prefix with the suffix before it in sa, up to cap.

    Only places whose left symbols differ are compared; any other place has one less than the place before it.
    """
    n = len(t)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    here = np.arange(n)
    known = (before < 1) | (here == 0)
    rest = np.flatnonzero(~known)
    known[rest] = t[rest - 1] != t[before[rest] - 1]
    heads = np.flatnonzero(known)
    live = heads[before[heads] >= 0]
    length = np.zeros(n, np.int64)
    # true lengths are needed for what follows a head, so a head is compared up to cap and its followers
    need = np.append(heads[1:], n) - heads
    goal = np.zeros(n, np.int64)
    goal[heads] = need + cap
    k = 0
    while len(live):
        x, y = live + k, before[live] + k
        ok = (x < n) & (y < n)
        live, x, y = live[ok], x[ok], y[ok]
        ok = t[x] == t[y]
        length[live[~ok]] = k
        live = live[ok]
        k += 1
        length[live] = k
        live = live[goal[live] > k]
    head = np.maximum.accumulate(np.where(known, here, 0))
    return np.clip(length[head] - (here - head), 0, cap)


def judge(k: int):
    """Windows of k bytes of a bucket that also start in a document with a smaller id.

    Equal strings are one, with the smallest id. Of windows that repeat inside one string, the first speaks for all, so
    long repetitive texts shrink to one period. Windows that no other string can have (their fingerprint stands alone)
    are left out, and the remaining fragments go into one suffix array: a group of neighbours with common prefixes of k
    bytes or more is one window, and belongs to the smallest id in it.
    """

    def firsts(maybe: np.ndarray, owner: np.ndarray, h: np.ndarray, place: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """For each of the windows given, the first one of its string that is equal, byte for byte."""
        by = maybe[np.lexsort((maybe, h[maybe], owner[maybe]))]
        new = np.append(True, (owner[by[1:]] != owner[by[:-1]]) | (h[by[1:]] != h[by[:-1]]))
        head = by[np.flatnonzero(new)[np.cumsum(new) - 1]]
        again = np.flatnonzero(by != head)
        for at in range(0, len(again), 1 << 20):
            part = again[at : at + (1 << 20)]
            x, y, same = place[by[part]], place[head[part]], np.ones(len(part), bool)
            for j in range(k):
                same &= raw[x + j] == raw[y + j]
            head[part[~same]] = by[part[~same]]
        return head[np.argsort(by)]

    def run(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, strings: bytes):
        edges = np.append(0, np.cumsum(sizes))
        cut = edges.tolist()
        seen: dict[bytes, int] = {}
        kind = np.fromiter((seen.setdefault(strings[i:j], len(seen)) for i, j in zip(cut, cut[1:])), np.int64, len(ids))
        heads = np.zeros(len(seen), np.int64)
        heads[kind[::-1]] = np.arange(len(ids))[::-1]
        least = np.full(len(seen), np.iinfo(np.int64).max)
        np.minimum.at(least, kind, ids)
        distinct = list(seen)
        raw = np.frombuffer(b"".join(distinct), np.uint8)
        size = sizes[heads]
        at = np.append(0, np.cumsum(size))
        n = size - k + 1
        first = np.cumsum(n) - n  # windows of all distinct strings, one after another
        owner = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(owner)) - first[owner] + at[owner]
        best = least[owner]
        c = sk.prefix_hashes(sk._TABLE[raw], sk.BASE_BYTE)
        h = sk.spans(c, place, place + k, sk.BASE_BYTE)
        del c
        bins = (h >> np.uint64(42)).astype(np.int64)
        some = np.flatnonzero(np.bincount(bins, minlength=1 << 22)[bins] > 1)
        order = some[np.argsort(h[some])]
        equal = np.zeros(len(order), bool)
        equal[1:] = h[order][1:] == h[order][:-1]
        equal[:-1] |= equal[1:]
        every = np.sort(order[equal])
        del order, equal, bins, some
        lead = firsts(every, owner, h, place, raw) if len(every) else every
        maybe = every[lead == every]
        if len(maybe):
            new = np.append(True, (maybe[1:] != maybe[:-1] + 1) | (owner[maybe[1:]] != owner[maybe[:-1]]))
            head = np.flatnonzero(new)
            runs = np.append(head[1:], len(maybe)) - head
            # fragments with a separator after each
            width = runs + k
            base = np.cumsum(width) - width
            pos = np.repeat(place[maybe[head]] - base, width) + np.arange(int(width.sum()))
            t = np.zeros(len(pos) + 1, np.int64)
            t[:-1] = raw[np.minimum(pos, len(raw) - 1)].astype(np.int64) + 2
            t[base + width - 1] = 1
            sa = suffix_array(t, 258)
            lcp = permuted_common_prefixes(t, sa, k)
            window = np.full(len(t), -1, np.int64)
            window[np.repeat(base, runs) + np.arange(len(maybe)) - np.repeat(head, runs)] = maybe
            w = window[sa]
            joined = (w >= 0) & np.append(False, w[:-1] >= 0) & (lcp[sa] >= k)
            group = np.cumsum(~joined) - 1
            low = np.minimum.reduceat(np.where(w >= 0, best[w], np.iinfo(np.int64).max), np.flatnonzero(~joined))
            best[w[w >= 0]] = low[group[w >= 0]]
            best[every] = best[lead]
        # each occurrence of a string against the smallest id of each of its windows
        lowest = np.minimum.reduceat(best, first) if len(first) else best
        hit = np.flatnonzero(ids > lowest[kind])
        if not len(hit):
            return hit, hit, hit
        m = n[kind[hit]]
        string = np.repeat(hit, m)
        own = np.arange(len(string)) - np.repeat(np.cumsum(m) - m, m)
        gone = ids[string] > best[first[kind[string]] + own]
        string, own = string[gone], own[gone]
        new = np.append(True, (string[1:] != string[:-1]) | (own[1:] != own[:-1] + 1))
        head = np.flatnonzero(new)
        return string[head], own[head], own[np.append(head[1:], len(own)) - 1] + 1

    return run


def dedup(df: DataFrame, *, k: int = 50, m: int = 12) -> DataFrame:
    """Removes each byte under a string of k bytes that also starts in a document with a smaller doc_id.

    df: doc_id, text; others are ignored. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that
    stay) for every row. Null texts are empty. Texts below k bytes lose nothing. Strings are judged on the input, and
    never cross texts. A null doc_id comes after all others. Rows with one doc_id remove nothing from each other; a span
    found in one of them counts for all of them. An empty table gives an empty one.
    """

    def finish(text: bytes, parts: list[bytes] | None):
        starts, ends = sk.covered(parts, len(text))
        kept, at = [], 0
        for i, j in zip(starts.tolist(), ends.tolist()):
            kept.append(text[at:i])
            at = j
        kept = b"".join((*kept, text[at:]))
        return len(text), len(text) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept

    found = sk.removed_spans(df, k, m, False, False, judge(k))
    return sk.applied(df, found, finish, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.documents(spark, sf_dir)).drop("kept")
