"""Substring dedup over word windows, partitioned by super-k-mers."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from . import common
from . import superkmers as sk


def numbered(u: sk.Units) -> np.ndarray:
    """A number for each word, equal for equal words and for no others.

    Words are grouped by hash, and each is compared with the first of its group byte by byte; only if a hash is shared by
    unlike words are the words themselves looked up.
    """
    _, first, number = np.unique(u.values, return_index=True, return_inverse=True)
    raw, size = np.frombuffer(u.raw, np.uint8), u.hi - u.lo
    lead = first[number]
    same = bool((size == size[lead]).all())
    for at in range(0, len(number) if same else 0, 1 << 18):
        n = size[at : at + (1 << 18)]
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        same &= bool((raw[np.repeat(u.lo[at : at + (1 << 18)], n) + step] == raw[np.repeat(u.lo[lead[at : at + (1 << 18)]], n) + step]).all())
    if same:
        return number
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(u.raw[i:j], len(seen)) for i, j in zip(u.lo.tolist(), u.hi.tolist())), np.int64, len(u.lo))


def judge(k: int):
    """Windows of a bucket whose word sequence also starts earlier, by sorting all windows of the bucket.

    Words are numbered exactly (see numbered), windows are sorted by a fingerprint of their numbers, and neighbours with
    one fingerprint are compared number by number, so windows that count as equal are.
    """

    def run(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, strings: bytes):
        edges = np.append(0, np.cumsum(sizes)).tolist()
        u = sk.Units([strings[i:j] for i, j in zip(edges, edges[1:])], True, 1)
        n = np.diff(u.first) - k + 1
        owner = np.repeat(np.arange(len(n)), n)
        own = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = u.first[owner] + own
        number = numbered(u)
        c = sk.prefix_hashes(sk.mixed((number + 1).astype(np.uint64) * sk._MIX), sk.BASE_WORD)
        h = sk.spans(c, at, at + k, sk.BASE_WORD)
        order = np.argsort(h)
        equal = np.zeros(len(order), bool)
        equal[1:] = h[order][1:] == h[order][:-1]
        some = equal.copy()
        some[:-1] |= equal[1:]
        order = order[some]
        if not len(order):
            z = np.zeros(0, np.int64)
            return z, z, z
        key, place = ids[owner[order]], starts[owner[order]] + own[order]
        by = np.lexsort((place, key, h[order]))
        first = order[by]
        heads = np.append(True, h[first][1:] != h[first][:-1])
        lead, x = first[np.flatnonzero(heads)[np.cumsum(heads) - 1]], first
        same = np.ones(len(x), bool)
        for j in range(k):
            same &= number[at[x] + j] == number[at[lead] + j]
        if not same.all():  # two sequences with one fingerprint: the numbers themselves decide the order
            by = np.lexsort((place, key, *(number[at[order] + j] for j in range(k)), h[order]))
        order = order[by]
        later = np.append(False, h[order][1:] == h[order][:-1])
        if not same.all():
            for j in range(k):
                later[1:] &= number[at[order[1:]] + j] == number[at[order[:-1]] + j]
        # the first of a group stays, and so does a repeated row of it
        head = np.flatnonzero(~later)[np.cumsum(~later) - 1]
        key, place = key[by], place[by]
        later &= (key != key[head]) | (place != place[head])
        gone = np.sort(order[later])
        if not len(gone):
            z = np.zeros(0, np.int64)
            return z, z, z
        new = np.append(True, (gone[1:] != gone[:-1] + 1) | (owner[gone[1:]] != owner[gone[:-1]]))
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(gone)) - 1
        return owner[gone[heads]], own[gone[heads]], own[gone[tails]] + 1

    return run


def dedup(df: DataFrame, *, k: int = 20, m: int = 5) -> DataFrame:
    """Removes each word under a window of k words that also starts earlier, in document order by doc_id.

    df: doc_id, text; others are ignored. Returns doc_id, n_words, n_removed, kept_sha256, kept_text for every row.
    Null and empty texts have no words. Texts below k words lose nothing. Windows are judged on the input. A null doc_id
    comes after all others. Rows with one doc_id count as one document: repeated rows give equal results, each like the
    first; if their texts differ, each loses the spans found in any of them. An empty table gives an empty one.
    """

    def finish(text: bytes, parts: list[bytes] | None):
        w = text.translate(SPACES).split()
        gone = np.zeros(len(w), bool)
        for i, j in zip(*sk.covered(parts, len(w))):
            gone[i:j] = True
        kept = b" ".join([x for x, y in zip(w, gone.tolist()) if not y]) if parts else b" ".join(w)
        return len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()

    SPACES = bytes(32 if i in (9, 10, 11, 12, 13) else i for i in range(256))
    found = sk.removed_spans(df, k, m, True, True, judge(k))
    return sk.applied(df, found, finish, "n_words long, n_removed long, kept_sha256 string, kept_text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.documents(spark, sf_dir)).drop("kept_text")
