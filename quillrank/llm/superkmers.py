"""Super-k-mers: windows of a text travel to buckets by their minimiser, as packed strings.

A window is k consecutive units (bytes, or words) of one text. Its minimiser is the lowest-ranked gram of m units inside
it. Equal windows have equal minimisers, so they meet in one bucket; consecutive windows with the same minimiser travel
as one string. Shared by suffix-array dedup (bytes) and substring dedup (words), which differ in how a bucket is judged.

Hot grams. A gram that stands in very many places would bring as many strings to one bucket: the windows that straddle
the edges of a frequent passage are all different. So all grams are counted first, over all rows, in slots by their
hash, a few of them for each bucket. A slot with more grams than a bucket's share of bytes can take is hot, and the grams
in it are ranked behind all others: their windows go by the next gram, as by a second minimiser. No gram outside a hot
slot has more strings than that, whichever windows come to it, so no bucket grows with the input. What is sent to all
executors is one bit a slot, and slots are bounded. Equal strings of one batch travel once, so windows inside a passage
or copy, which have no other gram, are combined on the map side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bytes of text that are hashed at a time, and of packed strings that are sorted and compressed together.
TEXT_BYTES, FLUSH_BYTES = 3 << 20, 40 << 20

#: Packed bytes a bucket should hold, and those that a byte of text gives about.
BUCKET_BYTES, PACKED = 6 << 20, 3.5

#: Slots of gram counts for each bucket, and of all at most; a bit each is broadcast.
SLOTS, MOST_SLOTS = 16, 1 << 22

#: A slot is hot from this many times a bucket's bytes on, if each gram in it brought one string.
HOT_BUCKETS = 2

_MIX = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, modulo 2**64, for i below n at least; base is odd."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, np.uint64(b), np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers[base] = tuple(out)
    return _powers[base]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _ODD
    return h ^ (h >> np.uint64(32))


def prefix_hashes(values: np.ndarray, base: int) -> np.ndarray:
    """C with C[j] - C[i] the polynomial hash of values[i:j], shifted by i places (see spans)."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), base)[0][: len(values)], out=out[1:])
    return out


def spans(c: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the runs of values from starts to ends, equal for equal runs."""
    return mixed((c[ends] - c[starts]) * powers(len(c), base)[1][starts])


def gram_hashes(c: np.ndarray, m: int, base: int) -> np.ndarray:
    """Hashes of the m values from each place on."""
    n = len(c) - m
    return mixed((c[m:] - c[:n]) * powers(len(c), base)[1][:n])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    have = 1
    while have < w:
        step = min(have, w - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x


BASE_BYTE, BASE_WORD = 0x5851F42D4C957F2D, 0x14057B7EF767814F


class Units:
    """Some texts as one run of units, with a hash for each gram of m units.

    words: a unit is a word; else a byte. raw: the texts one after another. lo, hi: where each unit starts and ends in
    raw; first: the first unit of each text, and the number of all units.
    """

    def __init__(self, texts: list[bytes], words: bool, m: int):
        self.raw = b"\n".join(texts) + b"\n" if words else b"".join(texts)
        self.m, self.words = m, words
        b = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + words
        edges = np.concatenate([[0], np.cumsum(sizes)])
        c = prefix_hashes(_TABLE[b], BASE_BYTE)
        if words:
            space = _SPACE[b]
            inside = ~space
            step = np.diff(inside.astype(np.int8), prepend=0, append=0)
            self.lo, self.hi = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            self.values = spans(c, self.lo, self.hi, BASE_BYTE) + _MIX * (self.hi - self.lo).astype(np.uint64)
            self.first = np.searchsorted(self.lo, edges)
            c = prefix_hashes(self.values, BASE_WORD)
        else:
            self.first = edges
        self.c = c
        self.base = BASE_WORD if words else BASE_BYTE
        self.n = int(self.first[-1])

    def grams(self) -> np.ndarray:
        return gram_hashes(self.c, self.m, self.base) if self.n >= self.m else np.zeros(0, np.uint64)

    def ranks(self, hot: np.ndarray) -> np.ndarray:
        """Ranks of all grams: three in four grams, and those in hot slots, come behind the rest."""
        h = self.grams()
        behind = (h & np.uint64(3)) != 0
        if len(hot):
            at = np.flatnonzero(~behind)
            behind[at[hot[slots_of(h[at], len(hot))]]] = True
        return (h >> np.uint64(1)) | (behind.astype(np.uint64) << np.uint64(63))

    def runs(self, k: int, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of windows with one minimiser: first window, last window, the minimiser's rank."""
        starts, ends = self.first[:-1], self.first[1:] - k + 1
        mask = np.zeros(self.n + 1, np.int32)
        ok = ends > starts
        mask[starts[ok]] += 1
        mask[ends[ok]] -= 1
        at = np.flatnonzero(np.cumsum(mask[:-1]) > 0)
        if not len(at):
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(0, np.uint64)
        low = sliding_min(self.ranks(hot), k - self.m + 1)[at]
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(at)) - 1
        return at[heads], at[tails], low[heads]


def text_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(keys, texts as UTF-8) of rows with about `size` bytes together."""
    ids, texts, held = [], [], 0
    for b in common.chunks_by_bytes(batches, 1, size):
        ids.append(b.column(0).to_numpy(zero_copy_only=False))
        texts += b.column(1).cast(pa.binary()).to_pylist()
        held += b.column(1).nbytes
        if held >= size:
            yield np.concatenate(ids), texts
            ids, texts, held = [], [], 0
    if texts:
        yield np.concatenate(ids), texts


def slots_of(h: np.ndarray, n: int) -> np.ndarray:
    """The slot of each gram hash, of n, which is a power of two."""
    return (mixed(h * _MIX) & np.uint64(n - 1)).astype(np.int64)


def slots_for(size: int, buckets: int) -> int:
    """SLOTS for each bucket or more, as a power of two; for a text of `size` bytes no more than its grams are worth."""
    return min(MOST_SLOTS, 1 << max(6, min(SLOTS * buckets, max(1, size // 64)).bit_length()))


def hot_slots(rows: DataFrame, k: int, words: bool, m: int, size: int, buckets: int) -> np.ndarray:
    """For each slot whether it is hot. rows: key, text; size: the bytes of all texts.

    One of four grams can be a minimiser at first, so only those count. A gram brings strings of twice k units at most.
    """
    n = slots_for(size, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n, np.int64)
        for _, texts in text_batches(batches, TEXT_BYTES):
            g = Units(texts, words, m).grams()
            counts += np.bincount(slots_of(g[(g & np.uint64(3)) == 0], n), minlength=n)
        slots = np.flatnonzero(counts)
        for at in range(0, len(slots), 1 << 18):
            part = slots[at : at + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(counts[part])], ["slot", "n"])

    string = 2 * k * (6 if words else 1)
    share = max(BUCKET_BYTES, size * PACKED / MOST_SLOTS * SLOTS)  # beyond MOST_SLOTS, slots hold several buckets
    local = common.map_arrow(rows, run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = local.filter(F.col("n") * string > HOT_BUCKETS * share).select("slot")
    hot = np.zeros(n, bool)
    hot[[r[0] for r in found.collect()]] = True  # MOST_SLOTS at most
    return hot if hot.any() else np.zeros(0, bool)


#: Columns of a bucket's blob before its strings: ids as differences, starts, sizes.
def to_blob(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, strings: bytes) -> bytes:
    head = np.array([len(ids), len(strings)], np.int64).tobytes()
    return b"".join((head, np.diff(ids, prepend=0).tobytes(), starts.astype(np.uint32).tobytes(), sizes.astype(np.uint32).tobytes(), strings))


def from_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    n, size = (int(x) for x in np.frombuffer(blob, np.int64, 2))
    ids = np.cumsum(np.frombuffer(blob, np.int64, n, 16))
    starts, sizes = (np.frombuffer(blob, np.uint32, n, 16 + 8 * n + i * 4 * n).astype(np.int64) for i in (0, 1))
    return ids, starts, sizes, blob[16 + 16 * n : 16 + 16 * n + size]


RANGES = "key long, spans binary"


def grouped_spans(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
    """Rows of RANGES: a row a text with its spans [start, end) of removed units."""
    order = np.lexsort((starts, ids))
    ids, pairs = ids[order], np.stack([starts, ends], 1).astype(np.uint32)[order]
    heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
    blobs = [pairs[i:j].tobytes() for i, j in zip(heads, np.append(heads[1:], len(ids)))]
    return pa.RecordBatch.from_arrays([pa.array(ids[heads], pa.int64()), pa.array(blobs, pa.binary())], ["key", "spans"])


def scatter(rows: DataFrame, k: int, m: int, words: bool, hot: np.ndarray, buckets: int, same_text: bool) -> DataFrame:
    """bucket, blob: all windows of rows (key, text) as packed strings; below 0, spans that are settled already.

    Strings that are equal inside a batch are sent once, for the smallest (key, start): the windows of the others repeat
    an earlier one for certain. same_text: repeats inside one text count, too; else only those of a smaller key.
    """
    hot_all = rows.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        held, size, flushed = [], 0, 0

        def send(bucket: list[int], blobs: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array([packer.compress(x) for x in blobs], pa.binary())], ["bucket", "blob"])

        def flush() -> Iterator[pa.RecordBatch]:
            """Combines equal strings of what is held, and gives one blob a bucket."""
            ids, starts, units, bucket, finger, lo, hi = (np.concatenate([x[i] for x in held]) for i in range(7))
            raws, which = [x[7] for x in held], np.repeat(np.arange(len(held)), [len(x[0]) for x in held])
            order = np.argsort(finger, kind="stable")
            f = finger[order]
            equal = np.append(False, f[1:] == f[:-1])
            some = equal.copy()
            some[:-1] |= equal[1:]
            drop = np.zeros(len(ids), bool)
            if some.any():
                at = order[some]
                at = at[np.lexsort((starts[at], ids[at], finger[at]))]
                heads = np.append(True, finger[at][1:] != finger[at][:-1])
                lead = at[np.flatnonzero(heads)[np.cumsum(heads) - 1]]
                later = (ids[at] > ids[lead]) | ((ids[at] == ids[lead]) & (starts[at] > starts[lead]) if same_text else False)
                for x, y in zip(at[later].tolist(), lead[later].tolist()):  # equal for certain
                    drop[x] = raws[which[x]][lo[x] : hi[x]] == raws[which[y]][lo[y] : hi[y]]
            if drop.any():
                spans_ = grouped_spans(ids[drop], starts[drop], starts[drop] + units[drop] - 1 + k)
                found = spans_.column(1).to_pylist()
                head = np.concatenate([[spans_.num_rows], spans_.column(0).to_numpy(), [len(x) for x in found]]).astype(np.int64)
                blob = b"".join((head.tobytes(), *found))
                yield send([-1 - flushed * 1009 - TaskContext.get().partitionId()], [blob])
            keep = np.flatnonzero(~drop)
            keep = keep[np.lexsort((starts[keep], ids[keep], bucket[keep]))]
            edges = np.flatnonzero(np.diff(bucket[keep], prepend=-1, append=-1))
            out, blobs = [], []
            for i, j in zip(edges[:-1], edges[1:]):
                at = keep[i:j]
                strings = b"".join([raws[w][s:e] for w, s, e in zip(which[at].tolist(), lo[at].tolist(), hi[at].tolist())])
                out.append(int(bucket[at[0]]))
                blobs.append(to_blob(ids[at], starts[at], hi[at] - lo[at], strings))
                if len(blobs) >= 32:
                    yield send(out, blobs)
                    out, blobs = [], []
            if blobs:
                yield send(out, blobs)

        for keys, texts in text_batches(batches, TEXT_BYTES):
            u = Units(texts, words, m)
            a, z, rank = u.runs(k, hot_all.value)
            if not len(a):
                continue
            owner = np.searchsorted(u.first, a, side="right") - 1
            lo, hi = (u.lo[a], u.hi[z + k - 1]) if words else (a, z + k)
            bucket = (mixed(rank ^ _MIX) >> np.uint64(8)).astype(np.int64) % buckets
            held.append((keys[owner], a - u.first[owner], z - a + 1, bucket, spans(u.c, a, z + k, u.base), lo, hi, u.raw))
            size += int((hi - lo).sum())
            if size >= FLUSH_BYTES:
                yield from flush()
                held, size, flushed = [], 0, flushed + 1
        if held:
            yield from flush()

    return common.map_arrow(rows, run, "bucket long, blob binary")


def judged(blobs: DataFrame, k: int, judge) -> DataFrame:
    """RANGES of all buckets. judge(ids, starts, sizes, strings) gives the windows of a bucket that repeat.

    It returns arrays: string, first window, last window + 1. A bucket is a group of bounded size, as the number of
    buckets follows the input; groups below 0 hold settled spans, which pass.
    """

    def bucket(table: pa.Table) -> pa.Table:
        reader = zstandard.ZstdDecompressor()
        blobs = (reader.decompress(x) for x in table.column("blob").to_pylist())
        if table.column("bucket")[0].as_py() < 0:
            out = []
            for x in blobs:
                n = int(np.frombuffer(x, np.int64, 1)[0])
                keys, sizes = np.frombuffer(x, np.int64, n, 8), np.frombuffer(x, np.int64, n, 8 + 8 * n)
                edges = (8 + 16 * n + np.append(0, np.cumsum(sizes))).tolist()
                out.append(pa.RecordBatch.from_arrays([pa.array(keys), pa.array([x[i:j] for i, j in zip(edges, edges[1:])], pa.binary())], ["key", "spans"]))
            return pa.Table.from_batches(out)
        parts = [from_blob(x) for x in blobs]
        ids, starts, sizes = (np.concatenate([p[i] for p in parts]) for i in range(3))
        strings = b"".join([p[3] for p in parts])
        del parts
        i, a, z = judge(ids, starts, sizes, strings)
        return pa.Table.from_batches([grouped_spans(ids[i], starts[i] + a, starts[i] + z - 1 + k)])

    return common.group_arrow(blobs.groupBy("bucket"), bucket, RANGES)


def removed_spans(df: DataFrame, k: int, m: int, words: bool, same_text: bool, judge) -> DataFrame:
    """key, parts (array of binary spans) for each text of df that has repeated windows."""
    rows = df.select(common.key_of().alias("key"), common.text_of().alias("text"))
    size = int(rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    buckets = max(16, -(-int(size * PACKED) // BUCKET_BYTES))
    hot = hot_slots(rows, k, words, m, size, buckets)
    found = judged(scatter(rows, k, m, words, hot, buckets, same_text), k, judge)
    return found.groupBy("key").agg(F.collect_list("spans").alias("parts"))


def applied(df: DataFrame, spans_: DataFrame, finish, schema: str) -> DataFrame:
    """finish(text, spans) for each row of df. Texts are compressed before they move to their spans."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([packer.compress(x) for x in b.column(2).cast(pa.binary()).to_pylist()], pa.binary())], ["doc_id", "key", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for b in batches:
            rows = [finish(reader.decompress(t), p) for t, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            for at in range(0, len(rows), 2000):
                part = pa.Table.from_pylist([dict(zip(names, r)) for r in rows[at : at + 2000]], schema=kinds)
                yield from part.add_column(0, "doc_id", b.column(0).slice(at, 2000)).combine_chunks().to_batches()

    names = [x.split()[0] for x in schema.split(", ")]
    kinds = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for n, x in zip(names, schema.split(", "))])
    texts = common.map_arrow(df.select("doc_id", common.key_of().alias("key"), common.text_of().alias("text")), pack, f"doc_id {kind}, key long, text binary")
    return common.map_arrow(texts.join(spans_, "key", "left").select("doc_id", "text", "parts"), run, f"doc_id {kind}, {schema}")


def covered(parts: list[bytes] | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs (starts, ends) among n units."""
    z = np.zeros(0, np.int64)
    if not parts:
        return z, z
    pairs = np.frombuffer(b"".join(parts), np.uint32).reshape(-1, 2).astype(np.int64)
    pairs = np.minimum(pairs[np.argsort(pairs[:, 0], kind="stable")], n)
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.append(True, pairs[1:, 0] > reach[:-1])
    heads = np.flatnonzero(new)
    return pairs[heads, 0], reach[np.append(heads[1:], len(pairs)) - 1]
