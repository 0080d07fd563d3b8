"""Packing documents into token sequences with balanced attention cost."""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import common, tokens

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

#: Sequence ids are the number of the partition times this plus a count inside it.
STRIDE = 1 << 36


def cost(length: int, linear: float, quadratic: float) -> float:
    """Estimated cost of attending over one piece: linear layers plus attention inside the piece."""
    return linear * length + quadratic * length * length


def assign(lengths: list[int], capacity: int, n_sequences: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int]], list[int]]:
    """Pieces (item, start, length, sequence) and the fill of each sequence.

    Items in descending length go to the sequence of lowest cost among all that have room for them, ties to the first
    one; none is passed over while some sequence has room. An item that fits nowhere waits; in the end the waiting ones,
    longest first, are cut to fill the room that is left, the largest room first, so that they come in few pieces.
    """
    costs, room, pieces, waiting = np.zeros(n_sequences), np.full(n_sequences, capacity, np.int64), [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[i]
        if not n:
            continue
        fits = np.flatnonzero(room >= n)
        if not len(fits):
            waiting.append(i)
            continue
        s = int(fits[costs[fits].argmin()])
        pieces.append((i, 0, n, s))
        room[s] -= n
        costs[s] += cost(n, linear, quadratic)
    left = [(-int(room[s]), s) for s in np.flatnonzero(room).tolist()]
    heapq.heapify(left)
    for i in waiting:
        start = 0
        while start < lengths[i]:
            most, s = heapq.heappop(left)
            n = min(lengths[i] - start, -most)
            pieces.append((i, start, n, s))
            room[s] -= n
            start += n
            if room[s]:
                heapq.heappush(left, (-int(room[s]), s))
    return pieces, (capacity - room).tolist()


def shard_sizes(total: int, capacity: int) -> list[int]:
    """Capacities of the sequences for `total` tokens: full ones, then one for each power of two in the rest.

    Sequences at a power of two need no padding, so none is left.
    """
    rest = total % capacity
    return [capacity] * (total // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(df: DataFrame, *, capacity: int = 2048, eos: int = 1, linear: float = 1.0, quadratic: float = 1.0 / 1024, shard_tokens: int = 1 << 20, tokenizer_file: str | None = None) -> DataFrame:
    """Pieces of all rows of df (doc_id, text; others are ignored), packed into sequences of `capacity` tokens.

    A row's tokens are those of its text (null: empty) and then `eos`, so an empty text is one token. Each partition
    packs shards of about `shard_tokens` tokens by itself, in one pass over the scan without a shuffle; memory is
    bounded by the shard, as longer documents give full sequences first. Inside a shard the remainders, longest first,
    go to the sequence of lowest estimated cost that has room; equal lengths in the order of the rows. Repeated rows and
    ids are packed as rows of their own.
    doc_id null stays null. An empty table gives no pieces. A lost task packs the same rows the same way again.
    """
    path = tokenizer_file or tokens.tokenizer_path()

    def shard(docs: list[tuple[object, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
        """One shard's pieces, and how many sequences it used from `first` on."""
        items, out, used = [], [], first
        for d, (_, ids) in enumerate(docs):
            whole = len(ids) // capacity * capacity
            for s in range(0, whole, capacity):
                out.append((d, s, capacity, used, 0))
                used += 1
            if whole < len(ids):
                items.append((d, whole, len(ids) - whole))
        total = sum(n for *_, n in items)
        sizes = shard_sizes(total, capacity)
        full = [n for n in sizes if n == capacity]
        # what does not fill whole sequences goes, from the shortest items, into those of a power of two
        small, rest = [], total - len(full) * capacity
        by_size = sorted(items, key=lambda x: (-x[2], x[0]))
        while rest:
            d, s, n = by_size.pop()
            take = min(n, rest)
            small.append((d, s + n - take, take))
            rest -= take
            if take < n:
                by_size.append((d, s, n - take))
        pieces, _ = assign([n for *_, n in by_size], capacity, len(full), linear, quadratic)
        offsets = [0] * len(full)
        for i, start, n, s in pieces:
            d, at, _ = by_size[i]
            out.append((d, at + start, n, used + s, offsets[s]))
            offsets[s] += n
        used += len(full)
        for size in [n for n in sizes if n < capacity]:
            at = 0
            while at < size:
                d, s, n = small.pop()
                take = min(n, size - at)
                out.append((d, s, take, used, at))
                at += take
                if take < n:
                    small.append((d, s + take, n - take))
            used += 1
        crc = [zlib.crc32(docs[d][1][s : s + n]) for d, s, n, *_ in out]
        cols = list(zip(*out)) if out else [()] * 5
        longs = lambda x: pa.array(x, pa.int64())
        arrays = [longs([docs[d][0] for d in cols[0]]), longs(cols[1]), longs(cols[2]), longs(crc), longs([len(docs[d][1]) for d in cols[0]]), longs(cols[3]), longs(cols[4])]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]), used

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.PartEncoder(path, lambda ids: array("I", ids).tobytes(), "ids")
        end, used, docs, held = np.array([eos], "<u4").tobytes(), TaskContext.get().partitionId() * STRIDE, [], 0
        for b in common.chunks_by_bytes(batches, 1, 2 << 20):
            for doc, parts in zip(b.column(0).to_pylist(), encoder(b.column(1).to_pylist())):
                ids = np.frombuffer(b"".join((*parts, end)), "<u4")
                docs.append((doc, ids))
                held += len(ids)
                if held >= shard_tokens:
                    out, used = shard(docs, used)
                    docs, held = [], 0
                    yield out
        if docs:
            yield shard(docs, used)[0]

    return common.map_arrow(df.select(df["doc_id"].cast("long").alias("doc_id"), common.text_of().alias("text")), run, SCHEMA, (path, "ids"), 4)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.documents(spark, sf_dir))
