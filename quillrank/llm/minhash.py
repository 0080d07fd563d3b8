"""MinHash near-dedup: banded minima, signature verification, exact confirmation, star components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, components
from . import superkmers as sk

#: Bands and minima a band. A pair at similarity 0.8 shares no band with probability (1 - 0.8**7)**56 = 2e-6.
BANDS, ROWS = 56, 7

#: Texts in a block; places of a signature.
BLOCK, PLACES = 256, BANDS * ROWS


def floor_of(least: float) -> float:
    """Share of equal places that a pair of the least similarity falls below once in three million."""
    return least - 5 * (least * (1 - least) / PLACES) ** 0.5


#: Ids of rows to drop up to which they are broadcast (8 bytes each).
BROADCAST_IDS = 500_000

_rng = np.random.default_rng(977)
_A = _rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, one text after another in rising order, and their edges."""
    u = sk.Units([t.translate(_LOWER) for t in texts], True, 1)
    words = np.diff(u.first)
    n = np.where(words >= k, words - k + 1, np.minimum(words, 1))
    owner = np.repeat(np.arange(len(texts)), n)
    at = u.first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    h = sk.spans(u.c, at, at + np.minimum(words[owner], k), sk.BASE_WORD)
    order = np.lexsort((h, owner))
    h = h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.append(0, np.cumsum(np.bincount(owner[new], minlength=len(texts))))


def minima(h: np.ndarray) -> np.ndarray:
    """Minima of all universal hashes over one set."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(_A), np.uint32(0xFFFFFFFF))
    for at in range(0, len(x), 128):
        np.minimum(low, (x[at : at + 128, None] * _A + _B).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    """One key a band from the minima in it; keys of different bands differ."""
    m = low.reshape(-1, BANDS, ROWS).astype(np.uint64)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * sk._MIX, m.shape[:2]).copy()
    for i in range(ROWS):
        out = sk.mixed((out ^ m[:, :, i]) * sk._ODD + sk._MIX)
    return out


def text_ids(texts: list[bytes]) -> pa.Array:
    """A 64-bit hash of each text."""
    return pa.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in texts], pa.int64())


def features(df: DataFrame, k: int) -> DataFrame:
    """key, row, node, twin, n_shingles, bands, sig for each row.

    row: a hash of the text; node and twin: two independent hashes of the shingle set, equal for equal sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in sk.text_batches(batches, 1 << 20):
            h, edges = shingle_sets(texts, k)
            sizes = np.diff(edges)
            low = np.stack([minima(h[i:j]) for i, j in zip(edges[:-1], edges[1:])])
            total = np.append(np.uint64(0), np.cumsum(sk.mixed(h * sk._ODD + sk._MIX), dtype=np.uint64))
            node = sk.mixed(total[edges[1:]] - total[edges[:-1]] + sizes.astype(np.uint64)) >> np.uint64(1)
            total = np.append(np.uint64(0), np.cumsum(sk.mixed((h ^ sk._ODD) * sk._MIX + sk._ODD), dtype=np.uint64))
            twin = sk.mixed((total[edges[1:]] - total[edges[:-1]]) ^ sk._MIX)
            bands = band_keys(low).view(np.int64)
            arrays = [pa.array(keys), text_ids(texts), pa.array(node.view(np.int64)), pa.array(twin.view(np.int64)), pa.array(sizes), pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel()), BANDS).cast(pa.list_(pa.int64())), pa.array([x.tobytes() for x in low.astype(np.uint8)], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "row", "node", "twin", "n_shingles", "bands", "sig"])

    rows = df.select(common.key_of().alias("key"), common.text_of().alias("text"))
    return common.map_arrow(rows, run, "key long, row long, node long, twin long, n_shingles long, bands array<long>, sig binary")


def alike(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree in a share of places that a pair of the wanted similarity hardly stays below."""
    places = PLACES
    floor = floor_of(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(-1, places) for i in (2, 3))
                yield b.select([0, 1]).filter(pa.array((x == y).mean(axis=1) >= floor))

    both = pairs.join(sigs.withColumnsRenamed({"node": "a", "sig": "sa"}), "a").join(sigs.withColumnsRenamed({"node": "b", "sig": "sb"}), "b")
    return common.map_arrow(both.select("a", "b", "sa", "sb"), run, "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their whole sets. texts: node, text (zstandard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, last, own = zstandard.ZstdDecompressor(), None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if a != last:
                    last, own = a, shingle_sets([reader.decompress(x.as_py())], k)[0]
                other = shingle_sets([reader.decompress(y.as_py())], k)[0]
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.withColumnsRenamed({"node": "b", "text": "tb"}), "b").join(texts.withColumnsRenamed({"node": "a", "text": "ta"}), "a")
    return common.map_arrow(both.select("a", "b", "ta", "tb"), run, "a long, b long")


def across(placed: DataFrame, sigs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of one bucket but different components. placed: band, no, node, label.

    In a bucket with several components, the nodes outside its largest one are compared with all nodes, block by block. A
    row is a pair of blocks of about BLOCK signatures and texts, so a bucket of n nodes with m outside has n * m / BLOCK**2
    rows of bounded size, and none is gathered in one task; n * m signatures are compared, which no method that loses no
    link of a bucket can save where all its texts are unlike. Pairs with like signatures are confirmed on whole sets there, in every bucket
    that they share: signatures hold 8 bits of each minimum, so they do not tell which buckets those are.
    """
    floor = floor_of(percent / 100)
    counts = placed.groupBy("band", "label").agg(F.count("*").alias("c"))
    largest = F.max(F.struct("c", "label"))
    mixed = counts.groupBy("band").agg(largest.alias("top"), F.sum("c").alias("n"), F.count("*").alias("labels")).filter("labels > 1")
    mixed = mixed.select("band", F.col("top.label").alias("top"), "n", (F.col("n") - F.col("top.c")).alias("rest"))
    rows = placed.join(mixed, "band").join(sigs.join(texts, "node"), "node")
    packed = F.collect_list(F.struct("node", "label", "sig", "text"))
    deal = lambda n: F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / BLOCK))
    every = rows.groupBy("band", deal("n").alias("i")).agg(packed.alias("x")).select("band", "x")
    others = rows.filter("label != top").groupBy("band", deal("rest").alias("j")).agg(packed.alias("y")).select("band", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()

        def opened(v):
            return v.field(0).to_numpy(), v.field(1).to_numpy(), np.frombuffer(b"".join(v.field(2).to_pylist()), np.uint8).reshape(-1, PLACES), v.field(3)

        for b in batches:
            sets: dict[int, np.ndarray] = {}

            def own(node: int, packed) -> np.ndarray:
                if node not in sets:
                    if len(sets) > 4096:
                        sets.clear()
                    sets[node] = shingle_sets([reader.decompress(packed.as_py())], k)[0]
                return sets[node]

            links = []
            for r in range(b.num_rows):
                (nx, lx, sx, tx), (ny, ly, sy, ty) = opened(b.column(0)[r].values), opened(b.column(1)[r].values)
                for j in range(len(ny)):
                    at = np.flatnonzero(lx != ly[j])
                    at = at[(sx[at] == sy[j]).mean(axis=1) >= floor]
                    for i in at.tolist():
                        p, q = own(int(nx[i]), tx[i]), own(int(ny[j]), ty[j])
                        both = len(np.intersect1d(p, q, assume_unique=True))
                        if 100 * both >= percent * (len(p) + len(q) - both):
                            links.append((int(nx[i]), int(ny[j])))
            yield pa.RecordBatch.from_arrays([pa.array([f(x) for x in links], pa.int64()) for f in (min, max)], ["a", "b"])

    return common.map_arrow(every.join(others, "band").select("x", "y"), run, "a long, b long").distinct()


def classes_of(feats: DataFrame) -> DataFrame:
    """node, rep, row, sig, unlike: the smallest key of each class of equal sets, a text that it stands with there, and its signature.

    unlike: whether sets of one node differ in their second hash, so that they are not equal.
    """
    least = F.min(F.struct("key", "row", "sig"))
    unlike = F.min("twin") != F.max("twin")
    return feats.groupBy("node").agg(least.alias("x"), unlike.alias("unlike")).select("node", F.col("x.key").alias("rep"), F.col("x.row").alias("row"), F.col("x.sig").alias("sig"), "unlike")


def settled(feats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """feats and its written classes, with a node for each set alone: sets that share a node but not the second hash get
    nodes made of both, until none is shared. There are none below some billions of sets."""
    while True:
        classes = common.written(classes_of(feats.filter("n_shingles > 0")))
        unlike = classes.filter("unlike").select("node", "unlike")
        if unlike.isEmpty():
            return feats, classes.drop("unlike")
        own = F.when(F.col("unlike"), F.shiftrightunsigned(F.xxhash64("node", "twin"), 1)).otherwise(F.col("node"))
        feats = common.written(feats.join(unlike, "node", "left").withColumn("node", own).select(*feats.columns))


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """band, no, node, label: the component of each node of a bucket, or itself."""
    return members.join(labels, "node", "left").select("band", "no", "node", F.coalesce("label", "node").alias("label"))


def texts_of(df: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """node, text of the nodes given, from the row with the smallest key of each; texts move compressed.

    Rows that share a key (repeated ids, and all null ones) may differ in text, so a text is found by its hash as well.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            raw = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), text_ids(raw), pa.array([packer.compress(x) for x in raw], pa.binary())], ["key", "row", "text"])

    wanted = nodes.join(classes, "node").select("node", F.col("rep").alias("key"), "row")
    packed = common.map_arrow(df.select(common.key_of().alias("key"), common.text_of().alias("text")), pack, "key long, row long, text binary")
    return packed.join(wanted, ["key", "row"]).select("node", "text").dropDuplicates(["node"])


def near_classes(df: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of df (doc_id, text; others are ignored).

    Sets are the distinct k-word shingles of the text with A-Z in lower case; fewer words are one shingle; null, empty
    and wordless texts have empty sets and link with nothing. Sets that share percent of their union are linked;
    component_id is the smallest doc_id that is reachable. Rows with equal sets (by two 64-bit hashes) are one node, so
    copies cost nothing.
    Each bucket of each band links its texts to one leader (verified by signature, confirmed on whole sets), and these
    links give components. In buckets that still hold several components, all nodes outside the largest one are compared
    with all others, in blocks of signatures, so no link inside a bucket is lost. A null doc_id comes last and gives component null.
    Repeated rows are each returned; of rows with one doc_id all are kept or none. An empty table gives an empty one.
    """
    feats, classes = settled(common.written(features(df, k)))
    real = feats.filter("n_shingles > 0")

    rows = real.select("node", F.posexplode("bands").alias("no", "band"))
    # the leader of a bucket is its smallest node in an order of its own, so a large group meets as many leaders as it has bands
    lead = F.min(F.struct(F.xxhash64("node", "band").alias("h"), "node"))
    shared = rows.groupBy("band").agg(lead.alias("a"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo != hi").select("band", F.col("a.node").alias("a"))
    members = common.written(rows.join(shared, "band").select("band", "no", "a", "node").distinct())
    stars = common.written(members.filter("node != a").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct())
    nodes = common.written(stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct())
    texts = common.written(texts_of(df, nodes, classes))
    sigs = common.written(classes.select("node", "sig").join(nodes, "node", "left_semi"))
    labels = components.components(confirmed(alike(stars, sigs, percent / 100), texts, k, percent))
    placed = common.written(labelled(members, labels))
    labels = components.grown(labels, common.written(across(placed, sigs, texts, k, percent)))

    linked = labels.join(classes, "node")
    least = linked.groupBy("label").agg(F.min("rep").alias("component"))
    linked = linked.join(least, "label").select("node", "component")
    whole = classes.join(linked, "node", "left").select("node", F.coalesce("component", "rep").alias("component"))
    out = feats.select("key", "node", "n_shingles").join(whole, "node", "left")
    null = lambda c: F.when(c != common.NULL_KEY, c)
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("key"))
    return out.select(null(F.col("key")).alias("doc_id"), "n_shingles", null(component).alias("component_id"), (component == F.col("key")).alias("kept"))


def keep_first(df: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """Rows of df that are the first of their component, with all columns, whatever their names.

    Null, empty and wordless texts have no set and stay. Very long texts count whole. Rows that repeat a doc_id go or
    stay together, and all those without one as well, as in near_classes; of equal texts under different ids the smallest
    id stays. An empty table gives an empty one. The ids that go move, not the texts (see common.without).
    """
    gone = near_classes(df, k=k, percent=percent).filter("not kept").select(common.key_of().alias("key"))
    return common.without(df, gone, BROADCAST_IDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(common.documents(spark, sf_dir), k=4)
