"""Quality rules: compression bands over whole documents and fixed chunks."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession

from . import common

_WORD = re.compile(common.WORD_CLASS)
_SYMBOL = re.compile(r"[#*$%&|<>]")

SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, ratio double, n_chunks long, n_chunks_out long"


@dataclass(frozen=True)
class Bands:
    """Limits for the ratio of plain to compressed bytes.

    Prose compresses better the longer it is, so the upper limit rises with the logarithm of the length. A text must stay
    below it as a whole, and half of its chunks at least must stay inside the chunk limits. Texts from one chunk on have
    chunks; the last one ends with the text, so every byte lies in some chunk. Texts under least_bytes say nothing about
    compression and pass.
    """

    level: int = 3
    chunk_bytes: int = 2048
    least_bytes: int = 256
    low: float = 1.1
    at_256: float = 2.05
    per_doubling: float = 0.09
    most: float = 3.2
    chunk_low: float = 1.15
    chunk_high: float = 2.6

    def high(self, n: int) -> float:
        return min(self.most, self.at_256 + self.per_doubling * (math.log2(n) - 8))


def features(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = _WORD.findall(text)
    n, seen, lines = len(words), set(), 0
    if "\n" in text:
        for line in text.split("\n"):
            if _WORD.search(line):
                lines += line in seen
                seen.add(line)
    repeated = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            count = Counter(windows)
            end = 0
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, sum(map(len, words)), len(_SYMBOL.findall(text)), lines, repeated


def verdict(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[bool, float | None, int, int]:
    """Whether raw is inside the bands; its ratio, its chunks, and those outside the chunk limits."""
    n, size = len(raw), bands.chunk_bytes
    if n < bands.least_bytes:
        return True, None, 0, 0
    ratio = n / len(packer.compress(raw))
    starts = [*range(0, n - size, size), n - size] if n >= size else []
    chunks = [size / len(packer.compress(raw[i : i + size])) for i in starts]
    out = sum(not bands.chunk_low <= x <= bands.chunk_high for x in chunks)
    return bands.low <= ratio <= bands.high(n) and 2 * out <= len(chunks), ratio, len(chunks), out


def compression_rules(df: DataFrame, *, bands: Bands = Bands()) -> DataFrame:
    """Features, base rule and compression verdict of every row of df (doc_id, text; others are ignored).

    A text fails the base rule with fewer than 50 words or with more than half of its words in repeated 3-word windows;
    it is kept if it passes that and is inside the compression bands. Null, empty and wordless texts fail. Texts of
    any length are compressed whole, and from one chunk on by chunks as well; a value at a limit is inside. Repeated rows
    are each returned; an empty table gives an empty one.
    """
    kind = df.schema["doc_id"].dataType.simpleString()
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    types = [kinds[x.split()[1]] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for b in common.chunks_by_bytes(batches, 1, 4 << 20):
            rows = []
            for text in b.column(1).to_pylist():
                n, *rest, repeated = features(text)
                failed = n < 50 or 100 * repeated > 50 * n
                inside, *more = verdict(text.encode(), bands, packer)
                rows.append((n, *rest, repeated, failed, inside and not failed, *more))
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", *names])

    return common.map_arrow(df.select("doc_id", common.text_of().alias("text")), run, f"doc_id {kind}, {SCHEMA}")


def keep_passing(df: DataFrame, *, bands: Bands = Bands()) -> DataFrame:
    """Rows of df that compression_rules keeps, with all columns, in one pass without a shuffle.

    df: text, and any columns besides, which come back as they are, whatever their names. Null and empty texts go, as
    they fail the base rule. Very long texts are judged whole. Repeated rows go or stay alike; a null id changes nothing.
    An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for b in batches:
            keep = []
            for text in b.column(at).to_pylist():
                text = text or ""
                n, *_, repeated = features(text)
                keep.append(not (n < 50 or 100 * repeated > 50 * n) and verdict(text.encode(), bands, packer)[0])
            yield b.filter(pa.array(keep, pa.bool_()))

    at = df.columns.index("text")
    return common.map_arrow(df, run, df.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules(common.documents(spark, sf_dir))
