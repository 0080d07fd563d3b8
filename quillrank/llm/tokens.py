"""Token counts: batch encoding in Arrow functions that returns lengths only."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession

from . import common

#: A text may be cut before a single space between two characters that are not white space: no
#: byte-level pre-token of the vocabulary spans such a place, so the parts give the whole's tokens.
_CUT = re.compile(r"(?<=\S)(?= \S)")

#: Parts that are longer, or beyond so many, are encoded without being remembered.
CACHE_PART_CHARS, CACHE_PARTS = 64, 600_000

_tokenizers: dict[str, object] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str):
    """One tokenizer a worker process."""
    if path not in _tokenizers:
        import os

        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        _tokenizers[path] = found
    return _tokenizers[path]


def _key(part: str) -> str:
    """The name a part is remembered by: words without the space before them, as a plain split gives them; others after one."""
    word = part[0] == " " and len(part) > 1 and not part[1].isspace() and not part[-1].isspace()
    return part[1:] if word else " " + part


class PartEncoder:
    """Encodes texts part by part and remembers the parts.

    value: what to keep of a part's ids (their number, or themselves); kind: its name. Words repeat, so most parts of a batch
    are found in the worker's memory, which later tasks share, and only new ones go to the tokenizer, in one batch. Where
    every space of a text is a place to cut, a plain split gives its parts' names; only other texts are searched for places.
    """

    def __init__(self, path: str, value: Callable, kind: str):
        self.tokenizer, self.value = tokenizer(path), value
        self.known = common.kept((path, kind))

    def _names(self, text: str, new: set[str]) -> list[str]:
        """Names of the text's parts; those not known go to new."""
        names = text.split(" ")
        if len(names) == 1 or not (names[0] or " ")[-1].isspace():
            names[0] = " " + names[0]
            lost = set(names).difference(self.known)
            if all(x and (x[0] == " " or not (x[0].isspace() or x[-1].isspace())) for x in lost):
                new |= lost
                return names
        names = [_key(p) for p in _CUT.split(text)]
        new.update(set(names).difference(self.known))
        return names

    def __call__(self, texts: list[str]) -> Iterator[list]:
        """For each text, the values of its parts in order."""
        known, found, late, lost, once = self.known, [], {}, set(), {}
        for t in texts:
            names = t.split(" ")
            if t and (len(names) == 1 or not (names[0] or " ")[-1].isspace()):
                names[0] = " " + names[0]
                try:
                    found.append(list(map(known.__getitem__, names)))
                    continue
                except KeyError:
                    pass
            if t:
                late[len(found)] = self._names(t, lost)
            found.append([])
        new = {x[1:] if x[0] == " " else " " + x for x in lost}

        def keep(part: str, ids: list[int]) -> None:
            (known if len(part) <= CACHE_PART_CHARS and len(known) < CACHE_PARTS else once)[_key(part)] = self.value(ids)

        # new parts that start with a space and end without white space stand in runs, as they do in texts
        alone = [p for p in new if p[0] != " " or p[-1].isspace() or len(p) > CACHE_PART_CHARS]
        runs = [p for p in new.difference(alone)]
        runs = [runs[i : i + 256] for i in range(0, len(runs), 256)]
        for parts, e in zip(runs, self.tokenizer.encode_batch(list(map("".join, runs)), add_special_tokens=False)):
            ids, ends = e.ids, np.cumsum([len(p) for p in parts])
            at = np.searchsorted(np.fromiter((o[0] for o in e.offsets), np.int64, len(ids)), ends).tolist()
            for p, i, j in zip(parts, [0, *at], at):
                keep(p, ids[i:j])
        for i in range(0, len(alone), 4096):
            for p, e in zip(alone[i : i + 4096], self.tokenizer.encode_batch_fast(alone[i : i + 4096], add_special_tokens=False)):
                keep(p, e.ids)
        for i, names in late.items():
            found[i] = [known[x] if x in known else once[x] for x in names] if once else list(map(known.__getitem__, names))
        return iter(found)


def token_counts(df: DataFrame, *, limit: int = 512, tokenizer_file: str | None = None, batch_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of df (columns doc_id and text; others are ignored).

    Tokens are those of the `tokenizers` library for the given file without added special tokens. Special
    strings inside a text count as the library takes them by default. Each Arrow batch is dealt into slices of
    about batch_bytes, and texts are cut at safe boundaries, so one long text costs no more than many short ones.
    Null and empty texts: 0 bytes, 0 tokens. Repeated rows are each returned. An empty table gives an empty one.
    """
    path = tokenizer_file or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartEncoder(path, len, "length")
        for b in common.chunks_by_bytes(batches, 1, batch_bytes):
            sizes = pa.compute.binary_length(b.column(1)).cast(pa.int64())
            counts = pa.array([sum(x) for x in encoder(b.column(1).to_pylist())], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes, counts, pa.compute.greater(counts, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = df.select("doc_id", common.text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return common.map_arrow(rows, run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean", (path, "length"), 4)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.documents(spark, sf_dir))
