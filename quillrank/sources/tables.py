"""Readers: the candidate sheet in wide or long form, its lookups, audio bytes, and derived inputs for the queries."""

from __future__ import annotations

import io
import re
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OPTION = re.compile(r"^option_(\d+)$", re.I)


def option_columns(columns: list[str]) -> list[tuple[int, str]]:
    """(number, header) of the candidate columns in numeric order; result columns that share the prefix are none."""
    return sorted((int(m[1]), c) for c in columns if (m := OPTION.match(c.strip())))


def header(columns: list[str], name: str) -> str:
    """The header that means `name`, whatever its case; raises if there is none."""
    for c in columns:
        if c.strip().lower() == name.lower():
            return c
    raise ValueError(f"column {name!r} is missing; there are {columns}")


def audio_header(columns: list[str]) -> str | None:
    """The first header that starts with `audio` and has no `id` in it."""
    return next((c for c in columns if c.strip().lower().startswith("audio") and "id" not in c.lower()), None)


def candidates(sheet: DataFrame, keep_blank: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """audio_id, option_no, transcript: one row an option, trimmed; blank ones are left out unless wanted.

    also: columns of the sheet's row that its options keep, without a join.
    """
    options = option_columns(sheet.columns)
    cells = F.array(*(F.struct(F.lit(n).alias("option_no"), F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias("transcript")) for n, c in options))
    rows = sheet.select(F.col(header(sheet.columns, "audio_id")).cast("string").alias("audio_id"), *also, F.inline(cells))
    return rows if keep_blank else rows.filter("transcript <> ''")


def lookup(sheet: DataFrame, audio_id: str) -> DataFrame:
    """Options, correct option and language of the first row with this id; raises if there is none."""
    own = sheet.filter(F.trim(F.col(header(sheet.columns, "audio_id")).cast("string")) == audio_id.strip())
    own = own.orderBy(F.monotonically_increasing_id()).limit(1)
    if own.isEmpty():
        raise KeyError(f"audio_id {audio_id!r} is not in the sheet")
    rest = own.select(F.col("audio_id").cast("string").alias("audio_id"), "language", F.expr("try_cast(correct_option as int)").alias("correct_option"))
    return candidates(own, keep_blank=True).join(F.broadcast(rest), "audio_id")


def audio_ids(sheet: DataFrame) -> DataFrame:
    return sheet.select(F.trim(F.col("audio_id").cast("string")).alias("audio_id")).filter(F.col("audio_id").rlike("^[0-9]+$"))


def pending(sheet: DataFrame) -> DataFrame:
    """Ids whose detected option is blank in some way of writing it."""
    done = F.trim(F.coalesce(F.col(header(sheet.columns, "detected_option")).cast("string"), F.lit("")))
    return audio_ids(sheet.filter(done.isin("", "None", "nan")))


def discover(files: DataFrame) -> DataFrame:
    """audio_id of each file whose whole name is digits and .mp3 (from the binaryFile source)."""
    name = F.regexp_extract("path", r"(?:^|/)([0-9]+)\.mp3$", 1)
    return files.select(name.alias("audio_id"), "path").filter("audio_id <> ''").orderBy(F.col("audio_id").cast("long"))


def decode_wav(files: DataFrame, rate: int = 16000) -> DataFrame:
    """path, duration, samples (mono, at `rate`) of PCM WAV bytes; other bytes give null samples."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part.path, part.content):
                try:
                    with wave.open(io.BytesIO(content)) as w:
                        kind = {1: np.uint8, 2: "<i2", 4: "<i4"}[w.getsampwidth()]
                        x = np.frombuffer(w.readframes(w.getnframes()), kind).astype(np.float64).reshape(-1, w.getnchannels())
                        x = ((x - 128) / 128 if w.getsampwidth() == 1 else x / 2.0 ** (8 * w.getsampwidth() - 1)).mean(axis=1)
                        own, n = w.getframerate(), len(x)
                    at = np.arange(int(n * rate / own)) * own / rate
                    rows.append((path, n / own, np.interp(at, np.arange(n), x).astype(np.float32) if own != rate and n else x.astype(np.float32)))
                except (wave.Error, EOFError, KeyError):
                    rows.append((path, None, None))
            yield pd.DataFrame(rows, columns=["path", "duration", "samples"])

    return files.select("path", "content").mapInPandas(run, "path string, duration double, samples array<float>")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
