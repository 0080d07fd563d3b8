"""Ranks, the final blend, and the wide result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import clip01, number

KEY = ["audio_id", "option_no"]
METRICS = ("wer", "aqs", "cer", "tss", "lgs", "final_score")


@dataclass(frozen=True)
class Weights:
    """Shares of the three scores. If they do not add up to more than 0, the defaults hold."""

    aqs: float = 0.5
    tss: float = 0.45
    lgs: float = 0.05

    def settled(self) -> Weights:
        return self if self.aqs + self.tss + self.lgs > 0 else Weights(0.45, 0.35, 0.20)


def rank(rows: DataFrame, score: str) -> DataFrame:
    """rows with rank within the recording: highest score first, null scores out, ties to the lower option."""
    w = Window.partitionBy("audio_id").orderBy(F.desc(score), "option_no")
    return rows.filter(number(F.col(score)).isNotNull()).withColumn("rank", F.row_number().over(w))


def blend(a: Column, t: Column, g: Column, weights: Weights = Weights()) -> Column:
    w = weights.settled()
    return clip01((w.aqs * a + w.tss * t + w.lgs * g) / (w.aqs + w.tss + w.lgs))


def final(aqs: DataFrame, tss: DataFrame, lgs: DataFrame, weights: Weights = Weights(), missing: str = "zero") -> DataFrame:
    """final_score and rank from three score tables. missing: 'zero' fills gaps, 'strict' needs all three."""
    how = {"zero": "full", "strict": "inner"}[missing]
    rows = aqs.join(tss, KEY, how).join(lgs, KEY, how)
    cols = [number(F.col(c)) for c in ("aqs", "tss", "lgs")]
    rows = rows.filter(F.coalesce(*cols).isNotNull()) if missing == "zero" else rows.filter(cols[0].isNotNull() & cols[1].isNotNull() & cols[2].isNotNull())
    score = blend(*(F.coalesce(c, F.lit(0.0)) for c in cols), weights)
    return rank(rows.select(*KEY, "aqs", "tss", "lgs", score.alias("final_score")), "final_score")


def wide(scores: DataFrame, options: int = 5, digits: int = 5) -> DataFrame:
    """One row a recording: each metric for each option, metric by metric, and the detected option."""
    have = [m for m in METRICS if m in scores.columns]
    best = F.max(F.when(F.col("rank") == 1, F.col("option_no"))).alias("detected_option")
    cells = [F.max(F.when(F.col("option_no") == n, F.round(m, digits))).alias(f"option_{n}_{m}") for m in have for n in range(1, options + 1)]
    return scores.groupBy("audio_id").agg(*cells, best)


def upsert(sheet: DataFrame, results: DataFrame) -> DataFrame:
    """sheet with the columns of results: new values where there are any, else the old; missing columns are appended."""
    fresh = results.select(F.col("audio_id"), *(F.col(c).alias(f"__{c}") for c in results.columns if c != "audio_id"))
    rows = sheet.join(fresh, "audio_id", "left")
    own = [F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in results.columns and c != "audio_id" else F.col(c) for c in sheet.columns]
    return rows.select(*own, *(F.col(f"__{c}").alias(c) for c in results.columns if c not in sheet.columns))


def accuracy(results: DataFrame, sheet: DataFrame) -> DataFrame:
    """Share of recordings whose detected option is the correct one."""
    both = results.select("audio_id", "detected_option").join(sheet.select("audio_id", "correct_option"), "audio_id")
    return both.agg(F.count("*").alias("n"), F.avg((F.col("detected_option") == F.col("correct_option")).cast("int")).alias("accuracy"))
