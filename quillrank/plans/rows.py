"""The row pipeline: from a sheet and what the models gave for its recordings to scores, ranks and the written sheet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import number
from ..operators import alignment, linguistic, ranking, similarity
from ..sources import tables

KEY = ["audio_id", "option_no"]


@dataclass(frozen=True)
class Outputs:
    """What models outside gave: one table each, so any model that fills these columns will do.

    texts: audio_id, model_ix, text of each recogniser. words: aligned words (see operators.alignment). segments: the
    spans that words were aligned to; durations: audio_duration of each option's recording; pauses: audio_id, start, end
    of its pauses. logprobs: audio_id, option_no, lp of each masked token.
    """

    texts: DataFrame
    words: DataFrame
    segments: DataFrame
    durations: DataFrame
    pauses: DataFrame
    logprobs: DataFrame


def scored(sheet: DataFrame, outputs: Outputs, weights: ranking.Weights = ranking.Weights(), missing: str = "zero") -> DataFrame:
    """audio_id, option_no, wer, aqs, cer, tss, lgs, final_score, rank of each option of the sheet that has any score.

    A blank option, or one that could not be aligned, has no score at all; a recording of which every recognised text is
    blank has no row. missing: 'zero' puts 0 for a score that is missing, 'strict' leaves such an option's final score and
    rank null. All steps group or join by recording, or by recording and option; nothing is gathered beyond a recording.
    """
    heard = outputs.texts.filter(F.trim(F.coalesce("text", F.lit(""))) != "").select("audio_id").distinct()
    named = tables.candidates(sheet).join(heard, "audio_id", "left_semi")
    quality = alignment.option_quality(outputs.words, outputs.segments, outputs.durations, outputs.pauses)
    quality = quality.select(*KEY, number(F.col("aqs")).alias("aqs")).filter("aqs is not null")
    alike = similarity.tss(similarity.rates(similarity.pairs(named, outputs.texts))).select(*KEY, "wer", "cer", "tss")
    live = named.join(quality, KEY)  # stands in the plan once, as all metrics of alignment would be computed again
    fluent = live.join(linguistic.pppl(outputs.logprobs), KEY, "left")
    fluent = fluent.withColumn("lgs", linguistic.lgs(linguistic.pppl_score(F.col("pppl")), linguistic.structural(F.col("transcript"))))
    fluent = linguistic.tie_boost(fluent.select(*KEY, "transcript", "aqs", "lgs"))

    rows = fluent.select(*KEY, "aqs", "lgs").join(alike, KEY, "left")
    three = [number(F.col(c)) for c in ("aqs", "tss", "lgs")]
    score = ranking.blend(*(F.coalesce(c, F.lit(0.0)) for c in three), weights)
    if missing == "strict":
        score = F.when(three[0].isNotNull() & three[1].isNotNull() & three[2].isNotNull(), score)
    elif missing != "zero":
        raise ValueError(f"missing must be 'zero' or 'strict', not {missing!r}")
    rows = rows.withColumn("final_score", score)
    place = F.row_number().over(Window.partitionBy("audio_id").orderBy(F.desc_nulls_last("final_score"), "option_no"))
    return rows.select(*KEY, "wer", "aqs", "cer", "tss", "lgs", "final_score", F.when(F.col("final_score").isNotNull(), place).alias("rank"))


def report(scores: DataFrame) -> DataFrame:
    """The ranking as it is read: recording, rank, option, the three scores, the final one, and whether it is the choice."""
    kept = scores.filter("rank is not null")
    return kept.select("audio_id", "rank", "option_no", *(F.round(c, 4).alias(c) for c in ("aqs", "tss", "lgs", "final_score")), (F.col("rank") == 1).alias("detected"))


def results(sheet: DataFrame, scores: DataFrame, options: int = 5) -> DataFrame:
    """The sheet with six metrics for each option, metric by metric, and detected_option; old values stay where none is new."""
    return ranking.upsert(sheet, ranking.wide(scores, options))
