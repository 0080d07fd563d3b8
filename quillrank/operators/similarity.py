"""Candidates against recognised references: error rates, similarity, confusion, and their blend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import sequences, text
from ..functions.scores import clip01

KEY = ["audio_id", "option_no"]


def pairs(candidates: DataFrame, refs: DataFrame) -> DataFrame:
    """Each option with each reference of its recording, compared forms side by side. Blank references are left out.

    Texts are normalised once each, before the join. They are few bytes and much work, so they are dealt out by recording
    to the session's number of partitions, which the join and what groups by option keep.
    """
    parts = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candidates, refs = candidates.repartition(parts, "audio_id"), refs.repartition(parts, "audio_id")
    hyp = candidates.select(*KEY, text.normalize_cmp(F.col("transcript")).alias("hyp"))
    ref = refs.filter(F.trim(F.coalesce("text", F.lit(""))) != "").select("audio_id", F.col("model_ix").alias("ref_ix"), text.normalize_cmp(F.col("text")).alias("ref"))
    return hyp.join(ref, "audio_id")


def wer(ref: Column, hyp: Column) -> Column:
    r, h = text.words(ref), text.words(hyp)
    return F.when(F.size(r) == 0, 0.0).when(F.size(h) == 0, 1.0).otherwise(F.least(sequences.word_distance(ref, hyp) / F.size(r), F.lit(1.0)))


def cer(ref: Column, hyp: Column) -> Column:
    """Spaces count."""
    return F.when(F.length(ref) == 0, 0.0).when(F.length(hyp) == 0, 1.0).otherwise(F.least(sequences.char_distance(ref, hyp) / F.length(ref), F.lit(1.0)))


def wer_uncapped(ref: Column, hyp: Column) -> Column:
    r, h = text.words(ref), text.words(hyp)
    return F.when(F.size(r) == 0, 1.0).when(F.size(h) == 0, 1.0).otherwise(sequences.word_distance(ref, hyp) / F.size(r))


def cer_nospace(ref: Column, hyp: Column) -> Column:
    r, h = F.regexp_replace(ref, text.SPACE, ""), F.regexp_replace(hyp, text.SPACE, "")
    return F.when(F.length(r) == 0, 1.0).otherwise(sequences.char_distance(r, h) / F.length(r))


def rates(frame: DataFrame, fuzzy: bool = True) -> DataFrame:
    out = frame.withColumn("wer", wer(F.col("ref"), F.col("hyp"))).withColumn("cer", cer(F.col("ref"), F.col("hyp")))
    return out.withColumn("fuzzy", sequences.ratio(True, True)("ref", "hyp")) if fuzzy else out


def consistency(variance: Column) -> Column:
    """How little word errors differ between references, from their variance."""
    return clip01(1 - 20 * variance)


def tss(rows: DataFrame) -> DataFrame:
    """Means over references, consistency from the spread of word errors, and the text similarity score."""
    out = rows.groupBy(KEY).agg(F.avg("wer").alias("wer"), F.var_pop("wer").alias("wer_var"), F.avg("cer").alias("cer"), F.avg("fuzzy").alias("fuzzy"))
    out = out.withColumn("consistency", consistency(F.col("wer_var")))
    return out.withColumn("tss", clip01(0.45 * (1 - F.col("wer")) + 0.20 * (1 - F.col("cer")) + 0.15 * F.col("fuzzy") + 0.20 * F.col("consistency")))


def combined(a: Column, t: Column) -> Column:
    return clip01(0.55 * a + 0.45 * t)


def edit_counts(frame: DataFrame) -> DataFrame:
    """hits, subs, dels, ins of each pair."""
    steps = sequences.edit_steps(text.words(F.col("ref")), text.words(F.col("hyp")))
    n = lambda op: F.size(F.filter("steps", lambda s: s["op"] == op)).cast("long")
    return frame.withColumn("steps", steps).select(*KEY, "ref_ix", n("H").alias("hits"), n("S").alias("subs"), n("D").alias("dels"), n("I").alias("ins"))


def edit_alignment(frame: DataFrame) -> DataFrame:
    """One row a step, in order."""
    steps = sequences.edit_steps(text.words(F.col("ref")), text.words(F.col("hyp")))
    return frame.select(*KEY, "ref_ix", F.posexplode(steps).alias("pos", "step")).select(*KEY, "ref_ix", "pos", "step.op", "step.ref", "step.hyp")


def confusion(frame: DataFrame, top: int = 10) -> DataFrame:
    """The commonest substitutions, deletions and insertions of each kind; ties go to the one seen first."""
    rows = edit_alignment(frame.filter("ref <> ''")).filter("op <> 'H'")
    counts = rows.groupBy("op", "ref", "hyp").agg(F.count("*").alias("n"), F.min(F.struct("audio_id", "option_no", "ref_ix", "pos")).alias("first"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("op").orderBy(F.desc("n"), "first"))).filter(F.col("rank") <= top).drop("first")


def bag_confusion(frame: DataFrame) -> DataFrame:
    """matched, deleted, inserted words of each pair as bags, and the share of the reference that is matched."""
    key = [*KEY, "ref_ix"]
    count = lambda c, n: frame.select(*key, F.explode(text.words(F.col(c))).alias("word")).groupBy(*key, "word").agg(F.count("*").alias(n))
    both = count("ref", "r").join(count("hyp", "h"), [*key, "word"], "full").fillna(0, ["r", "h"])
    low = F.least("r", "h")
    out = both.groupBy(key).agg(F.sum(low).alias("matched"), F.sum(F.col("r") - low).alias("deleted"), F.sum(F.col("h") - low).alias("inserted"))
    return out.withColumn("match_rate", F.when(F.col("matched") + F.col("deleted") > 0, F.col("matched") / (F.col("matched") + F.col("deleted"))).otherwise(0.0))


def acoustic_score(w: Column, c: Column, var: Column) -> Column:
    raw = clip01(1 - 0.5 * w - 0.5 * c)
    return 0.5 + (raw - 0.5) * (1 - F.least(2 * var, F.lit(0.5)))


def acoustic_similarity(candidates: DataFrame, outputs: DataFrame) -> DataFrame:
    """Uncapped word error over all references, character error against the most confident one, and their score."""
    rows = pairs(candidates, outputs).withColumn("w", wer_uncapped(F.col("ref"), F.col("hyp")))
    best = outputs.filter("trim(text) <> ''").groupBy("audio_id").agg(F.max(F.struct("confidence", (-F.col("model_ix")).alias("m"))).alias("b")).select("audio_id", (-F.col("b.m")).alias("best"))
    rows = rows.join(best, "audio_id").withColumn("c", F.when(F.col("ref_ix") == F.col("best"), cer_nospace(F.col("ref"), F.col("hyp"))))
    out = rows.groupBy(KEY).agg(F.avg("w").alias("mean_wer"), F.var_pop("w").alias("wer_var"), F.max("c").alias("cer"))
    return out.withColumn("score", acoustic_score(F.col("mean_wer"), F.col("cer"), F.col("wer_var")))
