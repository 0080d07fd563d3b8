"""Speech-recognition outputs: roll-up, cleaning, positional consensus, reliability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequences, text


def rollup(models: DataFrame, segments: DataFrame) -> DataFrame:
    """text, confidence, entropy, no_speech_prob of each model from its segments; without any: '', 0, 1, 1."""
    own = segments.groupBy("audio_id", "model_ix").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg_ix", "text"))), lambda s: F.trim(s["text"])), " ").alias("text"), F.avg("avg_logprob").alias("confidence"), F.avg("compression_ratio").alias("entropy"), F.avg("no_speech_prob").alias("no_speech_prob"))
    out = models.join(own, ["audio_id", "model_ix"], "left")
    return out.select("audio_id", "model_ix", F.trim(F.coalesce("text", F.lit(""))).alias("text"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("entropy", F.lit(1.0)).alias("entropy"), F.coalesce("no_speech_prob", F.lit(1.0)).alias("no_speech_prob"))


def hallucination() -> tuple[Column, Column]:
    """(flag, reasons) of an output."""
    say = lambda name, c, col: F.when(c, F.concat(F.lit(name), F.format_string("%.2f", F.col(col).cast("double")), F.lit(")")))
    found = F.concat_ws(
        " + ",
        say("extreme_repetition(ratio=", F.col("entropy") > 2.8, "entropy"),
        say("very_low_confidence(conf=", F.col("confidence") < -1.5, "confidence"),
        say("no_speech(prob=", F.col("no_speech_prob") > 0.8, "no_speech_prob"),
        F.when(F.col("text").rlike(r"(.)\1{50,}"), "pathological_character_loop"),
        F.when(F.col("text").rlike(r"^[\s.!؟،؛\-—]+$"), "only_punctuation"),
    )
    return found != "", found


def clean_route(outputs: DataFrame) -> DataFrame:
    """Outputs after cleaning: lost ones are emptied, other suspects cleaned strictly, the rest gently."""
    flag, why = hallucination()
    lost = flag & ((F.col("entropy") > 2.8) | (F.col("confidence") < -1.5))
    cleaned = F.when(lost, "").when(flag, text.clean_strict(F.col("text"))).otherwise(text.clean_conservative(F.col("text")))
    rows = outputs.select("*", flag.alias("hallucination_detected"), why.alias("reasons"), cleaned.alias("_t"), lost.alias("_lost"))
    default = lambda c, v: F.when(F.col("_lost"), v).otherwise(F.col(c)).alias(c)
    return rows.select("audio_id", "model_ix", F.col("_t").alias("text"), default("confidence", 0.0), default("entropy", 1.0), default("no_speech_prob", 1.0), "hallucination_detected", "reasons")


def _places(outputs: DataFrame) -> DataFrame:
    """audio_id, tops: for each place the commonest token (ties to the earliest model), its count, and that of all.

    One shuffle brings a recording's few outputs together; places are counted inside the row, so no token moves alone.
    """
    own = F.struct("model_ix", text.words(F.coalesce("text", F.lit(""))).alias("w"))
    rows = outputs.groupBy("audio_id").agg(F.sort_array(F.collect_list(own)).alias("m"))
    most = F.array_max(F.transform("m", lambda x: F.size(x["w"])))

    def top(p: Column) -> Column:
        here = F.filter(F.transform("m", lambda x: F.struct(F.get(x["w"], p).alias("token"), (-x["model_ix"]).alias("f"))), lambda t: t["token"].isNotNull())
        best = lambda some: F.array_max(F.transform(some, lambda t: F.struct(F.size(F.filter(some, lambda u: u["token"] == t["token"])).alias("n"), t["f"].alias("f"), t["token"].alias("token"), F.size(some).alias("of"))))
        return sequences.let(here, best)

    places = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
    return rows.select("audio_id", F.transform(places, top).alias("tops"))


def consensus(outputs: DataFrame) -> DataFrame:
    """audio_id, consensus: the commonest token of each place, ties to the earliest model; '' where all are blank."""
    return _places(outputs).select("audio_id", F.array_join(F.transform("tops", lambda t: t["token"]), " ").alias("consensus"))


def _agreed() -> Column:
    total = F.aggregate("tops", F.lit(0.0), lambda a, t: a + t["n"] / t["of"])
    return F.when(F.size("tops") > 0, total / F.size("tops"))


def agreement(outputs: DataFrame) -> DataFrame:
    """Mean over places of the top token's share; null where no output has a word."""
    return _places(outputs).select("audio_id", _agreed().alias("agreement"))


def reliability(outputs: DataFrame) -> DataFrame:
    """rss = agreement * confidence / (1 + entropy) * (1 - no speech), from means over the models."""
    conf = F.avg(F.when(F.col("confidence") < 0, F.exp("confidence")).otherwise(F.col("confidence")))
    means = outputs.groupBy("audio_id").agg(conf.alias("conf"), F.avg("entropy").alias("ent"), F.avg(1 - F.col("no_speech_prob")).alias("speech"))
    return agreement(outputs).join(means, "audio_id").select("audio_id", (F.col("agreement") * F.col("conf") / (1 + F.col("ent")) * F.col("speech")).alias("rss"))

