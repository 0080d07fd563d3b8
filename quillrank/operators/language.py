"""Language votes and the route to one language for a recording."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (1.0, 1.5, 1.0)


def chunk_vote(votes: DataFrame) -> DataFrame:
    """audio_id, lang, share: weighted confidences of the start, middle and end chunks (chunk_ix 0, 1, 2)."""
    weight = F.when(F.col("chunk_ix") == 1, WEIGHTS[1]).otherwise(WEIGHTS[0])
    sums = votes.groupBy("audio_id", "lang").agg(F.sum(F.col("conf") * weight).alias("s"))
    total = F.sum("s").over(Window.partitionBy("audio_id"))
    return sums.select("audio_id", "lang", F.round(F.when(total > 0, F.col("s") / total), 4).alias("share"))


def best(shares: DataFrame) -> DataFrame:
    """The language of the largest share of each recording; ties go to the smaller code."""
    w = Window.partitionBy("audio_id").orderBy(F.desc("share"), "lang")
    return shares.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")


def ensemble(primary: DataFrame, fallback: DataFrame, exclude_other: bool = False) -> DataFrame:
    """0.4 of the primary and 0.6 of the fallback shares, over all languages of either."""
    p, f = primary.withColumnRenamed("share", "p"), fallback.withColumnRenamed("share", "f")
    both = p.join(f, ["audio_id", "lang"], "full").fillna(0.0, ["p", "f"])
    both = both.filter("lang <> 'other'") if exclude_other else both
    return both.select("audio_id", "lang", F.round(0.4 * F.col("p") + 0.6 * F.col("f"), 4).alias("share"))


def nonsense(text: Column) -> Column:
    """Empty, mostly one character, or hardly any letters and digits. Spaces are not counted."""
    chars = F.filter(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s", ""), ""), lambda c: c != "")
    n = F.size(chars)
    sorted_ = F.sort_array(chars)
    # the longest run in sorted characters is the commonest character
    run = F.aggregate(sorted_, F.struct(F.lit("").alias("last"), F.lit(0).alias("now"), F.lit(0).alias("top")), lambda a, c: F.struct(c.alias("last"), F.when(a["last"] == c, a["now"] + 1).otherwise(1).alias("now"), F.greatest(a["top"], F.when(a["last"] == c, a["now"] + 1).otherwise(1)).alias("top")))["top"]
    letters = F.size(F.filter(chars, lambda c: c.rlike(r"[\p{L}\p{N}]")))
    return F.when(n == 0, True).otherwise((run / n > 0.7) | (letters / n < 0.1))


def route(rows: DataFrame) -> DataFrame:
    """method and language from speech_ratio, conf, text, primary, fallback and joint languages."""
    bad = nonsense(F.col("text"))
    conf = F.when(bad, 0.0).otherwise(F.col("conf"))
    lost = F.col("fallback").isNull() | (F.col("fallback") == "unknown")
    method = F.when(F.col("speech_ratio") < 0.2, "none").when(conf >= 0.7, "whisper_primary").when(lost, "whisper_primary_fallback").otherwise("whisper_ensemble")
    rows = rows.withColumn("method", method)
    return rows.withColumn("language", F.when(F.col("method") == "none", "unknown").when(F.col("method") == "whisper_ensemble", F.col("joint")).otherwise(F.col("primary")))
