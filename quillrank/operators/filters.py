"""Plausibility checks of candidate transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import sequences, text

# Words a minute by language, and 140 for others.
WPM = {"ar": 130, "fa": 130, "ur": 130, "en": 150, "fr": 150, "it": 150, "pt": 150, "de": 130, "ru": 140, "tr": 140, "hi": 130, "es": 160, "zh": 200, "ja": 200, "ko": 140}

REASONS = ("script", "duration", "rate", "outlier", "diversity", "empty_tokens", "repetition")


def wpm(lang: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in WPM.items() for x in kv)), lang), F.lit(140))


def est_duration(w: Column, lang: Column) -> Column:
    return F.size(w) / wpm(lang) * 60


def _within(x: Column, low: float, high: float) -> Column:
    """Bounds belong to the range, also where division leaves x a last bit outside: nine digits decide."""
    return F.round(x, 9).between(round(low, 9), round(high, 9))


def check_duration(est: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, _within(est / seconds, 1 / 3, 3.0)).otherwise(False)


def check_rate(w: Column, lang: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, _within(F.size(w) / (seconds / 60) / wpm(lang), 0.4, 2.0)).otherwise(False)


def check_ttr(w: Column) -> Column:
    low = F.transform(w, F.lower)
    return F.when(F.size(w) == 0, False).when(F.size(w) <= 3, True).otherwise(F.size(F.array_distinct(low)) / F.size(w) >= 0.3)


def check_empty_tokens(w: Column) -> Column:
    """At most 0.3 of the words say nothing: no letter or digit, one character repeated, or a single one that is not CJK."""

    def empty(x: Column) -> Column:
        one = F.replace(x, F.substring(x, 1, 1), F.lit("")) == ""
        return F.when(F.length(x) == 1, ~x.rlike(r"[\x{4E00}-\x{9FFF}]") | ~x.rlike(r"[\p{L}\p{N}]")).otherwise(one & (F.length(x) > 2) | ~x.rlike(r"[\p{L}\p{N}]"))

    return F.when(F.size(w) == 0, False).otherwise(F.size(F.filter(w, empty)) / F.size(w) <= 0.3)


def _stands(items: Column, times: Column) -> Column:
    """Whether an item stands more than `times` times: once sorted, such a one fills times + 1 places in a row."""
    return sequences.let(F.sort_array(items), lambda s: F.exists(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.get(s, i) == F.get(s, i + times)))


def check_repetition(w: Column) -> Column:
    """No word over 0.4 of all, and no five words in a row three times; up to three words pass.

    Hashes stand for the words first: where no hash is too frequent, no word is. Only where one is, words decide.
    """

    def grams(low: Column, gram) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(low) - 5), gram)

    def judged(low: Column, h: Column) -> Column:
        most = F.floor(F.size(low) * F.lit(4) / F.lit(10)).cast("int")
        word = F.when(_stands(h, most), _stands(low, most)).otherwise(False)
        hashed = sequences.let(grams(low, lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(5)))), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), False).otherwise(_stands(g, F.lit(2))))
        gram = F.when(F.size(low) < 10, False).when(hashed, _stands(grams(low, lambda i: F.array_join(F.slice(low, i + 1, 5), " ")), F.lit(2))).otherwise(False)
        return ~word & ~gram

    both = F.transform(w, F.lower)
    return F.when(F.size(w) <= 3, True).otherwise(sequences.let(both, lambda low: sequences.let(F.transform(low, lambda x: F.xxhash64(x)), lambda h: judged(low, h))))


def outliers(rows: DataFrame) -> DataFrame:
    """rows (audio_id, transcript, ...) with ok_outlier: length within a third and three times the median of its audio."""
    medians = rows.groupBy("audio_id").agg(F.median(F.length("transcript")).alias("med"), F.count("*").alias("options"))
    ok = F.when(F.col("options") < 2, True).when(F.col("med") == 0, False).otherwise((F.length("transcript") / F.col("med")).between(0.33, 3))
    return rows.join(medians, "audio_id").withColumn("ok_outlier", ok).drop("med", "options")


def checks(rows: DataFrame, with_script: bool = False, with_outlier: bool = True) -> DataFrame:
    """The checks of candidates (audio_id, option_no, transcript, lang, seconds) as ok_ columns, evaluated together.

    Only the outlier check needs the other options of a recording, and so a shuffle.
    """
    rows = (outliers(rows) if with_outlier else rows).withColumn("w", text.words(F.col("transcript")))
    rows = rows.withColumns({"ok_duration": check_duration(est_duration(F.col("w"), F.col("lang")), F.col("seconds")), "ok_rate": check_rate(F.col("w"), F.col("lang"), F.col("seconds")), "ok_diversity": check_ttr(F.col("w")), "ok_empty_tokens": check_empty_tokens(F.col("w")), "ok_repetition": check_repetition(F.col("w"))})
    if with_script:
        top = sequences.dominant_script("transcript")
        rows = rows.withColumn("ok_script", (F.trim("transcript") != "") & (top["ratio"] >= 0.5))
    return rows.drop("w")


def filter_candidates(rows: DataFrame) -> DataFrame:
    """passed and the reasons of failure in fixed order, for each candidate."""
    rows = checks(rows, with_script=True)
    why = F.array_compact(F.array(*(F.when(~F.col(f"ok_{r}"), r) for r in REASONS)))
    return rows.withColumn("reasons", F.concat_ws(",", why)).withColumn("passed", F.col("reasons") == "")
