"""Metrics and anomalies of aligned words (audio_id, option_no, seg_ix, word_ix, word, start, end, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import clip01

KEY = ["audio_id", "option_no"]
PUNCT = "؟،؛.!?:"
TIMED = "start is not null and end is not null"


def normalise_segments(segments: DataFrame) -> DataFrame:
    """Missing times as 0 and missing text as ''."""
    return segments.withColumns({"start": F.coalesce("start", F.lit(0.0)), "end": F.coalesce("end", F.lit(0.0)), "text": F.trim(F.coalesce("text", F.lit("")))})


def word_metrics(words: DataFrame) -> DataFrame:
    """word_ratio, avg_conf, conf_std of each option."""
    timed = F.avg(F.expr(f"cast({TIMED} as int)"))
    std = F.when(F.count("score") > 1, F.stddev_pop("score")).otherwise(0.0)
    return words.groupBy(KEY).agg(timed.alias("word_ratio"), F.coalesce(F.avg("score"), F.lit(0.0)).alias("avg_conf"), std.alias("conf_std"))


def unaligned_ratio(words: DataFrame) -> DataFrame:
    """Share of segments without any word that has a start."""
    segs = words.groupBy(*KEY, "seg_ix").agg((F.count("start") == 0).cast("int").alias("u"))
    return segs.groupBy(KEY).agg(F.avg("u").alias("unaligned_ratio"))


def timing_deviation(words: DataFrame, original: DataFrame) -> DataFrame:
    """mean, std, max, p90 of the distance between middles of original segments and of their timed words."""
    timed = words.filter(TIMED)
    spans = timed.groupBy(*KEY, "seg_ix").agg(F.min(F.struct("word_ix", "start")).alias("a"), F.max(F.struct("word_ix", "end")).alias("z"))
    both = spans.join(original, [*KEY, "seg_ix"])
    d = F.abs((F.col("a.start") + F.col("z.end")) / 2 - (F.col("start") + F.col("end")) / 2)
    out = both.select(*KEY, d.alias("d")).groupBy(KEY).agg(F.avg("d").alias("mean_dev"), F.stddev_pop("d").alias("std_dev"), F.max("d").alias("max_dev"), F.percentile("d", 0.9).alias("p90_dev"))
    return words.select(KEY).distinct().join(out, KEY, "left").fillna(0.0)


def char_confidence(chars: DataFrame) -> DataFrame:
    """Distribution of character scores; options without any are left out."""
    q = F.percentile("score", F.array(*(F.lit(x) for x in (0.1, 0.25, 0.5, 0.75, 0.9))))
    out = chars.filter("score is not null").groupBy(KEY).agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), F.min("score").alias("min"), F.max("score").alias("max"), q.alias("q"), F.count("score").alias("n"))
    return out.select(*KEY, "mean", "std", "min", "max", *(F.col("q")[i].alias(k) for i, k in enumerate(("p10", "p25", "p50", "p75", "p90"))), "n")


def segment_confidence(words: DataFrame) -> DataFrame:
    return words.groupBy(*KEY, "seg_ix").agg(F.count("*").alias("n_words"), F.count("score").alias("n_scored"), F.avg("score").alias("mean_score"), F.min("score").alias("min_score"))


def _in_order(value: str, *place: str) -> Column:
    """The group's values by place: at a threshold the last bit counts, and it depends on the order of the steps."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*place, value)))), lambda x: x[value])


def _mean(values: Column) -> Column:
    """Mean of values added up one after another; null without any."""
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def _deviation(values: Column) -> Column:
    """Population deviation by a running mean, step by step as the comparison SQL has it (Spark's own update rounds otherwise)."""

    def step(a: Column, x: Column) -> Column:
        n = a["n"] + 1
        mean = a["mean"] + (x - a["mean"]) / n
        return F.struct(n.alias("n"), mean.alias("mean"), (a["square"] + (x - mean) * (x - a["mean"])).alias("square"))

    none = F.struct(*(F.lit(0.0).alias(k) for k in ("n", "mean", "square")))
    return F.when(F.size(values) > 0, F.aggregate(values, none, step, lambda a: F.sqrt(a["square"] / a["n"])))


def hallucinated(words: DataFrame, original: DataFrame, low: float = 0.35, cv: float = 0.20, edge: float = 0.15, share: float = 0.65) -> DataFrame:
    """Segments with low confidence, evenly spaced words, or words that crowd the segment's edges; with the reasons."""
    near = (F.abs(F.col("center") - F.col("o.start")) < edge) | (F.abs(F.col("center") - F.col("o.end")) < edge)
    timed = words.filter(TIMED).withColumn("center", (F.col("start") + F.col("end")) / 2)
    gaps = timed.withColumn("gap", F.col("center") - F.lag("center").over(Window.partitionBy(*KEY, "seg_ix").orderBy("center", "word_ix")))
    placed = gaps.alias("w").join(original.alias("o"), [*KEY, "seg_ix"])
    spread = placed.groupBy(*KEY, "seg_ix").agg(F.count("*").alias("n"), _in_order("gap", "center", "word_ix").alias("gaps"), F.avg(near.cast("int")).alias("edge"))
    spread = spread.withColumns({"g": _mean(F.col("gaps")), "s": _deviation(F.col("gaps"))}).drop("gaps")
    scores = words.groupBy(*KEY, "seg_ix").agg(_in_order("score", "word_ix").alias("m")).withColumn("m", _mean(F.col("m"))).join(original.select(*KEY, "seg_ix"), [*KEY, "seg_ix"])
    rows = scores.join(spread, [*KEY, "seg_ix"], "left")
    why = F.concat_ws(",", F.when(F.col("m") < low, "low_confidence"), F.when((F.col("n") >= 3) & (F.col("g") > 0) & (F.col("s") / F.col("g") < cv), "uniform_spacing"), F.when(F.col("edge") >= share, "boundary_cluster"))
    return rows.select(*KEY, "seg_ix", why.alias("reasons")).filter("reasons <> ''")


def skipped(words: DataFrame, durations: DataFrame, least: float = 2.0, running_max: bool = False) -> DataFrame:
    """Uncovered regions of at least `least` seconds: before the first word, between neighbours by start, after the last.

    durations: audio_id, option_no, audio_duration. Without a timed word the whole recording is skipped. A neighbour is
    the row before, even if an earlier word reaches further; running_max counts that reach.
    """
    w = Window.partitionBy(KEY).orderBy("start", "seg_ix", "word_ix")
    timed = words.filter(TIMED)
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1)) if running_max else F.lag("end").over(w)
    inner = timed.select(*KEY, F.coalesce(before, F.lit(0.0)).alias("from_s"), F.col("start").alias("to_s"))
    last = timed.groupBy(KEY).agg(F.max(F.struct("start", "seg_ix", "word_ix", "end")).alias("l"), F.max("end").alias("m"))
    tail = durations.join(last, KEY, "left").select(*KEY, F.coalesce(F.col("m") if running_max else F.col("l.end"), F.lit(0.0)).alias("from_s"), F.col("audio_duration").alias("to_s"), F.col("l").isNull().alias("whole"))
    rows = inner.withColumn("whole", F.lit(False)).unionByName(tail)
    return rows.filter((F.col("to_s") - F.col("from_s") >= least) | F.col("whole")).select(*KEY, "from_s", "to_s", (F.col("to_s") - F.col("from_s")).alias("duration"))


def overlaps(words: DataFrame, least: float = 0.02) -> DataFrame:
    """Neighbours by start that overlap by more than `least` seconds."""
    w = Window.partitionBy(KEY).orderBy("start", "seg_ix", "word_ix")
    nxt = lambda c: F.lead(c).over(w)
    rows = words.filter(TIMED).select(*KEY, "word", "start", "end", nxt("word").alias("word_b"), nxt("start").alias("start_b"), nxt("end").alias("end_b"))
    size = F.least("end", "end_b") - F.greatest("start", "start_b")
    return rows.filter(F.col("start_b").isNotNull()).select(*KEY, F.col("word").alias("word_a"), "word_b", size.alias("overlap"), F.greatest("start", "start_b").alias("at_time")).filter(F.col("overlap") > least)


def punct_pause(words: DataFrame, pauses: DataFrame, tolerance: float = 0.40) -> DataFrame:
    """Agreement of punctuation with pauses: pp_score from the gap method and the match method."""
    w = Window.partitionBy(*KEY, "seg_ix").orderBy("word_ix")
    rows = words.filter(TIMED).select(*KEY, "end", F.substring(F.trim("word"), -1, 1).alias("last"), F.lead("start").over(w).alias("next"))
    rows = rows.withColumn("punct", F.expr(f"last <> '' and instr('{PUNCT}', last) > 0")).withColumn("gap", F.greatest(F.lit(0.0), F.col("next") - F.col("end")))
    p, q = F.when(F.col("punct") & F.col("next").isNotNull(), F.col("gap")), F.when(~F.col("punct") & F.col("next").isNotNull(), F.col("gap"))
    times = F.collect_list(F.when(F.col("punct"), F.col("end")))
    stats = rows.groupBy(KEY).agg(F.coalesce(F.avg(p), F.lit(0.0)).alias("mp"), F.coalesce(F.avg(q), F.lit(0.01)).alias("mn"), F.coalesce(F.avg((p >= tolerance).cast("int")), F.lit(0.0)).alias("cov"), F.count(p).alias("n_gaps"), times.alias("times"))
    held = pauses.groupBy("audio_id").agg(F.collect_list("start").alias("pauses"))
    both = stats.join(held, "audio_id", "left").withColumn("pauses", F.coalesce("pauses", F.array().cast("array<double>")))
    near = lambda xs, ys: F.size(F.filter(xs, lambda x: F.exists(ys, lambda y: F.abs(x - y) <= tolerance)))
    a = F.when(F.col("n_gaps") > 0, 0.55 * clip01((F.col("mp") / (F.col("mn") + 1e-6) - 1) / 3) + 0.45 * F.col("cov")).otherwise(0.0)
    both = both.withColumns({"a": a, "np": F.size("times"), "ns": F.size("pauses")})
    both = both.withColumn("precision", F.when(F.col("np") > 0, near(F.col("times"), F.col("pauses")) / F.col("np"))).withColumn("recall", F.when(F.col("ns") > 0, near(F.col("pauses"), F.col("times")) / F.col("ns")))
    f1 = F.when((F.col("np") > 0) & (F.col("ns") > 0), F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)).otherwise(F.col("a"))
    weight = F.when((F.col("ns") >= 3) & (F.col("np") >= 2), 0.65).otherwise(0.30)
    return both.select(*KEY, "a", f1.alias("f1"), clip01(weight * f1 + (1 - weight) * F.col("a")).alias("pp_score"), F.col("np").alias("n_punct"), F.col("ns").alias("n_pauses"))


def aqs(rows: DataFrame) -> DataFrame:
    """Alignment quality from all metrics of an option in one row; missing ones make it null, but for the characters'."""
    c = F.col
    phoneme = F.coalesce(c("phoneme_mean"), c("avg_conf"))
    skip = c("skipped") / (c("audio_duration") + 1e-8)
    base = 0.22 * c("word_ratio") + 0.15 * c("avg_conf") + 0.10 * (1 - c("unaligned_ratio")) + 0.09 * clip01(1 - c("mean_dev") / 3) + 0.06 * clip01(1 - c("p90_dev") / 3) + 0.13 * clip01(phoneme) + 0.05 * clip01(1 - c("conf_std") / 0.25) + 0.20 * clip01(c("pp_score"))
    loss = F.least(F.lit(0.30), 0.05 * c("n_hallucinated")) + F.least(F.lit(0.30), 0.5 * skip) + F.least(F.lit(0.10), 0.01 * c("n_overlaps"))
    return rows.withColumn("aqs", clip01(base - loss))


def option_quality(words: DataFrame, original: DataFrame, durations: DataFrame, pauses: DataFrame) -> DataFrame:
    """aqs of each option from its aligned words: all metrics joined on one key, which also partitions them."""
    parts = [
        unaligned_ratio(words),
        timing_deviation(words, original),
        punct_pause(words, pauses).select(*KEY, "pp_score"),
        hallucinated(words, original).groupBy(KEY).agg(F.count("*").alias("n_hallucinated")),
        skipped(words, durations).groupBy(KEY).agg(F.sum("duration").alias("skipped")),
        overlaps(words).groupBy(KEY).agg(F.count("*").alias("n_overlaps")),
    ]
    rows = word_metrics(words).join(durations, KEY)
    for p in parts:
        rows = rows.join(p, KEY, "left")
    rows = rows.fillna(0.0, ["pp_score", "skipped"]).fillna(0, ["n_hallucinated", "n_overlaps"])
    return aqs(rows.withColumn("phoneme_mean", F.lit(None).cast("double")))
