"""Signal operators on samples (audio_id, pos, x), intervals, and frame levels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def metrics(samples: DataFrame, rate: int = 16000) -> DataFrame:
    """Noise, energy and signal-to-noise figures of each recording, from its untrimmed samples in one aggregation."""
    level = F.abs(F.col("x").cast("double"))
    out = samples.groupBy("audio_id").agg(F.percentile(level, F.array(F.lit(0.9), F.lit(0.1), F.lit(0.2))).alias("q"), F.avg(level * level).alias("avg_energy"), (F.count("x") / rate).alias("raw_duration"))
    snr = F.when(F.col("q")[1] < 1e-10, 999.0).otherwise(20 * F.log10(F.col("q")[0] / F.col("q")[1]))
    out = out.select("audio_id", "raw_duration", snr.alias("snr_db"), F.col("q")[2].alias("noise_level"), "avg_energy")
    return out.withColumn("audio_quality", F.when(F.col("snr_db") > 20, "clean").when(F.col("snr_db") > 10, "moderate").otherwise("noisy"))


def energy_vad(samples: DataFrame, frame: int = 480, db: float = -45.0) -> DataFrame:
    """speech_frames, total_frames, speech_ratio by mean level of frames; a frame that ends with the recording is left out."""
    n = samples.groupBy("audio_id").agg(F.count("*").alias("n"))
    frames = samples.groupBy("audio_id", F.floor(F.col("pos") / frame).alias("f")).agg(F.avg(F.abs("x")).alias("level"))
    frames = frames.join(n, "audio_id").filter(F.col("f") * frame < F.col("n") - frame)
    loud = F.sum(F.when(F.col("level") > 10 ** (db / 20), 1).otherwise(0))
    return frames.groupBy("audio_id").agg(loud.alias("speech_frames"), F.count("*").alias("total_frames")).withColumn("speech_ratio", F.col("speech_frames") / F.col("total_frames"))


def trim_silence(samples: DataFrame, db: float = -40.0) -> DataFrame:
    """first, last: the edges of what is louder than a share of the peak; a silent recording keeps all of itself."""
    peak = samples.groupBy("audio_id").agg(F.max(F.abs("x")).alias("peak"), F.max("pos").alias("end"))
    loud = samples.join(peak, "audio_id").groupBy("audio_id", "end").agg(*(f(F.when(F.abs("x") > F.col("peak") * 10 ** (db / 20), F.col("pos"))).alias(k) for f, k in ((F.min, "first"), (F.max, "last"))))
    return loud.select("audio_id", F.coalesce("first", F.lit(0)).cast("long").alias("first"), F.coalesce("last", "end").cast("long").alias("last"))


def speech_ratio(vad: DataFrame, lengths: DataFrame) -> DataFrame:
    """Share of samples inside speech intervals (audio_id, start, end); recordings without any have 0."""
    spoken = vad.groupBy("audio_id").agg(F.sum(F.col("end") - F.col("start")).alias("spoken"))
    return lengths.join(spoken, "audio_id", "left").select("audio_id", (F.coalesce("spoken", F.lit(0)) / F.col("n")).alias("speech_ratio"))


def gap_plan(vad: DataFrame, rate: int = 16000, lead: float = 0.40, trail: float = 0.25, least: float = 0.12, most: float = 2.0) -> DataFrame:
    """Padded parts to keep and the silence to put after each, from speech intervals (audio_id, seg_ix, start, end, n)."""
    w = Window.partitionBy("audio_id").orderBy("start", "seg_ix")
    following = F.lead("start").over(w)
    rest = F.greatest(F.lit(0.0), F.greatest(F.lit(0.0), (following - F.col("end")) / rate) - trail - lead)
    gap = F.when(following.isNotNull(), F.floor(rate * F.greatest(F.lit(least), F.least(rest, F.lit(most)))))
    start, end = F.greatest(F.lit(0), F.col("start") - int(lead * rate)), F.least(F.col("n"), F.col("end") + int(trail * rate))
    return vad.select("audio_id", "seg_ix", start.cast("long").alias("from_pos"), end.cast("long").alias("to_pos"), F.coalesce(gap, F.lit(0)).cast("long").alias("gap"))


def trim_by_plan(audio: DataFrame, plan: DataFrame, keep: float = 0.40) -> DataFrame:
    """audio_id, samples put together by a gap plan; the original where none, or under `keep` of it, would be left."""
    parts = plan.groupBy("audio_id").agg(F.sort_array(F.collect_list(F.struct("seg_ix", "from_pos", "to_pos", "gap"))).alias("plan"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x, plan in zip(b.samples, b.plan):
                made = [y for p in (plan if plan is not None else []) for y in (x[p["from_pos"] : p["to_pos"]], np.zeros(p["gap"], np.float32))]
                y = np.concatenate(made) if made else x
                out.append(y if len(y) >= keep * len(x) else x)
            yield pd.DataFrame({"audio_id": b.audio_id, "samples": out})

    return audio.select("audio_id", "samples").join(parts, "audio_id", "left").mapInPandas(run, "audio_id string, samples array<float>")


def pauses(levels: DataFrame, hop: float, db: float = -42.0, least: float = 0.12) -> DataFrame:
    """start, end, duration of quiet runs in frame levels (audio_id, frame, rms): islands between changes."""
    w = Window.partitionBy("audio_id").orderBy("frame")
    quiet = (20 * F.log10(F.greatest("rms", F.lit(1e-10))) < db).cast("int")
    rows = levels.select("audio_id", "frame", quiet.alias("q")).withColumn("new", (F.col("q") != F.coalesce(F.lag("q").over(w), F.lit(-1))).cast("int"))
    rows = rows.withColumn("island", F.sum("new").over(w)).withColumn("next", F.coalesce(F.lead("frame").over(w), F.col("frame")))
    out = rows.filter("q = 1").groupBy("audio_id", "island").agg((F.min("frame") * hop).alias("start"), (F.max("next") * hop).alias("end"))
    return out.withColumn("duration", F.col("end") - F.col("start")).filter(F.col("duration") >= least).select("audio_id", "start", "end", "duration")


def chunk_plan(lengths: DataFrame, rate: int = 16000, chunk: float = 30.0, overlap: float = 1.0) -> DataFrame:
    """Chunks [from_pos, to_pos) of n samples with an overlap; the last is what is left."""
    size, step = int(chunk * rate), int((chunk - overlap) * rate)
    starts = F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1, F.lit(step).cast("long")))
    return lengths.select("audio_id", "n", F.posexplode(starts).alias("chunk_ix", "from_pos")).select("audio_id", "chunk_ix", "from_pos", F.least(F.col("from_pos") + size, F.col("n")).alias("to_pos"))
