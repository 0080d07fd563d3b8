"""Pseudo-perplexity, structure, their blend, and the boost that breaks ties."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ..functions import sequences
from ..functions.scores import clip01

KEY = ["audio_id", "option_no"]

# Bracket pairs, and characters whose repetition counts.
OPENERS, CLOSERS = "([{«‹“‘", ")]}»›”’"
RUN_CHARS = "؟،؛.!?,;:\"'\\-–—"


def pppl(logprobs: DataFrame) -> DataFrame:
    """exp of the negative mean log probability of masked tokens; null with fewer than two."""
    return logprobs.groupBy(KEY).agg(F.when(F.count("lp") >= 2, F.exp(-F.avg("lp"))).alias("pppl"))


def pppl_score(p: Column, worst: float = 200.0) -> Column:
    return F.when(p.isNull(), 0.5).otherwise(clip01(1 - F.ln(F.greatest(F.lit(1.0), p)) / F.ln(F.lit(max(worst, 2.0)))))


def bracket_balance(c: Column) -> Column:
    """Brackets without a partner: a closer that does not match the top counts and leaves it; openers left count."""
    chars = F.filter(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), rf"[^\Q{OPENERS}{CLOSERS}\E]", ""), ""), lambda x: x != "")
    zero = F.struct(F.lit("").alias("stack"), F.lit(0).alias("bad"))

    def step(a: Column, x: Column) -> Column:
        opens = F.position(x, F.lit(OPENERS))
        closes = F.position(x, F.lit(CLOSERS))
        top = F.substring(a["stack"], -1, 1)
        fits = (closes > 0) & (F.length(a["stack"]) > 0) & (F.position(top, F.lit(OPENERS)) == closes)
        stack = F.when(opens > 0, F.concat(a["stack"], x)).when(fits, F.substring(a["stack"], F.lit(1), F.length(a["stack"]) - 1)).otherwise(a["stack"])
        return F.struct(stack.alias("stack"), (a["bad"] + F.when((closes > 0) & ~fits, 1).otherwise(0)).alias("bad"))

    return F.aggregate(chars, zero, step, lambda a: a["bad"] + F.length(a["stack"]))


def punct_runs(c: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rf"([{RUN_CHARS}])\1{{3,}}"), F.lit(1)))


def structural(c: Column) -> Column:
    loss = F.least(F.lit(0.4), 0.1 * bracket_balance(c)) + F.least(F.lit(0.2), 0.05 * punct_runs(c)) + 0.15 * sequences.script_mix(F.coalesce(c, F.lit(""))).cast("int")
    return clip01(1 - loss)


def lgs(score: Column, structure: Column) -> Column:
    return clip01(0.75 * score + 0.25 * structure)


def odd_one_out(texts: dict[int, str], least: float = 0.005, ratio: Callable[[str, str], float] = sequences.char_ratio) -> int | None:
    """The text that is least like the others on average, if it is clearly so."""
    if len(texts) < 3:
        return None
    mean = {a: float(np.mean([ratio(x, y) for b, y in texts.items() if b != a])) for a, x in texts.items()}
    low = min(mean, key=mean.get)
    rest = float(np.mean([v for k, v in mean.items() if k != low]))
    return low if rest - mean[low] >= least else None


def tie_boost(rows: DataFrame, boost: float = 0.015, passes: int = 10) -> DataFrame:
    """rows (audio_id, option_no, transcript, lgs, and others, which stay) with ties of three or more broken in favour of
    the odd one out.

    One option is boosted a pass, until nothing changes. A group holds the options of one recording; passes share the
    ratios of its texts. Groups are few bytes and much work, so they keep the session's number of partitions.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("option_no").reset_index(drop=True)
        score, flag = group.lgs.to_list(), [False] * len(group)
        ratio = cache(sequences.char_ratio)
        for _ in range(passes):
            buckets: dict[float, list[int]] = {}
            for i, s in enumerate(score):
                if s is not None and s == s:
                    buckets.setdefault(round(s, 4), []).append(i)
            odd = next((o for b in buckets.values() if len(b) >= 3 and (o := odd_one_out({i: group.transcript[i] for i in b if group.transcript[i]}, ratio=ratio)) is not None), None)
            if odd is None:
                break
            score[odd], flag[odd] = min(max(score[odd] + boost, 0.0), 1.0), True
        return group.assign(lgs=score, tiebreak=flag)

    dealt = rows.withColumns({"option_no": F.col("option_no").cast("int"), "lgs": F.col("lgs").cast("double")}).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "audio_id")
    return dealt.groupBy("audio_id").applyInPandas(run, StructType([*dealt.schema, StructField("tiebreak", BooleanType())]))
