"""The row pipeline against the same chain recomputed in plain Python, and its treatment of gaps."""

from collections import defaultdict
from difflib import SequenceMatcher
from math import exp, log
from statistics import fmean, pvariance

import pytest
from pyspark.sql import functions as F

from quillrank.functions import text
from quillrank.operators import alignment, ranking
from quillrank.plans import rows
from quillrank.sources import fixtures as fx

D = "/root/testdata/sf0.001"
clip = lambda x: min(1.0, max(0.0, x))


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def given(spark):
    words = fx.talk_aligned(spark, D)
    return rows.Outputs(fx.talk_asr(spark, D), words, fx.segments(words), fx.durations(words), fx.word_pauses(words.filter("option_no = 1")), fx.logprobs(spark, D))


def expected(spark, out):
    """Every score anew from the texts; the alignment score, which has SQL of its own, is read."""
    quality = {(r.audio_id, r.option_no): r.aqs for r in alignment.option_quality(out.words, out.segments, out.durations, out.pauses).collect()}
    refs, lps, texts = defaultdict(list), defaultdict(list), {}
    for r in out.texts.filter("trim(text) <> ''").select("audio_id", text.normalize_cmp(F.col("text")).alias("t")).collect():
        refs[r.audio_id].append(r.t)
    for r in out.logprobs.collect():
        lps[r.audio_id, r.option_no].append(r.lp)
    for r in fx.talk(spark, D).select("audio_id", "option_no", "transcript", text.normalize_cmp(F.col("transcript")).alias("t")).collect():
        if r.transcript and r.transcript.strip() and (r.audio_id, r.option_no) in quality and refs[r.audio_id]:
            texts[r.audio_id, r.option_no] = (r.transcript.strip(), r.t)
    alike, fluent = {}, defaultdict(dict)
    for key, (raw, h) in texts.items():
        w = [min(1.0, distance(r.split(), h.split()) / len(r.split())) if r.split() and h.split() else float(bool(r.split())) for r in refs[key[0]]]
        c = [min(1.0, distance(r, h) / len(r)) if r and h else float(bool(r)) for r in refs[key[0]]]
        f = [SequenceMatcher(None, r.split(), h.split()).ratio() for r in refs[key[0]]]
        alike[key] = (fmean(w), fmean(c), clip(0.45 * (1 - fmean(w)) + 0.2 * (1 - fmean(c)) + 0.15 * fmean(f) + 0.2 * clip(1 - 20 * pvariance(w))))
        lp = lps[key]
        score = clip(1 - log(max(1.0, exp(-fmean(lp)))) / log(200.0)) if len(lp) >= 2 else 0.5
        assert not set(raw) & set("([{)]}«»‹›“”‘’")  # so structure loses nothing
        fluent[key[0]][key[1]] = 0.75 * score + 0.25
    for audio, own in fluent.items():
        for _ in range(10):
            ties = defaultdict(list)
            for o in sorted(own):
                ties[round(own[o], 4)].append(o)
            for tied in ties.values():
                if len(tied) >= 3:
                    mean = {o: fmean(SequenceMatcher(None, texts[audio, o][0], texts[audio, p][0], autojunk=False).ratio() for p in tied if p != o) for o in tied}
                    low = min(mean, key=mean.get)
                    if fmean(v for o, v in mean.items() if o != low) - mean[low] >= 0.005:
                        own[low] = clip(own[low] + 0.015)
                        break
            else:
                break
    found = {}
    for key in texts:
        w, c, t = alike[key]
        g = fluent[key[0]][key[1]]
        found[key] = (w, quality[key], c, t, g, clip(0.5 * quality[key] + 0.45 * t + 0.05 * g))
    return found


def test_chain_against_plain_python(spark):
    out = given(spark)
    made = rows.scored(fx.talk_sheet(spark, D), out).collect()
    wanted = expected(spark, out)
    assert {(r.audio_id, r.option_no) for r in made} == set(wanted) and len(made) == len(wanted) > 20
    for r in made:
        assert (r.wer, r.aqs, r.cer, r.tss, r.lgs, r.final_score) == pytest.approx(wanted[r.audio_id, r.option_no], abs=1e-9)
    order = defaultdict(list)
    for (audio, option), v in wanted.items():
        order[audio].append((-round(v[-1], 9), option))
    assert {(r.audio_id, r.option_no): r.rank for r in made} == {(a, o): i + 1 for a, x in order.items() for i, (_, o) in enumerate(sorted(x))}


def small(spark, texts, words=(1, 2, 3)):
    f = spark.createDataFrame
    sheet = f([("a", "one two", "", "one three", 7), ("b", "x", "y", "z", None)], "audio_id string, option_1 string, option_2 string, option_3 string, detected_option int")
    aligned = f([(a, o, 0, i, "w", float(i), i + 0.5, 0.9) for a in "ab" for o in words for i in range(2)], "audio_id string, option_no int, seg_ix int, word_ix int, word string, start double, end double, score double")
    spans = f([(a, o, 0, 0.0, 1.5) for a in "ab" for o in words], "audio_id string, option_no int, seg_ix int, start double, end double")
    long = f([(a, o, 1.5) for a in "ab" for o in words], "audio_id string, option_no int, audio_duration double")
    pauses = f([], "audio_id string, start double, end double")
    lps = f([], "audio_id string, option_no int, lp double")
    return sheet, rows.Outputs(f(texts, "audio_id string, model_ix int, text string"), aligned, spans, long, pauses, lps)


def test_gaps(spark):
    """Blank and unaligned options have no score, recordings without a recognised text no row; the sheet keeps the rest."""
    sheet, out = small(spark, [("a", 0, "one two"), ("a", 1, " "), ("b", 0, ""), ("b", 1, None)], words=(1, 2))
    made = rows.scored(sheet, out)
    assert [(r.audio_id, r.option_no, r.rank) for r in made.collect()] == [("a", 1, 1)]
    done = {r.audio_id: r for r in rows.results(sheet, made).collect()}
    assert done["a"].detected_option == 1 and done["b"].detected_option is None and done["b"].option_2 == "y"
    assert done["a"].option_1_wer == 0.0 and done["a"].option_2_wer is None
    assert [r.detected for r in rows.report(made).collect()] == [True]


def test_policies_and_columns(spark):
    sheet, out = small(spark, [("a", 0, "one two"), ("b", 0, "y")])
    zero, strict = rows.scored(sheet, out), rows.scored(sheet, out, missing="strict")
    same = lambda df: sorted(tuple(r) for r in df.collect())
    assert same(zero) == same(strict)  # every live option has all three scores
    wide = ranking.wide(zero)
    assert wide.columns == ["audio_id", *(f"option_{n}_{m}" for m in ("wer", "aqs", "cer", "tss", "lgs", "final_score") for n in range(1, 6)), "detected_option"]
    with pytest.raises(ValueError):
        rows.scored(sheet, out, missing="none")


def test_alignment_is_computed_once(spark):
    made = rows.scored(fx.talk_sheet(spark, D), given(spark))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("percentile(") == 1
    assert fx.talk_aligned(spark, D).select(F.spark_partition_id()).distinct().count() == 4


def test_empty_tables(spark):
    sheet, out = small(spark, [])
    assert rows.scored(sheet.limit(0), out).count() == 0 and rows.scored(sheet, out).count() == 0
    assert rows.results(sheet, rows.scored(sheet, out)).count() == 2
