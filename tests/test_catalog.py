"""Queries against DuckDB on the smallest tables, and hand-computed boundary cases."""

import glob
import os
import random
from difflib import SequenceMatcher

import duckdb
import pytest
from pyspark.sql import functions as F

from quillrank.functions import sequences, text
from quillrank.functions.scores import clip01
from quillrank.operators import alignment, consensus, filters, linguistic, ranking, similarity
from quillrank.plans.catalog import ORACLES, QUERIES

D = "/root/testdata/sf0.001"
NAMES = ["punct_pause", "aqs", "load_candidates", "pending_ids", "audio_metrics", "vad_gap_plan", "lang_ensemble", "normalize_cmp", "check_repetition", "consensus", "rss", "skipped_regions", "overlaps", "cer", "bag_confusion", "final_ranking", "final_ranking_strict", "selection_accuracy", "upsert_results", "discover_ids", "lang_best", "results_wide"]


def rows(columns, data):
    def plain(v):
        if v is None or v != v:
            return None
        return round(float(v), 6) if not isinstance(v, (str, bool)) else v

    return sorted(repr([plain(v) for _, v in sorted(zip(columns, r))]) for r in data)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_duckdb(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{D}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = QUERIES[name](spark, D)
    other = con.execute(ORACLES[name])
    columns = [c[0] for c in other.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, other.fetchall())


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column).first()[0]


def test_word_error_edges(spark):
    w = lambda r, h: one(spark, similarity.wer(F.col("r"), F.col("h")), r=r, h=h)
    assert [w("", "a"), w("a", ""), w("a b c", "a x c"), w("a", "b c d e")] == [0.0, 1.0, 1 / 3, 1.0]
    assert one(spark, similarity.wer_uncapped(F.col("r"), F.col("h")), r="a", h="b c d e") == 4.0


def test_word_error_of_very_many_words(spark):
    words = [f"w{i}" for i in range(60_000)]
    w = lambda r, h: one(spark, similarity.wer(F.col("r"), F.col("h")), r=r, h=h)
    assert w(" ".join(words), " ".join(words)) == 0.0
    assert one(spark, similarity.wer_uncapped(F.col("r"), F.col("h")), r="a", h=" ".join(words)) == 60_000.0


def test_discovery_takes_whole_names_only(spark):
    paths = ["/a/12.mp3", "7.mp3", "/a/abc12.mp3", "/a/x-9.mp3", "/a/3.wav", "/a/9.mp3.txt"]
    from quillrank.sources import tables

    assert [r.audio_id for r in tables.discover(spark.createDataFrame([(p,) for p in paths], "path string")).collect()] == ["7", "12"]


def test_lookup_takes_the_first_row_and_raises(spark):
    from quillrank.sources import tables

    sheet = spark.createDataFrame([("1", "fr", "a", 2), ("1", "en", "b", 1)], "audio_id string, language string, option_1 string, correct_option int").coalesce(1)
    assert [tuple(r) for r in tables.lookup(sheet, "1").select("transcript", "language", "correct_option").collect()] == [("a", "fr", 2)]
    with pytest.raises(KeyError):
        tables.lookup(sheet, "5")


def test_steps_are_cheapest():
    steps = sequences.steps("the cat sat on the mat".split(), "the cat sit on mat now".split())
    assert sum(op != "H" for op, *_ in steps) == 3
    assert [h for op, _, h in steps if op != "D"] == "the cat sit on mat now".split()


def test_autojunk(spark):
    a, b = " ".join(["q"] + ["the", "cat"] * 120), " ".join(["the", "cat"] * 120)
    assert one(spark, sequences.ratio(True, True)("a", "b"), a=a, b=b) == 0.0
    assert one(spark, sequences.ratio(False, True)("a", "b"), a=a, b=b) > 0.99


def test_ratio_of_characters_is_that_of_difflib():
    rnd = random.Random(3)
    for _ in range(400):
        a, b = ("".join(rnd.choices("ab c", k=rnd.randint(0, 60))) for _ in "ab")
        for x, y in ((a, b), (a, b[:5] + a[7:] + b[5:]), (a * 2, a), (a, a)):
            assert sequences.char_ratio(x, y) == sequences.char_ratio(x, y, deep=3) == sequences.char_ratio(x, y, most=0) == SequenceMatcher(None, x, y, autojunk=False).ratio()


def test_distance_is_that_of_the_table_and_pairs_are_dealt_out(spark):
    rnd = random.Random(4)

    def plain(a, b):
        last = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            last = row
        return last[-1]

    for _ in range(400):
        a, b = (rnd.choices(["a", "bc", "é", "𝄞"], k=rnd.randint(0, 90)) for _ in "ab")
        for x, y in ((a, b), (a, a[:5] + b[7:] + a[9:]), ("".join(a), "".join(b)), (a, a)):
            assert sequences.distance(x, y) == sequences.distance(y, x, kept=0) == plain(x, y)
        for x in (a, a * 5):
            assert sequences.word_ratio(x, b * 4) == SequenceMatcher(None, x, b * 4).ratio()
    made = QUERIES["tss"](spark, D)
    assert made.select(F.spark_partition_id()).distinct().count() == 4  # one small file still uses all partitions
    assert "levenshtein" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_tie_boost_takes_each_ratio_once_and_spreads(spark, monkeypatch):
    rows = [(f"r{i}", n, f"{t} {i}", 0.5) for i in range(40) for n, t in enumerate(["one two three", "one two tree", "quite another", "one to three", "or else"], 1)]
    made = linguistic.tie_boost(spark.createDataFrame(rows, "audio_id string, option_no int, transcript string, lgs double"))
    assert made.select(F.spark_partition_id()).distinct().count() == 4  # small groups still use all partitions
    assert {r.option_no for r in made.filter("tiebreak").collect()} >= {3, 5}
    monkeypatch.setattr(linguistic, "SequenceMatcher", None, raising=False)  # no pair of texts is left to the slow matcher
    assert linguistic.odd_one_out({1: "one two", 2: "one too", 3: "else"}) == 3


def test_checks(spark):
    ok = lambda f, t: one(spark, f(text.words(F.col("t"))), t=t)
    assert not ok(filters.check_ttr, "yes yes yes yes yes yes") and ok(filters.check_ttr, "a a a")
    assert not ok(filters.check_empty_tokens, ". . . . . . text")
    assert ok(filters.check_repetition, "a b c") and not ok(filters.check_repetition, "a a a b c")


def test_checks_need_no_second_reading_and_repetition_counts_words(spark):
    plan = QUERIES["filter_candidates"](spark, D)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and QUERIES["check_ttr"](spark, D)._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0
    rnd = random.Random(5)

    def plain(t):
        top, grams = max(t.count(x) for x in t), [tuple(t[i : i + 5]) for i in range(len(t) - 4)] if len(t) >= 10 else []
        return len(t) <= 3 or (top / len(t) <= 0.4 and max(map(grams.count, grams), default=0) < 3)

    texts = [rnd.choices("abcdef"[: rnd.randint(1, 6)], k=rnd.randint(1, 30)) for _ in range(300)] + [list("abcdefgh") * 3, list("abcdefgh") * 2, list("aabcd"), list("aaaabbbccc"), list("aaaaabbbcc")]
    made = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "i int, t string").select("i", filters.check_repetition(text.words(F.col("t"))).alias("ok")).collect()
    assert {r.i: r.ok for r in made} == {i: plain(t) for i, t in enumerate(texts)}


def test_nested_limits_hold_their_value_once(spark):
    df = spark.range(1).select((F.col("id") / 2).alias("x"))
    nested = clip01(1 - clip01(1 - clip01(1 - linguistic.structural(F.col("x").cast("string")))))
    assert df.select(nested.alias("y"))._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert [one(spark, clip01(F.col("x")), x=x) for x in (-1.0, 0.25, 7.0)] == [0.0, 0.25, 1.0]


def test_arrow_functions_get_small_batches(spark):
    @text.small
    @F.pandas_udf("long")
    def rows_at_once(x):
        return x * 0 + len(x)

    @text.small
    @F.pandas_udf("long")
    def bytes_at_once(x):
        return x.map(len) * 0 + int(x.map(len).sum())

    names = list(text.BATCH)
    try:
        for name in names:
            spark.conf.unset(name)
        assert spark.range(20_000, numPartitions=1).select(rows_at_once("id").alias("n")).agg(F.max("n")).first()[0] <= 1000
        texts = spark.range(400, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
        assert texts.select(bytes_at_once("t").alias("n")).agg(F.max("n")).first()[0] <= 3 << 20
        spark.conf.set(names[1], "7")
        text.nfkc(F.col("t"))
        assert spark.conf.get(names[1]) == "7"
    finally:
        for name in names:
            spark.conf.unset(name)


def test_rate_bounds_belong_to_the_range(spark):
    w = " ".join(["w"] * 140)
    for n, k, ok in ((147, 1, True), (217, 2, True), (148, 1, False)):  # 140 of n words: 0.4 exactly, and less
        seconds = n / (0.55 + k * 0.5)
        assert one(spark, filters.check_rate(text.words(F.col("t")), F.lit("en"), F.col("s")), t=w, s=seconds) is ok


def test_brackets_runs_and_clip(spark):
    n = lambda f, t: one(spark, f(F.col("t")), t=t)
    assert [n(linguistic.bracket_balance, t) for t in ("([)]", "don’t", "(a)", "")] == [2, 1, 0, 0]
    assert [n(linguistic.punct_runs, t) for t in ("!!!!", "!!!")] == [1, 0]
    assert one(spark, clip01(F.col("x")), x=float("nan")) is None
    assert [one(spark, linguistic.pppl_score(F.col("p")), p=p) for p in (1.0, 200.0, 1000.0)] == [1.0, 0.0, 0.0]


def test_numbers_in_sequence(spark):
    assert one(spark, text.normalize_full(F.col("t"), F.col("l")), t="twenty-one", l="en") == "201"


def test_consensus_ties_go_to_the_first_model(spark):
    df = spark.createDataFrame([("x", 0, "a b"), ("x", 1, "a c"), ("x", 2, "a c"), ("y", 0, "a"), ("y", 1, "b"), ("z", 0, "")], "audio_id string, model_ix int, text string")
    assert {r[0]: r[1] for r in consensus.consensus(df).collect()} == {"x": "a c", "y": "a", "z": ""}
    agreed = {r[0]: r[1] for r in consensus.agreement(df).collect()}
    assert abs(agreed["x"] - 5 / 6) < 1e-12 and agreed["z"] is None


def test_low_confidence_does_not_depend_on_the_order_of_rows(spark):
    score = [0.67, 0.24, 0.26, 0.42, 0.03, 0.48]  # 0.35 on average; added up word by word 0.3499999999999999
    rows = [("x", 1, 0, i, "w", 10.0 * i, 10.0 * i + 1, s) for i, s in enumerate(score)]
    kind = "audio_id string, option_no int, seg_ix int, word_ix int, word string, start double, end double, score double"
    span = spark.createDataFrame([("x", 1, 0, -9.0, 99.0)], "audio_id string, option_no int, seg_ix int, start double, end double")
    for order in ((0, 1, 2, 3, 4, 5), (5, 4, 3, 2, 1, 0), (1, 3, 5, 0, 2, 4), (4, 1, 2, 3, 5, 0), (3, 5, 0, 1, 2, 4)):
        made = alignment.hallucinated(spark.createDataFrame([rows[i] for i in order], kind).coalesce(1), span).collect()
        assert ["low_confidence" in r.reasons for r in made] == [True]


def test_spacing_at_its_bound_is_that_of_the_sql(spark, tmp_path):
    """Gaps whose deviation is a fifth of their mean: which side the last bit falls to depends on the steps of the variance."""
    ids = {1: [48, 50, 54, 62, 70], 2: [49, 57, 65, 67, 71], 3: [48, 56, 64, 66, 70]}  # three more words have no times
    events = [(e, f"2024-01-01 00:00:{i:02}", u, "view") for u, es in ids.items() for i, e in enumerate(es)]
    events += [(90 + i, f"2024-01-01 00:00:{i:02}", u, "error") for u in ids for i in range(5, 8)]
    made = spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string").selectExpr("event_id", "to_timestamp(ts) as ts", "user_id", "event_type")
    made.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    for name in ("hallucinated_segments", "aqs"):
        df, other = QUERIES[name](spark, str(tmp_path)), con.execute(ORACLES[name])
        columns, data = [c[0] for c in other.description], other.fetchall()
        assert len(data) == 3 and rows(df.columns, df.collect()) == rows(columns, data)


def test_regions_and_overlaps(spark):
    kind = "audio_id string, option_no int, seg_ix int, word_ix int, word string, start double, end double, score double"
    w = spark.createDataFrame([("x", 1, 0, i, "w", *t, 1.0) for i, t in enumerate([(0.0, 10.0), (1.0, 2.0), (5.0, 6.0)])] + [("y", 1, 0, 0, "w", None, None, None)], kind)
    d = spark.createDataFrame([("x", 1, 10.0), ("y", 1, 1.0)], "audio_id string, option_no int, audio_duration double")
    assert sorted((r.audio_id, r.from_s, r.to_s) for r in alignment.skipped(w, d).collect()) == [("x", 2.0, 5.0), ("x", 6.0, 10.0), ("y", 0.0, 1.0)]
    assert alignment.overlaps(w, 1.0).count() == 0 and alignment.overlaps(w, 0.5).count() == 1


def test_final_policies(spark):
    t = lambda name, data: spark.createDataFrame(data, f"audio_id string, option_no int, {name} double")
    a, s, g = t("aqs", [("x", 1, 1.0), ("x", 2, 1.0)]), t("tss", [("x", 1, 1.0), ("x", 2, 1.0)]), t("lgs", [("x", 2, 1.0)])
    assert [(r.option_no, r.rank) for r in ranking.final(a, s, g).orderBy("rank").collect()] == [(2, 1), (1, 2)]
    assert [r.option_no for r in ranking.final(a, s, g, missing="strict").collect()] == [2]
    assert ranking.Weights(0, 0, 0).settled() == ranking.Weights(0.45, 0.35, 0.20)


def test_poll_is_idempotent(spark, tmp_path):
    from quillrank.streaming.poll import poll

    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    score = lambda rows: rows.select("audio_id", F.lit(1).alias("detected_option"))
    for part in (["1", "2"], ["2", "3"]):
        spark.createDataFrame([(x,) for x in part], "audio_id string").write.mode("append").parquet(src)
        poll(spark, src, "audio_id string", out, ck, score).awaitTermination()
    assert sorted(r.audio_id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]
