"""Benchmark decontamination by runs that every overlap holds, with DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Seeds of the benchmark up to which they are sent to all executors (8 bytes each, and their places), and doc_ids to drop.
BROADCAST_SEEDS = 200_000

#: Slots of the seed filter for each seed at least, and slots at least and at most (a byte each).
SEED_SLOTS, FILTER_SLOTS = 32, (1 << 10, 1 << 22)

#: A passage leaks if at least LEAST tokens of it (or the whole item, if shorter) agree in SHARE of the places. A window
#: of twice LEAST or more that agrees so has a half that does, so those that hold a hit end within REACH of it.
LEAST, SHARE = 16, 0.8
REACH = 2 * LEAST - 2

#: What a place that differs takes away, where one that agrees adds 1: windows of SHARE or more sum up to 0 or more.
COST = round(SHARE / (1 - SHARE))


def run_of(n: int) -> int:
    """Tokens that agree in a row, at least, in n tokens that agree in SHARE of the places.

    n - w tokens in the w + 1 gaps of w others; 4 for every n of 16 or more, since w is at most n / 5.
    """
    wrong = n // (COST + 1)
    return -(-(n - wrong) // (wrong + 1))


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def seed(hashes: str, i: Column, k: int) -> Column:
    """Hash of k tokens from token i (from 1) of a hashed text."""
    return F.xxhash64(F.lit(k), *(F.get(hashes, i - 1 + j) for j in range(k)))


def places_of(k: int) -> Column:
    """Places of all runs of k tokens of a text, from 1."""
    return F.when(F.col("n") >= k, F.sequence(F.lit(1), F.col("n") - k + 1)).otherwise(F.array().cast("array<int>"))


def settled(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """keep and the columns given, computed once a row.

    Without the generator in between, the optimiser would put an array's expression in the place of each use of it, also
    inside functions over its elements, and compute it anew for each element.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def seed_filter(index: DataFrame, n_seeds: int) -> tuple[Column, int]:
    """For each slot whether some seed of index falls there, as an array of 0 and 1, and the number of slots.

    Executors fill the slots. They go into the plan as one string, which the optimiser turns into an array constant. Its
    size follows the benchmark, never the texts, and is bounded: of a larger benchmark more runs pass, which the join on
    the seeds themselves settles.
    """
    low, high = FILTER_SLOTS
    slots = min(high, max(low, 1 << (n_seeds * SEED_SLOTS).bit_length()))
    full = index.select(F.col("seed").bitwiseAND(slots - 1).alias("i"), F.lit("1").alias("b")).distinct()
    rows = index.sparkSession.range(slots).withColumnRenamed("id", "i").join(full, "i", "left").select("i", F.coalesce("b", F.lit("0")).alias("b"))
    made = rows.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "b"))), lambda x: x["b"]), ",").alias("slots"))
    return F.split(F.lit(made.first()[0]), ",").cast("array<tinyint>"), slots


def _hashed(df: DataFrame, *keep: str) -> DataFrame:
    """keep, words, their hashes h, and their number n."""
    rows = settled(df, list(keep), words=tokens(common.text_of()))
    return settled(rows, [*keep, "words"], h=F.transform("words", lambda w: F.xxhash64(w)), n=F.size("words"))


def leaks(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """key, item_id, shift, at, item_at, end, same: verified overlaps of df's texts with benchmark items.

    at and item_at: first token of the overlap in the text and in the item; end: that after its last one in the text;
    same: how many tokens agree, at most, in the windows that make it up. One row for each text, item and alignment
    (shift: at - item_at).
    """
    items = common.written(_hashed(benchmark.filter("item_id is not null"), "item_id").filter("n > 0"))
    # whole items of less than LEAST tokens hold shorter runs
    k_of = F.element_at(F.array(*(F.lit(run_of(n)) for n in range(1, LEAST + 1))), F.least(F.col("n"), F.lit(LEAST)))
    runs = sorted(r[0] for r in items.select(k_of).distinct().collect())
    places = items.withColumn("k", k_of)
    places = [places.filter(F.col("k") == k).select("item_id", "k", "h", F.explode(places_of(k)).alias("q")).select("item_id", "k", "q", seed("h", F.col("q"), k).alias("seed")) for k in runs]
    index = items.select("item_id", F.lit(0).alias("k"), F.lit(0).alias("q"), F.lit(0).cast("long").alias("seed")).limit(0)
    for some in places:
        index = index.unionByName(some)
    index = common.written(index)
    n_seeds = index.count()
    whole = items.select("item_id", F.col("words").alias("item"))

    around = lambda p: F.slice("words", F.greatest(p - REACH, F.lit(1)), F.least(F.lit(REACH), p - 1) + REACH + 1)
    texts = _hashed(df.select(common.key_of().alias("key"), "text"), "key")
    full, slots = seed_filter(index, n_seeds)
    # one row a token, inside one generated loop: only rows that pass the filter take the words around with them
    every = texts.select("key", "words", "h", "n", F.posexplode("h").alias("i", "x")).withColumn("p", F.col("i") + 1)
    seeds = [F.when(F.col("p") + k - 1 <= F.col("n"), seed("h", F.col("p"), k)) for k in runs]
    known = [F.get(full, x.bitwiseAND(slots - 1).cast("int")) == 1 for x in seeds]
    hits = every.filter(reduce(or_, known, F.lit(False))).select("key", "p", around(F.col("p")).alias("near"), F.explode(F.array(F.lit(None).cast("long"), *seeds)).alias("seed"))
    # the index and the items go to all executors if they are few; else the hits, which are few, are shuffled to them
    small = F.broadcast if n_seeds <= BROADCAST_SEEDS else lambda x: x
    pairs = hits.join(small(index.select("seed", "item_id", "q")), "seed").join(small(whole), "item_id")
    pairs = pairs.withColumn("before", F.least(F.lit(REACH), F.col("p") - 1))
    pairs = pairs.withColumn("left", F.least("before", F.col("q") - 1))
    right = F.least(F.size("near") - F.col("before"), F.size("item") - F.col("q") + 1)
    pairs = settled(pairs, ["key", "item_id", "p", "q", "near", "item", "before", "left"], length=F.col("left") + right, need=F.least(F.lit(LEAST), F.size("item"))).filter("length >= need")
    steps = F.zip_with(F.slice("near", F.col("before") - F.col("left") + 1, F.col("length")), F.slice("item", F.col("q") - F.col("left"), F.col("length")), lambda a, b: F.when(a == b, 1).otherwise(-COST))
    sums = F.aggregate(steps, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    pairs = settled(pairs, ["key", "item_id", "p", "q", "left", "length", "need"], sums=sums)
    # a window from i to j (both from 0, j after its last token) agrees well enough if the sum does not fall in it
    fits = lambda i, j: F.get("sums", j) >= F.get("sums", i)
    starts = lambda j: F.sequence(F.lit(0), j - F.col("need"))
    ends = F.filter(F.sequence(F.col("need"), F.col("length")), lambda j: F.exists(starts(j), lambda i: fits(i, j)))
    sure = settled(pairs, ["key", "item_id", "p", "q", "left", "need", "sums"], ends=ends).filter(F.size("ends") > 0)
    sure = settled(sure, ["key", "item_id", "p", "q", "left", "need", "sums"], j=F.element_at("ends", -1))
    sure = settled(sure, ["key", "item_id", "p", "q", "left", "sums", "j"], i=F.get(F.filter(starts(F.col("j")), lambda i: fits(i, F.col("j"))), 0))
    length = F.col("j") - F.col("i")
    gain = F.get("sums", F.col("j")) - F.get("sums", F.col("i"))
    sure = sure.select("key", "item_id", (F.col("p") - F.col("left") - 1 + F.col("i")).alias("at"), (F.col("q") - F.col("left") - 1 + F.col("i")).alias("item_at"), length.alias("length"), ((gain + COST * length) / (COST + 1)).cast("int").alias("same"))
    return sure.groupBy("key", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(F.min("at").alias("at"), F.min("item_at").alias("item_at"), F.max(F.col("at") + F.col("length")).alias("end"), F.max("same").alias("same"))


def report(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids for every row of df (doc_id, text; others are ignored).

    benchmark: item_id, text. Tokens are lower-cased runs of letters and digits, so punctuation and case do not matter.
    A text leaks an item if on some alignment at least 0.8 of the tokens agree over 16 tokens or more, or over the whole
    item if that is shorter; an item of fewer than 5 tokens has to stand there as it is. Candidates are runs that every
    such overlap holds, so none is missed. Null texts are empty; items with a null id or without tokens are ignored. A null doc_id comes last in joins and is returned as null. Rows with one doc_id
    share what is found in any of them. Empty tables give an empty result, or nothing contaminated.
    """
    found = leaks(df, benchmark).groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    rows = df.select("doc_id", common.key_of().alias("key")).join(found, "key", "left")
    ids = F.coalesce("item_ids", F.array().cast(found.schema["item_ids"].dataType))
    return rows.select("doc_id", (F.size(ids) > 0).alias("contaminated"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"))


def clean(df: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of df that leak no benchmark item, with all columns, whatever their names.

    Null, empty and wordless texts leak nothing. Very long texts are searched whole. Rows with one doc_id, and all those
    without one, go or stay together, so a repeated row counts like its first. Empty tables, and a benchmark without
    usable items, drop nothing. The leaking ids move, not the texts (see common.without).
    """
    return common.without(df, leaks(df, benchmark), BROADCAST_SEEDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.withColumn("item_ids", F.concat_ws(",", F.transform("item_ids", lambda x: x.cast("string"))))
