"""Chat formatting: every participant's perspective of a dialogue, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Turns that one rendered part covers, and rows of such a block beyond which it is cut further.
PART_TURNS, PART_ROWS = 256, 4096

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def perspectives(df: DataFrame, *, part_turns: int = PART_TURNS, part_rows: int = PART_ROWS) -> DataFrame:
    """conv_id, part, split, speaker, n_turns, n_own, text, masks for each participant and part of each dialogue.

    df: conv_id, turn, role, text; others are ignored. A participant is any role but `system`. In a participant's row its
    own messages are the assistant's, those of others are users named by their role, and system messages stay system.
    masks: "start:end" spans of text, in code points, comma-joined, where loss is taken: the participant's own contents
    with their end mark.
    A dialogue is rendered in parts of part_turns turn numbers (part 0 holds turns 0 to 255), so no group grows with a
    dialogue's length; a block with more than part_rows rows, as repeated turns give, is cut in the order of its turns
    into pieces of part_rows rows (split 0, 1, ...). A participant who is silent in a part has a row there without masks.
    Equal turns come in order of role and text; repeated rows are rendered as often as they stand. A null role speaks
    as `unknown`; a null text is empty; a null turn comes before all others, in part 0; null conv_ids are one dialogue.
    A dialogue without participants, and an empty table, give no rows.
    """
    rows = df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"), common.text_of().alias("text"))
    rows = rows.withColumn("part", F.floor(F.coalesce("turn", F.lit(0)) / part_turns).cast("long"))
    roles = F.array_except(F.collect_set("role"), F.array(F.lit("system")))
    blocks = common.written(rows.groupBy("conv_id", "part").agg(F.count("*").alias("rows"), roles.alias("roles")))
    large = blocks.filter(F.col("rows") > part_rows)
    if large.isEmpty():
        rows = rows.withColumn("split", F.lit(0).cast("long"))
    else:
        rows = _cut(rows, large, part_rows)
    talks = rows.groupBy("conv_id", "part", "split").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    here = F.array_except(F.array_distinct(F.transform("said", lambda m: m["role"])), F.array(F.lit("system")))
    several = blocks.groupBy("conv_id").agg(F.count("*").alias("n"), F.max("rows").alias("most")).filter((F.col("n") > 1) | (F.col("most") > part_rows)).select(F.col("conv_id").alias("c"))
    if not several.isEmpty():  # only dialogues of several pieces may have participants who are silent in one
        all_roles = blocks.join(several, F.col("conv_id").eqNullSafe(F.col("c"))).select("c", F.explode("roles").alias("role")).groupBy("c").agg(F.collect_set("role").alias("everyone"))
        talks = talks.join(all_roles, F.col("conv_id").eqNullSafe(F.col("c")), "left")
        here = F.coalesce("everyone", here)
    own = talks.select("conv_id", "part", "split", "said", F.explode(here).alias("speaker"))

    def head(m):
        who = F.when(m["role"] == F.col("speaker"), F.lit("assistant")).when(m["role"] == "system", F.lit("system")).otherwise(F.concat(F.lit("user name="), m["role"]))
        return F.concat(F.lit(OPEN), who, F.lit("\n"))

    shown = own.select("conv_id", "part", "split", "speaker", F.transform("said", lambda m: F.struct((m["role"] == F.col("speaker")).alias("own"), F.length(head(m)).alias("skip"), F.concat(head(m), m["text"], F.lit(CLOSE)).alias("line"))).alias("lines"))
    # ends of all lines so far; the masks follow from them place by place
    ends = F.aggregate("lines", F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x["line"]))))
    shown = shown.withColumn("ends", ends)
    spans = F.transform(F.filter(F.transform("lines", lambda x, i: F.struct(x["own"].alias("own"), (F.get("ends", i) + x["skip"]).alias("start"), (F.get("ends", i + 1) - 1).alias("end"))), lambda s: s["own"]), lambda s: F.concat_ws(":", s["start"], s["end"]))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    return shown.select("conv_id", "part", "split", "speaker", F.size("lines").cast("long").alias("n_turns"), F.size(F.filter("lines", lambda x: x["own"])).cast("long").alias("n_own"), text.alias("text"), F.array_join(spans, ",").alias("masks"))


def _cut(rows: DataFrame, large: DataFrame, part_rows: int) -> DataFrame:
    """rows with split: the place of a row among those of its block, in pieces of part_rows rows; 0 in other blocks.

    Rows of large blocks are sorted over all tasks, and their places follow from the rows that earlier tasks hold of the
    block, so no block is gathered in one task. Equal rows may be dealt over tasks in any order.
    """
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    large = large.select(F.col("conv_id").alias("c"), F.col("part").alias("p"))
    kept = rows.join(large, same, "left_anti").withColumn("split", F.lit(0).cast("long"))
    some = rows.join(large, same, "left_semi").withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    some = common.written(some.orderBy("conv_id", "part", "turn", "role", "text", "tie").select(*rows.columns, F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")))
    held = some.groupBy("conv_id", "part", "task").agg(F.count("*").alias("held"), F.min("at").alias("first"))
    before = F.sum("held").over(Window.partitionBy("conv_id", "part").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    held = held.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("task").alias("t"), (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    some = some.join(held, same & (F.col("task") == F.col("t")))
    return kept.unionByName(some.select(*rows.columns, F.floor((F.col("at") + F.col("shift")) / part_rows).cast("long").alias("split")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet")).withColumn("text", F.sha2("text", 256))


ORACLE = f"""
with m as (
  select conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text,
         cast(floor(coalesce(turn, 0) / {PART_TURNS}.0) as bigint) as part
  from conversations
), n as (
  select *, cast((row_number() over (partition by conv_id, part order by turn nulls first, role, text) - 1) // {PART_ROWS} as bigint) as split from m
), s as (select distinct conv_id, role as speaker from m where role <> 'system'
), l as (
  select n.conv_id, n.part, n.split, s.speaker, n.turn, n.role, n.role = s.speaker as own,
         '{OPEN}' || case when n.role = s.speaker then 'assistant' when n.role = 'system' then 'system' else 'user name=' || n.role end || chr(10) as head,
         n.text || '<|im_end|>' || chr(10) as body, n.text as said
  from n join s on n.conv_id is not distinct from s.conv_id
), p as (
  select *, sum(length(head || body)) over (partition by conv_id, part, split, speaker order by turn nulls first, role, said rows unbounded preceding) as e from l
)
select conv_id, part, split, speaker, count(*) as n_turns, cast(sum(case when own then 1 else 0 end) as bigint) as n_own,
       sha256(string_agg(head || body, '' order by turn nulls first, role, said)) as text,
       coalesce(string_agg(cast(cast(e - length(body) as bigint) as varchar) || ':' || cast(cast(e - 1 as bigint) as varchar), ',' order by turn nulls first, role, said) filter (where own), '') as masks
from p group by conv_id, part, split, speaker
"""
