"""Inputs of the queries, derived from the test tables by rules that Spark and the comparison SQL both have.

No table is cut: every row and every whole text takes part. `documents` gives candidate sheets for operators that are
linear in the text; `conversations`, whose texts are short, gives candidates for the quadratic ones; `events` gives
aligned words and `embeddings` samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WORDS = r"filter(split(text, '[ \\t\\n\\r\\f\\x0B]+'), x -> x <> '')"


def _sql(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables})


def sheet(spark: SparkSession, d: str) -> DataFrame:
    """Wide sheet, one recording a document, with five options derived from its words."""
    return _sql(spark, d, rf"""
        select cast(doc_id as string) as audio_id, case lang when 'en' then 'English_US' when 'fr' then 'French' when 'de' then 'German' else 'Spanish' end as language,
               concat('http://audio/', doc_id) as audio, array_join(w, ' ') as option_1, array_join(filter(w, (x, i) -> (i + 1) % 5 <> 0), ' ') as option_2,
               array_join(transform(w, (x, i) -> if((i + 1) % 4 = 0, reverse(x), x)), ' ') as option_3, regexp_replace(lower(array_join(w, ' ')), '[^a-z0-9 ]', '') as option_4,
               if(doc_id % 7 = 0, '', trim(repeat(concat(array_join(slice(w, 1, 3), ' '), ' '), 12))) as option_5, 1 as correct_option, if(doc_id % 3 = 0, null, 1) as detected_option,
               size(w) / (0.55D + (doc_id % 12) * 0.5D) as seconds, lang
        from (select doc_id, lang, {_WORDS} as w from {{documents}})""", "documents")


#: The same in the comparison SQL, as the start of a WITH clause.
SHEET = r"""
w as (select doc_id, lang, list_filter(string_split_regex(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') as w from documents),
sheet as (select cast(doc_id as varchar) as audio_id, case lang when 'en' then 'English_US' when 'fr' then 'French' when 'de' then 'German' else 'Spanish' end as language,
  'http://audio/' || doc_id as audio, array_to_string(w, ' ') as option_1, array_to_string(list_filter(w, lambda x, i: i % 5 <> 0), ' ') as option_2,
  array_to_string(list_transform(w, lambda x, i: case when i % 4 = 0 then reverse(x) else x end), ' ') as option_3, regexp_replace(lower(array_to_string(w, ' ')), '[^a-z0-9 ]', '', 'g') as option_4,
  case when doc_id % 7 = 0 then '' else trim(repeat(array_to_string(w[1:3], ' ') || ' ', 12)) end as option_5, 1 as correct_option, case when doc_id % 3 = 0 then null else 1 end as detected_option,
  len(w) / (0.55 + (doc_id % 12) * 0.5) as seconds, lang, doc_id from w),
options as (select audio_id, 1 as option_no, option_1 as transcript, lang, seconds from sheet union all select audio_id, 2, option_2, lang, seconds from sheet union all select audio_id, 3, option_3, lang, seconds from sheet
  union all select audio_id, 4, option_4, lang, seconds from sheet union all select audio_id, 5, option_5, lang, seconds from sheet),
cand as (select audio_id, cast(option_no as int) as option_no, trim(transcript) as transcript, lang, seconds, list_filter(string_split_regex(transcript, '[ \t\n\r\f\v]+'), lambda x: x <> '') as t from options where trim(transcript) <> '')
"""


def asr(spark: SparkSession, d: str) -> DataFrame:
    """Three recognised versions of each document."""
    return _sql(spark, d, rf"""
        select cast(doc_id as string) as audio_id, m as model_ix,
               case m when 0 then array_join(filter(w, (x, i) -> (i + 1) % 11 <> 0), ' ') when 1 then if(doc_id % 13 = 0, '', array_join(transform(w, (x, i) -> if((i + 1) % 6 = 0, 'um', x)), ' ')) else array_join(w, ' ') end as text,
               -(doc_id % 20) / 10.0D as confidence, 1 + (doc_id % 25) / 10.0D as entropy, (doc_id % 10) / 10.0D as no_speech_prob
        from (select doc_id, {_WORDS} as w from {{documents}}) lateral view explode(array(0, 1, 2)) t as m""", "documents")


ASR = r"""
w as (select doc_id, list_filter(string_split_regex(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') as w from documents),
asr as (select cast(doc_id as varchar) as audio_id, cast(m as int) as model_ix,
  case m when 0 then array_to_string(list_filter(w, lambda x, i: i % 11 <> 0), ' ') when 1 then case when doc_id % 13 = 0 then '' else array_to_string(list_transform(w, lambda x, i: case when i % 6 = 0 then 'um' else x end), ' ') end else array_to_string(w, ' ') end as text,
  -(doc_id % 20) / 10.0 as confidence, 1 + (doc_id % 25) / 10.0 as entropy, (doc_id % 10) / 10.0 as no_speech_prob from w, (select unnest([0, 1, 2]) as m)),
tok as (select audio_id, model_ix, unnest(range(0, len(t))) as pos, unnest(t) as token from (select audio_id, model_ix, list_filter(string_split(text, ' '), lambda x: x <> '') as t from asr)),
place as (select audio_id, pos, token, count(*) as n, min(model_ix) as first from tok group by all)
"""


def talk(spark: SparkSession, d: str) -> DataFrame:
    """Candidates from conversations: each five turns in a row are the options of one recording."""
    return _sql(spark, d, "select concat(conv_id, '-', turn div 5) as audio_id, cast(turn % 5 + 1 as int) as option_no, text as transcript from {conversations}", "conversations")


def talk_asr(spark: SparkSession, d: str) -> DataFrame:
    """Three recognised versions of the first of each five turns."""
    return _sql(spark, d, rf"""
        select audio_id, m as model_ix,
               case m when 0 then array_join(filter(w, (x, i) -> (i + 1) % 11 <> 0), ' ') when 1 then if(conv_id % 13 = 0, '', array_join(transform(w, (x, i) -> if((i + 1) % 6 = 0, 'um', x)), ' ')) else array_join(w, ' ') end as text,
               -(conv_id % 20 + m) / 10.0D as confidence
        from (select conv_id, concat(conv_id, '-', turn div 5) as audio_id, {_WORDS} as w from {{conversations}} where turn % 5 = 0) lateral view explode(array(0, 1, 2)) t as m""", "conversations")


#: Candidates and references in compared form; the sharp s is the one letter that stays outside ASCII and is one sign here.
TALK = r"""
norm as (select conv_id, turn, text, trim(regexp_replace(lower(regexp_replace(strip_accents(text), '[!?.,:;''"()\[\]{}\-_+=/\\|]', ' ', 'g')), '\s+', ' ', 'g')) as t from conversations),
hyp as (select conv_id || '-' || (turn // 5) as audio_id, cast(turn % 5 + 1 as int) as option_no, replace(t, 'ß', '~') as hyp from norm),
rw as (select conv_id, conv_id || '-' || (turn // 5) as audio_id, list_filter(string_split_regex(text, '[ \t\n\r\f\v]+'), lambda x: x <> '') as w from conversations where turn % 5 = 0),
rr as (select audio_id, cast(m as int) as ref_ix, case m when 0 then array_to_string(list_filter(w, lambda x, i: i % 11 <> 0), ' ') when 1 then case when conv_id % 13 = 0 then '' else array_to_string(list_transform(w, lambda x, i: case when i % 6 = 0 then 'um' else x end), ' ') end else array_to_string(w, ' ') end as text from rw, (select unnest([0, 1, 2]) as m)),
ref as (select audio_id, ref_ix, replace(trim(regexp_replace(lower(regexp_replace(strip_accents(text), '[!?.,:;''"()\[\]{}\-_+=/\\|]', ' ', 'g')), '\s+', ' ', 'g')), 'ß', '~') as ref from rr where trim(text) <> ''),
pair as (select h.audio_id, option_no, ref_ix, hyp, ref from hyp h join ref r on h.audio_id = r.audio_id)
"""


def aligned(spark: SparkSession, d: str) -> DataFrame:
    """Aligned words from events: a recording a user, a pause of over two seconds every ten words."""
    return _sql(spark, d, """
        select cast(user_id as string) as audio_id, 1 as option_no, cast(floor((n - 1) / 8) as int) as seg_ix, cast(n as int) as word_ix, if(event_id % 6 = 0, concat(event_type, '?'), event_type) as word,
               if(event_type = 'error', null, s) as start, if(event_type = 'error', null, s + 0.125D + (event_id % 8) / 8.0D) as end, if(event_type = 'error', null, (event_id % 100) / 100.0D) as score, s as s0, s + 0.125D + (event_id % 8) / 8.0D as e0, user_id % 4 as tail
        from (select *, n * 0.5D + floor(n / 10) * 3.0D + (event_id % 4) * 0.0625D as s from (select user_id, event_id, event_type, row_number() over (partition by user_id order by ts, event_id) as n from {events}))""", "events")


ALIGNED = """
ev as (select user_id, event_id, event_type, row_number() over (partition by user_id order by ts, event_id) as n from events),
evs as (select *, n * 0.5 + floor(n / 10) * 3.0 + (event_id % 4) * 0.0625 as s from ev),
al as (select cast(user_id as varchar) as audio_id, cast(1 as int) as option_no, cast(floor((n - 1) / 8) as int) as seg_ix, cast(n as int) as word_ix, case when event_id % 6 = 0 then event_type || '?' else event_type end as word,
  cast(case when event_type = 'error' then null else s end as double) as start, cast(case when event_type = 'error' then null else s + 0.125 + (event_id % 8) / 8.0 end as double) as "end", cast(case when event_type = 'error' then null else (event_id % 100) / 100.0 end as double) as score,
  cast(s as double) as s0, cast(s + 0.125 + (event_id % 8) / 8.0 as double) as e0, user_id % 4 as tail from evs),
seg as (select audio_id, option_no, seg_ix, a + (seg_ix % 3) * 0.25::double as start, z + (seg_ix % 3) * 0.25::double as "end" from (select audio_id, option_no, seg_ix, min(s0) as a, max(e0) as z from al group by 1, 2, 3)),
dur as (select audio_id, option_no, max(e0) + max(tail) as audio_duration from al group by 1, 2),
timed as (select * from al where start is not null and "end" is not null)
"""


def segments(words: DataFrame) -> DataFrame:
    return words.selectExpr("audio_id", "option_no", "seg_ix", "s0", "e0").groupBy("audio_id", "option_no", "seg_ix").agg({"s0": "min", "e0": "max"}).selectExpr("audio_id", "option_no", "seg_ix", "`min(s0)` + (seg_ix % 3) * 0.25D as start", "`max(e0)` + (seg_ix % 3) * 0.25D as end")


def durations(words: DataFrame) -> DataFrame:
    return words.groupBy("audio_id", "option_no").agg({"e0": "max", "tail": "max"}).selectExpr("audio_id", "option_no", "`max(e0)` + `max(tail)` as audio_duration")


def word_pauses(words: DataFrame) -> DataFrame:
    """Gaps of 0.12 s and more between timed words."""
    return words.filter("start is not null").selectExpr("audio_id", "end", "lead(start) over (partition by audio_id order by start, word_ix) as next").filter("next - end >= 0.12").selectExpr("audio_id", "end as start", "next as end", "next - end as duration")


def samples(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, "select cast(vec_id as string) as audio_id, pos, cast(x as double) as x from {embeddings} lateral view posexplode(embedding) t as pos, x", "embeddings")


SAMPLES = "s as (select cast(vec_id as varchar) as audio_id, cast(unnest(range(0, len(embedding))) as int) as pos, cast(unnest(embedding) as double) as x from embeddings)"


def votes(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, "select source as audio_id, cast(doc_id % 3 as int) as chunk_ix, lang, (n_chars % 100) / 100.0D as conf from {documents}", "documents")


VOTES = "v as (select source as audio_id, doc_id % 3 as chunk_ix, lang, (n_chars % 100) / 100.0 as conf from documents)"


def scores(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three score tables over documents and options, each with gaps of its own, in binary fractions."""
    base = "from (select doc_id, cast(k as int) as option_no from {documents} lateral view explode(array(1, 2, 3, 4, 5)) x as k)"
    one = lambda name, f, keep: _sql(spark, d, f"select cast(doc_id as string) as audio_id, option_no, {f} as {name} {base} where {keep}", "documents")
    return one("aqs", "((doc_id * 7 + option_no * 3) % 16) / 16.0D", "doc_id % 9 <> 0"), one("tss", "((doc_id * 5 + option_no) % 16) / 16.0D", "doc_id % 11 <> 0"), one("lgs", "((doc_id + option_no * 5) % 16) / 16.0D", "doc_id % 9 <> 0 or option_no > 2")


SCORES = """
o as (select doc_id, cast(k as int) as option_no from documents, (select unnest([1, 2, 3, 4, 5]) as k)),
a as (select cast(doc_id as varchar) as audio_id, option_no, cast(((doc_id * 7 + option_no * 3) % 16) / 16.0 as double) as aqs from o where doc_id % 9 <> 0),
t as (select cast(doc_id as varchar) as audio_id, option_no, cast(((doc_id * 5 + option_no) % 16) / 16.0 as double) as tss from o where doc_id % 11 <> 0),
g as (select cast(doc_id as varchar) as audio_id, option_no, cast(((doc_id + option_no * 5) % 16) / 16.0 as double) as lgs from o where doc_id % 9 <> 0 or option_no > 2)
"""


def logprobs(spark: SparkSession, d: str) -> DataFrame:
    """Made token log probabilities of conversation turns."""
    return _sql(spark, d, r"select concat(conv_id, '-', turn div 5) as audio_id, cast(turn % 5 + 1 as int) as option_no, pos, -(octet_length(tok) % 7) / 2.0D as lp from {conversations} lateral view posexplode(filter(split(text, '\\s+'), x -> x <> '')) t as pos, tok", "conversations")


LOGPROBS = r"lp as (select conv_id || '-' || (turn // 5) as audio_id, cast(turn % 5 + 1 as int) as option_no, -(strlen(tok) % 7) / 2.0 as lp from (select conv_id, turn, unnest(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) as tok from conversations))"


def talk_sheet(spark: SparkSession, d: str) -> DataFrame:
    """The candidates of conversations as a wide sheet; recordings whose number ends in 3 have been decided before."""
    rows = talk(spark, d)
    cells = [F.max(F.when(F.col("option_no") == n, F.col("transcript"))).alias(f"option_{n}") for n in range(1, 6)]
    old = F.when(F.col("audio_id").rlike("3-[0-9]+$"), 2)
    return rows.groupBy("audio_id").agg(*cells).select("audio_id", *(f"option_{n}" for n in range(1, 6)), F.lit(1).alias("correct_option"), old.alias("detected_option"))


def talk_aligned(spark: SparkSession, d: str) -> DataFrame:
    """Aligned words of the same candidates: one segment an option, two words a second, every ninth word without times.

    Texts are few bytes and their words many rows, so texts are dealt out by option first; what groups by option stays there.
    """
    turns = _sql(spark, d, "select concat(conv_id, '-', turn div 5) as audio_id, cast(turn % 5 + 1 as int) as option_no, conv_id, text from {conversations}", "conversations")
    dealt = turns.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "audio_id", "option_no")
    return spark.sql(r"""
        select audio_id, option_no, 0 as seg_ix, pos + 1 as word_ix, word, if(lost, null, s0) as start, if(lost, null, e0) as end, if(lost, null, ((n * 7 + pos + option_no * 11) % 100) / 100.0D) as score, s0, e0, tail
        from (select *, s0 + 0.125D + (n % 8) / 8.0D as e0 from (select *, pos * 0.5D + floor(pos / 10) * 3.0D + (n % 4) * 0.0625D as s0, (pos + option_no) % 9 = 4 as lost
        from (select audio_id, option_no, pos, word, octet_length(word) as n, conv_id % 4 as tail from {turns} lateral view posexplode(filter(split(text, '\\s+'), x -> x <> '')) t as pos, word)))""", turns=dealt)
