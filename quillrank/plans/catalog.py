"""All queries by name, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequences, text
from ..operators import alignment, audio, consensus, filters, language, linguistic, ranking, similarity
from ..sources import fixtures as fx
from ..sources import tables
from . import rows as pipeline_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def r6(*cols: str) -> list:
    return [F.round(c, 6).alias(c) for c in cols]


# sources


@query("load_candidates", f"with {fx.SHEET} select audio_id, option_no, transcript from cand")
def _(s, d):
    return tables.candidates(fx.sheet(s, d))


@query("lookup_options", f"with {fx.SHEET} select audio_id, cast(option_no as int) as option_no, trim(transcript) as transcript, 1 as correct_option, (select language from sheet where audio_id = '7') as language from options where audio_id = '7'")
def _(s, d):
    return tables.lookup(fx.sheet(s, d), "7").select("audio_id", "option_no", "transcript", "correct_option", "language")


@query("list_audio_ids", "select cast(doc_id as varchar) as audio_id from documents")
def _(s, d):
    return tables.audio_ids(fx.sheet(s, d))


@query("pending_ids", "select cast(doc_id as varchar) as audio_id from documents where doc_id % 3 = 0")
def _(s, d):
    return tables.pending(fx.sheet(s, d))


@query("language_code", "select cast(doc_id as varchar) as audio_id, lang as code, lang as safe from documents")
def _(s, d):
    code = text.language_code(F.col("language"))
    return fx.sheet(s, d).select("audio_id", code.alias("code"), text.safe_language(code).alias("safe"))


@query("discover_ids", "select cast(doc_id as varchar) as audio_id, '/audio/' || doc_id || '.mp3' as path from documents where doc_id % 5 = 0")
def _(s, d):
    return tables.discover(tables.table(s, d, "documents").select(F.concat(F.lit("/audio/"), F.when(F.col("doc_id") % 5 == 1, "abc").when(F.col("doc_id") % 5 == 2, "x-").otherwise(""), "doc_id", F.when(F.col("doc_id") % 5 == 3, ".txt").when(F.col("doc_id") % 5 == 4, ".wav").otherwise(".mp3")).alias("path")))


# signals

_METRICS = """select audio_id, quantile_cont(abs(x), 0.9) as hi, quantile_cont(abs(x), 0.1) as lo, quantile_cont(abs(x), 0.2) as noise, avg(x * x) as e, count(*) / 16000.0 as d from s group by 1"""
_SNR = "case when lo < 1e-10 then 999.0 else 20 * log10(hi / lo) end"


@query("audio_metrics", f"with {fx.SAMPLES}, m as ({_METRICS}), n as (select *, {_SNR} as snr from m) select audio_id, round(snr, 6) as snr_db, round(noise, 6) as noise_level, round(e, 6) as avg_energy, round(d, 6) as raw_duration, case when snr > 20 then 'clean' when snr > 10 then 'moderate' else 'noisy' end as audio_quality from n")
def _(s, d):
    return audio.metrics(fx.samples(s, d)).select("audio_id", *r6("snr_db", "noise_level", "avg_energy", "raw_duration"), "audio_quality")


@query("snr", f"with {fx.SAMPLES}, m as ({_METRICS}) select audio_id, round({_SNR}, 6) as snr_db from m")
def _(s, d):
    return audio.metrics(fx.samples(s, d)).select("audio_id", *r6("snr_db"))


@query("noise_floor", f"with {fx.SAMPLES} select audio_id, round(quantile_cont(abs(x), 0.2), 6) as noise_level from s group by 1")
def _(s, d):
    return audio.metrics(fx.samples(s, d)).select("audio_id", *r6("noise_level"))


@query("avg_energy", f"with {fx.SAMPLES} select audio_id, round(avg(x * x), 6) as avg_energy from s group by 1")
def _(s, d):
    return audio.metrics(fx.samples(s, d)).select("audio_id", *r6("avg_energy"))


@query("audio_quality", f"with {fx.SAMPLES}, m as ({_METRICS}), n as (select *, {_SNR} as snr from m) select audio_id, case when snr > 20 then 'clean' when snr > 10 then 'moderate' else 'noisy' end as audio_quality from n")
def _(s, d):
    return audio.metrics(fx.samples(s, d)).select("audio_id", "audio_quality")


@query("energy_vad", f"with {fx.SAMPLES}, n as (select audio_id, count(*) as n from s group by 1), f as (select audio_id, floor(pos / 8.0) as f, avg(abs(x)) as l from s group by 1, 2) select audio_id, cast(sum(case when l > pow(10, -20 / 20.0) then 1 else 0 end) as bigint) as speech_frames, count(*) as total_frames, round(sum(case when l > pow(10, -20 / 20.0) then 1.0 else 0 end) / count(*), 6) as speech_ratio from f join n using (audio_id) where f * 8 < n - 8 group by 1")
def _(s, d):
    return audio.energy_vad(fx.samples(s, d), frame=8, db=-20.0).select("audio_id", "speech_frames", "total_frames", *r6("speech_ratio"))


@query("trim_silence", f"with {fx.SAMPLES}, p as (select audio_id, max(abs(x)) as peak, max(pos) as e from s group by 1) select audio_id, cast(coalesce(min(pos) filter (where abs(x) > peak * pow(10, -6 / 20.0)), 0) as bigint) as first, cast(coalesce(max(pos) filter (where abs(x) > peak * pow(10, -6 / 20.0)), max(e)) as bigint) as last from s join p using (audio_id) group by 1")
def _(s, d):
    return audio.trim_silence(fx.samples(s, d), db=-6.0)


_VAD = "vad as (select audio_id, seg_ix, cast(start * 16000 as bigint) as start, cast(\"end\" * 16000 as bigint) as \"end\" from seg), len as (select audio_id, cast(audio_duration * 16000 as bigint) as n from dur)"


def _vad(s, d):
    w = fx.aligned(s, d)
    seg = fx.segments(w).selectExpr("audio_id", "seg_ix", "cast(start * 16000 as bigint) as start", "cast(end * 16000 as bigint) as end")
    return seg, fx.durations(w).selectExpr("audio_id", "cast(audio_duration * 16000 as bigint) as n")


@query("speech_ratio", f'with {fx.ALIGNED}, {_VAD} select audio_id, round(sum("end" - start) / max(n), 6) as speech_ratio from vad join len using (audio_id) group by 1')
def _(s, d):
    return audio.speech_ratio(*_vad(s, d)).select("audio_id", *r6("speech_ratio"))


@query("vad_gap_plan", f'with {fx.ALIGNED}, {_VAD}, l as (select *, lead(start) over (partition by audio_id order by start, seg_ix) as nx from vad join len using (audio_id)) select audio_id, seg_ix, cast(greatest(0, start - 6400) as bigint) as from_pos, cast(least(n, "end" + 4000) as bigint) as to_pos, cast(case when nx is null then 0 else floor(16000 * greatest(0.12::double, least(greatest(0::double, greatest(0::double, (nx - "end") / 16000.0::double) - 0.25::double - 0.40::double), 2.0::double))) end as bigint) as gap from l')
def _(s, d):
    vad, n = _vad(s, d)
    return audio.gap_plan(vad.join(n, "audio_id"))


@query("audio_pauses", f"with {fx.SAMPLES}, q as (select audio_id, pos, 20 * log10(greatest(abs(x), 1e-10)) < -20 as q, coalesce(lead(pos) over (partition by audio_id order by pos), pos) as nx from s), i as (select *, pos - row_number() over (partition by audio_id, q order by pos) as g from q) select audio_id, round(min(pos) * 0.0625, 6) as start, round(max(nx) * 0.0625, 6) as \"end\", round((max(nx) - min(pos)) * 0.0625, 6) as duration from i where q group by audio_id, g having (max(nx) - min(pos)) * 0.0625 >= 0.12")
def _(s, d):
    levels = fx.samples(s, d).select("audio_id", F.col("pos").alias("frame"), F.abs("x").alias("rms"))
    return audio.pauses(levels, hop=0.0625, db=-20.0).select("audio_id", *r6("start", "end", "duration"))


@query("chunk_plan", "with n as (select cast(doc_id as varchar) as audio_id, cast(n_chars as bigint) * 1000 as n from documents), c as (select audio_id, n, unnest(range(0, n, 464000)) as from_pos from n) select audio_id, cast(from_pos // 464000 as int) as chunk_ix, cast(from_pos as bigint) as from_pos, cast(least(from_pos + 480000, n) as bigint) as to_pos from c")
def _(s, d):
    return audio.chunk_plan(tables.table(s, d, "documents").selectExpr("cast(doc_id as string) as audio_id", "cast(n_chars as bigint) * 1000 as n"))


# languages

_VOTE = "c as (select audio_id, lang, sum(conf * case when chunk_ix = 1 then 1.5 else 1.0 end) as s from v group by 1, 2), f as (select audio_id, lang, s / sum(s) over (partition by audio_id) as share from c)"


@query("lang_chunk_vote", f"with {fx.VOTES}, {_VOTE} select audio_id, lang, round(share, 4) as share from f")
def _(s, d):
    return language.chunk_vote(fx.votes(s, d))


@query("lang_ensemble", f"with {fx.VOTES}, {_VOTE}, p as (select audio_id, lang, 0.75 as p from f where lang = 'en' union all select distinct audio_id, 'other', 0.25 from f) select coalesce(p.audio_id, f.audio_id) as audio_id, coalesce(p.lang, f.lang) as lang, round(0.4::double * coalesce(p, 0) + 0.6::double * coalesce(round(share, 4), 0), 4) as share from p full join f on p.audio_id = f.audio_id and p.lang = f.lang")
def _(s, d):
    fallback = language.chunk_vote(fx.votes(s, d))
    primary = fallback.filter("lang = 'en'").select("audio_id", "lang", F.lit(0.75).alias("share")).unionByName(fallback.select("audio_id", F.lit("other").alias("lang"), F.lit(0.25).alias("share")).distinct())
    return language.ensemble(primary, fallback)


@query("lang_best", f"with {fx.VOTES}, {_VOTE}, r as (select audio_id, lang, round(share, 4) as share, row_number() over (partition by audio_id order by round(share, 4) desc, lang) as k from f) select audio_id, lang, share from r where k = 1")
def _(s, d):
    return language.best(language.chunk_vote(fx.votes(s, d)))


_NONSENSE = r"n as (select doc_id, lang, n_chars, regexp_replace(text, '\s', '', 'g') as x from documents), c as (select doc_id, count(*) as k, sum(case when regexp_matches(ch, '[\p{L}\p{N}]') then 1 else 0 end) as a from (select doc_id, unnest(string_split(x, '')) as ch from n) where ch <> '' group by 1), t as (select doc_id, max(k) as m from (select doc_id, ch, count(*) as k from (select doc_id, unnest(string_split(x, '')) as ch from n) where ch <> '' group by all) group by 1), z as (select n.doc_id, lang, n_chars, coalesce(m * 1.0 / k > 0.7 or a * 1.0 / k < 0.1, true) as bad from n left join c using (doc_id) left join t using (doc_id))"


@query("nonsense_text", f"with {_NONSENSE} select cast(doc_id as varchar) as audio_id, bad as nonsense from z")
def _(s, d):
    return tables.table(s, d, "documents").select(F.col("doc_id").cast("string").alias("audio_id"), language.nonsense(F.col("text")).alias("nonsense"))


@query("lang_route", f"with {_NONSENSE}, r as (select *, (doc_id % 10) / 10.0 as sr, case when bad then 0 else (n_chars % 100) / 100.0 end as conf from z), m as (select *, case when sr < 0.2 then 'none' when conf >= 0.7 then 'whisper_primary' when doc_id % 7 = 0 then 'whisper_primary_fallback' else 'whisper_ensemble' end as method from r) select cast(doc_id as varchar) as audio_id, method, case method when 'none' then 'unknown' when 'whisper_ensemble' then 'fr' else lang end as language from m")
def _(s, d):
    rows = tables.table(s, d, "documents").selectExpr("cast(doc_id as string) as audio_id", "text", "(doc_id % 10) / 10.0D as speech_ratio", "(n_chars % 100) / 100.0D as conf", "lang as primary", "if(doc_id % 7 = 0, 'unknown', 'fr') as fallback", "'fr' as joint")
    return language.route(rows).select("audio_id", "method", "language")


# normalisers: over all documents; the SQL has the same class of characters where it matters here


def _normal(name: str, make, sql: str | None = None):
    @query(name, sql and f"select doc_id, {sql} as t from documents")
    def run(s, d):
        return tables.table(s, d, "documents").select("doc_id", make(F.col("text"), F.col("lang")).alias("t"))


_WS = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
_normal("strip_punct", lambda c, g: text.strip_punct(c), r"regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g')")
_normal("cjk_space", lambda c, g: text.cjk_space(c), r"regexp_replace(text, '([\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}\x{AC00}-\x{D7AF}])', ' \1 ', 'g')")
_normal("normalize_light", text.normalize_light, _WS.format(r"regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', '', 'g')"))
_normal("normalize_cmp", lambda c, g: text.normalize_cmp(c), _WS.format(r"""lower(regexp_replace(strip_accents(text), '[!?.,:;''"()\[\]{}\-_+=/\\|]', ' ', 'g'))"""))
_normal("normalize_align", lambda c, g: text.normalize_align(c), _WS.format(r"""regexp_replace(text, '[؟،؛:!.''"()\-\[\]{}…‹›«»„‟—–]', ' ', 'g')"""))
_normal("simple_clean", lambda c, g: text.simple_clean(c), _WS.format(r"regexp_replace(text, '[^\p{L}\p{N}_\s]', '', 'g')"))
_normal("asr_normalize", lambda c, g: text.asr_normalize(c), _WS.format(r"regexp_replace(regexp_replace(lower(text), '\|', ' ', 'g'), '[^\p{L}\p{N}_\s]', '', 'g')"))
_normal("clean_conservative", lambda c, g: text.clean_conservative(c), r"trim(regexp_replace(regexp_replace(text, '\.{2,}', '.', 'g'), ' {2,}', ' ', 'g'))")
_normal("strip_annotations", lambda c, g: text.strip_annotations(c), r"trim(regexp_replace(regexp_replace(text, '[\[{(][^\]})]{0,60}[\]})]', ' ', 'g'), '[ \t]{2,}', ' ', 'g'))")
_normal("lower_unless_rtl", text.lower_unless_rtl, "lower(text)")
_normal("collapse_space", lambda c, g: text.collapse(c), _WS.format("text"))
_normal("nfkc", lambda c, g: text.nfkc(c), "nfc_normalize(text)")
_normal("arabic_forms", text.arabic, "text")
_normal("script_of", lambda c, g: text.script_of(g), "'Latn'")
_normal("clean_strict", lambda c, g: text.clean_strict(c))
_normal("squash_runs", lambda c, g: text.squash(c))
_normal("strip_fillers", text.strip_fillers)
_normal("number_words", text.number_words)
_normal("normalize_full", text.normalize_full)


@query("normalise_segments", f'with {fx.ALIGNED} select audio_id, option_no, seg_ix, word_ix, coalesce(start, 0) as start, coalesce("end", 0) as "end", word as text from al')
def _(s, d):
    return alignment.normalise_segments(fx.aligned(s, d).withColumn("text", F.col("word"))).select("audio_id", "option_no", "seg_ix", "word_ix", "start", "end", "text")


# checks of candidates


def _cand(s, d):
    return tables.candidates(fx.sheet(s, d), also=("lang", "seconds"))


_WPM = "case lang when 'de' then 130 when 'es' then 160 else 150 end"
_EST = f"len(t) * 60.0 / {_WPM}"


@query("est_duration", f"with {fx.SHEET} select audio_id, option_no, round({_EST}, 6) as est from cand")
def _(s, d):
    return _cand(s, d).select("audio_id", "option_no", F.round(filters.est_duration(text.words(F.col("transcript")), F.col("lang")), 6).alias("est"))


def _check(name: str, column: str, sql: str):
    @query(name, f"with {fx.SHEET} select audio_id, option_no, {sql} as ok from cand")
    def run(s, d):
        return filters.checks(_cand(s, d), with_outlier=False).select("audio_id", "option_no", F.col(column).alias("ok"))


_low = "list_transform(t, lambda x: lower(x))"
_DUR = f"case when seconds > 0 then round({_EST} / seconds, 9) between round(1 / 3.0, 9) and 3 else false end"
_RATE = f"case when seconds > 0 then round(len(t) / (seconds / 60) / {_WPM}, 9) between 0.4 and 2.0 else false end"
_TTR = f"case when len(t) = 0 then false when len(t) <= 3 then true else len(list_distinct({_low})) * 1.0 / len(t) >= 0.3 end"
_EMPTY = r"case when len(t) = 0 then false else len(list_filter(t, lambda x: not regexp_matches(x, '[\p{L}\p{N}]') or (length(x) > 2 and replace(x, x[1], '') = '') or (length(x) = 1 and not regexp_matches(x, '[\x{4E00}-\x{9FFF}]')))) * 1.0 / len(t) <= 0.3 end"
_check("check_ttr", "ok_diversity", _TTR)
_check("check_empty_tokens", "ok_empty_tokens", _EMPTY)


@query("check_duration", f"with {fx.SHEET} select audio_id, option_no, {_DUR} as ok from cand")
def _(s, d):
    return filters.checks(_cand(s, d), with_outlier=False).select("audio_id", "option_no", F.col("ok_duration").alias("ok"))


@query("check_rate", f"with {fx.SHEET} select audio_id, option_no, {_RATE} as ok from cand")
def _(s, d):
    return filters.checks(_cand(s, d), with_outlier=False).select("audio_id", "option_no", F.col("ok_rate").alias("ok"))


_OUT = "m as (select audio_id, median(length(transcript)) as med, count(*) as n from cand group by 1)"


@query("check_outlier", f"with {fx.SHEET}, {_OUT} select audio_id, option_no, case when n < 2 then true when med = 0 then false else length(transcript) / med between 0.33 and 3 end as ok from cand join m using (audio_id)")
def _(s, d):
    return filters.outliers(_cand(s, d)).select("audio_id", "option_no", F.col("ok_outlier").alias("ok"))


_REP = """top as (select audio_id, option_no, max(k) as k from (select audio_id, option_no, w, count(*) as k from (select audio_id, option_no, lower(unnest(t)) as w from cand) group by all) group by all),
g5 as (select audio_id, option_no, max(k) as g from (select audio_id, option_no, g, count(*) as k from (select audio_id, option_no, lower(array_to_string(t[i:i+4], ' ')) as g from (select audio_id, option_no, t, unnest(range(1, len(t) - 3)) as i from cand where len(t) >= 10)) group by all) group by all)"""
_REPOK = "case when len(t) <= 3 then true else k * 1.0 / len(t) <= 0.4 and coalesce(g, 0) < 3 end"


@query("check_repetition", f"with {fx.SHEET}, {_REP} select c.audio_id, c.option_no, {_REPOK} as ok from cand c left join top using (audio_id, option_no) left join g5 using (audio_id, option_no)")
def _(s, d):
    return filters.checks(_cand(s, d), with_outlier=False).select("audio_id", "option_no", F.col("ok_repetition").alias("ok"))


@query("filter_candidates")
def _(s, d):
    return filters.filter_candidates(_cand(s, d)).select("audio_id", "option_no", "passed", "reasons")


@query("dominant_script")
def _(s, d):
    top = sequences.dominant_script("transcript")
    return _cand(s, d).select("audio_id", "option_no", top["script"].alias("script"), F.round(top["ratio"], 6).alias("ratio"))


# recognised outputs

_SEG = "sg as (select cast(conv_id as varchar) as audio_id, cast(turn % 2 as int) as model_ix, cast(turn as int) as seg_ix, trim(text) as text, -(turn + 1) / 8.0 as lp, 1 + turn / 4.0 as cr, turn / 8.0 as ns from conversations), md as (select distinct cast(conv_id as varchar) as audio_id, cast(m as int) as model_ix from conversations, (select unnest([0, 1, 2]) as m))"


@query("asr_rollup", f"with {_SEG}, r as (select audio_id, model_ix, string_agg(text, ' ' order by seg_ix) as text, avg(lp) as c, avg(cr) as e, avg(ns) as n from sg group by 1, 2) select audio_id, model_ix, coalesce(trim(text), '') as text, cast(coalesce(c, 0) as double) as confidence, cast(coalesce(e, 1) as double) as entropy, cast(coalesce(n, 1) as double) as no_speech_prob from md left join r using (audio_id, model_ix)")
def _(s, d):
    seg = tables.table(s, d, "conversations").selectExpr("cast(conv_id as string) as audio_id", "cast(turn % 2 as int) as model_ix", "cast(turn as int) as seg_ix", "text", "-(turn + 1) / 8.0D as avg_logprob", "1 + turn / 4.0D as compression_ratio", "turn / 8.0D as no_speech_prob")
    return consensus.rollup(seg.select("audio_id", F.explode(F.array(*map(F.lit, (0, 1, 2)))).alias("model_ix")).distinct(), seg)


@query("asr_hallucination", f"with {fx.ASR} select audio_id, model_ix, entropy > 2.8 or confidence < -1.5 or no_speech_prob > 0.8 or regexp_matches(text, '^[\\s.!؟،؛\\-—]+$') as suspect, concat_ws(' + ', case when entropy > 2.8 then printf('extreme_repetition(ratio=%.2f)', cast(entropy as double)) end, case when confidence < -1.5 then printf('very_low_confidence(conf=%.2f)', cast(confidence as double)) end, case when no_speech_prob > 0.8 then printf('no_speech(prob=%.2f)', cast(no_speech_prob as double)) end, case when regexp_matches(text, '^[\\s.!؟،؛\\-—]+$') then 'only_punctuation' end) as reasons from asr")
def _(s, d):
    flag, why = consensus.hallucination()
    return fx.asr(s, d).select("audio_id", "model_ix", flag.alias("suspect"), why.alias("reasons"))


@query("asr_clean_route")
def _(s, d):
    return consensus.clean_route(fx.asr(s, d))


_CONS = "top as (select audio_id, pos, arg_max(token, n * 10 - first) as token, max(n) as m, sum(n) as s from place group by 1, 2)"


@query("consensus", f"with {fx.ASR}, {_CONS}, c as (select audio_id, string_agg(token, ' ' order by pos) as consensus from top group by 1) select distinct asr.audio_id, coalesce(consensus, '') as consensus from asr left join c using (audio_id)")
def _(s, d):
    return consensus.consensus(fx.asr(s, d))


_AGREE = f"{_CONS}, ag as (select audio_id, avg(m * 1.0 / s) as agreement from top group by 1)"


@query("agreement", f"with {fx.ASR}, {_AGREE} select distinct asr.audio_id, round(agreement, 9) as agreement from asr left join ag using (audio_id)")
def _(s, d):
    return consensus.agreement(fx.asr(s, d)).select("audio_id", F.round("agreement", 9).alias("agreement"))


@query("rss", f"with {fx.ASR}, {_AGREE}, mm as (select audio_id, avg(case when confidence < 0 then exp(confidence) else confidence end) as c, avg(entropy) as e, avg(1 - no_speech_prob) as p from asr group by 1) select mm.audio_id, round(agreement * c / (1 + e) * p, 6) as rss from mm left join ag using (audio_id)")
def _(s, d):
    return consensus.reliability(fx.asr(s, d)).select("audio_id", *r6("rss"))


@query("word_agreement")
def _(s, d):
    p = similarity.pairs(fx.talk(s, d), fx.talk_asr(s, d))
    return p.select("audio_id", "option_no", "ref_ix", F.round(sequences.word_agreement("ref", "hyp"), 6).alias("agreement"))


# alignment


@query("word_ratio", f"with {fx.ALIGNED} select audio_id, option_no, round(avg(case when start is not null and \"end\" is not null then 1.0 else 0 end), 6) as word_ratio from al group by 1, 2")
def _(s, d):
    return alignment.word_metrics(fx.aligned(s, d)).select("audio_id", "option_no", *r6("word_ratio"))


@query("avg_conf", f"with {fx.ALIGNED} select audio_id, option_no, round(coalesce(avg(score), 0), 6) as avg_conf, round(case when count(score) > 1 then stddev_pop(score) else 0 end, 6) as conf_std from al group by 1, 2")
def _(s, d):
    return alignment.word_metrics(fx.aligned(s, d)).select("audio_id", "option_no", *r6("avg_conf", "conf_std"))


_DEV = """dv as (select t.audio_id, t.option_no, abs((arg_min(t.start, word_ix) + arg_max(t."end", word_ix)) / 2 - (max(g.start) + max(g."end")) / 2) as d from timed t join seg g on t.audio_id = g.audio_id and t.option_no = g.option_no and t.seg_ix = g.seg_ix group by t.audio_id, t.option_no, t.seg_ix)"""


@query("timing_deviation", f"with {fx.ALIGNED}, {_DEV}, x as (select audio_id, option_no, avg(d) as a, stddev_pop(d) as s, max(d) as m, quantile_cont(d, 0.9) as p from dv group by 1, 2) select distinct al.audio_id, al.option_no, round(coalesce(a, 0), 6) as mean_dev, round(coalesce(s, 0), 6) as std_dev, round(coalesce(m, 0), 6) as max_dev, round(coalesce(p, 0), 6) as p90_dev from al left join x using (audio_id, option_no)")
def _(s, d):
    w = fx.aligned(s, d)
    return alignment.timing_deviation(w, fx.segments(w)).select("audio_id", "option_no", *r6("mean_dev", "std_dev", "max_dev", "p90_dev"))


@query("unaligned_ratio", f"with {fx.ALIGNED}, u as (select audio_id, option_no, seg_ix, case when count(start) = 0 then 1.0 else 0 end as u from al group by 1, 2, 3) select audio_id, option_no, round(avg(u), 6) as unaligned_ratio from u group by 1, 2")
def _(s, d):
    return alignment.unaligned_ratio(fx.aligned(s, d)).select("audio_id", "option_no", *r6("unaligned_ratio"))


@query("phoneme_conf", f"with {fx.ALIGNED} select audio_id, option_no, round(avg(score), 6) as mean, round(stddev_pop(score), 6) as std, min(score) as min, max(score) as max, round(quantile_cont(score, 0.1), 6) as p10, round(quantile_cont(score, 0.25), 6) as p25, round(quantile_cont(score, 0.5), 6) as p50, round(quantile_cont(score, 0.75), 6) as p75, round(quantile_cont(score, 0.9), 6) as p90, count(score) as n from al where score is not null group by 1, 2")
def _(s, d):
    return alignment.char_confidence(fx.aligned(s, d)).select("audio_id", "option_no", *r6("mean", "std"), "min", "max", *r6("p10", "p25", "p50", "p75", "p90"), "n")


@query("segment_conf", f"with {fx.ALIGNED} select audio_id, option_no, seg_ix, count(*) as n_words, count(score) as n_scored, round(avg(score), 6) as mean_score, min(score) as min_score from al group by 1, 2, 3")
def _(s, d):
    return alignment.segment_confidence(fx.aligned(s, d)).select("audio_id", "option_no", "seg_ix", "n_words", "n_scored", *r6("mean_score"), "min_score")


_HALL = """cc as (select t.audio_id, t.option_no, t.seg_ix, word_ix, (t.start + t."end") / 2 as c, g.start as gs, g."end" as ge from timed t join seg g using (audio_id, option_no, seg_ix)),
gg as (select *, c - lag(c) over (partition by audio_id, option_no, seg_ix order by c, word_ix) as gap from cc),
st as (select audio_id, option_no, seg_ix, count(*) as n, avg(gap) as g, stddev_pop(gap) as s, avg(case when abs(c - gs) < 0.15 or abs(c - ge) < 0.15 then 1.0 else 0 end) as e from gg group by 1, 2, 3),
sc as (select audio_id, option_no, seg_ix, avg(score) as m from al group by 1, 2, 3),
hl as (select sc.audio_id, sc.option_no, sc.seg_ix, concat_ws(',', case when m < 0.35 then 'low_confidence' end, case when n >= 3 and g > 0 and s / g < 0.2 then 'uniform_spacing' end, case when e >= 0.65 then 'boundary_cluster' end) as reasons from sc left join st using (audio_id, option_no, seg_ix))"""


@query("hallucinated_segments", f"with {fx.ALIGNED}, {_HALL} select * from hl where reasons <> ''")
def _(s, d):
    w = fx.aligned(s, d)
    return alignment.hallucinated(w, fx.segments(w))


_SKIP = """nb as (select audio_id, option_no, coalesce(lag("end") over (partition by audio_id, option_no order by start, seg_ix, word_ix), 0) as from_s, start as to_s, false as whole from timed),
la as (select audio_id, option_no, arg_max("end", start * 100000 + word_ix) as le from timed group by 1, 2),
sk as (select * from nb union all select dur.audio_id, dur.option_no, coalesce(le, 0), audio_duration, le is null from dur left join la using (audio_id, option_no)),
sr as (select audio_id, option_no, from_s, to_s, to_s - from_s as duration from sk where to_s - from_s >= 2.0 or whole)"""


@query("skipped_regions", f"with {fx.ALIGNED}, {_SKIP} select * from sr")
def _(s, d):
    w = fx.aligned(s, d)
    return alignment.skipped(w, fx.durations(w))


_OVER = """nx as (select audio_id, option_no, word as word_a, start, "end", lead(word) over w as word_b, lead(start) over w as sb, lead("end") over w as eb from timed window w as (partition by audio_id, option_no order by start, seg_ix, word_ix)),
ov as (select audio_id, option_no, word_a, word_b, least("end", eb) - greatest(start, sb) as overlap, greatest(start, sb) as at_time from nx where sb is not null and least("end", eb) - greatest(start, sb) > 0.02)"""


@query("overlaps", f"with {fx.ALIGNED}, {_OVER} select * from ov")
def _(s, d):
    return alignment.overlaps(fx.aligned(s, d))


_PP = """pr as (select audio_id, option_no, "end" as e, right(trim(word), 1) in ('?', '!', '.', ':') as punct, lead(start) over (partition by audio_id, option_no, seg_ix order by word_ix) as nx from timed),
pg as (select *, greatest(0, nx - e) as gap from pr),
pm as (select audio_id, option_no, coalesce(avg(gap) filter (punct and nx is not null), 0) as mp, coalesce(avg(gap) filter (not punct and nx is not null), 0.01) as mn, coalesce(avg(case when gap >= 0.4 then 1.0 else 0 end) filter (punct and nx is not null), 0) as cov, count(*) filter (punct and nx is not null) as ng, count(*) filter (punct) as np from pg group by 1, 2),
pz as (select audio_id, e as at from (select audio_id, "end" as e, lead(start) over (partition by audio_id order by start, word_ix) as nx from al where start is not null) where nx - e >= 0.12),
pn as (select audio_id, count(*) as ns from pz group by 1),
hp as (select audio_id, option_no, count(*) as hit from pg where punct and exists (select 1 from pz where pz.audio_id = pg.audio_id and abs(pz.at - pg.e) <= 0.4) group by 1, 2),
hr as (select k.audio_id, k.option_no, count(*) as hit from pm k join pz on k.audio_id = pz.audio_id where exists (select 1 from pg where pg.audio_id = k.audio_id and pg.option_no = k.option_no and pg.punct and abs(pz.at - pg.e) <= 0.4) group by 1, 2),
pa as (select pm.audio_id, pm.option_no, np, coalesce(ns, 0) as ns, case when ng > 0 then 0.55 * greatest(0, least(1, (mp / (mn + 1e-6) - 1) / 3)) + 0.45 * cov else 0 end as a, coalesce(hp.hit, 0) * 1.0 / nullif(np, 0) as p, coalesce(hr.hit, 0) * 1.0 / nullif(ns, 0) as r
  from pm left join pn using (audio_id) left join hp on hp.audio_id = pm.audio_id and hp.option_no = pm.option_no left join hr on hr.audio_id = pm.audio_id and hr.option_no = pm.option_no),
pf as (select *, case when np > 0 and ns > 0 then case when p + r > 0 then 2 * p * r / (p + r) else 0 end else a end as f1, case when ns >= 3 and np >= 2 then 0.65 else 0.30 end as wt from pa),
ppz as (select audio_id, option_no, a, f1, greatest(0, least(1, wt * f1 + (1 - wt) * a)) as pp_score, np as n_punct, ns as n_pauses from pf)"""


@query("punct_pause", f"with {fx.ALIGNED}, {_PP} select audio_id, option_no, round(a, 6) as a, round(f1, 6) as f1, round(pp_score, 6) as pp_score, n_punct, n_pauses from ppz")
def _(s, d):
    w = fx.aligned(s, d)
    return alignment.punct_pause(w, fx.word_pauses(w)).select("audio_id", "option_no", *r6("a", "f1", "pp_score"), "n_punct", "n_pauses")


_AQS = """wm as (select audio_id, option_no, avg(case when start is not null and "end" is not null then 1.0 else 0 end) as wr, coalesce(avg(score), 0) as cf, case when count(score) > 1 then stddev_pop(score) else 0 end as cs from al group by 1, 2),
um as (select audio_id, option_no, avg(u) as u from (select audio_id, option_no, seg_ix, case when count(start) = 0 then 1.0 else 0 end as u from al group by 1, 2, 3) group by 1, 2),
dm as (select audio_id, option_no, avg(d) as a, quantile_cont(d, 0.9) as p from dv group by 1, 2),
nh as (select audio_id, option_no, count(*) as n from hl where reasons <> '' group by 1, 2),
nk as (select audio_id, option_no, sum(duration) as d from sr group by 1, 2),
no as (select audio_id, option_no, count(*) as n from ov group by 1, 2),
aq as (select audio_id, option_no, 0.22 * wr + 0.15 * cf + 0.13 * cf + 0.10 * (1 - u) + 0.09 * greatest(0, least(1, 1 - coalesce(dm.a, 0) / 3)) + 0.06 * greatest(0, least(1, 1 - coalesce(dm.p, 0) / 3)) + 0.05 * greatest(0, least(1, 1 - cs / 0.25)) + 0.20 * coalesce(pp_score, 0)
  - least(0.30, 0.05 * coalesce(nh.n, 0)) - least(0.30, 0.5 * coalesce(nk.d, 0) / (audio_duration + 1e-8)) - least(0.10, 0.01 * coalesce(no.n, 0)) as x
  from wm join dur using (audio_id, option_no) join um using (audio_id, option_no) left join dm using (audio_id, option_no) left join ppz using (audio_id, option_no) left join nh using (audio_id, option_no) left join nk using (audio_id, option_no) left join no using (audio_id, option_no))"""


@query("aqs", f"with {fx.ALIGNED}, {_DEV}, {_HALL}, {_SKIP}, {_OVER}, {_PP}, {_AQS} select audio_id, option_no, round(greatest(0, least(1, x)), 6) as aqs from aq")
def _(s, d):
    w = fx.aligned(s, d)
    return alignment.option_quality(w, fx.segments(w), fx.durations(w), fx.word_pauses(w)).select("audio_id", "option_no", *r6("aqs"))


@query("rank_aqs", f"with {fx.SCORES} select audio_id, option_no, aqs, cast(row_number() over (partition by audio_id order by aqs desc, option_no) as int) as rank from a")
def _(s, d):
    return ranking.rank(fx.scores(s, d)[0], "aqs")


# similarity


def _pairs(s, d):
    return similarity.pairs(fx.talk(s, d), fx.talk_asr(s, d))


@query("edit_counts")
def _(s, d):
    return similarity.edit_counts(_pairs(s, d))


@query("wer")
def _(s, d):
    return _pairs(s, d).select("audio_id", "option_no", "ref_ix", F.round(similarity.wer(F.col("ref"), F.col("hyp")), 6).alias("wer"))


@query("cer", f"with {fx.TALK} select audio_id, option_no, ref_ix, round(case when length(ref) = 0 then 0 when length(hyp) = 0 then 1 else least(levenshtein(ref, hyp) * 1.0 / length(ref), 1) end, 6) as cer from pair")
def _(s, d):
    return _pairs(s, d).select("audio_id", "option_no", "ref_ix", F.round(similarity.cer(F.col("ref"), F.col("hyp")), 6).alias("cer"))


@query("cer_nospace", f"with {fx.TALK} select audio_id, option_no, ref_ix, round(case when replace(ref, ' ', '') = '' then 1 else levenshtein(replace(ref, ' ', ''), replace(hyp, ' ', '')) * 1.0 / length(replace(ref, ' ', '')) end, 6) as cer from pair")
def _(s, d):
    return _pairs(s, d).select("audio_id", "option_no", "ref_ix", F.round(similarity.cer_nospace(F.col("ref"), F.col("hyp")), 6).alias("cer"))


@query("wer_uncapped")
def _(s, d):
    return _pairs(s, d).select("audio_id", "option_no", "ref_ix", F.round(similarity.wer_uncapped(F.col("ref"), F.col("hyp")), 6).alias("wer"))


@query("fuzzy")
def _(s, d):
    return _pairs(s, d).select("audio_id", "option_no", "ref_ix", F.round(sequences.ratio(True, True)("ref", "hyp"), 6).alias("fuzzy"))


@query("edit_alignment")
def _(s, d):
    return similarity.edit_alignment(_pairs(s, d))


@query("confusion_topn")
def _(s, d):
    return similarity.confusion(_pairs(s, d))


@query("consistency", "with x as (select cast(user_id as varchar) as audio_id, (event_id % 16) / 64.0 as w from events) select audio_id, round(greatest(0, least(1, 1 - 20 * var_pop(w))), 6) as consistency from x group by 1")
def _(s, d):
    rows = tables.table(s, d, "events").selectExpr("cast(user_id as string) as audio_id", "(event_id % 16) / 64.0D as w")
    return rows.groupBy("audio_id").agg(F.round(similarity.consistency(F.var_pop("w")), 6).alias("consistency"))


@query("tss")
def _(s, d):
    return similarity.tss(similarity.rates(_pairs(s, d))).select("audio_id", "option_no", *r6("wer", "wer_var", "cer", "fuzzy", "consistency", "tss"))


@query("rank_tss", f"with {fx.SCORES} select audio_id, option_no, tss, cast(row_number() over (partition by audio_id order by tss desc, option_no) as int) as rank from t")
def _(s, d):
    return ranking.rank(fx.scores(s, d)[1], "tss")


@query("combined_score", f"with {fx.SCORES} select audio_id, option_no, round(0.55 * aqs + 0.45 * tss, 6) as combined from a join t using (audio_id, option_no)")
def _(s, d):
    a, t, _g = fx.scores(s, d)
    return a.join(t, ["audio_id", "option_no"]).select("audio_id", "option_no", F.round(similarity.combined(F.col("aqs"), F.col("tss")), 6).alias("combined"))


_BAG = "rk as (select audio_id, option_no, ref_ix, w, count(*) as r from (select *, unnest(string_split(ref, ' ')) as w from pair) where w <> '' group by all), hk as (select audio_id, option_no, ref_ix, w, count(*) as h from (select *, unnest(string_split(hyp, ' ')) as w from pair) where w <> '' group by all), bk as (select audio_id, option_no, ref_ix, coalesce(r, 0) as r, coalesce(h, 0) as h from rk full join hk using (audio_id, option_no, ref_ix, w)), bs as (select audio_id, option_no, ref_ix, sum(least(r, h)) as m, sum(r) as r, sum(h) as h from bk group by 1, 2, 3)"


@query("bag_confusion", f"with {fx.TALK}, {_BAG} select audio_id, option_no, ref_ix, cast(m as bigint) as matched, cast(r - m as bigint) as deleted, cast(h - m as bigint) as inserted, round(case when r > 0 then m * 1.0 / r else 0 end, 6) as match_rate from bs")
def _(s, d):
    return similarity.bag_confusion(_pairs(s, d)).select("audio_id", "option_no", "ref_ix", "matched", "deleted", "inserted", *r6("match_rate"))


@query("acoustic_score", f"with {fx.SCORES}, x as (select audio_id, option_no, greatest(0, least(1, 1 - 0.5 * aqs - 0.5 * tss)) as raw, lgs from a join t using (audio_id, option_no) join g using (audio_id, option_no)) select audio_id, option_no, round(0.5 + (raw - 0.5) * (1 - least(2 * lgs, 0.5)), 6) as score from x")
def _(s, d):
    a, t, g = fx.scores(s, d)
    rows = a.join(t, ["audio_id", "option_no"]).join(g, ["audio_id", "option_no"])
    return rows.select("audio_id", "option_no", F.round(similarity.acoustic_score(F.col("aqs"), F.col("tss"), F.col("lgs")), 6).alias("score"))


@query("acoustic_similarity")
def _(s, d):
    return similarity.acoustic_similarity(fx.talk(s, d), fx.talk_asr(s, d)).select("audio_id", "option_no", *r6("mean_wer", "wer_var", "cer", "score"))


# language score and final ranking

_PPPL = "pp as (select audio_id, option_no, case when count(lp) >= 2 then exp(-avg(lp)) end as pppl from lp group by 1, 2)"
_PS = "case when pppl is null then 0.5 else greatest(0, least(1, 1 - ln(greatest(1, pppl)) / ln(200))) end"


@query("pppl", f"with {fx.LOGPROBS}, {_PPPL} select audio_id, option_no, round(pppl, 6) as pppl from pp")
def _(s, d):
    return linguistic.pppl(fx.logprobs(s, d)).select("audio_id", "option_no", *r6("pppl"))


@query("pppl_score", f"with {fx.LOGPROBS}, {_PPPL} select audio_id, option_no, round({_PS}, 6) as score from pp")
def _(s, d):
    return linguistic.pppl(fx.logprobs(s, d)).select("audio_id", "option_no", F.round(linguistic.pppl_score(F.col("pppl")), 6).alias("score"))


def _docs(name: str, make):
    @query(name)
    def run(s, d):
        return tables.table(s, d, "documents").select("doc_id", make(F.col("text")).alias("value"))


_docs("bracket_balance", linguistic.bracket_balance)
_docs("punct_runs", linguistic.punct_runs)
_docs("script_mix", lambda c: sequences.script_mix(c))
_docs("structural", lambda c: F.round(linguistic.structural(c), 6))


def _lgs(s, d):
    p = linguistic.pppl(fx.logprobs(s, d))
    rows = fx.talk(s, d).join(p, ["audio_id", "option_no"], "left")
    return rows.withColumn("lgs", linguistic.lgs(linguistic.pppl_score(F.col("pppl")), linguistic.structural(F.col("transcript"))))


@query("lgs")
def _(s, d):
    return _lgs(s, d).select("audio_id", "option_no", *r6("lgs"))


@query("tie_boost")
def _(s, d):
    return linguistic.tie_boost(fx.talk(s, d).withColumn("lgs", F.lit(0.5))).select("audio_id", "option_no", *r6("lgs"), "tiebreak")


@query("rank_lgs", f"with {fx.SCORES} select audio_id, option_no, lgs, cast(row_number() over (partition by audio_id order by lgs desc, option_no) as int) as rank from g")
def _(s, d):
    return ranking.rank(fx.scores(s, d)[2], "lgs")


_Z = "0.5 * coalesce(aqs, 0) + 0.45 * coalesce(tss, 0) + 0.05 * coalesce(lgs, 0)"
_FINAL = f"fs as (select audio_id, option_no, {_Z} as f from a full join t using (audio_id, option_no) full join g using (audio_id, option_no)), fr as (select audio_id, option_no, f, row_number() over (partition by audio_id order by f desc, option_no) as rank from fs)"


@query("final_score", f"with {fx.SCORES}, {_FINAL} select audio_id, option_no, round(f, 6) as final_score from fs")
def _(s, d):
    return ranking.final(*fx.scores(s, d)).select("audio_id", "option_no", *r6("final_score"))


@query("final_ranking", f"with {fx.SCORES}, {_FINAL} select audio_id, option_no, round(f, 6) as final_score, cast(rank as int) as rank from fr")
def _(s, d):
    return ranking.final(*fx.scores(s, d)).select("audio_id", "option_no", *r6("final_score"), "rank")


@query("final_ranking_strict", f"with {fx.SCORES} select audio_id, option_no, round(f, 6) as final_score, cast(row_number() over w as int) as rank, row_number() over w = 1 as detected from (select audio_id, option_no, {_Z} as f from a join t using (audio_id, option_no) join g using (audio_id, option_no)) window w as (partition by audio_id order by f desc, option_no)")
def _(s, d):
    return ranking.final(*fx.scores(s, d), missing="strict").select("audio_id", "option_no", *r6("final_score"), "rank", (F.col("rank") == 1).alias("detected"))


_CELLS = ", ".join(f"max(case when option_no = {n} then round({m}, 5) end) as option_{n}_{m}" for m in ("aqs", "tss", "lgs") for n in range(1, 6))


@query("results_wide", f"with {fx.SCORES} select audio_id, {_CELLS} from a full join t using (audio_id, option_no) full join g using (audio_id, option_no) group by 1")
def _(s, d):
    return ranking.wide(ranking.final(*fx.scores(s, d)).drop("final_score")).drop("detected_option")


@query("upsert_results", f"with {fx.SHEET}, {fx.SCORES}, {_FINAL}, best as (select audio_id, option_no as detected, round(f, 5) as top from fr where rank = 1) select s.audio_id, s.option_1, s.option_5, s.correct_option, coalesce(detected, s.detected_option) as detected_option, top as option_score from sheet s left join best using (audio_id)")
def _(s, d):
    made = ranking.upsert(fx.sheet(s, d), ranking.wide(ranking.final(*fx.scores(s, d))))
    top = F.array_max(F.array(*(F.col(f"option_{n}_final_score") for n in range(1, 6))))
    return made.select("audio_id", "option_1", "option_5", "correct_option", "detected_option", top.alias("option_score"))


@query("selection_accuracy", f"with {fx.SCORES}, {_FINAL} select count(*) as n, avg(case when option_no = 1 then 1.0::double else 0 end) as accuracy from fr where rank = 1")
def _(s, d):
    return ranking.accuracy(ranking.wide(ranking.final(*fx.scores(s, d))), fx.sheet(s, d))


# the whole chain from the sheet to the ranking, on scores that are computed


def _scored(s, d, missing="zero"):
    words = fx.talk_aligned(s, d)
    pauses = fx.word_pauses(words.filter("option_no = 1"))
    given = pipeline_rows.Outputs(fx.talk_asr(s, d), words, fx.segments(words), fx.durations(words), pauses, fx.logprobs(s, d))
    return pipeline_rows.scored(fx.talk_sheet(s, d), given, missing=missing)


@query("row_pipeline")
def _(s, d):
    return _scored(s, d).select("audio_id", "option_no", *r6("wer", "aqs", "cer", "tss", "lgs", "final_score"), "rank")


@query("row_pipeline_strict")
def _(s, d):
    return _scored(s, d, "strict").select("audio_id", "option_no", *r6("wer", "aqs", "cer", "tss", "lgs", "final_score"), "rank", (F.col("rank") == 1).alias("detected"))


@query("row_report")
def _(s, d):
    return pipeline_rows.report(_scored(s, d))


@query("row_results")
def _(s, d):
    return pipeline_rows.results(fx.talk_sheet(s, d), _scored(s, d))
