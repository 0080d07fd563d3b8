"""Text normalisers as Column functions; the two that need Unicode tables are Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import wraps

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Word lists, maps and character sets that results depend on.
NUMBER_WORDS = {
    "en": ["zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty"],
    "fr": ["zéro", "un", "deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf", "dix"],
    "de": ["null", "ein", "zwei", "drei", "vier", "fünf", "sechs", "sieben", "acht", "neun", "zehn"],
    "es": ["cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve", "diez"],
    "ar": ["صفر", "واحد", "اثنان", "ثلاثة", "أربعة", "خمسة", "ستة", "سبعة", "ثمانية", "تسعة", "عشرة"],
}
FILLERS = {
    "en": ["uh", "um", "erm", "hmm", "ah", "like", "you know", "i mean", "basically", "literally", "actually", "so"],
    "ar": ["اه", "ااه", "ايه", "يعني", "اممم", "هممم", "طب"],
    "fr": ["euh", "ben", "bah", "hein", "quoi"],
    "de": ["äh", "ähm", "halt", "also", "ne"],
    "es": ["eh", "este", "o sea", "bueno", "pues"],
}
LANGUAGE_CODES = {"arabic_sa": "ar", "arabic_eg": "ar", "arabic": "ar", "english_us": "en", "english_uk": "en", "english": "en", "french": "fr", "german": "de", "spanish": "es", "italian": "it", "portuguese": "pt", "russian": "ru", "chinese": "zh", "japanese": "ja", "korean": "ko", "hindi": "hi", "turkish": "tr"}
RTL = ["ar", "he", "fa", "ur"]
SCRIPTS = {"ar": "Arab", "fa": "Arab", "ur": "Arab", "he": "Hebr", "ru": "Cyrl", "zh": "Hans", "ja": "Jpan", "ko": "Kore", "hi": "Deva"}
HARAKAT_CMP = r"[\x{0610}-\x{061A}\x{064B}-\x{065F}\x{0670}\x{06D6}-\x{06DC}\x{06DF}-\x{06E4}\x{06E7}-\x{06E8}\x{06EA}-\x{06ED}]"
HARAKAT_ALIGN = r"[\x{064B}-\x{0658}\x{0670}]"
PUNCT_CMP = r"[؟،؛!?.,:;'\"()\[\]{}\-_+=/\\|]"
PUNCT_ALIGN = r"[؟،؛:!.'\"()\-\[\]{}…‹›«»„‟—–]"
#: White space as Python's str has it.
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE = f"[{SPACE_CHARS}]"


def words(c: Column) -> Column:
    """Runs of characters that are not white space."""
    return F.filter(F.split(c, SPACE + "+"), lambda w: w != "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, SPACE + "+", " "), "^ | $", "")


#: Bytes and rows of an Arrow batch that a function here is given; a longer row stands alone.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": 1 << 20, "spark.sql.execution.arrow.maxRecordsPerBatch": 1000}


def small(f: Callable) -> Callable:
    """The Arrow function f, which gets small batches from where it is used on; smaller settings of the session stay.

    A worker holds a batch, its texts as objects and all results at once. The settings are read when a plan runs.
    """

    @wraps(f)
    def use(*columns) -> Column:
        conf = SparkSession.active().conf
        for name, most in BATCH.items():
            now = re.fullmatch(r"(\d+)b?", str(conf.get(name, "64m" if "Bytes" in name else "10000")))
            if not now or not 0 < int(now[1]) <= most:
                conf.set(name, str(most))
        return f(*columns)

    return use


@small
@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


@small
@F.pandas_udf(T.StringType())
def bare(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks."""
    drop = lambda x: x if x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return s.map(drop, na_action="ignore")


def strip_punct(c: Column) -> Column:
    return F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}_{SPACE_CHARS}]", "")


def lower_unless_rtl(c: Column, lang: Column) -> Column:
    return F.when(lang.isin(RTL), c).otherwise(F.lower(c))


def _whole(word: str) -> str:
    return rf"(?iu)(?<![\p{{L}}\p{{N}}_]){re.escape(word)}(?![\p{{L}}\p{{N}}_])"


def _by_language(c: Column, lang: Column, steps: dict) -> Column:
    out = c
    for code, pairs in steps.items():
        x = c
        for word, to in pairs:
            x = F.regexp_replace(x, _whole(word), to)
        out = F.when(lang == code, x).otherwise(out)
    return out


def strip_fillers(c: Column, lang: Column) -> Column:
    """Fillers of the text's language removed one after another, as whole words."""
    return _by_language(c, lang, {k: [(w, "") for w in v] for k, v in FILLERS.items()})


def number_words(c: Column, lang: Column) -> Column:
    """Number words of the text's language as digits, one word after another."""
    return _by_language(c, lang, {k: [(w, str(i)) for i, w in enumerate(v)] for k, v in NUMBER_WORDS.items()})


def arabic(c: Column, lang: Column) -> Column:
    """Marks and elongation removed; alef and hamza forms unified."""
    x = F.regexp_replace(c, r"[\x{064B}-\x{0652}\x{0640}]", "")
    x = F.regexp_replace(F.regexp_replace(x, r"[\x{0622}\x{0623}\x{0625}\x{0671}]", "ا"), r"[\x{0624}\x{0626}]", "ء")
    return F.when(lang.isin("ar", "fa", "ur"), x).otherwise(c)


def cjk_space(c: Column) -> Column:
    return F.regexp_replace(c, r"([\x{4E00}-\x{9FFF}\x{3040}-\x{30FF}\x{AC00}-\x{D7AF}])", " $1 ")


def normalize_full(c: Column, lang: Column, with_arabic: bool = False) -> Column:
    x = lower_unless_rtl(nfkc(c), lang)
    x = arabic(x, lang) if with_arabic else x
    return F.coalesce(collapse(cjk_space(strip_punct(number_words(strip_fillers(x, lang), lang)))), F.lit(""))


def normalize_light(c: Column, lang: Column) -> Column:
    return F.coalesce(collapse(strip_punct(lower_unless_rtl(nfkc(c), lang))), F.lit(""))


def simple_clean(c: Column) -> Column:
    """Compatibility form without punctuation; case stays."""
    return collapse(strip_punct(nfkc(c)))


def asr_normalize(c: Column) -> Column:
    return collapse(strip_punct(F.regexp_replace(F.lower(c), r"\|", " ")))


def normalize_cmp(c: Column) -> Column:
    """The form that error rates compare."""
    x = bare(F.regexp_replace(F.coalesce(c, F.lit("")), HARAKAT_CMP + r"|ـ", ""))
    return collapse(F.lower(F.regexp_replace(x, PUNCT_CMP, " ")))


def normalize_align(c: Column) -> Column:
    return collapse(F.regexp_replace(F.regexp_replace(c, HARAKAT_ALIGN, ""), PUNCT_ALIGN, " "))


def squash(c: Column, run: int = 20) -> Column:
    """Runs of more than `run` equal characters as two."""
    return F.regexp_replace(c, rf"(.)\1{{{run},}}", "$1$1")


def clean_conservative(c: Column, run: int | None = None) -> Column:
    x = squash(c, run) if run else c
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"\.{2,}", "."), " {2,}", " "))


def clean_strict(c: Column) -> Column:
    x = F.regexp_replace(F.regexp_replace(c, "ـ+", ""), r"(?<![\p{L}\p{N}_])[A-Za-z]+-" + SPACE + "*", " ")
    return clean_conservative(squash(x, 10))


def strip_annotations(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[\[{(][^\]})]{0,60}[\]})]", " "), r"[ \t]{2,}", " "))


def language_code(tag: Column) -> Column:
    codes = F.create_map(*(F.lit(x) for kv in LANGUAGE_CODES.items() for x in kv))
    key = F.lower(F.trim(tag))
    return F.coalesce(F.try_element_at(codes, key), F.try_element_at(codes, F.split(key, "_")[0]), F.lit("unknown"))


def safe_language(code: Column) -> Column:
    return F.when(code.isNull() | code.isin("unknown", "und", "xx", "", "None"), "en").otherwise(code)


def script_of(lang: Column) -> Column:
    scripts = F.create_map(*(F.lit(x) for kv in SCRIPTS.items() for x in kv))
    return F.coalesce(F.try_element_at(scripts, lang), F.lit("Latn"))
