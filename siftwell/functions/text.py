"""Text functions on columns: normal form, entity slots, tokens, shingles, similarity, keys.

Python regular expressions know all of Unicode by default and Java's do not, so classes are spelled out.
Every function takes and gives a Column; null counts as an empty text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache
from importlib import resources

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Slot marks, and the patterns that they stand for, in the order of their use.
SLOTS = ("<ticker>", "<num>", "<date>", "<stock>")
CJK = "[\u4e00-\u9fff]"
# Characters that NFKC leaves as they are and never composes with each other: ASCII, accented letters, dashes, quotes, CJK and its stops.
STABLE = r"\x00-\x7F\xA1\xA7\xAB\xB0\xBB\xBF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E\u2013\u2014\u2018-\u201D\u3001\u3002\u4e00-\u9fff"
SLOT_PATTERNS = (
    (r"(?iu)\$[a-z][a-z0-9.\-]*", "<ticker>"),
    (r"(?iu)(?:\$|us\$|hk\$|rmb|人民币|美元|港币|元)(?U:\s)*\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?", "<num>"),
    (r"(?iu)\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?(?U:\s)*%", "<num>"),
    (r"(?iu)\p{Nd}{4}[-/]\p{Nd}{1,2}[-/]\p{Nd}{1,2}|\p{Nd}{1,2}[-/]\p{Nd}{1,2}[-/]\p{Nd}{2,4}|\p{Nd}{1,4}年\p{Nd}{1,2}月(?:\p{Nd}{1,2}日)?", "<date>"),
    (r"(?iu)(?<![0-9a-z一-鿿])\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?(?![0-9a-z一-鿿])", "<num>"),
)

_SPACE = r"(?U)[\s\x1C-\x1F]+"


@lru_cache(maxsize=1)
def entity_names() -> tuple[str, ...]:
    """Names of the dictionary, longest first, so that a full name goes before its short form."""
    lines = resources.files("siftwell.functions").joinpath("entity_names.txt").read_text(encoding="utf-8").splitlines()
    return tuple(sorted({x.strip() for x in lines if x.strip() and not x.startswith("#")}, key=lambda x: (-len(x), x)))


def _compatible(text: pd.Series) -> pd.Series:
    return text.map(lambda x: x if x is None else unicodedata.normalize("NFKC", x))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also where use has it inside a function of array items."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def collapse(text: Column) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def normalize_question(text: Column, compatible: bool = True) -> Column:
    """NFKC, then white space collapsed. Only texts with characters that NFKC may change leave the JVM for it.

    With compatible = False that step is left out, for texts known to be in this form.
    """
    text = text_or_empty(text)
    if compatible:
        nfkc = F.pandas_udf(_compatible, "string", F.PandasUDFType.SCALAR)
        text = F.coalesce(nfkc(F.when(text.rlike(f"[^{STABLE}]"), text)), text)
    return collapse(text)


def slot_entities(normal: Column, names: tuple[str, ...] | None = None) -> Column:
    """A normalised text whose names, tickers, amounts, percentages, dates and numbers are slots."""
    names = entity_names() if names is None else names
    out = normal
    if names:
        out = F.regexp_replace(out, "|".join(re.escape(n) for n in names), " <stock> ")
    for pattern, slot in SLOT_PATTERNS:
        out = F.regexp_replace(out, pattern, f" {slot} ")
    return collapse(out)


def tokens(slotted: Column, slots: bool = True) -> Column:
    """The distinct tokens of a text: slots, words, and CJK characters one by one."""
    low = F.lower(slotted)
    words = F.split(low, " ")
    plain = F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{N}_ ]+", " "), f"({CJK})", " $1 ")
    if not slots:
        return F.array_remove(F.array_distinct(F.split(plain, " +")), "")
    marked = F.filter(words, lambda w: w.isin(*SLOTS))
    rest = F.filter(words, lambda w: ~w.isin(*SLOTS))
    rest = F.regexp_replace(F.regexp_replace(F.array_join(rest, " "), r"[^\p{L}\p{N}_ ]+", " "), f"({CJK})", " $1 ")
    return F.array_remove(F.array_distinct(F.concat(marked, F.split(rest, " +"))), "")


def slot_counts(slotted: Column) -> Column:
    """How often each slot stands in a text: an array of SLOTS' length."""
    words = F.split(F.lower(slotted), " ")

    def count(slot: str) -> Column:
        return F.size(F.filter(words, lambda w: w == slot))

    return F.array(*map(count, SLOTS))


def shared_slot_counts_equal(left: Column, right: Column) -> Column:
    """Whether slots that both texts have occur equally often."""
    return F.forall(F.zip_with(left, right, lambda a, b: (a == 0) | (b == 0) | (a == b)), lambda x: x)


def jaccard(left: Column, right: Column) -> Column:
    """Of two distinct token arrays; 0 if either is empty."""
    common = F.size(F.array_intersect(left, right))
    return F.when((F.size(left) == 0) | (F.size(right) == 0), 0.0).otherwise(common / (F.size(left) + F.size(right) - common))


def length_without_signs(text: Column) -> Column:
    """Characters that are no punctuation, symbol or separator."""
    return F.length(F.regexp_replace(text_or_empty(text), r"[\p{P}\p{S}\p{Z}]", ""))


def cjk_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(CJK))


def cjk_ratio(text: Column) -> Column:
    text = text_or_empty(text)
    return F.when(F.length(text) == 0, 0.0).otherwise(cjk_count(text) / F.length(text))


def phrases(text: Column, words: int = 8, chars: int = 8) -> Column:
    """Distinct shingles: of characters without white space where there is CJK, else of words."""
    text = text_or_empty(text)
    by_word = let(
        F.array_remove(F.split(collapse(text), " "), ""),
        lambda ws: F.when(F.size(ws) >= words, F.transform(F.sequence(F.lit(1), F.size(ws) - words + 1), lambda i: F.array_join(F.slice(ws, i, words), " "))),
    )
    by_char = let(
        F.regexp_replace(text, _SPACE, ""),
        lambda t: F.when(F.length(t) >= chars, F.transform(F.sequence(F.lit(1), F.length(t) - chars + 1), lambda i: F.substring(t, i, F.lit(chars)))),
    )
    return F.array_distinct(F.coalesce(F.when(text.rlike(CJK), by_char).otherwise(by_word), F.array().cast("array<string>")))


def grounding_form(text: Column) -> Column:
    """White space gone, full-width stops, commas, colons and semicolons as their plain forms."""
    return F.regexp_replace(F.translate(text_or_empty(text), "，。、：；", ",.,:;"), _SPACE, "")


def grounded(quotes: Column, question: Column) -> Column:
    """Whether there are quotes and each is copied from the question."""
    return (F.size(quotes) > 0) & let(grounding_form(question), lambda form: F.forall(quotes, lambda q: F.contains(form, grounding_form(q))))


def content_key(*parts: Column) -> Column:
    """A SHA-256 of parts that no other split of the same characters gives."""
    pieces = [F.concat(F.length(text_or_empty(p)).cast("string"), F.lit(":"), text_or_empty(p)) for p in parts]
    return F.sha2(F.concat(*pieces), 256)


def json_text(raw: Column) -> Column:
    """The JSON object that a text holds, also between code fences; null if there is none."""
    fenced = F.regexp_extract(raw, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    is_object = lambda x: F.when(F.coalesce(F.schema_of_variant(F.try_parse_json(x)).startswith("OBJECT"), F.lit(False)), x)
    return F.coalesce(is_object(F.trim(raw)), is_object(F.nullif(fenced, F.lit(""))))


def json_object(raw: Column, schema: str) -> Column:
    """A JSON object, also between code fences, by schema; null if there is none."""
    return F.from_json(json_text(raw), schema, {"mode": "PERMISSIVE"})


def lax_boolean(value: Column) -> Column:
    """A boolean, or one of its usual words, as text; null for anything else."""
    word = F.lower(F.trim(value))
    return F.when(word.isin("true", "1", "yes", "y", "on", "t"), True).when(word.isin("false", "0", "no", "n", "off", "f"), False)


def epoch_millis(text: Column, zone: str = "Asia/Shanghai") -> Column:
    """Milliseconds of an ISO time; one without an offset is local to zone; null if it is none."""
    text = F.trim(text_or_empty(text))
    basic = F.regexp_replace(text, r"\A(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})\z", "$1-$2-$3T$4:$5:$6")
    aware = basic.rlike(r"(?:Z|[+-]\d{2}:?\d{2})\z")
    stamp = F.try_to_timestamp(basic)
    local = F.to_utc_timestamp(F.try_to_timestamp(F.concat(basic, F.when(F.length(basic) <= 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z")))), zone)
    dated = basic.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}(?:[ T]|\z)")
    return F.unix_millis(F.when(dated, F.when(aware, stamp).otherwise(local)))
