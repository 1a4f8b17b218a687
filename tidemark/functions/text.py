"""Normalisation of dates, labels and names, and the reason vocabulary, as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Date formats, in the order in which they are tried.
DATE_FORMATS = ("MMMM d, yyyy", "MMM d, yyyy", "yyyy-M-d", "M/d/yyyy", "d MMMM yyyy", "MMMM yyyy")
#: Fixed value: what a label looks like.
TICKER_PATTERN = r"^[A-Z0-9]{1,6}(\.[A-Z])?$"
#: Legal-form and share-class words that a name key leaves out.
NAME_SUFFIXES = (
    "incorporated", "inc", "corporation", "corp", "company", "co", "companies", "cos", "limited", "ltd", "plc", "llc", "lp", "l p", "holdings", "holding", "hldgs",
    "sa", "nv", "ag", "se", "cl a", "cl b", "class a", "class b", "class c", "and co", "& co",
)
#: The reason vocabulary and its patterns, in the order in which they are tried.
REASON_PATTERNS = (
    ("ticker_or_name_change", r"\b(ticker|symbol)\b.*\b(chang|switch)|\bchanged (its )?(name|ticker)|\brenam"),
    ("bankruptcy", r"\bbankrupt|\bchapter (11|7)\b|\binsolven|\breceivership|\bliquidat"),
    ("spinoff", r"\bspin[- ]?(off|out)|\bspun[- ]?(off|out)|\bsplit[- ]off|\bseparat(ed|ion) (from|of)|\bcarve[- ]?out"),
    ("going_private", r"\b(taken|went|going|take|go) private|\bprivate equity|\bbuyout\b|\bmanagement[- ]led"),
    ("merger", r"\bmerg(e|ed|er|ing)\b|\bcombin(ed|ation)\b|\bamalgamat"),
    ("acquisition", r"\bacqui(r|s)|\bbought\b|\bpurchas|\btakeover|\btook over|\btender offer|\bcompleted (its|the) (purchase|deal)"),
    ("delisting", r"\bdelist|\bsuspend|\bhalt|\bceased trading|\bexchange (removed|listing)"),
    ("index_rebalancing_reclassification", r"\bmidcap|\bmid[- ]cap|\bsmallcap|\bsmall[- ]cap|\bs&p 400|\bs&p 600|\bmoved to|\breclassif|\brebalanc|\bindex (change|reorgan)|\breorgani[sz]ed|\bindustr(y|ies) (representation|balance)|\bfewer"),
    ("market_cap_eligibility", r"\bmarket[- ]cap|\bcapitali[sz]ation|\bno longer (representative|eligible|qualif)|\beligib|\bfloat|\bliquidity|\bsize\b"),
    ("corporate_restructuring", r"\brestructur|\breorganiz|\brecapitali|\bholding company|\bconver(ted|sion) to|\bdomicile|\bredomicil|\bmoved (its )?(headquarters|hq|domicile)"),
    ("new_listing", r"\bipo\b|\binitial public offering|\bnewly (listed|public)|\bdirect listing"),
)
OTHER_REASON = "other_unknown"
REASONS = tuple(c for c, _ in REASON_PATTERNS) + (OTHER_REASON,)

_FOOTNOTE = r"\[[^\]]*\]"
_SUFFIX = r"\b(" + "|".join(sorted(NAME_SUFFIXES, key=len, reverse=True)) + r")\b"


def strip_footnotes(c: Column) -> Column:
    """Without [notes], white space collapsed and trimmed; null gives ''."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), _FOOTNOTE, ""), r"[\s ]+", " "))


def clean_display_name(c: Column) -> Column:
    return strip_footnotes(c)


def parse_date(c: Column) -> Column:
    """The date in any of DATE_FORMATS, a trailing parenthesis ignored; null if in none."""
    plain = F.regexp_replace(strip_footnotes(c), r"\s*\([^)]*\)\s*$", "")
    return F.coalesce(*[F.try_to_date(plain, f) for f in DATE_FORMATS])


def normalize_ticker(c: Column) -> Column:
    """Upper case, share class after a dot; '' for an empty label, null for what isn't one."""
    t = F.upper(F.regexp_replace(strip_footnotes(c), r"[\s ]", ""))
    t = F.regexp_replace(F.translate(t, "-/", ".."), r"\|+$", "")
    return F.when((t == "") | t.rlike(TICKER_PATTERN), t)


def compare_key(c: Column) -> Column:
    """A label without dots and dashes, in upper case."""
    return F.upper(F.translate(c, ".-", ""))


def _ascii(s: pd.Series) -> pd.Series:
    plain = s.map(lambda x: x is None or x.isascii())
    return s.where(plain, s[~plain].map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()))


def _to_ascii(c: Column) -> Column:
    """Compatibility decomposition without what isn't ASCII. All texts go through an Arrow batch, the ASCII ones unchanged."""
    return F.pandas_udf(_ascii, "string")(c)


def normalize_name(c: Column, ascii_only: bool = False) -> Column:
    """The key by which names are matched; '' for a name of legal forms only. ascii_only: the names are known to be ASCII, so no Python runs."""
    s = strip_footnotes(c)
    if not ascii_only:
        s = _to_ascii(s)
    s = F.regexp_replace(F.lower(s), r"\(.*?\)", " ")
    s = F.trim(F.regexp_replace(F.regexp_replace(F.replace(s, F.lit("&"), F.lit(" and ")), "[^a-z0-9 ]+", " "), " +", " "))

    def once(x: Column) -> Column:
        x = F.regexp_replace(F.regexp_replace(x, "^the ", ""), _SUFFIX, " ")
        return F.trim(F.regexp_replace(F.trim(F.regexp_replace(x, " +", " ")), r"\band$", ""))

    # a fold, so that each round is evaluated once; a round that changes the key takes a word off it at least
    return F.aggregate(F.sequence(F.lit(1), F.size(F.split(s, " "))), s, lambda x, _: once(x))


def classify_reason(c: Column) -> Column:
    """The first category whose pattern occurs in the text."""
    text = F.coalesce(c, F.lit(""))
    out = F.when(F.trim(text) == "", OTHER_REASON)
    for category, pattern in REASON_PATTERNS:
        out = out.when(text.rlike("(?i)" + pattern), category)
    return out.otherwise(OTHER_REASON)


def digits_or_null(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]+$"), c)


def joined(c: Column, by: str = ";") -> Column:
    return F.array_join(c, by)


def split_list(c: Column, by: str = ";") -> Column:
    """The parts of a joined list; null and '' give an empty one."""
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(c, by))
