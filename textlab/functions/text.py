"""Text column functions (all native Catalyst expressions except one Arrow UDF).

Fixed values that must equal the reference's behaviour are collected at the top.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ---------------------------------------------------------------------------
# Fixed values (must match the reference's Python semantics)
# ---------------------------------------------------------------------------
# Python's str.isspace() / re `\s` set: 29 BMP code points.  Java's `\s` covers
# only 6 and `(?U)\s` 25, so the class is spelled out.
PY_WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
# Word token: a maximal run of two or more "word" characters (letters, numbers,
# underscore), the meaning of `\b\w\w+\b` for Unicode strings.
WORD_TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Metadata enrichment prefixes and the value used for a missing field.
KEYWORD_PREFIX = "kw_"
COUNTRY_PREFIX = "c_"
MISSING_META = "unk"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# F1, F7, F8, F9
# ---------------------------------------------------------------------------
def clean_text(c) -> Column:
    """null -> "", any whitespace run -> one space, trimmed (F1)."""
    return F.trim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), PY_WHITESPACE_CLASS + "+", " "))


def token_count(c) -> Column:
    """Whitespace token count of an already cleaned text; empty -> 0."""
    c = _col(c)
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " "))).cast("int")


def enrich_text(keyword, country, text, use_meta: bool = True) -> Column:
    """`kw_<keyword> c_<country> <text>` with missing parts -> unk / unk / "" (F8)."""
    body = F.coalesce(_col(text), F.lit(""))
    if not use_meta:
        return body
    return F.concat(
        F.lit(KEYWORD_PREFIX), F.coalesce(_col(keyword), F.lit(MISSING_META)),
        F.lit(" " + COUNTRY_PREFIX), F.coalesce(_col(country), F.lit(MISSING_META)),
        F.lit(" "), body,
    )


def truncate_tokens(c, max_tokens: int) -> Column:
    """Keep the first ``max_tokens`` whitespace tokens of a cleaned text."""
    c = _col(c)
    return F.when(c == "", c).otherwise(F.array_join(F.slice(F.split(c, " "), 1, int(max_tokens)), " "))


# ---------------------------------------------------------------------------
# Lowercase + strip accents (NFKD, drop combining characters)
# ---------------------------------------------------------------------------
def _strip_accents_py(s: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, str]:
    """Derived by rule from the Unicode database of this Python.

    Returns (source, target, multi): every BMP character whose accent-stripped
    form is one character (or nothing) is a native ``translate`` entry; the
    characters in ``multi`` have a longer form (ligatures, Hangul syllables,
    compatibility sequences) and are left to the Python fallback.
    """
    src, dst, dels, multi = [], [], [], []
    for cp in range(0x80, 0x10000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        out = _strip_accents_py(ch)
        if out == ch:
            continue
        if out == "":
            dels.append(ch)
        elif len(out) == 1:
            src.append(ch)
            dst.append(out)
        else:
            multi.append(ch)
    return "".join(src) + "".join(dels), "".join(dst), "".join(multi)


@F.pandas_udf(StringType())
def _strip_accents_udf(s: pd.Series) -> pd.Series:
    return s.map(lambda v: None if v is None else _strip_accents_py(v))


def normalize_text(c) -> Column:
    """Lowercase, then remove accents the way NFKD + drop-combining does.

    Rows whose non-ASCII characters all map to at most one character are handled
    by a native ``translate``; only the texts of rows with a multi-character
    decomposition or a supplementary character go through the Arrow UDF, which
    sees all others as null.  Membership is tested with ``translate`` (a hash
    lookup per character) rather than a regex class of thousands of ranges.
    """
    src, dst, multi = _accent_tables()
    low = F.lower(_col(c))
    needs_python = (F.length(F.translate(low, multi, "")) < F.length(low)) | low.rlike(r"[\x{10000}-\x{10ffff}]")
    # An extracted Python UDF runs on every row of its batch whatever the
    # surrounding CASE says, so rows that do not need it are sent as null.
    slow = _strip_accents_udf(F.when(needs_python, low))
    return (
        F.when(~low.rlike(r"[^\x00-\x7f]"), low)
        .when(needs_python, slow)
        .otherwise(F.translate(low, src, dst))
    )


# ---------------------------------------------------------------------------
# T2, T3
# ---------------------------------------------------------------------------
def word_tokens(c) -> Column:
    """Maximal runs of >= 2 word characters."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_TOKEN_PATTERN), 0)


# Every "token<space>token" pair of a space-joined token list, one match per
# token start (the lookahead lets consecutive pairs overlap).
BIGRAM_PATTERN = r"(?:^| )(?=([^ ]+ [^ ]+))"


def ngrams_1_2(tokens) -> Column:
    """Unigrams followed by space-joined bigrams of adjacent tokens.

    Tokens contain no spaces, so the bigrams are read off the space-joined
    list with one native regex pass (no interpreted lambda per element).
    """
    t = _col(tokens)
    bigrams = F.regexp_extract_all(F.array_join(t, " "), F.lit(BIGRAM_PATTERN), 1)
    return F.concat(t, bigrams)


def analyzed_terms(c) -> Column:
    """Text -> uni+bigram terms, the full analyzer chain T1 -> T2 -> T3."""
    return ngrams_1_2(word_tokens(normalize_text(c)))
