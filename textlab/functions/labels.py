"""Label / id column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Whole-field tokens that the reference's CSV reader turns into missing values
# (its library's default NA list; case-sensitive).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
# Severity labels run 0..4; a record is positive from this level up.
SEVERITY_MIN, SEVERITY_MAX, SEVERITY_POSITIVE = 0, 4, 2
ARTICLE_PREFIX = "@@"
# A decimal or scientific number as data files write it.
DECIMAL_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"
# A number literal: whole ones have no leading zeros, digits may be grouped by underscores.
NUMBER_PATTERN = r"^[+-]?(0+|[1-9][0-9]*(_[0-9]+)*|[0-9]+(\.[0-9]*)([eE][+-]?[0-9]+)?|[0-9]+[eE][+-]?[0-9]+|\.[0-9]+([eE][+-]?[0-9]+)?)\z"
BASED_PATTERN = r"^[+-]?0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)\z"
# Literals that are neither numbers nor lists: imaginary numbers, byte and other strings, sets and mappings, constants.
OTHER_LITERALS = r"^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[jJ]|[bBrRuU]{0,2}('[^']*'|\"[^\"]*\")|\{.*\}|False|None|Ellipsis|\.\.\.)\z"
SPACES = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# A list of whole numbers as they are usually written.
WHOLE_LIST = r"^\[[+-]?(0|[1-9][0-9]*)(, ?[+-]?(0|[1-9][0-9]*))*\]\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c) -> Column:
    """Whole-field NA tokens -> null."""
    c = _col(c)
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def article_id(c) -> Column:
    """`@@123` -> 123 (F2); anything else -> null."""
    c = _col(c)
    return F.when(c.rlike(r"^@@[0-9]+\z"), F.regexp_replace(c, ARTICLE_PREFIX, "").try_cast("bigint"))


def decimal(c) -> Column:
    """A decimal number's value, null for any other text (hexadecimal floats and type suffixes included)."""
    return F.when(_col(c).rlike(DECIMAL_PATTERN), _col(c)).try_cast("double")


def to_label(c) -> Column:
    """Raw severity text -> int, truncated toward zero; unparsable -> null."""
    return decimal(c).try_cast("int")


def severity_to_binary(c, level: int = SEVERITY_POSITIVE) -> Column:
    """`severity >= level` as 0/1."""
    return (_col(c) >= level).cast("int")


def binarize_label(c) -> Column:
    """Scalar or list label text -> 0/1.

    Rules, in order, on the text without surrounding white space: null -> 0;
    "0"/"1" -> itself; a list or tuple of numbers (bracketed or bare, a
    trailing comma allowed, whole numbers possibly quoted) -> 1 when any
    element truncated to int is non-zero; a number (or True) -> value > 0; any
    other literal (string, bytes, imaginary, set, mapping, None, False) -> 0;
    text that is not a literal -> 1 when it contains the digit 1.  Lists with
    elements that are no numbers, which the reference rejects with an error,
    take the digit rule.
    """
    raw = _col(c)
    t = F.regexp_replace(raw, rf"^{SPACES}+|{SPACES}+\z", "")
    parens = t.startswith("(") & t.endswith(")")
    is_tuple = parens & (t.contains(",") | (t == "()"))
    bare = ~parens & t.contains(",") & ~t.rlike(r"^[\[{]")
    # to a JSON list: tuple brackets, bare tuples, Python booleans, unary plus, quoted whole numbers, trailing comma
    listed = F.when(is_tuple, F.concat(F.lit("["), F.regexp_replace(t, r"^\(|\)\z", ""), F.lit("]")))
    listed = listed.when(bare, F.concat(F.lit("["), t, F.lit("]"))).otherwise(t)
    for pattern, to in (
        (r"\bTrue\b", "1"), (r"\bFalse\b", "0"), (r"(['\"])\s*([+-]?[0-9]+)\s*\1", "$2"),
        (r"(^|[\[,\s])\+(?=[0-9.])", "$1"), (r",\s*\]\z", "]"),
    ):
        listed = F.regexp_replace(listed, pattern, to)
    arr = F.when(listed.rlike(r"(?s)^\[.*\]\z"), F.from_json(listed, "array<double>"))
    list_hit = F.exists(arr, lambda x: x.cast("bigint") != 0).cast("int")
    # A parenthesised scalar "(x)" is just x.
    scalar = F.when(parens & ~is_tuple, F.regexp_replace(t, r"^\(\s*|\s*\)\z", "")).otherwise(t)
    num = F.when(scalar.rlike(NUMBER_PATTERN), F.regexp_replace(scalar, "_", "").try_cast("double"))
    based = scalar.rlike(BASED_PATTERN)
    based_hit = (~scalar.startswith("-") & F.regexp_replace(scalar, r"^[+-]?0[a-zA-Z]", "").rlike("[1-9a-fA-F]")).cast("int")
    return (
        F.when(raw.isNull(), F.lit(0))
        # the usual forms, told by one look: a digit, or a list of plain whole numbers
        .when(raw.isin("0", "1"), raw.try_cast("int"))
        .when(raw.rlike(WHOLE_LIST), raw.rlike("[1-9]").cast("int"))
        .when(t.isin("0", "1"), t.try_cast("int"))
        .when(arr.isNotNull() & ~F.exists(arr, lambda x: x.isNull()), list_hit)
        .when(num.isNotNull(), (num > 0).cast("int"))
        .when(based, based_hit)
        .when(scalar == "True", F.lit(1))
        .when(scalar.rlike("(?s)" + OTHER_LITERALS), F.lit(0))
        .otherwise(t.rlike("1").cast("int"))
        .cast("int")
    )


def label_raw(c) -> Column:
    """Raw label kept as text; missing -> 'nan' as the reference writes it."""
    return F.coalesce(_col(c).cast("string"), F.lit("nan"))
