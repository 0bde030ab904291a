"""Prompt, extraction and display expressions over text columns."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritally import fixed_values as V


def build_prompt(question: Column, null_text: str | None = None) -> Column:
    """The prompt for a question; NULL stays NULL unless ``null_text`` stands in for it."""
    if null_text is not None:
        question = F.coalesce(question, F.lit(null_text))
    return F.concat(F.lit(V.PROMPT_PREFIX), question, F.lit(V.PROMPT_SUFFIX))


def normalize_number(captured: Column) -> Column:
    """Drop thousands commas and cast; anything that is not a number, '' included, is NULL."""
    return F.replace(captured, F.lit(","), F.lit("")).try_cast("double")


def _first_capture(text: Column, pattern: str) -> Column:
    """The first capture of ``pattern``, NULL without a hit.

    ``regexp_extract`` gives '' instead, and either testing for that or casting it
    costs more than the search: the test runs the search again, the cast throws.
    """
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


@cache
def _folding(ignore_case: bool) -> tuple[str, str]:
    """Signs that count as digits and spaces to patterns over Unicode text, and the ASCII ones they stand for; with
    ``ignore_case`` also those that count as an ASCII letter without case."""
    signs = {chr(c): str(unicodedata.decimal(chr(c))) for c in range(128, sys.maxunicode) if unicodedata.decimal(chr(c), None) is not None}
    signs |= {chr(c): " " for c in range(sys.maxunicode) if chr(c).isspace() and chr(c) not in " \t\n\x0b\f\r"}
    if ignore_case:
        signs |= V.LETTERS_WITHOUT_CASE
    return "".join(signs), "".join(signs.values())


def fold_unicode(text: Column, ignore_case: bool = False) -> Column:
    """``text`` with digits and spaces of all scripts as ASCII ones, in one pass inside the JVM. The patterns, which know ASCII
    only, then find in it what they would find by the rules of Unicode, and the numbers can be cast."""
    return F.translate(text, *_folding(ignore_case))


def extract_gold(answer: Column, unicode: bool = False) -> Column:
    """The number after the gold marker, or NULL. With ``unicode`` digits and spaces of all scripts count."""
    return normalize_number(_first_capture(fold_unicode(answer) if unicode else answer, V.GOLD_PATTERN))


def _ignore_case(pattern: str) -> str:
    return "(?i)" + pattern


def extract_prediction(completion: Column, unicode: bool = False) -> Column:
    """The number a completion ends up with: patterns by priority, first hit inside each. With ``unicode`` digits, spaces and
    letters without case are those of Unicode.

    ``coalesce`` stops at the first pattern that hits, so most rows run one or two searches.
    """
    completion = fold_unicode(completion, ignore_case=True) if unicode else completion
    captures = (_first_capture(completion, _ignore_case(p)) for p in V.COMPLETION_PATTERNS)
    return normalize_number(F.coalesce(*captures))


def matched_pattern(completion: Column) -> Column:
    """1-based rank of the pattern that decides the prediction, or NULL."""
    rank = F.when(F.lit(False), F.lit(0))
    for i, p in enumerate(V.COMPLETION_PATTERNS, start=1):
        rank = rank.when(F.regexp_like(completion, F.lit(_ignore_case(p))), F.lit(i))
    return rank


def truncate_text(text: Column, n: int = V.ELLIPSIS_LENGTH) -> Column:
    """``text`` cut to ``n`` code points plus an ellipsis, if it is longer than that."""
    return F.when(
        F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(V.ELLIPSIS))
    ).otherwise(text)


def verdict_label(is_match: Column) -> Column:
    return F.when(is_match, F.lit("Yes")).otherwise(F.lit("No"))


def number_text(x: Column) -> Column:
    """A double as Python writes it: ``18.0``, ``0.0005``, ``1e+16``, ``-0.0``, ``inf``, ``nan``.

    No exponent from 1e-4 up to 1e16. The digits are those of the cast to text.
    """
    text = x.cast("string")
    size = F.abs(x)
    plain = lambda scale: F.rtrim(text.try_cast(f"decimal(38,{scale})").cast("string"), F.lit("0"))
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+"))
    digits = F.abs(power).cast("string")
    exponent = F.concat(mantissa, sign, F.when(F.length(digits) < 2, F.concat(F.lit("0"), digits)).otherwise(digits))
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.when(x < 0, F.lit("-inf")).otherwise(F.lit("inf")))
        .when(size == 0, F.when(text.startswith("-"), F.lit("-0.0")).otherwise(F.lit("0.0")))
        .when((size < 1e16) & (x == F.floor(x)), F.concat(x.try_cast("bigint").cast("string"), F.lit(".0")))
        .when((size >= 1e7) & (size < 1e16), plain(18))
        .when((size >= 1e-4) & (size < 1e-3), plain(25))
        .when((size >= 1e16) | (size < 1e-4), exponent)
        .otherwise(text)
    )


def pad_right(text: Column, width: int) -> Column:
    """``text`` filled with spaces to ``width``; longer text is kept whole."""
    return F.concat(text, F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(text))))


def escape_markdown_cell(text: Column) -> Column:
    """Keep a table cell on one line and in one column."""
    one_line = F.regexp_replace(text, r"\r\n|\r|\n", "<br>")
    return F.replace(one_line, F.lit("|"), F.lit("\\|"))


def fixed_decimals(x: Column, digits: int = V.DECIMALS) -> Column:
    """A number as text with ``digits`` decimals and no thousands separator.

    Rounds the exact binary value, ties to even, as C and Python formatting do. The whole part and what is
    left of it are exact; the product of the rest with the power of ten is rounded itself, so the side of
    the tie is taken from the two halves of the rest, whose products are exact. From 2^63 on a double
    is a whole number, of which only the first 17 digits are written exactly.
    """
    scale = float(10**digits)
    size = F.abs(x)
    whole = F.floor(F.when(size < 9.2e18, size))
    rest = size - F.floor(size).cast("double")
    below = F.floor(rest * scale)
    high = rest * 134217729.0 - (rest * 134217729.0 - rest)
    past_half = (high * scale - (below + F.lit(0.5))) + (rest - high) * scale
    even = whole if digits == 0 else below
    up = (past_half > 0) | ((past_half == 0) & (even % 2 == 1))
    units = below + up.cast("bigint")
    carried = whole + F.floor(units / F.lit(10**digits)).cast("bigint")
    decimals = F.concat(F.lit("."), F.lpad((units % 10**digits).cast("string"), digits, "0")) if digits else F.lit("")
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(F.isnan(x), F.lit("nan"))
        .when(size == float("inf"), F.concat(sign, F.lit("inf")))
        .when(size < 9.2e18, F.concat(sign, carried.cast("string"), decimals))
        .when(x.isNotNull(), F.format_string(f"%.{digits}f", x))
    )
