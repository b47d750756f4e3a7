"""Title terms and description cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import settings as S
from ..rules import wording as W
from .text import replace_all, strip


def translate_title(c: Column, terms=W.TITLE_TERMS, case_sensitive=W.CASE_SENSITIVE_TERMS) -> Column:
    """Ordered term map over a product title."""
    return strip(replace_all(c, terms, case_sensitive=case_sensitive))


def clean_description(c: Column, source_keyword: str = S.Store.source_keyword,
                      kinds=W.UNWANTED_SENTENCES) -> Column:
    """Drop promotional sentences, then tidy the gaps they leave. Blank stays as it is.

    The look-behind lets a match begin at the start of a sentence only. Without it the same
    sentences go, but every character of a long one is tried as a start.
    """
    cleaned = c
    for kind in [source_keyword, *kinds]:
        cleaned = F.regexp_replace(cleaned, f"(?iUd)(?<![^<.!?])[^<.!?]*(?:{kind})[^<.!?]*[.!?]?", "")
    cleaned = F.regexp_replace(cleaned, r"[ \t]{2,}", " ")
    # An unbounded repeat of this group would use up the matcher's stack. Runs are shortened from 64
    # to 3 breaks at a time; seven times is enough for the longest string there can be.
    for _ in range(7):
        cleaned = F.regexp_replace(cleaned, r"(?iU)(?:<br\s*/?>|\n){64}", "\n\n\n")
    cleaned = F.regexp_replace(cleaned, r"(?iU)(?:<br\s*/?>|\n){3,256}", "<br>")
    return F.when(c == "", c).otherwise(strip(cleaned))


def context_hint(brand: Column, title: Column, make: Column, model: Column, year: Column) -> Column:
    """``brand | title in English | make | model | year``, blanks left out."""
    parts = [brand, translate_title(title), make, model, year]
    return F.concat_ws(" | ", *[F.nullif(p, F.lit("")) for p in parts])


def numbered_blocks(answer: Column, expected: Column) -> Column:
    """``[1] text [2] text`` to an array of ``expected`` texts; missing numbers are ``""``,
    a repeated number keeps its last text."""
    pattern = F.lit(r"(?s)\[([0-9]+)\]\s*(.*?)(?=\[[0-9]+\]|$)")
    wanted = F.when(expected > 0, F.sequence(F.lit(1), expected)).otherwise(
        F.array().cast("array<int>")
    )

    def cut(text: Column) -> Column:
        numbers, bodies = F.regexp_extract_all(text, pattern, F.lit(1)), F.regexp_extract_all(text, pattern, F.lit(2))
        return F.arrays_zip(numbers.alias("n"), bodies.alias("body"))

    def texts(blocks: Column) -> Column:
        def last_body(i: Column) -> Column:
            hits = F.filter(blocks, lambda b: b["n"].try_cast("bigint") == i)
            return F.coalesce(strip(F.try_element_at(hits, F.lit(-1))["body"]), F.lit(""))

        return F.transform(wanted, last_body)

    # The answer is cut once: within the lambda of a number it would be cut again for each number.
    return F.transform(F.transform(F.array(answer), cut), texts)[0]


def keep_source_if_blank(translated: Column, source: Column) -> Column:
    return F.coalesce(F.nullif(translated, F.lit("")), source)


def cache_key(c: Column) -> Column:
    return F.md5(F.encode(c, "utf-8"))
