"""Text columns: stripping, case, slugs, localised numbers, tags of markup.

Regex dialect: ``(?U)`` gives ``\\w \\s \\b`` their Unicode meaning.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# No character from here on has a compatibility form with ASCII in it.
LAST_FOLDED = 0x20000
WORD_SPLIT = r"(?U)([^\p{L}]+|\p{L}+)"


def strip(c: Column) -> Column:
    """Drop white space of every kind at both ends (``trim`` drops spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(c: Column) -> Column:
    """The stripped text, or NULL where it is blank."""
    return F.nullif(strip(c), F.lit(""))


def first_filled(*cs: Column) -> Column:
    """First non-blank text, stripped; ``""`` where all are blank."""
    return F.coalesce(*[filled(c) for c in cs], F.lit(""))


def text_or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def title_case(c: Column) -> Column:
    """Capital after every non-letter: ``2nd`` -> ``2Nd``, ``sc-project`` -> ``Sc-Project``."""
    pieces = F.regexp_extract_all(c, F.lit(WORD_SPLIT), F.lit(1))
    return F.array_join(F.transform(pieces, F.initcap), "")


def tag_slug(c: Column) -> Column:
    """``SC-Project`` -> ``SC_Project``; case is kept."""
    words = F.regexp_replace(strip(c), r"(?U)[^\w]", "_")
    return F.regexp_replace(F.regexp_replace(words, r"_+", "_"), r"^_+|_+$", "")


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, str]:
    """Compatibility folding to ASCII as a rule over Unicode: characters that fold to one
    ASCII character (two aligned strings), and the others as ``char=text`` pairs."""
    source, target, longer = [], [], []
    for code in range(0x80, LAST_FOLDED):
        char = chr(code)
        folded = unicodedata.normalize("NFKD", char)
        if folded == char:
            continue
        ascii_text = folded.encode("ascii", "ignore").decode("ascii")
        if len(ascii_text) == 1:
            source.append(char)
            target.append(ascii_text)
        elif ascii_text:
            longer.append(f"{char}\u0001{ascii_text}")
    return "".join(source), "".join(target), "\u0002".join(longer)


def ascii_fold(c: Column) -> Column:
    """Accents and compatibility forms folded to ASCII; what has no ASCII form is dropped."""
    source, target, longer = _folding()
    single = F.translate(c, source, target)
    table = F.str_to_map(F.lit(longer), F.lit("\u0002"), F.lit("\u0001"))
    by_char = F.array_join(
        F.transform(F.split(single, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    folded = F.when(single.rlike(r"[^\x00-\x7F]"), by_char).otherwise(single)
    plain = F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)
    return F.regexp_replace(plain, r"[^\x00-\x7F]+", "")


def url_slug(c: Column) -> Column:
    """``Akrapovič Slip-On`` -> ``akrapovic-slip-on``."""
    hyphenated = F.regexp_replace(F.lower(ascii_fold(c)), r"[^a-z0-9]+", "-")
    return F.regexp_replace(hyphenated, r"^-+|-+$", "")


def parse_price(c: Column) -> Column:
    """Localised price text to double; 0 where it is not a number.

    ``€ 1.299,00`` -> 1299, ``1.299`` -> 1299, ``649,95`` -> 649.95, ``1,299.00`` -> 0.
    """
    bare = F.regexp_replace(c, r"(?U)[€$£\s]", "")
    no_thousands = F.when(bare.rlike(r"[0-9]\.[0-9]{3}"), F.replace(bare, F.lit("."), F.lit("")))
    dotted = F.replace(F.coalesce(no_thousands, bare), F.lit(","), F.lit("."))
    digits = F.regexp_replace(dotted, r"[^0-9.]", "")
    number = F.when(digits.rlike(r"^(?:[0-9]+\.?[0-9]*|\.[0-9]+)$"), digits.try_cast("double"))
    return F.coalesce(number, F.lit(0.0))


def plain_number(c: Column) -> Column:
    """Text that is a plain decimal number, as double; NULL otherwise."""
    bare = strip(c)
    return F.when(
        bare.rlike(r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"),
        bare.try_cast("double"),
    )


def strip_tags(c: Column) -> Column:
    """Markup replaced by a space, ends stripped."""
    return strip(F.regexp_replace(c, r"<[^>]+>", " "))


def replace_all(c: Column, rules, flags="(?iUd)", case_sensitive=frozenset()) -> Column:
    """Fold of ordered ``(pattern, replacement)`` rules."""
    for pattern, replacement in rules:
        prefix = "(?Ud)" if pattern in case_sensitive else flags
        c = F.regexp_replace(c, prefix + pattern, replacement)
    return c


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Value of a small fixed dictionary, NULL where the key is unknown."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def search_any(c: Column, pattern: str) -> Column:
    """Case-insensitive search with Unicode classes."""
    return c.rlike("(?iUd)" + pattern)
